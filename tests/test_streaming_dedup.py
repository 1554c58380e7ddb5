import random

from pyspark.sql import functions as F

from clickloom.operators import cleaning as C
from clickloom.streaming import events as St
from tests.helpers import events


def _run(spark, df, folder, batches, delay):
    """``df`` as a stream of ``batches`` files; each row in the file of its column ``_file``."""
    for i in range(batches):
        df.where(F.col("_file") == i).drop("_file").coalesce(1).write.mode("append").parquet(str(folder / "in"))
    name = f"kept_{folder.name.replace('-', '_')}"
    src = St.stream_events(spark, str(folder / "in"), df.drop("_file").schema)
    q = (St.near_dedup(src, delay=delay).writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", str(folder / "state")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None
    return spark.table(name)


def _rows(df):
    return sorted((str(r["event_time"]), r["user_id"], r["product_id"], r["event_type"], r["user_session"], r["price"]) for r in df.collect())


def test_stream_keeps_what_the_batch_rule_keeps(spark, tmp_path):
    St.use_rocksdb(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        draw = random.Random(9)
        rows = [(draw.randrange(0, 1200) / 4, draw.choice(["view", "cart"]), draw.randrange(2), draw.randrange(3), draw.choice(["s", "t"]), draw.randrange(3) / 2)
                for _ in range(260)]
        rows += [(100, "view", 50, 1, "s"), (101, "view", 50, 1, "s"), (102, "view", 50, 1, "s"), (104, "view", 50, 1, "s"), (104, "view", 50, 1, "a")]
        rows += [(10_000, "view", 99, 99, "end"), (20_000, "view", 99, 99, "end")]  # they carry the watermark past all others
        df = events(spark, rows)
        batch = _rows(C.near_dedup(df.where("user_id <> 99")))
        assert 0 < len(batch) < 260
        # files in the order of time, rows up to 60 s apart shuffled between neighbouring files
        secs = F.unix_timestamp("event_time") - F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        wild = F.floor((secs + F.pmod(F.xxhash64("event_time", "user_id", "price"), F.lit(60))) / 75)
        put = df.withColumn("_file", F.when(secs >= 20_000, 7).when(secs >= 10_000, 6).otherwise(F.least(wild, F.lit(5))).cast("int"))
        got = _run(spark, put, tmp_path, 8, "70 seconds")
        assert _rows(got.where("user_id <> 99")) == batch
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
