import os
import tempfile

from pyspark.sql import functions as F

from clickloom.sources import files as Fl
from clickloom.streaming import events as St
from tests.helpers import events


def test_csv_bad_records_and_zone_parse(spark):
    d = tempfile.mkdtemp(prefix="clickloom-csv-")
    with open(os.path.join(d, "2020-Jan.csv"), "w") as fh:
        fh.write("event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n")
        fh.write("2020-01-01 00:00:05 UTC,view,1,2,a.b,x,3.5,7,s1\n")
        fh.write("2020-01-01 00:00:06 UTC,view,notanumber,2,a.b,,3.5,7,s1\n")
        fh.write("2020-01-01 01:00:00 UTC,cart,2,2,,y,4.0,8,\n")
    raw = Fl.read_raw_csv(spark, d).cache()
    assert Fl.check_bad_records(raw, max_bad=5) == 1
    # on the scan itself too, where Spark prunes columns
    assert Fl.check_bad_records(Fl.read_raw_csv(spark, d), max_bad=5) == 1
    parsed = Fl.parse_event_time(raw).filter(F.col(Fl.CORRUPT).isNull())
    rows = parsed.orderBy("product_id").collect()
    assert rows[1].category_code is None and rows[1].user_session is None
    assert parsed.select(F.unix_timestamp("event_time")).first()[0] == 1577836805
    # the file name is only known at the scan (not on a cached frame)
    assert Fl.months_from_file_stem(Fl.read_raw_csv(spark, d), ["2020-Jan"]).count() == 0


def test_month_window_loader_accepts_product_id(spark):
    df = events(spark, [(0, "view", 1, 1, "s"), (40 * 86400, "view", 2, 1, "s")])
    out = Fl.load_month_window(df, "2024-01").collect()
    assert len(out) == 1 and out[0].item_id == 1


def test_streaming_dedup_and_popularity(spark):
    d = tempfile.mkdtemp(prefix="clickloom-stream-")
    df = events(spark, [(0, "view", 1, 1, "s"), (0.4, "view", 1, 1, "s"), (3, "view", 1, 1, "s"),
                        (5, "cart", 2, 2, "t")])
    df.write.mode("overwrite").parquet(os.path.join(d, "in"))
    src = St.stream_events(spark, os.path.join(d, "in"), df.schema)
    q = (St.dedup_within_watermark(src).writeStream.format("memory").queryName("dedup_out")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert spark.sql("SELECT count(*) FROM dedup_out").first()[0] == 3
    q2 = (St.windowed_popularity(src, "1 day", "0 seconds").writeStream.format("memory").queryName("pop_out")
          .outputMode("complete").trigger(availableNow=True).start())
    q2.awaitTermination(120)
    got = {r.product_id: r.n for r in spark.sql("SELECT * FROM pop_out").collect()}
    assert got == {1: 3, 2: 1}


def test_stems_with_part_numbers(spark):
    d = tempfile.mkdtemp(prefix="clickloom-stems-")
    for month in ("2020-Jan", "2020-Feb"):
        path = os.path.join(d, month)
        spark.range(6).select(F.lit("2020-01-01 00:00:05 UTC").alias("event_time"), F.lit(month).alias("event_type"), "id").repartition(
            3).write.option("header", True).csv(path)
        assert Fl.name_parts(spark, path, month, os.path.join(d, "named")) == 3
    raw = Fl.read_raw_csv(spark, os.path.join(d, "named"))
    assert {r.event_type for r in Fl.months_from_file_stem(raw, ["2020-Jan"]).select("event_type").collect()} == {"2020-Feb"}
    assert Fl.months_from_file_stem(raw, ["2020-Jan"], exclude=False).select("event_type").count() == 6
