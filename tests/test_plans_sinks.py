import os
import tempfile

from pyspark.sql import functions as F

from clickloom.plans import cleaning_job
from clickloom.sources import files as Fl
from tests.helpers import events


def test_cleaning_job_end_to_end(spark):
    rows = [(i, "view", 1 + i % 3, 1 + i % 4, f"s{i % 4}") for i in range(0, 60, 2)]
    df = events(spark, rows)
    d = tempfile.mkdtemp(prefix="clickloom-job-")
    report = cleaning_job.run(df, os.path.join(d, "out"), os.path.join(d, "pre"), k=3)
    assert report["clean"]["rows_clean"] == 30
    out = spark.read.parquet(os.path.join(d, "out"))
    assert out.count() == report["output"]["rows_out"]


def test_table_sink_and_bundle(spark):
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    Fl.save_table(df, "clickloom_sink_test")
    assert spark.table("clickloom_sink_test").count() == 5
    spark.sql("DROP TABLE clickloom_sink_test")
    d = tempfile.mkdtemp(prefix="clickloom-bundle-")
    Fl.write_parquet(df, os.path.join(d, "a"))
    Fl.export_parquet(df, os.path.join(d, "b"), ["id", F.col("x").cast("int").alias("x")], order_by=["id"])
    b = Fl.load_bundle(spark, d, ["a", "b"])
    assert b["a"].count() == 5 and dict(b["b"].dtypes)["x"] == "int"
    assert Fl.to_json_lines(df.limit(1)).first().json == '{"id":0,"x":0}'


def test_month_in_vocab_coerces_dirty_ids(spark):
    d = tempfile.mkdtemp(prefix="clickloom-vocab-")
    with open(os.path.join(d, "m.csv"), "w") as fh:
        fh.write("event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n")
        fh.write("2020-01-01 00:00:05 UTC,view,1,2,a.b,x,3.5,7,s1\n")
        fh.write("2020-01-01 00:00:06 UTC,view,1x,2,a.b,x,3.5,7,s1\n")
        fh.write("2020-01-01 00:00:07 UTC,view,2,2,a.b,x,3.5,99,s1\n")
    uv = spark.createDataFrame([(7, 0)], "user_id long, user_idx long")
    iv = spark.createDataFrame([(1, 1), (2, 2)], "product_id long, item_idx long")
    out = Fl.read_month_in_vocab(spark, d, uv, iv).collect()
    assert [(r.user_idx, r.item_idx) for r in out] == [(0, 1)]
