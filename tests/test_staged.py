import os

import pytest
from pyspark.sql import functions as F

from clickloom.operators import sampling as Sa
from clickloom.sources import files as Fl
from clickloom.sources import staged as St

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"


def ids(spark, path):
    return sorted(r["id"] for r in spark.read.parquet(path).collect())


def left_beside(path):
    return [n for n in os.listdir(os.path.dirname(path)) if n.startswith(os.path.basename(path) + ".")]


def test_replacing_reads_the_old_rows_and_leaves_nothing_beside(spark, tmp_path):
    path = str(tmp_path / "t")
    St.replace_parquet(spark.range(10), path)
    St.replace_parquet(spark.read.parquet(path).where("id >= 4"), path)
    assert ids(spark, path) == [4, 5, 6, 7, 8, 9] and left_beside(path) == []
    St.replace_parquet(spark.range(3).withColumn("p", F.col("id") % 2), path, partition_by=["p"])
    assert ids(spark, path) == [0, 1, 2] and {"p=0", "p=1"} <= set(os.listdir(path))
    St.replace_parquet(spark.range(0), path)
    assert ids(spark, path) == []


def test_a_failing_job_or_check_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    St.replace_parquet(spark.range(5), path)
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        St.replace_parquet(broken, path)
    assert ids(spark, path) == [0, 1, 2, 3, 4] and left_beside(path) == []

    def check(df):
        assert df.count() > 50, "too short"
    with pytest.raises(AssertionError, match="too short"):
        St.replace_parquet(spark.range(50), path, check)
    assert ids(spark, path) == [0, 1, 2, 3, 4] and left_beside(path) == []


def test_a_swap_that_dies_is_undone_or_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    St.replace_parquet(spark.range(5), path)
    move = St._Folders.move

    def fails(self, source, target):
        if ".staging-" in source:
            raise OSError("no")
        move(self, source, target)
    monkeypatch.setattr(St._Folders, "move", fails)
    with pytest.raises(OSError):
        St.replace_parquet(spark.range(7), path)
    monkeypatch.undo()
    assert ids(spark, path) == [0, 1, 2, 3, 4] and left_beside(path) == []
    # killed between the two moves: the next call finds the old table again
    os.rename(path, path + ".old-dead")
    os.mkdir(path + ".staging-dead")
    St.replace_parquet(spark.range(2), path, lambda df: None)
    assert ids(spark, path) == [0, 1] and left_beside(path) == []


def test_tables_are_replaced_also_with_another_schema(spark, tmp_path):
    name, path = "clickloom_staged_test", str(tmp_path / "t")
    St.replace_table(spark.range(4), name, path)
    St.replace_table(spark.range(6), name, path)
    assert spark.table(name).count() == 6
    St.replace_table(spark.range(2).withColumn("x", F.lit("a")), name, path)
    assert spark.table(name).columns == ["id", "x"] and spark.table(name).count() == 2
    spark.sql(f"DROP TABLE {name}")
    assert ids(spark, path) == [0, 1]  # an external table's rows stay


def test_a_months_reload_touches_its_files_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(60).withColumn("month", F.concat(F.lit("2020-0"), (F.col("id") % 3 + 1).cast("string")))
    assert St.reload_partitions(rows, path) == ["2020-01", "2020-02", "2020-03"]
    files = lambda m: sorted(os.listdir(os.path.join(path, f"month={m}")))
    before = {m: files(m) for m in ("2020-01", "2020-02", "2020-03")}
    assert St.reload_partitions(rows.where("month = '2020-02' AND id < 20"), path, only=["2020-02"]) == ["2020-02"]
    assert files("2020-01") == before["2020-01"] and files("2020-03") == before["2020-03"] and files("2020-02") != before["2020-02"]
    assert spark.read.parquet(path).count() == 47
    with pytest.raises(ValueError, match="2020-03"):
        St.reload_partitions(rows, path, only=["2020-01", "2020-02"])
    broken = rows.where("month = '2020-01'").withColumn("id", F.when(F.col("id") == 57, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        St.reload_partitions(broken, path)
    assert files("2020-01") == before["2020-01"] and spark.read.parquet(path).count() == 47
    assert St.reload_partitions(rows.limit(0), path) == []


def _csv(folder, bad, good=5):
    os.makedirs(folder)
    with open(os.path.join(folder, "a.csv"), "w") as fh:
        fh.write(HEADER)
        for i in range(good):
            fh.write(f"2020-01-01 00:00:0{i} UTC,view,{i},2,a.b,x,3.5,7,s1\n")
        for i in range(bad):
            fh.write(f"2020-01-01 00:00:06 UTC,view,bad{i},2,a.b,,3.5,7,s1\n")


def test_a_load_is_committed_within_the_tolerance(spark, tmp_path):
    path, rejected = str(tmp_path / "events"), str(tmp_path / "rejected")
    _csv(str(tmp_path / "in"), bad=2)
    assert St.load_csv(spark, str(tmp_path / "in"), path, rejected, max_bad=2) == {"good": 5, "bad": 2}
    assert sorted(r["product_id"] for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 4]
    assert all("bad" in r[Fl.CORRUPT] for r in spark.read.parquet(rejected).collect())
    _csv(str(tmp_path / "in2"), bad=3, good=1)
    with pytest.raises(ValueError, match="3 malformed"):
        St.load_csv(spark, str(tmp_path / "in2"), path, rejected, max_bad=2)
    assert spark.read.parquet(path).count() == 5 and spark.read.parquet(rejected).count() == 3
    _csv(str(tmp_path / "in3"), bad=0)
    assert St.load_csv(spark, str(tmp_path / "in3"), path, rejected, max_bad=0, prepare=Fl.parse_event_time) == {"good": 5, "bad": 0}
    assert spark.read.parquet(rejected).count() == 0 and dict(spark.read.parquet(path).dtypes)["event_time"] == "timestamp"
    assert sorted(os.listdir(tmp_path)) == ["events", "in", "in2", "in3", "rejected"]


def test_a_load_scans_its_files_once(spark, tmp_path):
    _csv(str(tmp_path / "in"), bad=1)
    tracker, group = spark.sparkContext.statusTracker(), "clickloom-load-once"
    spark.sparkContext.setJobGroup(group, group)
    St.load_csv(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "q"))
    jobs = tracker.getJobIdsForGroup(group)
    spark.sparkContext._jsc.clearJobGroup()
    assert len(jobs) == 1  # the write; moving, counting and reading the header add none


def test_schema_validation(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2020-01-01' AS event_time, 'view' AS event_type, 1 AS product_id, 2L AS category_id, 'a' AS category_code, 'b' AS brand,"
                   " 1.0D AS price, 3L AS user_id, 's' AS user_session, 5 AS extra")
    got = {r["column"]: r["status"] for r in Sa.schema_validation(df).collect()}
    assert got.pop("product_id") == "wrong_type" and got.pop("extra") == "unexpected" and set(got.values()) == {"ok"}
    one = Sa.table_validation(df).first()
    assert one["time_is_timestamp"] and not one["schema_ok"]
    text = Sa.table_validation(df.withColumn("event_time", F.lit("2020-01-01 00:00:00"))).first()
    assert not text["time_is_timestamp"]
