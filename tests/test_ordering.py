import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickloom.operators.ordering import dense_index, exact_quantiles, previous_row, running_sum, top_k_per_group
from clickloom.sources.testdata import sessionize
from tests.helpers import ts


def _random_frame(spark, n=400, seed=3):
    rnd = random.Random(seed)
    rows = [(i, rnd.randint(1, 4), ts(rnd.randint(0, 5 * 3600))) for i in range(n)]
    return spark.createDataFrame(rows, "id long, k long, t timestamp_ntz")


# no group, some groups and every group of 400 rows in four counts as hot
HOT = [1 << 20, 99, 3]


@pytest.mark.parametrize("hot_rows", HOT)
def test_previous_row_equals_plain_lag(spark, hot_rows):
    df = _random_frame(spark)
    got = previous_row(df, "k", "t", ["id"], ["id"], out="p", bucket_seconds=600, hot_rows=hot_rows)
    assert got.columns == ["id", "k", "t", "p"]
    got = {r.id: (r.p.id if r.p else None) for r in got.collect()}
    w = Window.partitionBy("k").orderBy("t", "id")
    want = {r.id: r.p for r in df.select("id", F.lag("id").over(w).alias("p")).collect()}
    assert got == want


@pytest.mark.parametrize("hot_rows", HOT)
def test_running_sum_equals_plain_window(spark, hot_rows):
    df = _random_frame(spark).withColumn("v", (F.col("id") % 3).cast("long"))
    got = running_sum(df, "k", "t", ["id"], F.col("v"), "cum", bucket_seconds=900, hot_rows=hot_rows)
    got = {r.id: r.cum for r in got.collect()}
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.id: r.c for r in df.select("id", F.sum("v").over(w).alias("c")).collect()}
    assert got == want


def test_sessionize_gap(spark):
    rows = [(1, 7, ts(0)), (2, 7, ts(100)), (3, 7, ts(100 + 1801)), (4, 8, ts(5))]
    df = spark.createDataFrame(rows, "event_id long, user_id long, event_time timestamp_ntz")
    out = {r.event_id: r.session_no for r in sessionize(df, "user_id", "event_time", "event_id", 1800).collect()}
    assert out == {1: 1, 2: 1, 3: 2, 4: 1}


def test_dense_index_starts_at_one_and_is_sorted(spark):
    df = spark.createDataFrame([(v,) for v in [50, 3, 3, 99, 7, 1000, 2]], "x long")
    out = sorted((r.x, r.idx) for r in dense_index(df, "x", "idx", start=1, num_partitions=3).collect())
    assert out == [(2, 1), (3, 2), (7, 3), (50, 4), (99, 5), (1000, 6)]


def test_exact_quantiles_match_numpy(spark):
    vals = [float(v) for v in np.random.default_rng(1).integers(0, 50, 333)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.1, 0.5, 0.9, 0.99, 1.0]
    got = {r.prob: r.value for r in exact_quantiles(df, "x", probs, num_partitions=4).collect()}
    for p in probs:
        assert abs(got[p] - float(np.quantile(vals, p))) < 1e-9


def test_top_k_per_group_is_partial_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    out = top_k_per_group(df, "g", [F.desc("v")], 2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.g, r.v) for r in out.collect()) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]
    assert "WindowGroupLimit" in plan or "AdaptiveSparkPlan" in plan


def test_order_of_ordinary_groups_takes_one_exchange(spark):
    df = _random_frame(spark)
    both = running_sum(previous_row(df, "k", "t", ["id"], ["id"], out="p"), "k", "t", ["id"], F.lit(1), "pos")
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
