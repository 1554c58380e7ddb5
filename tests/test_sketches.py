import math
import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import sketches as S

PROBS = (0.0, 0.01, 0.25, 0.5, 0.9, 1.0)


def test_merged_monthly_quantiles_keep_their_bound(spark, tmp_path):
    rows = spark.range(60_000).select(F.when(F.col("id") % 97 != 0, F.log1p(F.col("id") * 7919 % 60_013)).alias("x"), (F.col("id") % 5).alias("month"))
    S.quantile_sketches(rows, "x", ["month"]).write.partitionBy("month").parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert stored.count() == 5
    for months, picked in ((None, rows), ((1, 3), rows.where("month IN (1, 3)"))):
        own = stored if months is None else stored.where(F.col("month").isin(list(months)))
        found = S.sketch_quantiles(S.merge_quantile_sketches(own), PROBS).collect()
        assert {r["n"] for r in found} == {picked.where("x IS NOT NULL").count()}
        for r in S.rank_errors(picked, "x", [(r["prob"], r["value"]) for r in found]).collect():
            assert r["rank_error"] <= S.rank_error_bound()
    assert S.rank_error_bound(1024) < 0.01


def test_rank_errors_are_exact_with_ties_and_nulls(spark):
    rows = spark.createDataFrame([(x,) for x in (1.0, 2.0, 2.0, 2.0, 5.0, None)], "x double")
    got = [r["rank_error"] for r in S.rank_errors(rows, "x", [(0.5, 2.0), (0.1, 2.0), (0.5, 5.0), (1.0, 5.0), (0.9, 1.0)]).collect()]
    assert got == pytest.approx([0.0, 0.1, 0.3, 0.0, 0.7])


def test_quantiles_of_few_values_and_none(spark):
    rows = spark.createDataFrame([(1, 3.0), (1, 1.0), (1, 2.0), (2, None)], "g int, x double")
    found = S.sketch_quantiles(S.quantile_sketches(rows, "x", ["g"]), (0.0, 0.5, 1.0), ["g"]).collect()
    assert [(r["g"], r["prob"], r["value"], r["n"]) for r in found] == [(1, 0.0, 1.0, 3), (1, 0.5, 2.0, 3), (1, 1.0, 3.0, 3)]
    assert S.sketch_quantiles(S.merge_quantile_sketches(S.quantile_sketches(rows.limit(0), "x", ["g"])), (0.5,)).count() == 0


@pytest.mark.parametrize("users, lg", [(300, 12), (40_000, 10)])
def test_overlap_is_exact_below_the_sketch_and_bounded_above(spark, users, lg):
    draw = random.Random(users)
    active = {m: {u for u in range(users) if draw.random() < share} for m, share in (("2020-01", 0.5), ("2020-02", 0.3), ("2020-03", 0.0), ("2020-04", 0.9))}
    rows = spark.createDataFrame([(u, m) for m, us in active.items() for u in us for _ in range(1 + u % 2)] + [(None, "2020-01")], "user_id long, month string")
    got = {(r["month_a"], r["month_b"]): r["n_users"] for r in S.period_overlap(S.user_sketches(rows, ["month"], lg=lg), "month").collect()}
    want = {(a, b): len(active[a] & active[b]) for a in active for b in active if a <= b and active[a] & active[b]}
    assert set(got) == set(want)
    for (a, b), n in want.items():
        off = abs(got[a, b] - n)
        assert off == 0 if users < 1 << lg else off <= S.overlap_error_bound(len(active[a] | active[b]), lg)
    assert users < 1 << lg or got != want


def test_split_overlap_unites_rows_of_one_side(spark):
    rows = spark.createDataFrame([(u, "train", m) for m in (1, 2) for u in range(m * 5, m * 5 + 6)] + [(u, "test", 3) for u in range(9, 30)], "user_id long, split string, m int")
    r = S.split_overlap(S.user_sketches(rows, ["split", "m"]), "split", "train", "test").first()
    assert (r["train_users"], r["test_users"], r["overlap_users"]) == (11, 21, 7) and math.isclose(r["overlap_pct"], 700 / 21)
