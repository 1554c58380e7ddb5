"""Mergeable sketches (A9, A15, A16, A18, A19, A23): quantiles and user overlap
from small summaries that are stored once a month and merged for any period.

Spark's own KLL and theta sketches are combined map-side; a stored row is a few
KB whatever a month holds, so a year's figures read twelve rows and no events.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import attach

#: KLL: values a level holds; theta: log2 of the hashes kept
KLL_K, THETA_LG = 1024, 12


def rank_error_bound(k: int = KLL_K) -> float:
    """How far a quantile's rank may be off, as a share of all values: twice the
    99 % bound of a KLL sketch of size ``k``."""
    return 2 * 2.446 / k ** 0.9433


def quantile_sketches(df: DataFrame, value_col: str, keys: Sequence[str], k: int = KLL_K) -> DataFrame:
    """``keys, n, sketch``: a KLL sketch of the values of each key; nulls are no values."""
    value = F.col(value_col).cast("double")
    return df.where(value.isNotNull()).groupBy(*keys).agg(F.count(value).alias("n"), F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch"))


def merge_quantile_sketches(sketches: DataFrame, keys: Sequence[str] = (), k: int = KLL_K) -> DataFrame:
    """Sketches (n, sketch) summed up over all other columns than ``keys``."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probs: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """``keys, prob, value, n`` of each sketch row: values within ``rank_error_bound``
    of the quantiles' ranks. An empty table gives no rows."""
    each = F.explode(F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value")) for p in probs]))
    return sketches.where(F.col("n") > 0).select(*keys, "n", each.alias("q")).select(*keys, "q.prob", "q.value", "n")


def rank_errors(df: DataFrame, value_col: str, quantiles: Sequence[tuple[float, float]]) -> DataFrame:
    """``prob, value, rank_error`` of (prob, value) pairs: how far ``prob`` lies
    outside the ranks that the value really takes, in one pass over the values."""
    x = F.col(value_col).cast("double")
    counts = [c for i, (_, v) in enumerate(quantiles) for c in (F.count_if(x < v).alias(f"below{i}"), F.count_if(x <= v).alias(f"upto{i}"))]
    one = df.agg(F.count(x).alias("n"), *counts)

    def error(i: int, p: float):
        return F.greatest(F.col(f"below{i}") / F.col("n") - p, p - F.col(f"upto{i}") / F.col("n"), F.lit(0.0))

    rows = F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.lit(float(v)).alias("value"), error(i, p).alias("rank_error")) for i, (p, v) in enumerate(quantiles)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def user_sketches(df: DataFrame, keys: Sequence[str], user_col: str = "user_id", lg: int = THETA_LG) -> DataFrame:
    """``keys, sketch``: a theta sketch of the distinct users of each key."""
    return df.where(F.col(user_col).isNotNull()).groupBy(*keys).agg(F.theta_sketch_agg(user_col, F.lit(lg)).alias("sketch"))


def overlap_error_bound(n_either: float, lg: int = THETA_LG) -> float:
    """How far an overlap may be off where one of the sides has more than ``2 ** lg``
    users: four standard errors of the users in either. Below that it is exact."""
    return 4 * n_either / sqrt((1 << lg) - 2)


def period_overlap(sketches: DataFrame, key: str) -> DataFrame:
    """``month_a, month_b, n_users`` (a <= b by key) from one sketch a key,
    intersected without a join of users. The keys are a calendar: their sketches
    meet in one array, each pair of them once. Pairs without common users are left out."""
    one = sketches.select(F.col(key).alias("m"), "sketch").agg(F.array_sort(F.collect_list(F.struct("m", "sketch")), lambda a, b: F.when(
        a["m"] < b["m"], -1).when(a["m"] > b["m"], 1).otherwise(0)).alias("all"))
    a = one.select("all", F.posexplode("all").alias("i", "a"))
    pairs = a.select("a", F.explode(F.slice("all", F.col("i") + 1, F.size("all"))).alias("b"))
    n = F.theta_sketch_estimate(F.theta_intersection("a.sketch", "b.sketch")).cast("long")
    return pairs.select(F.col("a.m").alias("month_a"), F.col("b.m").alias("month_b"), n.alias("n_users")).where(F.col("n_users") > 0)


def split_overlap(sketches: DataFrame, key: str, train: str, test: str) -> DataFrame:
    """Train, test and common users from the sketches of both (``key`` names
    them; several rows of one are united), and the overlap in percent of the test users."""
    united = sketches.groupBy(key).agg(F.theta_union_agg("sketch").alias("sketch"))
    side = lambda name: united.where(F.col(key) == name).agg(F.first("sketch").alias(name))
    both = attach(side(train).withColumnRenamed(train, "_a"), side(test).withColumnRenamed(test, "_b"))
    n = lambda c: F.theta_sketch_estimate(c).cast("long")
    out = both.select(n(F.col("_a")).alias("train_users"), n(F.col("_b")).alias("test_users"), n(F.theta_intersection("_a", "_b")).alias("overlap_users"))
    return out.withColumn("overlap_pct", F.try_divide(F.col("overlap_users") * 100.0, F.col("test_users")))
