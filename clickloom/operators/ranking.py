"""Ranking evaluation: ground truth, Recall/Precision/NDCG/HR, cohorts and
diagnostics (R4-R7, R10-R14, R31, R32).

Recommendations are a long table ``(user, item, rank)`` with rank from 1.
Metrics are joins and grouped sums: the DCG of a user is the sum of
1/log2(rank + 1) over hit rows; the ideal DCG for ``n`` relevant items comes
from a k-row table (bounded by k, so broadcasting it is safe).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.columns import attach, rnd

# User cohorts by number of training pairs (inclusive bounds).
COHORTS = (("cold", 3, 10), ("medium", 11, 50), ("warm", 51, 1_000_000_000))


def ground_truth(test_events: DataFrame, user_vocab: DataFrame, item_vocab: DataFrame,
                 types: Sequence[str] = ("cart", "purchase")) -> DataFrame:
    """Distinct (user_idx, item_idx) of cart/purchase test events for users
    and items known from training."""
    return (test_events.filter(F.col("event_type").isin(list(types)))
            .join(user_vocab, "user_id").join(item_vocab, "product_id")
            .select("user_idx", "item_idx").distinct())


def gains(k: int) -> list[tuple[int, float, float]]:
    """(rank, gain 1/log2(rank + 1), ideal DCG of ``rank`` relevant items) for 1..k."""
    rows, acc = [], 0.0
    for n in range(1, k + 1):
        g = 1.0 / math.log2(n + 1)
        acc += g
        rows.append((n, g, acc))
    return rows


def gain_table(spark: SparkSession, k: int) -> DataFrame:
    """k rows of rank gains and ideal DCGs (the same doubles in every engine)."""
    return spark.createDataFrame(gains(k), "rank int, gain double, idcg double")


def user_metrics(recs: DataFrame, gt: DataFrame, k: int, recall_denominator: str = "min",
                 user_col: str = "user_idx", item_col: str = "item_idx") -> DataFrame:
    """Per ground-truth user: hits, recall, precision, NDCG and hit at ``k``.

    ``recall_denominator``: "min" -> hits / min(|GT|, k) (main evaluator),
    "gt" -> hits / |GT| (baseline comparison)."""
    spark = recs.sparkSession
    gt_size = gt.groupBy(user_col).agg(F.count(F.lit(1)).alias("gt_size"))
    g = gain_table(spark, k)
    hits = (recs.filter(F.col("rank") <= k).join(gt, [user_col, item_col])
            .join(F.broadcast(g.select("rank", "gain")), "rank")
            .groupBy(user_col).agg(F.count(F.lit(1)).alias("hits"), F.sum("gain").alias("dcg")))
    per = (gt_size.join(hits, user_col, "left").fillna(0, ["hits"]).fillna(0.0, ["dcg"])
           .withColumn("n_ideal", F.least(F.col("gt_size"), F.lit(k)).cast("int")))
    per = per.join(F.broadcast(g.select(F.col("rank").alias("n_ideal"), "idcg")), "n_ideal")
    den = F.col("n_ideal") if recall_denominator == "min" else F.col("gt_size")
    return per.select(user_col, "gt_size", "hits",
                      (F.col("hits") / den).alias("recall"),
                      (F.col("hits") / F.lit(k)).alias("precision"),
                      (F.col("dcg") / F.col("idcg")).alias("ndcg"),
                      (F.col("hits") > 0).cast("int").alias("hit"))


def compare_strategies(recs: dict[str, DataFrame], gt: DataFrame, ks: Sequence[int],
                       recall_denominator: str = "gt", user_col: str = "user_idx",
                       item_col: str = "item_idx") -> DataFrame:
    """Mean recall / NDCG / hit rate of several recommenders at several
    cutoffs, one row per (strategy, k).

    One pass instead of one join per (strategy, k): the strategies' lists are
    tagged and unioned, joined once with the ground truth, and hits and DCG at
    every cutoff are conditional sums of the same grouped aggregate. Gains and
    ideal DCGs are literal arrays indexed by rank (k values, no join)."""
    ks = sorted(set(ks))
    kmax = ks[-1]
    table = gains(kmax)
    gain_at = F.element_at(F.array(*[F.lit(g) for _, g, _ in table]), F.col("rank"))
    idcg_at = F.array(*[F.lit(i) for _, _, i in table])
    tagged = None
    for name, r in recs.items():
        t = r.filter(F.col("rank") <= kmax).select(F.lit(name).alias("strategy"), user_col, item_col, "rank")
        tagged = t if tagged is None else tagged.unionByName(t)
    sums = []
    for k in ks:
        at_k = F.col("rank") <= k
        sums += [F.sum(F.when(at_k, 1).otherwise(0)).alias(f"_h{k}"),
                 F.sum(F.when(at_k, gain_at).otherwise(0.0)).alias(f"_d{k}")]
    hits = tagged.join(gt, [user_col, item_col]).groupBy("strategy", user_col).agg(*sums)
    names = F.array(*[F.lit(n) for n in recs])
    per = (gt.groupBy(user_col).agg(F.count(F.lit(1)).alias("gt_size"))
           .select(user_col, "gt_size", F.explode(names).alias("strategy"))
           .join(hits, ["strategy", user_col], "left"))
    aggs = []
    for k in ks:
        h = F.coalesce(F.col(f"_h{k}"), F.lit(0))
        n_ideal = F.least(F.col("gt_size"), F.lit(k)).cast("int")
        den = n_ideal if recall_denominator == "min" else F.col("gt_size")
        aggs += [F.avg(h / den).alias(f"_r{k}"),
                 F.avg(F.coalesce(F.col(f"_d{k}"), F.lit(0.0)) / F.element_at(idcg_at, n_ideal)).alias(f"_n{k}"),
                 F.avg((h > 0).cast("int")).alias(f"_t{k}")]
    out = per.groupBy("strategy").agg(F.count(F.lit(1)).alias("n_users"), *aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"_r{k}").alias("r"),
                                        F.col(f"_n{k}").alias("n"), F.col(f"_t{k}").alias("t"))
                               for k in ks])).alias("_m")
    return (out.select("strategy", "n_users", rows)
            .select("strategy", F.col("_m.k").alias("k"), "n_users", rnd(F.col("_m.r"), 6).alias("recall"),
                    rnd(F.col("_m.n"), 6).alias("ndcg"), rnd(F.col("_m.t") * 100, 6).alias("hit_rate_pct")))


def summarize(per_user: DataFrame, k: int, label_cols: dict[str, object] | None = None) -> DataFrame:
    """Means of per-user metrics as one row (rounded to 6 places)."""
    lab = [F.lit(v).alias(n) for n, v in (label_cols or {}).items()]
    return per_user.agg(F.count(F.lit(1)).alias("n_users"),
                        rnd(F.avg("recall"), 6).alias(f"recall_at_{k}"),
                        rnd(F.avg("precision"), 6).alias(f"precision_at_{k}"),
                        rnd(F.avg("ndcg"), 6).alias(f"ndcg_at_{k}"),
                        rnd(F.avg("hit") * 100, 6).alias(f"hit_rate_pct_at_{k}")).select(*lab, "*")


def single_target_metrics(recs: DataFrame, targets: DataFrame, k: int, key: str = "session_idx",
                          item_col: str = "item_idx") -> DataFrame:
    """HR@k and NDCG@k with one target per row of ``targets``, averaged."""
    g = gain_table(recs.sparkSession, k).select("rank", "gain")
    hit = (targets.join(recs.filter(F.col("rank") <= k), [key, item_col], "left")
           .join(F.broadcast(g), "rank", "left")
           .select(key, F.when(F.col("rank").isNotNull(), 1.0).otherwise(0.0).alias("hr"),
                   F.coalesce(F.col("gain"), F.lit(0.0)).alias("nd")))
    return hit.agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("hr"), 6).alias(f"hr_at_{k}"),
                   rnd(F.avg("nd"), 6).alias(f"ndcg_at_{k}"))


def cohort_of(pairs: DataFrame, user_col: str = "user_idx") -> DataFrame:
    """Cohort label per user from the number of training pairs (null below 3)."""
    n = pairs.groupBy(user_col).agg(F.count(F.lit(1)).alias("n_train_pairs"))
    expr = None
    for name, lo, hi in COHORTS:
        c = (F.col("n_train_pairs") >= lo) & (F.col("n_train_pairs") <= hi)
        expr = F.when(c, name) if expr is None else expr.when(c, name)
    return n.withColumn("cohort", expr)


def stratified_metrics(per_user: DataFrame, pairs: DataFrame, k: int, user_col: str = "user_idx") -> DataFrame:
    """Metrics for overall and each cohort; empty cohorts give zero rows
    (users under 3 pairs count only in overall)."""
    spark = per_user.sparkSession
    tagged = per_user.join(cohort_of(pairs, user_col), user_col, "left")
    names = ["overall"] + [c[0] for c in COHORTS]
    lab = tagged.withColumn("_cohorts", F.array(F.lit("overall"), F.col("cohort")))
    ex = lab.select("*", F.explode("_cohorts").alias("_c")).filter(F.col("_c").isNotNull())
    agg = ex.groupBy("_c").agg(F.count(F.lit(1)).alias("n_users"),
                               rnd(F.avg("recall"), 6).alias(f"recall_at_{k}"),
                               rnd(F.avg("ndcg"), 6).alias(f"ndcg_at_{k}"),
                               rnd(F.avg("hit") * 100, 6).alias(f"hit_rate_pct_at_{k}"))
    grid = spark.createDataFrame([(n,) for n in names], "cohort string")
    out = grid.join(agg.withColumnRenamed("_c", "cohort"), "cohort", "left")
    return out.fillna(0, ["n_users"]).fillna(0.0, [f"recall_at_{k}", f"ndcg_at_{k}", f"hit_rate_pct_at_{k}"])


def seen_filter_diagnostic(gt: DataFrame, seen: DataFrame, pairs: DataFrame,
                           user_col: str = "user_idx", item_col: str = "item_idx") -> DataFrame:
    """Share of ground-truth items already seen in training, overall and per cohort."""
    flagged = gt.join(seen.select(user_col, item_col).withColumn("_seen", F.lit(1)), [user_col, item_col], "left")
    tagged = flagged.join(cohort_of(pairs, user_col).select(user_col, "cohort"), user_col, "left")
    ex = tagged.select("*", F.explode(F.array(F.lit("overall"), F.col("cohort"))).alias("_c")).filter(
        F.col("_c").isNotNull())
    return ex.groupBy(F.col("_c").alias("cohort")).agg(
        F.count(F.lit(1)).alias("gt_items"), F.count("_seen").alias("gt_seen"),
        rnd(F.count("_seen") * 100.0 / F.count(F.lit(1)), 6).alias("pct_gt_seen"))


def coverage_waterfall(test_events: DataFrame, user_vocab: DataFrame, users_enc: DataFrame,
                       types: Sequence[str] = ("cart", "purchase")) -> DataFrame:
    """Users with test cart/purchase -> of those in the user vocabulary ->
    of those with a feature row. One row per stage."""
    buyers = test_events.filter(F.col("event_type").isin(list(types))).select("user_id").distinct()
    in_vocab = buyers.join(user_vocab, "user_id")
    with_feat = in_vocab.join(users_enc.select("user_idx"), "user_idx", "left_semi")
    stages = [("1_buyers", buyers), ("2_in_vocab", in_vocab), ("3_has_features", with_feat)]
    out = None
    for name, df in stages:
        one = df.agg(F.count(F.lit(1)).alias("n_users")).select(F.lit(name).alias("stage"), "n_users")
        out = one if out is None else out.unionByName(one)
    return out


def per_user_diagnostics(per_user: DataFrame, pairs: DataFrame, user_col: str = "user_idx",
                         small_gt: int = 5) -> DataFrame:
    """Per cohort the mean GT size, hit rate and number of zero-hit users
    with at most ``small_gt`` GT items."""
    tagged = per_user.join(cohort_of(pairs, user_col), user_col, "left").fillna("under_3", ["cohort"])
    return tagged.groupBy("cohort").agg(
        F.count(F.lit(1)).alias("n_users"), rnd(F.avg("gt_size"), 6).alias("mean_gt_size"),
        rnd(F.avg("hit") * 100, 6).alias("hit_rate_pct"),
        F.count_if((F.col("hits") == 0) & (F.col("gt_size") <= small_gt)).alias("zero_hit_small_gt"))


def item_coverage(test_items: DataFrame, train_items: DataFrame, item_col: str = "product_id") -> DataFrame:
    """R14 + U3: test items, those seen in training (semi join), those not (anti join)."""
    t = test_items.select(item_col).distinct()
    tr = train_items.select(item_col).distinct()
    a = t.agg(F.count(F.lit(1)).alias("n_test_items"))
    b = t.join(tr, item_col, "left_semi").agg(F.count(F.lit(1)).alias("n_in_train"))
    c = t.join(tr, item_col, "left_anti").agg(F.count(F.lit(1)).alias("n_new"))
    return attach(a, b, c).select(
        "*", rnd(F.col("n_in_train") * 100.0 / F.col("n_test_items"), 6).alias("pct_covered"))


def first_hit_ranks(recs: DataFrame, gt: DataFrame, cutoffs: Sequence[int] = (10, 20, 100),
                    user_col: str = "user_idx", item_col: str = "item_idx") -> DataFrame:
    """Per GT user the best rank of a hit (null if none) and hit flags at
    each cutoff, summarised as one row."""
    first = (recs.join(gt, [user_col, item_col]).groupBy(user_col).agg(F.min("rank").alias("first_hit_rank")))
    per = gt.groupBy(user_col).agg(F.count(F.lit(1)).alias("gt_size")).join(first, user_col, "left")
    aggs = [F.count(F.lit(1)).alias("n_users"), rnd(F.avg("gt_size"), 6).alias("mean_gt_per_user"),
            rnd(F.avg("first_hit_rank"), 6).alias("mean_first_hit_rank")]
    aggs += [F.count_if(F.col("first_hit_rank") <= c).alias(f"users_hit_top_{c}") for c in cutoffs]
    return per.agg(*aggs)
