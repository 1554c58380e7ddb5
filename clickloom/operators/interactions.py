"""User x item interaction table and its quality summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import attach, distinct_counts, rnd
from clickloom.operators.ordering import lookup_join

# Confidence weights per event type.
W_PURCHASE = 4
W_CART = 2
W_VIEW = 1


def interactions(events: DataFrame, user_col: str = "user_id", item_col: str = "product_id",
                 type_col: str = "event_type", ts_col: str = "event_time") -> DataFrame:
    """A1: one row per (user, item) with confidence = 4*purchases + 2*carts + views,
    the three counts and the first/last interaction time; events of other types
    are no interactions. One partial aggregation (map-side combine), one
    shuffle on (user, item)."""
    t = F.col(type_col)
    events = events.filter(t.isin("view", "cart", "purchase"))
    n_v = F.count_if(t == "view")
    n_c = F.count_if(t == "cart")
    n_p = F.count_if(t == "purchase")
    return (events.groupBy(user_col, item_col)
            .agg((n_p * W_PURCHASE + n_c * W_CART + n_v * W_VIEW).alias("confidence_score"),
                 n_v.alias("n_views"), n_c.alias("n_carts"), n_p.alias("n_purchases"),
                 F.min(ts_col).alias("first_interaction"),
                 F.max(ts_col).alias("last_interaction")))


def interaction_quality(inter: DataFrame, user_col: str = "user_id",
                        item_col: str = "product_id", score_col: str = "confidence_score") -> DataFrame:
    """A2 + Q5: one row of pair/user/item counts, score stats, score shares and
    sparsity (percent), with the > 99 % sparsity gate."""
    s = F.col(score_col)
    agg = inter.agg(F.count(F.lit(1)).alias("total_pairs"),
                    F.avg(s).alias("avg_score"), F.max(s).cast("long").alias("max_score"),
                    F.count_if(s == 1).alias("score_eq_1"), F.count_if(s == 2).alias("score_eq_2"),
                    F.count_if(s >= 4).alias("score_ge_4"))
    agg = attach(agg, distinct_counts(inter, unique_users=user_col, unique_items=item_col))
    sparsity = (F.lit(1.0) - F.col("total_pairs") /
                (F.col("unique_users") * F.col("unique_items"))) * 100
    return agg.select(
        "total_pairs", "unique_users", "unique_items",
        rnd("avg_score", 6).alias("avg_score"), "max_score",
        rnd(sparsity, 6).alias("sparsity_pct"),
        rnd(F.col("score_eq_1") * 100.0 / F.col("total_pairs"), 6).alias("pct_score_1"),
        rnd(F.col("score_eq_2") * 100.0 / F.col("total_pairs"), 6).alias("pct_score_2"),
        rnd(F.col("score_ge_4") * 100.0 / F.col("total_pairs"), 6).alias("pct_score_ge4"),
        (sparsity > 99).alias("sparsity_gate_pass"))


def high_intent(inter: DataFrame, min_confidence: int = 2, score_col: str = "confidence_score") -> DataFrame:
    """Pairs with confidence >= 2 (two views also qualify)."""
    return inter.filter(F.col(score_col) >= min_confidence)


def normalised_weights(pairs: DataFrame, batch_col: str, score_col: str = "confidence_score",
                       out: str = "weight") -> DataFrame:
    """Confidence divided by its batch mean (mean weight 1 per batch).

    The batch mean is a grouped aggregate joined back, not a window, so a huge
    batch is combined map-side; the join back is salted, as there are few and
    large batches."""
    means = pairs.groupBy(batch_col).agg(F.avg(score_col).alias("_m"))
    return (lookup_join(pairs, means, batch_col, F.struct(*pairs.columns))
            .withColumn(out, F.col(score_col) / F.col("_m")).drop("_m"))


def top_items(inter: DataFrame, k: int = 20, item_col: str = "product_id",
              score_col: str = "confidence_score", user_col: str = "user_id") -> DataFrame:
    """W7 over interactions: the ``k`` items with most confidence (ties by id).
    Partial aggregation, then a TakeOrdered (per-partition top-k, then merge)."""
    return (inter.groupBy(item_col)
            .agg(F.sum(score_col).cast("long").alias("total_confidence"),
                 F.count_distinct(user_col).alias("n_users"))
            .orderBy(F.desc("total_confidence"), F.asc(item_col))
            .limit(k))
