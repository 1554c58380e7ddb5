"""Data-quality invariants as one-row violation counts (Q2-Q6).

Every check is a single aggregation (``count_if`` per rule) so a table of any
size is validated in one pass; a clean table returns zeros.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import attach, rnd

# The columns of the encoded artifacts, in order.
ITEM_ENCODED_COLUMNS = ("product_id", "item_idx", "cat_l1_idx", "cat_l2_idx", "brand_idx", "price_bucket",
                        "avg_price_scaled", "log_confidence_scaled", "purchase_rate_scaled")
USER_ENCODED_COLUMNS = ("user_id", "user_idx", "top_cat_idx", "peak_hour_bucket", "preferred_dow",
                        "has_purchase_history", "log_total_events", "months_active", "purchase_rate", "cart_rate",
                        "log_n_sessions", "avg_purchase_price_scaled")


def _any_null(cols: Sequence[str]):
    e = None
    for c in cols:
        e = F.col(c).isNull() if e is None else (e | F.col(c).isNull())
    return e


def item_feature_invariants(items: DataFrame, min_rows: int = 1, max_rows: int = 10**9) -> DataFrame:
    """Q2 (items): rows with a null, price bucket outside 0-7, negative rates, row-count gate."""
    return items.agg(F.count(F.lit(1)).alias("n_rows"),
                     F.count_if(_any_null(items.columns)).alias("rows_with_null"),
                     F.count_if((F.col("price_bucket") < 0) | (F.col("price_bucket") > 7)).alias("bad_price_bucket"),
                     F.count_if(F.col("item_purchase_rate") < 0).alias("negative_rate")).withColumn(
        "row_count_ok", (F.col("n_rows") >= min_rows) & (F.col("n_rows") <= max_rows))


def user_feature_invariants(users: DataFrame) -> DataFrame:
    """Q2 (users): nulls outside the price column, bucket/day ranges, rates in [0, 1]."""
    cols = [c for c in users.columns if c != "avg_purchase_price"]
    r = F.col("purchase_rate"), F.col("cart_rate")
    return users.agg(F.count(F.lit(1)).alias("n_rows"),
                     F.count_if(_any_null(cols)).alias("rows_with_null"),
                     F.count_if((F.col("peak_hour_bucket") < 0) | (F.col("peak_hour_bucket") > 3)).alias("bad_hour"),
                     F.count_if((F.col("preferred_dow") < 1) | (F.col("preferred_dow") > 7)).alias("bad_dow"),
                     F.count_if((r[0] < 0) | (r[0] > 1) | (r[1] < 0) | (r[1] > 1)).alias("bad_rate"))


def vocab_round_trip(df: DataFrame, vocab: DataFrame, key: str, idx: str, start: int) -> DataFrame:
    """Q3: every key maps to one index and back; indices dense from ``start``."""
    keys = df.select(key).distinct()
    fwd = keys.join(vocab, key, "left")
    back = vocab.groupBy(idx).agg(F.count(F.lit(1)).alias("_k"))
    a = fwd.agg(F.count(F.lit(1)).alias("n_keys"), F.count_if(F.col(idx).isNull()).alias("unmapped_keys"))
    b = vocab.agg(F.count(F.lit(1)).alias("vocab_size"), F.min(idx).alias("min_idx"), F.max(idx).alias("max_idx"),
                  F.count_distinct(idx).alias("distinct_idx"))
    c = back.agg(F.count_if(F.col("_k") > 1).alias("idx_with_many_keys"))
    out = attach(a, b, c)
    return out.withColumn("dense_ok", (F.col("min_idx") == start) &
                          (F.col("max_idx") == F.col("vocab_size") + start - 1) &
                          (F.col("distinct_idx") == F.col("vocab_size")))


def scaling_sanity(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q3 (scaling): mean and population std of each standardised column (0 and 1, or 0 for constants)."""
    both = [x for c in cols for x in (rnd(F.avg(c), 4).alias(f"mean_{c}"), rnd(F.stddev_pop(c), 4).alias(f"std_{c}"))]
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"mean_{c}").alias("mean"), F.col(f"std_{c}").alias("std")) for c in cols])
    return df.agg(*both).select(F.explode(rows).alias("r")).select("r.*")


def merge_alignment(left: DataFrame, merged: DataFrame, key: str, float_cols: Sequence[str]) -> DataFrame:
    """Q4: row counts before/after a merge, keys lost, NaN or null values created."""
    a = left.agg(F.count(F.lit(1)).alias("rows_before"))
    b = merged.agg(F.count(F.lit(1)).alias("rows_after"),
                   F.count_if(_any_null(float_cols) | F.exists(F.array(*[F.col(c) for c in float_cols]),
                                                               lambda x: F.isnan(x))).alias("rows_nan_or_null"))
    lost = left.select(key).join(merged.select(key), key, "left_anti").agg(F.count(F.lit(1)).alias("keys_lost"))
    return attach(a, b, lost)


def encoded_checks(items_enc: DataFrame, users_enc: DataFrame, item_vocab: DataFrame,
                   brand_vocab: DataFrame) -> DataFrame:
    """Q6: exact column sets, no nulls, index ranges, unknown = 0 present,
    distinct item indices = vocabulary size."""
    spark = items_enc.sparkSession
    cols_ok = spark.createDataFrame(
        [(tuple(items_enc.columns) == ITEM_ENCODED_COLUMNS, tuple(users_enc.columns) == USER_ENCODED_COLUMNS)],
        "item_columns_ok boolean, user_columns_ok boolean")
    i = items_enc.agg(F.count_if(_any_null(items_enc.columns)).alias("item_nulls"),
                      F.min("item_idx").alias("min_item_idx"),
                      F.count_distinct("item_idx").alias("distinct_item_idx"),
                      F.count_if(F.col("brand_idx") < 0).alias("negative_brand_idx"))
    u = users_enc.agg(F.count_if(_any_null([c for c in users_enc.columns if c != "avg_purchase_price_scaled"]))
                      .alias("user_nulls"),
                      F.count_if((F.col("preferred_dow") < 0) | (F.col("preferred_dow") > 6)).alias("bad_dow"))
    v = item_vocab.agg(F.count(F.lit(1)).alias("item_vocab_size"))
    unk = brand_vocab.agg(F.count_if((F.col("brand") == "unknown") & (F.col("idx") == 0)).alias("unknown_is_zero"))
    out = attach(cols_ok, i, u, v, unk)
    return out.withColumn("item_idx_dense", F.col("distinct_item_idx") == F.col("item_vocab_size")).withColumn(
        "pad_free", F.col("min_item_idx") >= 1)
