"""Item/user features, vocabularies, scaling and encoding.

Vocabularies are two-column DataFrames joined to the data, never driver
dictionaries. Scaling statistics are one-row aggregates, attached as scalar
subqueries.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import attach, category_level, exact_mean, price_bucket, rnd, safe_divide
from clickloom.operators.ordering import dense_index, lookup_join, top_k_per_group


def item_features(events: DataFrame, train_interactions: DataFrame,
                  item_col: str = "product_id") -> DataFrame:
    """A3 + J4: per item category levels, brand, price bucket and rounded mean
    price from ``events``, left-joined with confidence and purchase rate from
    ``train_interactions`` (both sides aggregated per item before the join)."""
    base = events.groupBy(item_col).agg(F.max("category_code").alias("_cc"), F.max("brand").alias("_br"),
                                        exact_mean("price", 6).alias("_avg"))
    stats = train_interactions.groupBy(item_col).agg(
        F.sum("confidence_score").alias("_conf"),
        safe_divide(F.sum("n_purchases"), F.sum("n_views")).alias("_rate"))
    cc = F.coalesce(F.col("_cc"), F.lit("unknown"))
    return (base.join(stats, item_col, "left")
            .select(item_col,
                    F.coalesce(F.get(F.split(cc, r"\."), 0), F.lit("unknown")).alias("cat_l1"),
                    category_level(F.col("_cc"), 2).alias("cat_l2"),
                    F.coalesce(F.col("_br"), F.lit("unknown")).alias("brand"),
                    price_bucket(F.col("_avg")).alias("price_bucket"),
                    rnd("_avg", 4).alias("avg_price"),
                    F.coalesce(F.col("_conf"), F.lit(0)).cast("long").alias("item_total_confidence"),
                    F.coalesce(F.col("_rate"), F.lit(0.0)).alias("item_purchase_rate")))


def user_features(train_events: DataFrame, items: DataFrame, user_col: str = "user_id",
                  item_col: str = "product_id") -> DataFrame:
    """A4 + A5 + W3 + J5 + J9: activity, rates, sessions, time habits, top
    category (most events, ties by name) and purchase price level.

    ``peak_hour_bucket`` is floor(mean hour / 6) and ``preferred_dow`` the
    rounded mean day of week (1 = Sunday): averages, not modes.
    """
    t = F.col("event_type")
    # a session first: distinct sessions are then rows, distinct months a short array, and no event is expanded
    sessions = train_events.groupBy(user_col, "user_session").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(t == "purchase").alias("n_purchase"), F.count_if(t == "cart").alias("n_cart"),
        F.sum(F.hour("event_time")).alias("hours"), F.sum(F.dayofweek("event_time")).alias("dows"), F.count("event_time").alias("n_times"),
        F.collect_set(F.date_format("event_time", "yyyy-MM")).alias("months"))
    n, times = F.sum("n"), F.sum("n_times")
    base = sessions.groupBy(user_col).agg(
        n.alias("total_events"),
        F.size(F.array_distinct(F.flatten(F.collect_set("months")))).cast("long").alias("months_active"),
        rnd(F.sum("n_purchase") / n, 4).alias("purchase_rate"),
        rnd(F.sum("n_cart") / n, 4).alias("cart_rate"),
        F.count("user_session").alias("n_sessions"),
        F.floor(F.try_divide(F.sum("hours"), times) / 6).cast("int").alias("peak_hour_bucket"),
        rnd(F.try_divide(F.sum("dows"), times)).cast("int").alias("preferred_dow"))
    enriched = train_events.select(user_col, item_col, "event_type").join(
        items.select(item_col, "cat_l1", "avg_price"), item_col)
    cats = enriched.groupBy(user_col, "cat_l1").agg(F.count(F.lit(1)).alias("_n"))
    top = top_k_per_group(cats, user_col, [F.desc("_n"), F.asc("cat_l1")], 1, rank_col=None)
    price = enriched.groupBy(user_col).agg(
        exact_mean("avg_price", 4, when=t == "purchase").alias("_pp"),
        exact_mean("avg_price", 4).alias("_vp"),
        (F.count_if(t == "purchase") > 0).cast("int").alias("has_purchase_history"))
    return (base.join(top.select(user_col, F.col("cat_l1").alias("_top")), user_col, "left")
            .join(price, user_col, "left")
            .select(user_col, "total_events", "months_active", "purchase_rate", "cart_rate", "n_sessions",
                    "peak_hour_bucket", "preferred_dow",
                    F.coalesce(F.col("_top"), F.lit("unknown")).alias("top_category"),
                    rnd(F.coalesce(F.col("_pp"), F.col("_vp")), 6).alias("avg_purchase_price"),
                    "has_purchase_history"))


def id_vocab(df: DataFrame, col: str, index_col: str, start: int = 1) -> DataFrame:
    """M1: dense ids in ascending id order starting at ``start`` (items start at
    1 so that 0 stays the padding index)."""
    return dense_index(df.select(col).filter(F.col(col).isNotNull()), col, index_col, start=start)


def string_vocab(df: DataFrame, col: str, index_col: str, unknown: str = "unknown") -> DataFrame:
    """M2: ``unknown`` -> 0, other values numbered from 1 in sorted order."""
    vals = df.select(col).filter(F.col(col).isNotNull() & (F.col(col) != unknown))
    numbered = dense_index(vals, col, index_col, start=1)
    zero = df.sparkSession.createDataFrame([(unknown, 0)], f"{col} string, {index_col} long")
    return numbered.unionByName(zero)


def standard_scale(df: DataFrame, cols: dict[str, Column], digits: int | None = None) -> DataFrame:
    """M3: adds ``name = (expr - mean) / std_pop`` for each ``name: expr``;
    a zero (or undefined) standard deviation divides by 1."""
    tmp = df.select("*", *[e.alias(f"_raw_{k}") for k, e in cols.items()])
    stats = tmp.agg(*[x for k in cols for x in (F.avg(f"_raw_{k}").alias(f"_m_{k}"),
                                               F.stddev_pop(f"_raw_{k}").alias(f"_s_{k}"))])
    out = attach(tmp, stats)
    for k in cols:
        sd = F.col(f"_s_{k}")
        v = (F.col(f"_raw_{k}") - F.col(f"_m_{k}")) / F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd)
        out = out.withColumn(k, rnd(v, digits) if digits is not None else v)
    return out.drop(*[c for k in cols for c in (f"_raw_{k}", f"_m_{k}", f"_s_{k}")])


def _lookup(df: DataFrame, vocab: DataFrame, col: str, index_col: str, out: str) -> DataFrame:
    """``df`` with the index of its ``col`` (0 if unknown). A brand or category may
    hold most rows: salted by the first column, the row's id."""
    v = vocab.select(F.col(col), F.col(index_col).alias(out))
    return lookup_join(df, v, col, F.col(df.columns[0]), how="left").withColumn(out, F.coalesce(F.col(out), F.lit(0)).cast("long"))


def encode_items(items: DataFrame, item_vocab: DataFrame, cat_l1_vocab: DataFrame, cat_l2_vocab: DataFrame,
                 brand_vocab: DataFrame, digits: int | None = 6) -> DataFrame:
    """M4 (items): indices and standardised price, log confidence and purchase rate."""
    df = items.join(item_vocab, "product_id")
    df = _lookup(df, cat_l1_vocab, "cat_l1", "idx", "cat_l1_idx")
    df = _lookup(df, cat_l2_vocab, "cat_l2", "idx", "cat_l2_idx")
    df = _lookup(df, brand_vocab, "brand", "idx", "brand_idx")
    df = standard_scale(df, {"avg_price_scaled": F.col("avg_price"),
                             "log_confidence_scaled": F.log1p("item_total_confidence"),
                             "purchase_rate_scaled": F.col("item_purchase_rate")}, digits)
    return df.select("product_id", "item_idx", "cat_l1_idx", "cat_l2_idx", "brand_idx", "price_bucket",
                     "avg_price_scaled", "log_confidence_scaled", "purchase_rate_scaled")


def encode_users(users: DataFrame, user_vocab: DataFrame, top_cat_vocab: DataFrame,
                 digits: int | None = 6) -> DataFrame:
    """M4 (users): indices, day of week remapped to 0-6 and six standardised
    columns (log events, months, rates, log sessions, purchase price)."""
    df = users.join(user_vocab, "user_id")
    df = _lookup(df, top_cat_vocab, "top_category", "idx", "top_cat_idx")
    df = df.withColumn("preferred_dow", F.col("preferred_dow") - 1)
    df = standard_scale(df, {"log_total_events": F.log1p("total_events"),
                             "months_active_s": F.col("months_active").cast("double"),
                             "purchase_rate_s": F.col("purchase_rate"),
                             "cart_rate_s": F.col("cart_rate"),
                             "log_n_sessions": F.log1p("n_sessions"),
                             "avg_purchase_price_scaled": F.col("avg_purchase_price")}, digits)
    return df.select("user_id", "user_idx", "top_cat_idx", "peak_hour_bucket", "preferred_dow",
                     "has_purchase_history", "log_total_events",
                     F.col("months_active_s").alias("months_active"),
                     F.col("purchase_rate_s").alias("purchase_rate"),
                     F.col("cart_rate_s").alias("cart_rate"), "log_n_sessions", "avg_purchase_price_scaled")


def train_pairs(inter: DataFrame, user_vocab: DataFrame, item_vocab: DataFrame) -> DataFrame:
    """M5: (user_idx, item_idx, confidence) for pairs whose user and item are
    both in the vocabularies (inner joins drop the rest)."""
    return (inter.join(user_vocab, "user_id").join(item_vocab, "product_id")
            .select("user_idx", "item_idx", "confidence_score"))


def dropped_pairs(inter: DataFrame, user_vocab: DataFrame, item_vocab: DataFrame) -> DataFrame:
    """M5 (drop count): pairs lost by :func:`train_pairs`, as one row."""
    kept = inter.join(user_vocab.select("user_id"), "user_id", "left_semi").join(
        item_vocab.select("product_id"), "product_id", "left_semi")
    a = inter.agg(F.count(F.lit(1)).alias("n_before"))
    b = kept.agg(F.count(F.lit(1)).alias("n_after"))
    return attach(a, b).select("n_before", "n_after", (F.col("n_before") - F.col("n_after")).alias("n_dropped"))


def cyclic_day_features(users_enc: DataFrame, dow_col: str = "preferred_dow") -> DataFrame:
    """M6: sin/cos of 2*pi*d/7 for the 0-6 day index of the encoded users."""
    ang = F.col(dow_col).cast("double") * (2 * math.pi / 7)
    return users_enc.select("user_id", "user_idx", dow_col, F.sin(ang).alias("dow_sin"),
                            F.cos(ang).alias("dow_cos"))


def augment_items(items_enc: DataFrame, items: DataFrame, inter: DataFrame, cutoff: Column,
                  digits: int | None = 6) -> DataFrame:
    """M14 + W5 + J10: price relative to the mean of the item's cat_l2 (mean 0
    replaced by 1 in the denominator) and log1p days from first interaction to
    the cutoff (clipped at 0, 0 for items without interactions), both
    standardised. Group means are aggregated and joined back (not a window)."""
    price = items.select("product_id", "avg_price").dropDuplicates(["product_id"])
    m = (items_enc.select("product_id", "item_idx", "cat_l2_idx").join(price, "product_id", "left")
         .withColumn("avg_price", F.greatest(F.coalesce(F.col("avg_price"), F.lit(0.0)), F.lit(0.0))))
    cat_mean = m.groupBy("cat_l2_idx").agg(F.avg("avg_price").alias("_cm"))
    m = lookup_join(m, cat_mean, "cat_l2_idx", F.col("product_id"))
    rel = (F.col("avg_price") - F.col("_cm")) / F.when(F.col("_cm") == 0, F.lit(1.0)).otherwise(F.col("_cm"))
    first = inter.groupBy("product_id").agg(F.min("first_interaction").alias("_fs"))
    days = F.greatest((F.unix_timestamp(cutoff) - F.unix_timestamp("_fs")) / 86400.0, F.lit(0.0))
    m = m.join(first, "product_id", "left").withColumn(
        "_rec", F.coalesce(F.log1p(days), F.lit(0.0)))
    out = standard_scale(m, {"price_relative_to_cat_avg_scaled": rel,
                             "product_recency_log_scaled": F.col("_rec")}, digits)
    return items_enc.join(out.select("product_id", "price_relative_to_cat_avg_scaled",
                                     "product_recency_log_scaled"), "product_id")


def log_sampling_frequency(pairs: DataFrame, items_enc: DataFrame) -> DataFrame:
    """ln(count / total pairs) per item index; items absent from ``pairs``
    get ln(1 / (max item_idx + 1))."""
    counts = pairs.groupBy("item_idx").agg(F.count(F.lit(1)).alias("_c"))
    tot = pairs.agg(F.count(F.lit(1)).alias("_t"))
    n_max = items_enc.agg((F.max("item_idx") + 1).alias("_n"))
    return (attach(items_enc.select("item_idx").join(counts, "item_idx", "left"), tot, n_max)
            .select("item_idx", F.when(F.col("_c").isNull(), F.log(1.0 / F.col("_n")))
                    .otherwise(F.log(F.col("_c") / F.col("_t"))).alias("log_q")))

