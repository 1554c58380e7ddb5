"""Data profiling aggregates (A6-A22, A25-A27, A30) and the small-list cross join J7.

Every profile is a grouped aggregation (partial, map-side combined) or a
two-level aggregation whose second level runs on already-reduced rows. Shares
"of the total" join a one-row total (a 1 x n cross join) instead of a global
``OVER ()`` window, so no step funnels all rows into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.columns import attach, bucket_label, category_level, rnd
from clickloom.operators.ordering import exact_quantiles, previous_within


def with_share(df: DataFrame, count_col: str, out: str, digits: int = 6) -> DataFrame:
    """W4 (``count / sum(count) over ()``): joins the one-row total."""
    total = df.agg(F.sum(count_col).alias("_tot"))
    return (attach(df, total)
            .withColumn(out, rnd(F.col(count_col) * 100.0 / F.col("_tot"), digits))
            .drop("_tot"))


def monthly_volume(df: DataFrame, ts_col: str = "event_time", user_col: str = "user_id",
                   item_col: str = "product_id", type_col: str = "event_type") -> DataFrame:
    """Events, users, items and type rates per calendar month."""
    n = F.count(F.lit(1))
    t = F.col(type_col)
    return (df.groupBy(F.date_format(ts_col, "yyyy-MM").alias("month"))
            .agg(n.alias("n_events"), F.count_distinct(user_col).alias("n_users"),
                 F.count_distinct(item_col).alias("n_items"),
                 rnd(F.count_if(t == "view") * 100.0 / n, 6).alias("view_pct"),
                 rnd(F.count_if(t == "cart") * 100.0 / n, 6).alias("cart_pct"),
                 rnd(F.count_if(t == "purchase") * 100.0 / n, 6).alias("purchase_pct")))


def null_audit(df: DataFrame, cols: Sequence[str] = ("category_code", "brand", "user_session"),
               by: str = "event_type") -> DataFrame:
    """Null counts per column, the correlated null (first two columns both
    null), per event type."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols]
    aggs.append(F.count_if(F.col(cols[0]).isNull() & F.col(cols[1]).isNull()).alias("null_both"))
    return df.groupBy(by).agg(*aggs)


def duplicate_profile(df: DataFrame, keys: Sequence[str] = ("event_time", "event_type", "product_id",
                                                            "user_id", "user_session"),
                      group: Sequence[str] = ("user_id", "product_id", "event_type"),
                      ts_col: str = "event_time", tiebreak: Sequence[str] = ("user_session", "price"),
                      gaps: Sequence[int] = (1, 5, 30)) -> DataFrame:
    """Exact duplicates (rows minus distinct key sets) and near duplicates,
    i.e. events within ``g`` whole seconds of the previous event of the same
    (user, item, type), for each ``g``."""
    n_distinct = df.select(*keys).distinct().agg(F.count(F.lit(1)).alias("n_distinct"))
    secs = F.unix_timestamp(F.col(ts_col))
    lagged = previous_within(df.withColumn("_s", secs), list(group), ts_col, list(tiebreak), ["_s"], max(gaps),
                             out="_p")
    gap = F.col("_s") - F.col("_p._s")
    near = lagged.agg(F.count(F.lit(1)).alias("n_rows"),
                      *[F.count_if(F.col("_p").isNotNull() & (gap <= g)).alias(f"near_dup_le_{g}s")
                        for g in gaps])
    out = attach(near, n_distinct)
    return out.select("n_rows", (F.col("n_rows") - F.col("n_distinct")).alias("exact_dups"),
                      *[f"near_dup_le_{g}s" for g in gaps])


def price_summary(df: DataFrame, col: str = "price") -> DataFrame:
    """A9 (scalars): min, max, mean, zero and below-1 counts, and the count
    above the mean plus three population standard deviations."""
    p = F.col(col)
    base = df.agg(F.min(p).alias("min_price"), F.max(p).alias("max_price"),
                  F.avg(p).alias("_avg"), F.stddev_pop(p).alias("_sd"),
                  F.count_if(p == 0).alias("n_zero"), F.count_if(p < 1).alias("n_below_1"))
    outl = attach(df.select(p.alias(col)), base.select("_avg", "_sd")).agg(
        F.count_if(p > F.col("_avg") + 3 * F.col("_sd")).alias("n_above_3sd"))
    return attach(base, outl).select("min_price", "max_price", rnd("_avg", 6).alias("avg_price"),
                                       rnd("_sd", 6).alias("std_price"), "n_zero", "n_below_1",
                                       "n_above_3sd")


def percentiles(df: DataFrame, col: str, probs: Sequence[float], metric: str) -> DataFrame:
    """Exact percentiles as rows ``(metric, prob, value)`` (distributed, see ordering)."""
    q = exact_quantiles(df, col, probs)
    return q.select(F.lit(metric).alias("metric"), rnd("prob", 6).alias("prob"),
                    rnd("value", 6).alias("value"))


# Bands of the price histogram (upper bounds, exclusive) after null and <=0.
PRICE_BANDS = ((1, "0-1"), (10, "1-10"), (50, "10-50"), (100, "50-100"), (500, "100-500"), (1000, "500-1k"), (5000, "1k-5k"),
               (10000, "5k-10k"))


def price_histogram(df: DataFrame, price_col: str = "price", item_col: str = "product_id") -> DataFrame:
    """events and distinct products of each price band, null and non-positive
    prices in bands of their own; ``position`` orders the bands by price."""
    price = F.col(price_col)
    band, place = F.lit(">10k"), F.lit(len(PRICE_BANDS) + 2)
    for i, (edge, label) in reversed(list(enumerate(PRICE_BANDS))):
        band, place = F.when(price < edge, label).otherwise(band), F.when(price < edge, i + 2).otherwise(place)
    band = F.when(price.isNull(), "NULL").when(price <= 0, "<=0").otherwise(band)
    place = F.when(price.isNull(), 0).when(price <= 0, 1).otherwise(place)
    return (df.groupBy(band.alias("price_band"), place.cast("int").alias("position"))
            .agg(F.count(F.lit(1)).alias("event_count"), F.count_distinct(item_col).alias("unique_products")))


# Bucket edges of the histograms (lower bounds, inclusive).
USER_EVENT_EDGES = (1, 2, 5, 10, 20, 50, 100)
EPD_EDGES = (0, 2, 5, 10, 50, 300)
ITEM_EVENT_EDGES = (1, 5, 10, 50, 100, 500, 1000)
SESSION_LEN_EDGES = (1, 2, 3, 5, 10, 20, 50)
K_THRESHOLDS = (1, 2, 3, 5, 10, 20, 30, 50)


def histogram(per_key: DataFrame, value_col: str, edges: Sequence[float], sum_col: str | None = None) -> DataFrame:
    """Second-level histogram of an already aggregated per-key table: bucket
    order, label, keys in the bucket, their share (%), optional summed column."""
    b = per_key.select(bucket_label(F.col(value_col), edges).alias("_b"), *( [sum_col] if sum_col else []))
    aggs = [F.count(F.lit(1)).alias("n")]
    if sum_col:
        aggs.append(F.sum(sum_col).cast("long").alias(f"sum_{sum_col}"))
    out = b.groupBy(F.col("_b.order").alias("bucket_order"), F.col("_b.label").alias("bucket")).agg(*aggs)
    return with_share(out, "n", "pct")


def user_activity_histogram(df: DataFrame, user_col: str = "user_id") -> DataFrame:
    """A10."""
    per_user = df.groupBy(user_col).agg(F.count(F.lit(1)).alias("n_events"))
    return histogram(per_user, "n_events", USER_EVENT_EDGES, "n_events")


def events_per_active_day_histogram(df: DataFrame, user_col: str = "user_id",
                                    ts_col: str = "event_time") -> DataFrame:
    """Events / distinct active days per user, bucketed."""
    per_user = df.groupBy(user_col).agg(
        (F.count(F.lit(1)) / F.count_distinct(F.to_date(ts_col))).alias("epd"))
    return histogram(per_user, "epd", EPD_EDGES)


def k_survival(df: DataFrame, thresholds: Sequence[int] = K_THRESHOLDS, user_col: str = "user_id") -> DataFrame:
    """A12 + A30 + J7: users with at least k events for each k (the k list is a
    literal array exploded against the per-user counts), % of the k=min row,
    and the marginal loss from the previous k (lag over the tiny k table)."""
    per_user = df.groupBy(user_col).agg(F.count(F.lit(1)).alias("n"))
    ks = F.explode(F.array(*[F.lit(k) for k in thresholds])).alias("min_interactions")
    crossed = per_user.select("n", ks).filter(F.col("n") >= F.col("min_interactions"))
    counts = crossed.groupBy("min_interactions").agg(F.count(F.lit(1)).alias("n_users"))
    grid = df.sparkSession.createDataFrame([(k,) for k in thresholds], "min_interactions int")
    counts = grid.join(counts, "min_interactions", "left").fillna(0, ["n_users"])
    mx = counts.agg(F.max("n_users").alias("_mx"))
    w = Window.orderBy("min_interactions")  # k table: len(thresholds) rows
    return (attach(counts, mx)
            .select("min_interactions", "n_users",
                    rnd(F.col("n_users") * 100.0 / F.col("_mx"), 6).alias("pct_of_max"),
                    (F.lag("n_users").over(w) - F.col("n_users")).alias("marginal_loss")))


def product_activity_histogram(df: DataFrame, item_col: str = "product_id") -> DataFrame:
    """A13 (histogram)."""
    per_item = df.groupBy(item_col).agg(F.count(F.lit(1)).alias("n_events"))
    return histogram(per_item, "n_events", ITEM_EVENT_EDGES, "n_events")


def top_products(df: DataFrame, k: int = 100, item_col: str = "product_id",
                 user_col: str = "user_id", type_col: str = "event_type") -> DataFrame:
    """A13 (table) + W7: the ``k`` most active products with brand and category."""
    t = F.col(type_col)
    return (df.groupBy(item_col)
            .agg(F.count(F.lit(1)).alias("n_events"), F.count_distinct(user_col).alias("n_users"),
                 F.count_if(t == "purchase").alias("n_purchases"),
                 F.max("brand").alias("brand"), F.max("category_code").alias("category_code"))
            .orderBy(F.desc("n_events"), F.asc(item_col)).limit(k))


def session_lengths(df: DataFrame, session_col: str = "user_session", ts_col: str = "event_time") -> DataFrame:
    return df.groupBy(session_col).agg(
        F.count(F.lit(1)).alias("n_events"),
        (F.unix_timestamp(F.max(ts_col)) - F.unix_timestamp(F.min(ts_col))).alias("duration_s"))


def session_length_histogram(df: DataFrame) -> DataFrame:
    """A14."""
    return histogram(session_lengths(df), "n_events", SESSION_LEN_EDGES, "n_events")


def session_duration_stats(df: DataFrame) -> DataFrame:
    """A15 (counts): sessions, zero-length, over 1 h, over 8 h, mean seconds."""
    d = F.col("duration_s")
    return session_lengths(df).agg(F.count(F.lit(1)).alias("n_sessions"),
                                   F.count_if(d == 0).alias("n_zero"),
                                   F.count_if(d > 3600).alias("n_over_1h"),
                                   F.count_if(d > 8 * 3600).alias("n_over_8h"),
                                   rnd(F.avg(d), 6).alias("avg_duration_s"))


def funnel(df: DataFrame, user_col: str = "user_id", type_col: str = "event_type") -> DataFrame:
    """Users who viewed / carted / purchased, and shares of viewers."""
    t = F.col(type_col)
    per_user = df.groupBy(user_col).agg(F.max((t == "view").cast("int")).alias("v"),
                                        F.max((t == "cart").cast("int")).alias("c"),
                                        F.max((t == "purchase").cast("int")).alias("p"))
    agg = per_user.agg(F.count(F.lit(1)).alias("n_users"),
                       F.sum("v").cast("long").alias("viewed"), F.sum("c").cast("long").alias("carted"),
                       F.sum("p").cast("long").alias("purchased"),
                       F.count_if((F.col("v") == 1) & (F.col("c") == 1)).alias("viewed_and_carted"),
                       F.count_if((F.col("c") == 1) & (F.col("p") == 1)).alias("carted_and_purchased"))
    return agg.select("*", rnd(F.col("carted") * 100.0 / F.col("viewed"), 6).alias("cart_pct_of_viewers"),
                      rnd(F.col("purchased") * 100.0 / F.col("viewed"), 6).alias("purchase_pct_of_viewers"))


def conversion_rates(df: DataFrame, min_views: int = 10, user_col: str = "user_id",
                     type_col: str = "event_type") -> DataFrame:
    """A18 (per user): purchases / views for users with at least ``min_views`` views."""
    t = F.col(type_col)
    return (df.groupBy(user_col)
            .agg(F.count_if(t == "view").alias("n_views"), F.count_if(t == "purchase").alias("n_purchases"))
            .filter(F.col("n_views") >= min_views)
            .withColumn("conversion", F.col("n_purchases") / F.col("n_views")))


def month_overlap(df: DataFrame, user_col: str = "user_id", ts_col: str = "event_time") -> DataFrame:
    """A19 + J6: users active in both month a and month b (a <= b).

    Pairs are never formed per user: users are first reduced to their sorted
    set of active months (bounded by the calendar) and counted per distinct
    set; month pairs are expanded once per distinct set, weighted by its user
    count."""
    um = df.select(user_col, F.date_format(ts_col, "yyyy-MM").alias("m")).distinct()
    sets = (um.groupBy(user_col).agg(F.array_sort(F.collect_list("m")).alias("ms"))
            .groupBy("ms").agg(F.count(F.lit(1)).alias("w")))
    a = sets.select("w", "ms", F.posexplode("ms").alias("i", "month_a"))
    pairs = a.select("w", "i", "month_a", F.explode(F.slice("ms", F.col("i") + 1, F.size("ms"))).alias("month_b"))
    return pairs.groupBy("month_a", "month_b").agg(F.sum("w").cast("long").alias("n_users"))


def category_landscape(df: DataFrame, level: int = 1, item_col: str = "product_id",
                       user_col: str = "user_id") -> DataFrame:
    """Events, items, users and event share per category level."""
    c = category_level(F.col("category_code"), level)
    out = df.groupBy(c.alias("category")).agg(F.count(F.lit(1)).alias("n_events"),
                                              F.count_distinct(item_col).alias("n_items"),
                                              F.count_distinct(user_col).alias("n_users"))
    return with_share(out, "n_events", "pct_events")


def brand_landscape(df: DataFrame, k: int = 20, item_col: str = "product_id") -> DataFrame:
    """A20 (brands) + W7: top ``k`` brands by events with their share."""
    out = df.groupBy("brand").agg(F.count(F.lit(1)).alias("n_events"),
                                  F.count_distinct(item_col).alias("n_items"))
    return with_share(out, "n_events", "pct_events").orderBy(F.desc("n_events"), "brand").limit(k)


def category_depth_nulls(df: DataFrame) -> DataFrame:
    """A20 (depth and null pattern): events by category depth and by which of
    category/brand is missing."""
    depth = F.when(F.col("category_code").isNull(), F.lit(0)).otherwise(F.size(F.split("category_code", r"\.")))
    pattern = F.concat(F.when(F.col("category_code").isNull(), "cat_null").otherwise("cat_ok"), F.lit("/"),
                       F.when(F.col("brand").isNull(), "brand_null").otherwise("brand_ok"))
    return df.groupBy(depth.alias("depth"), pattern.alias("null_pattern")).agg(F.count(F.lit(1)).alias("n_events"))


def active_months_histogram(df: DataFrame, user_col: str = "user_id", ts_col: str = "event_time") -> DataFrame:
    """A21 (active months per user)."""
    per_user = df.groupBy(user_col).agg(F.count_distinct(F.date_format(ts_col, "yyyy-MM")).alias("months"))
    return per_user.groupBy("months").agg(F.count(F.lit(1)).alias("n_users"))


def repurchase_histogram(df: DataFrame, user_col: str = "user_id", item_col: str = "product_id",
                         type_col: str = "event_type") -> DataFrame:
    """A21 (purchases per purchased (user, item) pair)."""
    per_pair = (df.filter(F.col(type_col) == "purchase").groupBy(user_col, item_col)
                .agg(F.count(F.lit(1)).alias("purchases")))
    return per_pair.groupBy("purchases").agg(F.count(F.lit(1)).alias("n_pairs"))


def hour_dow_distribution(df: DataFrame, ts_col: str = "event_time") -> DataFrame:
    """Events per hour of day and per day of week (1 = Sunday)."""
    h = df.groupBy(F.hour(ts_col).alias("bucket")).agg(F.count(F.lit(1)).alias("n_events"))
    d = df.groupBy(F.dayofweek(ts_col).alias("bucket")).agg(F.count(F.lit(1)).alias("n_events"))
    return (h.select(F.lit("hour").alias("kind"), "bucket", "n_events")
            .unionByName(d.select(F.lit("dow").alias("kind"), "bucket", "n_events")))


def category_item_counts(df: DataFrame, level: int = 2, item_col: str = "product_id") -> DataFrame:
    """Distinct items per category and % of the catalogue."""
    c = category_level(F.col("category_code"), level)
    per = df.select(c.alias("category"), item_col).distinct().groupBy("category").agg(
        F.count(F.lit(1)).alias("n_items"))
    catalog = df.agg(F.count_distinct(item_col).alias("_cat"))
    return (attach(per, catalog)
            .select("category", "n_items", rnd(F.col("n_items") * 100.0 / F.col("_cat"), 6).alias("pct_catalog")))


def item_first_seen(df: DataFrame, cutoff_col: Column, item_col: str = "product_id",
                    ts_col: str = "event_time") -> DataFrame:
    """First event per item, days to the cutoff and its log1p."""
    first = df.groupBy(item_col).agg(F.min(ts_col).alias("first_seen"))
    days = (F.unix_timestamp(cutoff_col) - F.unix_timestamp("first_seen")) / 86400.0
    return first.select(item_col, "first_seen", rnd(days, 6).alias("days_to_cutoff"),
                        rnd(F.log1p(F.greatest(days, F.lit(0.0))), 6).alias("log_days_to_cutoff"))


def popularity_share(df: DataFrame, item_col: str = "product_id", weight: Column | None = None) -> DataFrame:
    """Each item's share of all events (or of a weight's total)."""
    w = weight if weight is not None else F.lit(1)
    per = df.groupBy(item_col).agg(F.sum(w).cast("double").alias("n"))
    total = per.agg(F.sum("n").alias("_t"))
    return attach(per, total).select(item_col, F.col("n").alias("weight"),
                                       (F.col("n") / F.col("_t")).alias("share"))


def month_overlap_matrix(long: DataFrame) -> DataFrame:
    """A19 (matrix form): the symmetric month x month table of shared users,
    pivoted from :func:`month_overlap`. The pivot values are the calendar
    months (bounded by the calendar), listed explicitly so no extra pass is
    needed to discover them."""
    months = sorted(r[0] for r in long.select("month_a").union(long.select("month_b")).distinct().collect())
    both = long.unionByName(long.filter(F.col("month_a") != F.col("month_b")).select(
        F.col("month_b").alias("month_a"), F.col("month_a").alias("month_b"), "n_users"))
    return both.groupBy("month_a").pivot("month_b", months).agg(F.first("n_users")).fillna(0)
