"""Feature-decision analyses.

Quintile bins come from exact ranks (dense indices) and the closed-form
position of ``qcut``-style edges, not from a global window; cumulative
purchase shares are computed over the (small) table of distinct purchase
counts, so no step orders all items in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import attach, rnd, safe_divide
from clickloom.operators.ordering import dense_index, exact_quantiles

# Quintile labels, concentration cuts, price-tier classes, decision thresholds.
BIN_LABELS = ("very_cold", "cold", "medium", "warm", "hot")
CONCENTRATION_CUTS = (0.50, 0.70, 0.85)
MATCH_RATE_MIN = 0.30
PRICE_CORR_MIN = 0.4
ZERO_PURCHASE_PCT_MIN = 40.0


def item_stats(inter: DataFrame) -> DataFrame:
    """Per item: confidence, views, purchases, purchase rate and distinct users."""
    return inter.groupBy("product_id").agg(
        F.sum("confidence_score").alias("total_confidence"), F.sum("n_views").alias("n_views"),
        F.sum("n_purchases").alias("n_purchases"), F.count_distinct("user_id").alias("n_users")).withColumn(
        "purchase_rate", safe_divide(F.col("n_purchases"), F.col("n_views")))


def quintile_bins(stats: DataFrame, metric: str, n_bins: int = 5) -> DataFrame:
    """Items binned into ``n_bins`` equal-count bins by rank of ``metric``
    (ties by product id): rank r of N falls in bin #{j : r > 1 + (N-1) j / n_bins}."""
    ranked = dense_index(stats.select(metric, "product_id"), [metric, "product_id"], "_r", start=1)
    n = stats.agg(F.count(F.lit(1)).alias("_n"))
    r = attach(ranked, n)
    b = sum((F.col("_r") > F.lit(1) + (F.col("_n") - 1) * j / n_bins).cast("int") for j in range(1, n_bins))
    labels = F.array(*[F.lit(x) for x in BIN_LABELS])
    binned = stats.join(r.select("product_id", b.alias("bin")), "product_id")
    return binned.groupBy("bin").agg(
        F.count(F.lit(1)).alias("n_items"), rnd(F.avg(metric), 4).alias("avg_metric"),
        rnd(F.avg((F.col("n_purchases") > 0).cast("double")), 4).alias("pct_purchased"),
        rnd(F.avg("purchase_rate"), 4).alias("avg_purchase_rate")).select(
        F.element_at(labels, F.col("bin") + 1).alias("bin_label"), "*")


def purchase_concentration(stats: DataFrame, thresholds=(0.5, 0.8, 0.9)) -> DataFrame:
    """% of purchased items (by purchases, descending) needed to reach each
    share of all purchases. Works on the table of distinct purchase counts."""
    from pyspark.sql import Window
    p = stats.filter(F.col("n_purchases") > 0)
    groups = p.groupBy(F.col("n_purchases").alias("n")).agg(F.count(F.lit(1)).alias("c"))
    w = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)  # distinct counts only
    g = groups.select("n", "c", F.coalesce(F.sum(F.col("n") * F.col("c")).over(w), F.lit(0)).alias("cum_before"),
                      F.coalesce(F.sum("c").over(w), F.lit(0)).alias("items_before"))
    tot = p.agg(F.sum("n_purchases").alias("_tot"), F.count(F.lit(1)).alias("_items"))
    out = None
    for t in thresholds:
        need = F.ceil((F.lit(t) * F.col("_tot") - F.col("cum_before")) / F.col("n"))
        cand = (attach(g, tot)
                .withColumn("_j", F.greatest(need, F.lit(1)))
                .filter(F.col("_j") <= F.col("c"))
                .agg(F.min(F.col("items_before") + F.col("_j")).alias("rank"), F.max("_items").alias("_items")))
        row = cand.select(F.lit(t).alias("share"), F.col("rank").cast("long"),
                          rnd(F.col("rank") * 100.0 / F.col("_items"), 6).alias("pct_items"))
        out = row if out is None else out.unionByName(row)
    return out


def top_category_shares(train: DataFrame, items: DataFrame) -> DataFrame:
    """``user_id, share``: the share of a user's events in their top category."""
    e = train.select("user_id", "product_id").join(items.select("product_id", "cat_l1"), "product_id")
    per = e.groupBy("user_id", "cat_l1").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("user_id").agg((F.max("n") / F.sum("n")).alias("share"))


def describe(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles of a column,
    one row (exact quartiles)."""
    one = df.agg(F.count(col).alias("count"), rnd(F.avg(col), 6).alias("mean"), rnd(F.stddev_samp(col), 6).alias("std"),
                 rnd(F.min(col), 6).alias("min"), rnd(F.max(col), 6).alias("max"))
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75])
    # three rows become one
    at = lambda p: rnd(F.max(F.when(F.col("prob") == p, F.col("value"))), 6)
    return attach(one, q.agg(at(0.25).alias("p25"), at(0.5).alias("p50"), at(0.75).alias("p75")))


def top_category_concentration(train: DataFrame, items: DataFrame) -> DataFrame:
    """Per user the share of events in the top category, summarised:
    mean share and users per class (<50 %, 50-70 %, 70-85 %, >=85 %)."""
    u = top_category_shares(train, items)
    a, b, c = CONCENTRATION_CUTS
    s = F.col("share")
    return u.agg(F.count(F.lit(1)).alias("n_users"), rnd(F.avg(s), 6).alias("mean_share"),
                 F.count_if(s < a).alias("lt_50"), F.count_if((s >= a) & (s < b)).alias("from_50_to_70"),
                 F.count_if((s >= b) & (s < c)).alias("from_70_to_85"), F.count_if(s >= c).alias("ge_85"))


def top_category_match(test: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Share of test purchases whose item category equals the user's top
    category, overall and per category, with the > 0.30 decision."""
    pur = (test.filter(F.col("event_type") == "purchase").select("user_id", "product_id")
           .join(users.select("user_id", "top_category"), "user_id")
           .join(items.select("product_id", "cat_l1"), "product_id")
           .withColumn("m", (F.col("cat_l1") == F.col("top_category")).cast("double")))
    overall = pur.agg(F.count(F.lit(1)).alias("n_purchases"), rnd(F.avg("m"), 6).alias("match_rate")).select(
        F.lit("overall").alias("category"), "*")
    per = pur.groupBy(F.col("cat_l1").alias("category")).agg(F.count(F.lit(1)).alias("n_purchases"),
                                                             rnd(F.avg("m"), 6).alias("match_rate"))
    return overall.unionByName(per).withColumn("include", F.col("match_rate") > MATCH_RATE_MIN)


def price_tier_consistency(train: DataFrame, items: DataFrame) -> DataFrame:
    """For users with >= 2 purchases, sample std of the purchased items'
    price buckets, in four classes."""
    p = (train.filter(F.col("event_type") == "purchase").select("user_id", "product_id")
         .join(items.select("product_id", "price_bucket"), "product_id"))
    u = p.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("price_bucket").alias("sd")).filter(
        F.col("n") >= 2)
    cls = (F.when(F.col("sd") == 0, "single_tier").when(F.col("sd") <= 0.5, "tight")
           .when(F.col("sd") <= 1.0, "moderate").otherwise("wide"))
    return u.groupBy(cls.alias("price_tier_class")).agg(F.count(F.lit(1)).alias("n_users"))


def price_stability(train: DataFrame, test: DataFrame) -> DataFrame:
    """Pearson correlation of users' mean purchase price in train and test."""
    def avg_price(df, name):
        return (df.filter(F.col("event_type") == "purchase").groupBy("user_id")
                .agg(F.avg("price").alias(name)))
    j = avg_price(train, "p_train").join(avg_price(test, "p_test"), "user_id")
    return j.agg(F.count(F.lit(1)).alias("n_users"), rnd(F.corr("p_train", "p_test"), 6).alias("corr")).withColumn(
        "include", F.col("corr") > PRICE_CORR_MIN)


def decision_table(bins: DataFrame, train_users: DataFrame, train: DataFrame, match: DataFrame,
                   stability: DataFrame) -> DataFrame:
    """One row per candidate feature: metric, value and include decision."""
    from pyspark.sql import Window
    order = F.when(F.col("bin_label") == "very_cold", 0).when(F.col("bin_label") == "cold", 1).when(
        F.col("bin_label") == "medium", 2).when(F.col("bin_label") == "warm", 3).otherwise(4)
    b = bins.select(order.alias("o"), "avg_purchase_rate")
    w = Window.orderBy("o")  # five bins
    steps = b.select((F.col("avg_purchase_rate") - F.lag("avg_purchase_rate").over(w)).alias("d"))
    mono = steps.agg(F.count_if(F.col("d") > 0).cast("double").alias("value")).select(
        F.lit("popularity_bin").alias("feature"), F.lit("increasing_steps_of_4").alias("metric"), "value",
        (F.col("value") == 4).alias("include"))
    buyers = train.filter(F.col("event_type") == "purchase").select("user_id").distinct()
    zp = train_users.join(buyers.withColumn("_b", F.lit(1)), "user_id", "left").agg(
        rnd(F.count_if(F.col("_b").isNull()) * 100.0 / F.count(F.lit(1)), 6).alias("value")).select(
        F.lit("has_purchase_history").alias("feature"), F.lit("zero_purchase_pct").alias("metric"), "value",
        (F.col("value") > ZERO_PURCHASE_PCT_MIN).alias("include"))
    mr = match.filter(F.col("category") == "overall").select(
        F.lit("top_category").alias("feature"), F.lit("match_rate").alias("metric"),
        F.col("match_rate").alias("value"), "include")
    st = stability.select(F.lit("avg_purchase_price").alias("feature"), F.lit("train_test_corr").alias("metric"),
                          F.col("corr").alias("value"), "include")
    return mono.unionByName(zp).unionByName(mr).unionByName(st)
