"""Profiling queries (A6-A22, A25-A27, A30) with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions.columns import bucket_sql, rnd
from clickloom.operators import profiling as P
from clickloom.queries import register
from clickloom.queries.common import TEST_START, clean, order_interactions
from clickloom.queries.sql_base import CLEAN, CLICKSTREAM, ORDER_EVENTS, secs, with_
from clickloom.sources.testdata import clickstream

PROBS = [round(i / 100, 2) for i in range(1, 101)]
QPROBS = [0.1, 0.25, 0.5, 0.75, 0.9, 0.99]


def _hist_sql(per_key: str, value: str, edges, sum_col: str | None = None) -> str:
    o, lab = bucket_sql(value, edges)
    extra = f", CAST(sum({sum_col}) AS BIGINT) AS sum_{sum_col}" if sum_col else ""
    return f"""
SELECT bucket_order, bucket, n{', sum_' + sum_col if sum_col else ''},
       round(n * 100.0 / sum(n) OVER (), 6) AS pct
FROM (SELECT {o} AS bucket_order, {lab} AS bucket, count(*) AS n{extra}
      FROM ({per_key}) GROUP BY 1, 2)"""


def _quant_sql(src: str, col: str, probs, metric: str) -> str:
    plist = "[" + ", ".join(str(p) for p in probs) + "]"
    return f"""
SELECT '{metric}' AS metric, round(unnest({plist}::DOUBLE[]), 6) AS prob,
       round(unnest(quantile_cont({col}, {plist}::DOUBLE[])), 6) AS value
FROM {src} WHERE {col} IS NOT NULL"""


@register("monthly_volume_orders", with_(ORDER_EVENTS) + """
SELECT strftime(event_time, '%Y-%m') AS month, count(*) AS n_events,
       count(DISTINCT user_id) AS n_users, count(DISTINCT product_id) AS n_items,
       round(count_if(event_type = 'view') * 100.0 / count(*), 6) AS view_pct,
       round(count_if(event_type = 'cart') * 100.0 / count(*), 6) AS cart_pct,
       round(count_if(event_type = 'purchase') * 100.0 / count(*), 6) AS purchase_pct
FROM oi GROUP BY 1""")
def q_monthly(spark, sf):
    return P.monthly_volume(order_interactions(spark, sf))


@register("null_audit", with_(CLICKSTREAM) + """
SELECT event_type, count(*) AS n_rows, count_if(category_code IS NULL) AS null_category_code,
       count_if(brand IS NULL) AS null_brand, count_if(user_session IS NULL) AS null_user_session,
       count_if(category_code IS NULL AND brand IS NULL) AS null_both
FROM clickstream GROUP BY event_type""")
def q_nulls(spark, sf):
    return P.null_audit(clickstream(spark, sf))


@register("duplicate_profile", with_(CLICKSTREAM) + f""",
lagged AS (
  SELECT {secs('event_time')} - lag({secs('event_time')}) OVER (
           PARTITION BY user_id, product_id, event_type ORDER BY event_time, user_session, price) AS gap
  FROM clickstream)
SELECT n_rows, n_rows - n_distinct AS exact_dups, near_dup_le_1s, near_dup_le_5s, near_dup_le_30s
FROM (SELECT count(*) AS n_rows, count_if(gap <= 1) AS near_dup_le_1s,
             count_if(gap <= 5) AS near_dup_le_5s, count_if(gap <= 30) AS near_dup_le_30s FROM lagged)
CROSS JOIN (SELECT count(*) AS n_distinct FROM (
  SELECT DISTINCT event_time, event_type, product_id, user_id, user_session FROM clickstream))""")
def q_dups(spark, sf):
    return P.duplicate_profile(clickstream(spark, sf))


@register("price_summary", with_(CLICKSTREAM) + """
SELECT min(price) AS min_price, max(price) AS max_price, round(avg(price), 6) AS avg_price,
       round(stddev_pop(price), 6) AS std_price, count_if(price = 0) AS n_zero,
       count_if(price < 1) AS n_below_1,
       count_if(price > (SELECT avg(price) + 3 * stddev_pop(price) FROM clickstream)) AS n_above_3sd
FROM clickstream""")
def q_price_summary(spark, sf):
    return P.price_summary(clickstream(spark, sf))


@register("price_percentiles", with_(CLICKSTREAM) + _quant_sql("clickstream", "price", PROBS, "price"))
def q_price_pct(spark, sf):
    return P.percentiles(clickstream(spark, sf), "price", PROBS, "price")


@register("user_activity_histogram", with_(CLEAN) + _hist_sql(
    "SELECT user_id, count(*) AS n_events FROM clean GROUP BY user_id", "n_events",
    P.USER_EVENT_EDGES, "n_events"))
def q_user_hist(spark, sf):
    return P.user_activity_histogram(clean(spark, sf))


@register("events_per_active_day_histogram", with_(CLEAN) + _hist_sql(
    "SELECT user_id, count(*) / count(DISTINCT CAST(event_time AS DATE)) AS epd FROM clean GROUP BY user_id",
    "epd", P.EPD_EDGES))
def q_epd_hist(spark, sf):
    return P.events_per_active_day_histogram(clean(spark, sf))


def _ksurv_sql() -> str:
    ks = ", ".join(f"({k})" for k in P.K_THRESHOLDS)
    return with_(CLEAN) + f""",
pu AS (SELECT user_id, count(*) AS n FROM clean GROUP BY user_id),
ks AS (SELECT * FROM (VALUES {ks}) t(min_interactions)),
c AS (SELECT CAST(ks.min_interactions AS INTEGER) AS min_interactions,
             count(pu.user_id) AS n_users
      FROM ks LEFT JOIN pu ON pu.n >= ks.min_interactions GROUP BY 1)
SELECT min_interactions, n_users, round(n_users * 100.0 / max(n_users) OVER (), 6) AS pct_of_max,
       lag(n_users) OVER (ORDER BY min_interactions) - n_users AS marginal_loss
FROM c"""


@register("k_survival_curve", _ksurv_sql())
def q_ksurv(spark, sf):
    return P.k_survival(clean(spark, sf))


@register("product_activity_histogram", with_(CLEAN) + _hist_sql(
    "SELECT product_id, count(*) AS n_events FROM clean GROUP BY product_id", "n_events",
    P.ITEM_EVENT_EDGES, "n_events"))
def q_item_hist(spark, sf):
    return P.product_activity_histogram(clean(spark, sf))


@register("top_products_100", with_(CLEAN) + """
SELECT product_id, count(*) AS n_events, count(DISTINCT user_id) AS n_users,
       count_if(event_type = 'purchase') AS n_purchases, max(brand) AS brand,
       max(category_code) AS category_code
FROM clean GROUP BY product_id ORDER BY n_events DESC, product_id LIMIT 100""")
def q_top100(spark, sf):
    return P.top_products(clean(spark, sf), 100)


SESS = f"""
SELECT user_session, count(*) AS n_events,
       {secs('max(event_time)')} - {secs('min(event_time)')} AS duration_s
FROM clean GROUP BY user_session"""


@register("session_length_histogram", with_(CLEAN) + _hist_sql(SESS, "n_events", P.SESSION_LEN_EDGES, "n_events"))
def q_sess_hist(spark, sf):
    return P.session_length_histogram(clean(spark, sf))


@register("session_duration_stats", with_(CLEAN) + f"""
SELECT count(*) AS n_sessions, count_if(duration_s = 0) AS n_zero,
       count_if(duration_s > 3600) AS n_over_1h, count_if(duration_s > 28800) AS n_over_8h,
       round(avg(duration_s), 6) AS avg_duration_s
FROM ({SESS})""")
def q_sess_dur(spark, sf):
    return P.session_duration_stats(clean(spark, sf))


@register("session_duration_quantiles", with_(CLEAN) + f", s AS ({SESS})" +
          _quant_sql("s", "duration_s", QPROBS, "session_duration_s"))
def q_sess_q(spark, sf):
    return P.percentiles(P.session_lengths(clean(spark, sf)), "duration_s", QPROBS, "session_duration_s")


@register("sessions_per_user_quantiles", with_(CLEAN) + """,
s AS (SELECT user_id, count(DISTINCT user_session) AS n_sessions FROM clean GROUP BY user_id)
""" + _quant_sql("s", "n_sessions", QPROBS, "sessions_per_user"))
def q_spu(spark, sf):
    per_user = clean(spark, sf).groupBy("user_id").agg(F.count_distinct("user_session").alias("n_sessions"))
    return P.percentiles(per_user, "n_sessions", QPROBS, "sessions_per_user")


@register("funnel", with_(CLEAN) + """,
pu AS (SELECT user_id, max(CAST(event_type = 'view' AS INT)) AS v, max(CAST(event_type = 'cart' AS INT)) AS c,
              max(CAST(event_type = 'purchase' AS INT)) AS p FROM clean GROUP BY user_id),
a AS (SELECT count(*) AS n_users, CAST(sum(v) AS BIGINT) AS viewed, CAST(sum(c) AS BIGINT) AS carted,
             CAST(sum(p) AS BIGINT) AS purchased, count_if(v = 1 AND c = 1) AS viewed_and_carted,
             count_if(c = 1 AND p = 1) AS carted_and_purchased FROM pu)
SELECT *, round(carted * 100.0 / viewed, 6) AS cart_pct_of_viewers,
       round(purchased * 100.0 / viewed, 6) AS purchase_pct_of_viewers FROM a""")
def q_funnel(spark, sf):
    return P.funnel(clean(spark, sf))


@register("conversion_rate_quantiles", with_(CLEAN) + """,
r AS (SELECT user_id, count_if(event_type = 'purchase') / count_if(event_type = 'view') AS conversion
      FROM clean GROUP BY user_id HAVING count_if(event_type = 'view') >= 10)
""" + _quant_sql("r", "conversion", QPROBS, "conversion_rate"))
def q_conv(spark, sf):
    return P.percentiles(P.conversion_rates(clean(spark, sf)), "conversion", QPROBS, "conversion_rate")


@register("month_overlap_orders", with_(ORDER_EVENTS) + """,
um AS (SELECT DISTINCT user_id, strftime(event_time, '%Y-%m') AS m FROM oi)
SELECT a.m AS month_a, b.m AS month_b, count(*) AS n_users
FROM um a JOIN um b ON a.user_id = b.user_id AND a.m <= b.m GROUP BY 1, 2""")
def q_overlap(spark, sf):
    return P.month_overlap(order_interactions(spark, sf))


@register("category_landscape_l1", with_(CLEAN) + """
SELECT category, n_events, n_items, n_users, round(n_events * 100.0 / sum(n_events) OVER (), 6) AS pct_events
FROM (SELECT coalesce(nullif(split_part(coalesce(category_code, 'unknown'), '.', 1), ''), 'unknown') AS category,
             count(*) AS n_events, count(DISTINCT product_id) AS n_items, count(DISTINCT user_id) AS n_users
      FROM clean GROUP BY 1)""")
def q_cat_land(spark, sf):
    return P.category_landscape(clean(spark, sf), 1)


@register("brand_landscape_top20", with_(CLEAN) + """
SELECT brand, n_events, n_items, round(n_events * 100.0 / sum(n_events) OVER (), 6) AS pct_events
FROM (SELECT brand, count(*) AS n_events, count(DISTINCT product_id) AS n_items FROM clean GROUP BY brand)
ORDER BY n_events DESC, brand LIMIT 20""")
def q_brand_land(spark, sf):
    return P.brand_landscape(clean(spark, sf), 20)


@register("category_depth_nulls", with_(CLICKSTREAM) + """
SELECT CASE WHEN category_code IS NULL THEN 0 ELSE len(string_split(category_code, '.')) END AS depth,
       (CASE WHEN category_code IS NULL THEN 'cat_null' ELSE 'cat_ok' END) || '/' ||
       (CASE WHEN brand IS NULL THEN 'brand_null' ELSE 'brand_ok' END) AS null_pattern,
       count(*) AS n_events
FROM clickstream GROUP BY 1, 2""")
def q_depth(spark, sf):
    return P.category_depth_nulls(clickstream(spark, sf))


@register("active_months_histogram_orders", with_(ORDER_EVENTS) + """
SELECT months, count(*) AS n_users FROM (
  SELECT user_id, count(DISTINCT strftime(event_time, '%Y-%m')) AS months FROM oi GROUP BY user_id)
GROUP BY months""")
def q_active_months(spark, sf):
    return P.active_months_histogram(order_interactions(spark, sf))


@register("repurchase_histogram_orders", with_(ORDER_EVENTS) + """
SELECT purchases, count(*) AS n_pairs FROM (
  SELECT user_id, product_id, count(*) AS purchases FROM oi WHERE event_type = 'purchase' GROUP BY 1, 2)
GROUP BY purchases""")
def q_repurchase(spark, sf):
    return P.repurchase_histogram(order_interactions(spark, sf))


@register("hour_dow_distribution", with_(CLEAN) + """
SELECT 'hour' AS kind, CAST(hour(event_time) AS INTEGER) AS bucket, count(*) AS n_events FROM clean GROUP BY 2
UNION ALL
SELECT 'dow' AS kind, CAST(dayofweek(event_time) + 1 AS INTEGER) AS bucket, count(*) AS n_events
FROM clean GROUP BY 2""")
def q_hour_dow(spark, sf):
    return P.hour_dow_distribution(clean(spark, sf))


@register("category_item_counts_l2", with_(CLEAN) + """
SELECT category, n_items, round(n_items * 100.0 / (SELECT count(DISTINCT product_id) FROM clean), 6) AS pct_catalog
FROM (SELECT category, count(*) AS n_items FROM (
  SELECT DISTINCT coalesce(nullif(split_part(coalesce(category_code, 'unknown'), '.', 2), ''), 'unknown') AS category,
         product_id FROM clean) GROUP BY category)""")
def q_cat_items(spark, sf):
    return P.category_item_counts(clean(spark, sf), 2)


@register("item_first_seen", with_(CLEAN) + f"""
SELECT product_id, first_seen, round(d, 6) AS days_to_cutoff, round(ln(1 + greatest(d, 0.0)), 6) AS log_days_to_cutoff
FROM (SELECT product_id, min(event_time) AS first_seen,
             ({secs("TIMESTAMP '2024-01-26 00:00:00'")} - {secs('min(event_time)')}) / 86400.0 AS d
      FROM clean GROUP BY product_id)""")
def q_first_seen(spark, sf):
    cutoff = F.lit(TEST_START.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return P.item_first_seen(clean(spark, sf), cutoff)


@register("item_popularity_share", with_(CLEAN) + """
SELECT product_id, CAST(n AS DOUBLE) AS weight, round(n * 1.0 / sum(n) OVER (), 6) AS share
FROM (SELECT product_id, count(*) AS n FROM clean GROUP BY product_id)""")
def q_pop_share(spark, sf):
    out = P.popularity_share(clean(spark, sf))
    return out.select("product_id", "weight", rnd("share", 6).alias("share"))


# A column for each month of the orders, in the oracle by conditional sums.
ORDER_MONTHS = [f"{y}-{m:02d}" for y in range(1995, 2002) for m in range(1, 13)][:80]


@register("month_overlap_matrix_orders", with_(ORDER_EVENTS) + """,
um AS (SELECT DISTINCT user_id, strftime(event_time, '%Y-%m') AS m FROM oi)
SELECT a.m AS month_a, """ + ", ".join(f"count_if(b.m = '{m}') AS \"{m}\"" for m in ORDER_MONTHS) + """
FROM um a JOIN um b USING (user_id) GROUP BY a.m""")
def q_overlap_matrix(spark, sf):
    return P.month_overlap_matrix(P.month_overlap(order_interactions(spark, sf)))
