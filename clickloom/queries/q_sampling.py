"""Sampling, time filters and split queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from clickloom.operators import sampling as S
from clickloom.queries import register
from clickloom.queries.common import clean, labelled, order_interactions, split
from clickloom.queries.sql_base import CLEAN, DIRTY, ORDER_EVENTS, SPLITS, with_
from clickloom.sources.testdata import dirty_clickstream

CS = ("event_time, event_type, product_id, category_id, category_code, brand, price, "
      "user_id, user_session")


@register("hash_user_sample_50", with_(CLEAN) + f"""
SELECT {CS} FROM clean WHERE user_id IN (
  SELECT user_id FROM (SELECT DISTINCT user_id FROM clean)
  ORDER BY md5(CAST(user_id AS VARCHAR)), user_id LIMIT 50)""")
def q_hash_sample(spark, sf):
    return S.hash_user_sample(clean(spark, sf), 50)


@register("seeded_user_sample_30pct", with_(CLEAN) + f"""
SELECT {CS} FROM clean
WHERE CAST('0x' || substr(md5('7:' || CAST(user_id AS VARCHAR)), 1, 15) AS BIGINT) % 1000000 < 300000""")
def q_seeded(spark, sf):
    return S.seeded_user_sample(clean(spark, sf), 0.3, seed=7)


# Exactly n users drawn with a seed, all their events.
@register("random_users_40", with_(CLEAN) + f"""
SELECT {CS} FROM clean WHERE user_id IN (
  SELECT user_id FROM (SELECT DISTINCT user_id FROM clean)
  ORDER BY md5('11:' || CAST(user_id AS VARCHAR)), user_id LIMIT 40)""")
def q_random_users(spark, sf):
    return S.hash_user_sample(clean(spark, sf), 40, seed=11)


@register("row_budget_sample_2000", with_(CLEAN) + f""",
pu AS (SELECT user_id, count(*) AS n FROM clean GROUP BY user_id HAVING count(*) >= 5),
ranked AS (SELECT user_id, row_number() OVER (ORDER BY md5(CAST(user_id AS VARCHAR)), user_id) AS rn
           FROM pu)
SELECT {CS} FROM clean WHERE user_id IN (
  SELECT user_id FROM ranked WHERE rn <= (SELECT greatest(1, ceil(2000 / avg(n))) FROM pu))""")
def q_budget(spark, sf):
    return S.row_budget_sample(clean(spark, sf), 2000, min_events=5)


@register("month_filter_orders", with_(ORDER_EVENTS) + """
SELECT * FROM oi WHERE strftime(event_time, '%Y-%m') IN ('1996-03', '1997-11', '1999-12')""")
def q_month(spark, sf):
    return S.month_filter(order_interactions(spark, sf), ["1996-03", "1997-11", "1999-12"])


@register("time_range_week2", with_(CLEAN) + f"""
SELECT {CS} FROM clean
WHERE event_time >= TIMESTAMP '2024-01-08' AND event_time < TIMESTAMP '2024-01-15'""")
def q_range(spark, sf):
    return S.time_range(clean(spark, sf), dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 15))


@register("split_labels", with_(SPLITS) + f"\nSELECT {CS}, split FROM labelled")
def q_split(spark, sf):
    return labelled(spark, sf)


@register("split_sizes", with_(SPLITS) + """
SELECT split, count(*) AS n_events, count(DISTINCT user_id) AS n_users,
       count(DISTINCT product_id) AS n_items FROM labelled GROUP BY split""")
def q_split_sizes(spark, sf):
    from pyspark.sql import functions as F
    return (labelled(spark, sf).groupBy("split")
            .agg(F.count(F.lit(1)).alias("n_events"), F.count_distinct("user_id").alias("n_users"),
                 F.count_distinct("product_id").alias("n_items")))


_OVERLAP = """
SELECT train_users, test_users, overlap_users,
       round(overlap_users * 100.0 / test_users, 6) AS overlap_pct,
       round(overlap_users * 100.0 / test_users, 6) BETWEEN 65 AND 85 AS gate_pass
FROM (SELECT count(DISTINCT user_id) AS train_users FROM {a})
CROSS JOIN (SELECT count(DISTINCT user_id) AS test_users FROM {b})
CROSS JOIN (SELECT count(*) AS overlap_users FROM
            (SELECT DISTINCT user_id FROM {a}) JOIN (SELECT DISTINCT user_id FROM {b}) USING (user_id))"""


@register("split_overlap_events", with_(SPLITS) + _OVERLAP.format(a="train", b="test"))
def q_overlap(spark, sf):
    return S.split_overlap(split(spark, sf, "train"), split(spark, sf, "test"))


@register("month_split_overlap_orders", with_(ORDER_EVENTS) + """,
tr AS (SELECT * FROM oi WHERE event_time >= TIMESTAMP '1998-01-01' AND event_time < TIMESTAMP '1998-07-01'),
te AS (SELECT * FROM oi WHERE event_time >= TIMESTAMP '1998-07-01' AND event_time < TIMESTAMP '1998-08-01')
""" + _OVERLAP.format(a="tr", b="te"))
def q_month_overlap(spark, sf):
    oi = order_interactions(spark, sf)
    tr = S.month_filter(oi, [f"1998-{m:02d}" for m in range(1, 7)])
    te = S.month_filter(oi, ["1998-07"])
    return S.split_overlap(tr, te)


VALIDATION = """
SELECT count(DISTINCT user_id) AS n_users, count(*) AS n_events, count(DISTINCT product_id) AS n_items,
       min(event_time) AS min_time, max(event_time) AS max_time,
       count_if(price < 1.0) AS n_below_price_floor, count_if(user_id IS NULL) AS n_null_users,
       count_if(user_session IS NULL) AS n_null_sessions, count_if(category_code IS NULL) AS n_null_category_code,
       count_if(brand IS NULL) AS n_null_brand, count_if(event_type = 'view') AS n_view,
       count_if(event_type = 'cart') AS n_cart, count_if(event_type = 'purchase') AS n_purchase,
       count_if(event_type IS NULL OR event_type NOT IN ('view', 'cart', 'purchase')) AS n_other_types,
       (SELECT count(*) FROM (SELECT user_id FROM (SELECT user_id, CAST(event_time AS DATE) AS d, count(*) AS n FROM {src} GROUP BY 1, 2)
                              GROUP BY user_id HAVING avg(n) > {bots})) AS n_bot_users,
       true AS time_is_timestamp, true AS schema_ok
FROM {src}"""


# Over the faulty table: nulls, cheap rows, unknown types and a bot are counted.
@register("dirty_table_validation", with_(DIRTY) + VALIDATION.format(src="dirty", bots=60))
def q_dirty_validation(spark, sf):
    return S.table_validation(dirty_clickstream(spark, sf), bot_threshold=60)


@register("table_validation", with_(CLEAN) + VALIDATION.format(src="clean", bots=300))
def q_validation(spark, sf):
    return S.table_validation(clean(spark, sf))


# A table whose times are text, whose prices are missing and that has a column too many.
@register("table_schema_validation", """
SELECT c AS "column", e AS expected_type, f AS found_type, s AS status FROM (VALUES
  ('brand', 'string', 'string', 'ok'), ('category_code', 'string', 'string', 'ok'), ('category_id', 'bigint', 'bigint', 'ok'),
  ('event_time', 'timestamp', 'string', 'wrong_type'), ('event_type', 'string', 'string', 'ok'), ('loaded', NULL, 'date', 'unexpected'),
  ('price', 'double', NULL, 'missing'), ('product_id', 'bigint', 'bigint', 'ok'), ('user_id', 'bigint', 'bigint', 'ok'),
  ('user_session', 'string', 'string', 'ok')) t(c, e, f, s)""")
def q_schema(spark, sf):
    raw = clean(spark, sf).withColumn("event_time", F.col("event_time").cast("string")).withColumn("loaded", F.current_date())
    return S.schema_validation(raw.drop("price"))


def _profile_sql(label: str, src: str) -> str:
    return (f"SELECT '{label}' AS label, count(*) AS n_events, "
            + ", ".join(f"round(count_if(event_type = '{t}') * 100.0 / count(*), 6) AS pct_{t}"
                        for t in ("view", "cart", "purchase"))
            + ", " + ", ".join(f"round(count_if({c} IS NULL) * 100.0 / count(*), 6) AS pct_null_{c}"
                               for c in ("category_code", "brand"))
            + f" FROM {src}")


@register("sample_representativeness", with_(CLEAN) + """,
s50 AS (SELECT * FROM clean WHERE user_id IN (
  SELECT user_id FROM (SELECT DISTINCT user_id FROM clean)
  ORDER BY md5(CAST(user_id AS VARCHAR)), user_id LIMIT 50))
""" + _profile_sql("full", "clean") + "\nUNION ALL\n" + _profile_sql("hash50", "s50"))
def q_repr(spark, sf):
    c = clean(spark, sf)
    return S.sample_profile({"full": c, "hash50": S.hash_user_sample(c, 50)})
