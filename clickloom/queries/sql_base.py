"""DuckDB oracle building blocks (plain SQL over the pre-registered test views).

Each oracle query is ``WITH <shared CTEs> SELECT ...``. The CTEs restate the
library's semantics in the most direct SQL form (single unsplit windows,
unrolled loops), which is what makes them a useful cross-check of the
distributed Spark plans.
"""

from __future__ import annotations

SESSION_GAP = 12 * 3600


def secs(col: str) -> str:
    return f"CAST(floor(epoch({col})) AS BIGINT)"


CLICKSTREAM = f"""
cs_ev AS (
  SELECT e.event_id, e.ts AS event_time, e.user_id,
         CASE e.event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'cart'
                           ELSE e.event_type END AS event_type,
         e.value AS price,
         CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS product_id
  FROM events e
),
cs_part AS (
  SELECT cs_ev.*, CAST(p.p_size AS BIGINT) AS category_id,
         lower(p.p_type) || '.' || regexp_extract(p.p_name, '([^ ]+)$', 1) AS category_code,
         p.p_brand AS brand
  FROM cs_ev LEFT JOIN part p ON cs_ev.product_id = p.p_partkey
),
cs_lag AS (
  SELECT *, {secs('event_time')} AS _s,
         lag({secs('event_time')}) OVER (PARTITION BY user_id ORDER BY event_time, event_id) AS _ps
  FROM cs_part
),
clickstream_id AS (
  SELECT event_time, event_type, product_id, category_id, category_code, brand, price, user_id,
         CAST(user_id AS VARCHAR) || '-' || CAST(
           sum(CASE WHEN _ps IS NULL OR _s - _ps > {SESSION_GAP} THEN 1 ELSE 0 END)
             OVER (PARTITION BY user_id ORDER BY event_time, event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS VARCHAR) AS user_session,
         event_id
  FROM cs_lag
),
clickstream AS (
  SELECT event_time, event_type, product_id, category_id, category_code, brand, price, user_id,
         user_session FROM clickstream_id
)"""

_CLEAN_STEPS = """
cl_fill AS (
  SELECT event_time, event_type, product_id, category_id,
         coalesce(category_code, 'unknown') AS category_code, coalesce(brand, 'unknown') AS brand,
         price, user_id, user_session
  FROM {src} WHERE user_session IS NOT NULL
),
cl_exact AS (
  SELECT event_time, event_type, product_id, user_id, user_session,
         min({{'category_id': category_id, 'category_code': category_code, 'brand': brand,
              'price': price}}) AS _r
  FROM cl_fill GROUP BY event_time, event_type, product_id, user_id, user_session
),
cl_exact_flat AS (
  SELECT event_time, event_type, product_id, _r.category_id AS category_id,
         _r.category_code AS category_code, _r.brand AS brand, _r.price AS price,
         user_id, user_session
  FROM cl_exact
),
cl_near AS (
  SELECT * FROM (
    SELECT *, lag(CAST(floor(epoch(event_time)) AS BIGINT)) OVER (
             PARTITION BY user_id, product_id, event_type
             ORDER BY event_time, user_session, price) AS _ps
    FROM cl_exact_flat)
  WHERE _ps IS NULL OR CAST(floor(epoch(event_time)) AS BIGINT) - _ps > 1
),
cl_price AS (
  SELECT event_time, event_type, product_id, category_id, category_code, brand, price,
         user_id, user_session FROM cl_near WHERE price >= 1.0
),
cl_bots AS (
  SELECT user_id FROM (
    SELECT user_id, avg(n) AS a FROM (
      SELECT user_id, CAST(event_time AS DATE) AS d, count(*) AS n FROM cl_price GROUP BY 1, 2)
    GROUP BY user_id)
  WHERE a > 300
),
clean AS (
  SELECT * FROM cl_price WHERE user_id NOT IN (SELECT user_id FROM cl_bots)
)"""


def clean_sql(src: str, bots: int = 300) -> str:
    """The cleaning chain over the table ``src``."""
    return _CLEAN_STEPS.format(src=src).replace("a > 300", f"a > {bots}")


CLEAN = CLICKSTREAM + "," + clean_sql("clickstream")

DIRTY = CLICKSTREAM + """,
d_all AS (
  SELECT * FROM clickstream
  UNION ALL SELECT * REPLACE (price + 1 AS price) FROM clickstream WHERE event_type = 'purchase'
  UNION ALL SELECT * REPLACE (event_time + INTERVAL 1 SECOND AS event_time) FROM clickstream WHERE event_type = 'cart'
  UNION ALL SELECT c.* REPLACE (c.event_time + n.n * INTERVAL 20 SECOND AS event_time)
            FROM clickstream c CROSS JOIN range(1, 61) n(n) WHERE user_id = (SELECT min(user_id) FROM clickstream)
),
dirty AS (
  SELECT event_time, event_type, product_id, category_id,
         CASE WHEN category_id BETWEEN 1 AND 10 THEN NULL ELSE category_code END AS category_code,
         CASE WHEN category_id BETWEEN 1 AND 10 THEN NULL ELSE brand END AS brand,
         CASE WHEN event_type = 'error' THEN price / 100 ELSE price END AS price, user_id,
         CASE WHEN category_id BETWEEN 11 AND 13 THEN NULL ELSE user_session END AS user_session
  FROM d_all
)"""


def kcore_sql(src: str, k: int, rounds: int = 10, prefix: str = "kc") -> str:
    """Unrolled k-core: after the fixpoint further rounds change nothing, so
    ``rounds`` unrolled rounds equal "until stable or ``rounds`` rounds"."""
    parts = [f"{prefix}0 AS (SELECT * FROM {src})"]
    for i in range(1, rounds + 1):
        p = f"{prefix}{i - 1}"
        parts.append(
            f"{prefix}{i} AS (SELECT * FROM {p} WHERE user_id IN "
            f"(SELECT user_id FROM {p} GROUP BY user_id HAVING count(*) >= {k}) "
            f"AND product_id IN (SELECT product_id FROM {p} GROUP BY product_id "
            f"HAVING count(*) >= {k}))")
    return ",\n".join(parts)


INTERACTIONS_OF = """
SELECT user_id, product_id,
       CAST(count_if(event_type = 'purchase') * 4 + count_if(event_type = 'cart') * 2
            + count_if(event_type = 'view') AS BIGINT) AS confidence_score,
       count_if(event_type = 'view') AS n_views,
       count_if(event_type = 'cart') AS n_carts,
       count_if(event_type = 'purchase') AS n_purchases,
       min(event_time) AS first_interaction, max(event_time) AS last_interaction
FROM {src} WHERE event_type IN ('view', 'cart', 'purchase') GROUP BY user_id, product_id"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes if c.strip())


ORDER_EVENTS = """
oi AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS product_id, o.o_orderdate AS event_time,
         l.l_extendedprice AS price,
         CASE l.l_returnflag WHEN 'N' THEN 'view' WHEN 'A' THEN 'cart' ELSE 'purchase' END AS event_type,
         l.l_orderkey, l.l_linenumber
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

SPLIT_VAL = "2024-01-22 00:00:00"
SPLIT_TEST = "2024-01-26 00:00:00"

SPLITS = CLEAN + f""",
labelled AS (
  SELECT *, CASE WHEN event_time < TIMESTAMP '{SPLIT_VAL}' THEN 'train'
                 WHEN event_time < TIMESTAMP '{SPLIT_TEST}' THEN 'val' ELSE 'test' END AS split
  FROM clean
),
train AS (SELECT * EXCLUDE (split) FROM labelled WHERE split = 'train'),
val AS (SELECT * EXCLUDE (split) FROM labelled WHERE split = 'val'),
test AS (SELECT * EXCLUDE (split) FROM labelled WHERE split = 'test')"""


def scaled(expr: str, name: str, src_digits: int = 6) -> str:
    """Population z-score over all rows; zero std divides by 1 (oracle of standard_scale)."""
    sd = f"stddev_pop({expr}) OVER ()"
    return (f"round(({expr} - avg({expr}) OVER ()) / CASE WHEN coalesce({sd}, 0) = 0 THEN 1 ELSE {sd} END, "
            f"{src_digits}) AS {name}")


def str_vocab(src: str, col: str, name: str) -> str:
    return (f"{name} AS (SELECT {col} AS k, row_number() OVER (ORDER BY {col}) AS idx FROM "
            f"(SELECT DISTINCT {col} FROM {src} WHERE {col} IS NOT NULL AND {col} <> 'unknown') "
            f"UNION ALL SELECT 'unknown' AS k, 0 AS idx)")


def exact_mean_sql(expr: str, decimals: int, cond: str | None = None) -> str:
    """Oracle of ``functions.columns.exact_mean``."""
    e = f"CASE WHEN {cond} THEN {expr} END" if cond else expr
    m = f"{10 ** decimals}.0"
    return (f"(CASE WHEN count({e}) = 0 THEN NULL ELSE "
            f"CAST(sum(CAST(round(({e}) * {m}) AS BIGINT)) AS DOUBLE) / (count({e}) * {m}) END)")


FEATURES = SPLITS + ",\ninter_train AS (" + INTERACTIONS_OF.format(src="train") + """),
if_base AS (SELECT product_id, max(category_code) AS cc, max(brand) AS br, """ + exact_mean_sql("price", 6) + """ AS ap
            FROM clean GROUP BY product_id),
if_stats AS (SELECT product_id, sum(confidence_score) AS conf,
                    CASE WHEN sum(n_views) = 0 THEN NULL ELSE sum(n_purchases) / sum(n_views) END AS rate
             FROM inter_train GROUP BY product_id),
item_feats AS (
  SELECT b.product_id,
         coalesce(nullif(split_part(coalesce(cc, 'unknown'), '.', 1), ''), 'unknown') AS cat_l1,
         coalesce(nullif(split_part(coalesce(cc, 'unknown'), '.', 2), ''), 'unknown') AS cat_l2,
         coalesce(br, 'unknown') AS brand,
         CASE WHEN ap < 10 THEN 0 WHEN ap < 50 THEN 1 WHEN ap < 100 THEN 2 WHEN ap < 200 THEN 3
              WHEN ap < 500 THEN 4 WHEN ap < 1000 THEN 5 WHEN ap < 2000 THEN 6 ELSE 7 END AS price_bucket,
         round(ap, 4) AS avg_price,
         CAST(coalesce(conf, 0) AS BIGINT) AS item_total_confidence,
         coalesce(rate, 0.0) AS item_purchase_rate
  FROM if_base b LEFT JOIN if_stats s USING (product_id)),
uf_base AS (
  SELECT user_id, count(*) AS total_events, count(DISTINCT strftime(event_time, '%Y-%m')) AS months_active,
         round(count_if(event_type = 'purchase') / count(*), 4) AS purchase_rate,
         round(count_if(event_type = 'cart') / count(*), 4) AS cart_rate,
         count(DISTINCT user_session) AS n_sessions,
         CAST(floor(avg(hour(event_time)) / 6) AS INTEGER) AS peak_hour_bucket,
         CAST(round(avg(dayofweek(event_time) + 1)) AS INTEGER) AS preferred_dow
  FROM train GROUP BY user_id),
uf_enr AS (SELECT t.user_id, t.event_type, f.cat_l1, f.avg_price FROM train t JOIN item_feats f USING (product_id)),
uf_cat AS (SELECT user_id, cat_l1, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, cat_l1) AS rn
           FROM uf_enr GROUP BY user_id, cat_l1),
uf_price AS (SELECT user_id, """ + exact_mean_sql("avg_price", 4, "event_type = 'purchase'") + """ AS pp,
                    """ + exact_mean_sql("avg_price", 4) + """ AS vp, CAST(count_if(event_type = 'purchase') > 0 AS INTEGER) AS has_purchase_history
             FROM uf_enr GROUP BY user_id),
user_feats AS (
  SELECT b.user_id, b.total_events, b.months_active, b.purchase_rate, b.cart_rate, b.n_sessions,
         b.peak_hour_bucket, b.preferred_dow, coalesce(c.cat_l1, 'unknown') AS top_category,
         round(coalesce(p.pp, p.vp), 6) AS avg_purchase_price, p.has_purchase_history
  FROM uf_base b LEFT JOIN uf_cat c ON c.user_id = b.user_id AND c.rn = 1
  LEFT JOIN uf_price p ON p.user_id = b.user_id),
item_vocab AS (SELECT product_id, row_number() OVER (ORDER BY product_id) AS item_idx FROM item_feats),
user_vocab AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS user_idx
               FROM (SELECT DISTINCT user_id FROM inter_train)),
""" + str_vocab("item_feats", "cat_l1", "v_cat_l1") + ",\n" + str_vocab("item_feats", "cat_l2", "v_cat_l2") + \
    ",\n" + str_vocab("item_feats", "brand", "v_brand") + ",\n" + str_vocab("user_feats", "top_category", "v_top") + """,
ie_base AS (
  SELECT f.*, v.item_idx, coalesce(a.idx, 0) AS cat_l1_idx, coalesce(b.idx, 0) AS cat_l2_idx,
         coalesce(c.idx, 0) AS brand_idx
  FROM item_feats f JOIN item_vocab v USING (product_id)
  LEFT JOIN v_cat_l1 a ON a.k = f.cat_l1 LEFT JOIN v_cat_l2 b ON b.k = f.cat_l2 LEFT JOIN v_brand c ON c.k = f.brand),
items_enc AS (
  SELECT product_id, item_idx, cat_l1_idx, cat_l2_idx, brand_idx, price_bucket,
         """ + scaled("avg_price", "avg_price_scaled") + """,
         """ + scaled("ln(1 + item_total_confidence)", "log_confidence_scaled") + """,
         """ + scaled("item_purchase_rate", "purchase_rate_scaled") + """
  FROM ie_base),
ue_base AS (
  SELECT u.*, v.user_idx, coalesce(t.idx, 0) AS top_cat_idx
  FROM user_feats u JOIN user_vocab v USING (user_id) LEFT JOIN v_top t ON t.k = u.top_category),
users_enc AS (
  SELECT user_id, user_idx, top_cat_idx, peak_hour_bucket, preferred_dow - 1 AS preferred_dow, has_purchase_history,
         """ + scaled("ln(1 + total_events)", "log_total_events") + """,
         """ + scaled("CAST(months_active AS DOUBLE)", "months_active") + """,
         """ + scaled("purchase_rate", "purchase_rate") + """,
         """ + scaled("cart_rate", "cart_rate") + """,
         """ + scaled("ln(1 + n_sessions)", "log_n_sessions") + """,
         """ + scaled("avg_purchase_price", "avg_purchase_price_scaled") + """
  FROM ue_base),
pairs AS (
  SELECT v.user_idx, i.item_idx, t.confidence_score
  FROM inter_train t JOIN user_vocab v USING (user_id) JOIN item_vocab i USING (product_id))"""
