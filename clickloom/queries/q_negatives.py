"""Negative sampling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions.columns import rnd
from clickloom.operators import negatives as N
from clickloom.operators.profiling import percentiles
from clickloom.queries import register
from clickloom.queries.common import features
from clickloom.queries.sql_base import FEATURES, with_


def _items(f):
    return f.items_enc.select("item_idx", "cat_l2_idx", "price_bucket", "brand_idx")


def _d(*parts):
    return N.draw_sql("42", *parts)


# Every pool as a list, every pair's free items by filtering it, draws without
# replacement by taking the drawn element out of the list.
HARD = f""",
it AS (SELECT item_idx, cat_l2_idx, price_bucket FROM items_enc),
catl AS (SELECT cat_l2_idx AS cat, list(item_idx ORDER BY item_idx) AS items FROM it WHERE cat_l2_idx <> 0 GROUP BY 1),
bucl AS (SELECT price_bucket AS bucket, list(item_idx ORDER BY item_idx) AS items FROM it GROUP BY 1),
alll AS (SELECT list(item_idx ORDER BY item_idx) AS items FROM it),
upos AS (SELECT user_idx, list(item_idx) AS pos, count(*) AS n_train FROM pairs GROUP BY 1),
ucat AS (SELECT p.user_idx, list(DISTINCT i.cat_l2_idx) AS cats FROM pairs p JOIN it i USING (item_idx) WHERE i.cat_l2_idx <> 0 GROUP BY 1),
untouched AS (SELECT u.user_idx, list(c.cat ORDER BY c.cat) AS cats, sum(len(c.items)) AS n_items
         FROM upos u LEFT JOIN ucat USING (user_idx) CROSS JOIN catl c
         WHERE ucat.cats IS NULL OR NOT list_contains(ucat.cats, c.cat) GROUP BY 1),
pr AS (SELECT p.user_idx, p.item_idx, i.cat_l2_idx AS cat, i.price_bucket AS bucket, u.pos, a.cats AS anti_cats,
              i.cat_l2_idx <> 0 AND u.n_train >= 20 AND coalesce(len(a.cats), 0) > 0 AND coalesce(a.n_items, 0) >= 3 AS warm
       FROM pairs p JOIN it i USING (item_idx) JOIN upos u USING (user_idx) LEFT JOIN untouched a USING (user_idx)),
warm0 AS (SELECT user_idx, item_idx, slot, anti_cats[{_d('user_idx', 'item_idx', 'slot', "'category'")} % len(anti_cats) + 1] AS cat
          FROM (SELECT *, unnest(range(3)) AS slot FROM pr WHERE warm)),
warm_out AS (SELECT w.user_idx, w.item_idx, w.slot,
                    c.items[{_d('w.user_idx', 'w.item_idx', 'w.slot', "'item'")} % len(c.items) + 1] AS neg_item_idx,
                    'warm_anti_category' AS route
             FROM warm0 w JOIN catl c USING (cat)),
fr AS (SELECT r.*, list_filter(CASE WHEN r.cat <> 0 THEN c.items ELSE b.items END, lambda x: NOT list_contains(r.pos, x)) AS free
       FROM pr r LEFT JOIN catl c ON c.cat = r.cat LEFT JOIN bucl b ON b.bucket = r.bucket WHERE NOT r.warm),
l0 AS (SELECT user_idx, item_idx, CASE WHEN len(free) > 0 THEN free ELSE list_filter(alll.items, lambda x: x <> item_idx) END AS l0,
              CASE WHEN len(free) >= 3 THEN 'pool_sampled' WHEN len(free) > 0 THEN 'pool_with_replacement' ELSE 'catalogue_fallback' END AS route
       FROM fr CROSS JOIN alll),
x0 AS (SELECT *, l0[{_d('user_idx', 'item_idx', '0')} % len(l0) + 1] AS x0 FROM l0 WHERE len(l0) > 0),
l1 AS (SELECT *, CASE WHEN len(l0) >= 3 THEN list_filter(l0, lambda x: x <> x0) ELSE l0 END AS l1 FROM x0),
x1 AS (SELECT *, l1[{_d('user_idx', 'item_idx', '1')} % len(l1) + 1] AS x1 FROM l1),
l2 AS (SELECT *, CASE WHEN len(l0) >= 3 THEN list_filter(l1, lambda x: x <> x1) ELSE l1 END AS l2 FROM x1),
x2 AS (SELECT *, l2[{_d('user_idx', 'item_idx', '2')} % len(l2) + 1] AS x2 FROM l2),
hard AS (SELECT * FROM warm_out UNION ALL
         SELECT user_idx, item_idx, unnest([0, 1, 2]) AS slot, unnest([x0, x1, x2]) AS neg_item_idx, route FROM x2)"""


@register("hard_negatives", with_(FEATURES) + HARD + "\nSELECT user_idx, item_idx, CAST(slot AS INTEGER) AS slot, neg_item_idx, route FROM hard")
def q_hard(spark, sf):
    f = features(spark, sf)
    return N.hard_negatives(f.pairs, _items(f))


@register("uniform_negatives", with_(FEATURES) + f"""
SELECT user_idx, item_idx,
       list_transform(range(5), lambda s: {_d('user_idx', 'item_idx', 's')} % n + 1) AS negatives
FROM pairs CROSS JOIN (SELECT max(item_idx) AS n FROM items_enc)""")
def q_uniform(spark, sf):
    f = features(spark, sf)
    n_items = f.items_enc.agg(F.max("item_idx")).first()[0] + 1
    return N.uniform_negatives(f.pairs.select("user_idx", "item_idx"), ["user_idx", "item_idx"], n_items, 5)


POOL = """,
cn AS (SELECT cat_l2_idx, count(*) AS cat_n FROM items_enc WHERE cat_l2_idx <> 0 GROUP BY 1),
bn AS (SELECT price_bucket, count(*) AS b_n FROM items_enc GROUP BY 1),
ps AS (SELECT p.user_idx, p.item_idx, CASE WHEN i.cat_l2_idx <> 0 THEN cn.cat_n ELSE bn.b_n END - 1 AS pool_size
       FROM pairs p JOIN items_enc i USING (item_idx) LEFT JOIN cn USING (cat_l2_idx) JOIN bn USING (price_bucket))"""


@register("hard_negative_pool_sizes", with_(FEATURES) + POOL + "\nSELECT * FROM ps")
def q_pool(spark, sf):
    f = features(spark, sf)
    return N.pool_sizes(f.pairs, _items(f))


@register("hard_negative_pool_quantiles", with_(FEATURES) + POOL + """
SELECT 'pool_size' AS metric, round(unnest([0.1, 0.5, 0.9]::DOUBLE[]), 6) AS prob,
       round(unnest(quantile_cont(pool_size, [0.1, 0.5, 0.9]::DOUBLE[])), 6) AS value FROM ps""")
def q_pool_q(spark, sf):
    f = features(spark, sf)
    return percentiles(N.pool_sizes(f.pairs, _items(f)), "pool_size", [0.1, 0.5, 0.9], "pool_size")


SESS_NEG = """,
per AS (SELECT c.user_session, c.product_id, max(CAST(c.event_type = 'view' AS INTEGER)) AS viewed,
               max(CAST(c.event_type IN ('cart', 'purchase') AS INTEGER)) AS pos
        FROM train c GROUP BY 1, 2),
perc AS (SELECT per.*, f.cat_l2 AS cat FROM per LEFT JOIN item_feats f USING (product_id)),
possess AS (SELECT DISTINCT user_session FROM perc WHERE pos = 1),
poscat AS (SELECT DISTINCT user_session, cat FROM perc WHERE pos = 1),
vo AS (SELECT v.user_session, v.product_id,
              CASE WHEN EXISTS (SELECT 1 FROM poscat q WHERE q.user_session = v.user_session AND q.cat = v.cat)
                   THEN 1 END AS sc
       FROM perc v WHERE v.viewed = 1 AND v.pos = 0 AND v.user_session IN (SELECT user_session FROM possess)),
sn AS (SELECT s.user_session, coalesce(x.pool_size, 0) AS pool_size, coalesce(x.same_category, 0) AS same_category
       FROM possess s LEFT JOIN (SELECT user_session, count(*) AS pool_size, count(sc) AS same_category FROM vo
                                 GROUP BY 1) x USING (user_session))"""


@register("session_negatives", with_(FEATURES) + SESS_NEG + "\nSELECT * FROM sn")
def q_sess_neg(spark, sf):
    f = features(spark, sf)
    return N.session_negatives(f.train, f.items)


@register("session_negative_summary", with_(FEATURES) + SESS_NEG + """
SELECT count(*) AS positive_sessions, count_if(pool_size >= 1) AS usable_sessions,
       round(count_if(pool_size >= 3) * 100.0 / count_if(pool_size >= 1), 6) AS pct_ge3_of_usable,
       round(count_if(pool_size >= 3) * 100.0 / count(*), 6) AS pct_ge3_of_positive,
       round(sum(same_category) * 100.0 / sum(pool_size), 6) AS pct_same_category
FROM sn""")
def q_sess_neg_sum(spark, sf):
    f = features(spark, sf)
    sn = N.session_negatives(f.train, f.items)
    return sn.agg(F.count(F.lit(1)).alias("positive_sessions"),
                  F.count_if(F.col("pool_size") >= 1).alias("usable_sessions"),
                  rnd(F.count_if(F.col("pool_size") >= 3) * 100.0 / F.count_if(F.col("pool_size") >= 1), 6)
                  .alias("pct_ge3_of_usable"),
                  rnd(F.count_if(F.col("pool_size") >= 3) * 100.0 / F.count(F.lit(1)), 6).alias("pct_ge3_of_positive"),
                  rnd(F.sum("same_category") * 100.0 / F.sum("pool_size"), 6).alias("pct_same_category"))


@register("false_negative_risk", with_(FEATURES) + HARD + """,
popc AS (SELECT i.cat_l2_idx, p.item_idx, row_number() OVER (PARTITION BY i.cat_l2_idx ORDER BY count(*) DESC, p.item_idx) AS r,
                count(*) OVER (PARTITION BY i.cat_l2_idx) AS cn
         FROM pairs p JOIN items_enc i USING (item_idx) GROUP BY i.cat_l2_idx, p.item_idx),
topc AS (SELECT item_idx FROM popc WHERE r <= ceil(cn * 0.1))
SELECT count(*) AS n_negatives,
       round(avg(CASE WHEN a.cat_l2_idx = b.cat_l2_idx AND a.brand_idx = b.brand_idx THEN 1.0 ELSE 0.0 END), 6) AS same_cat_brand_share,
       round(avg(CASE WHEN t.item_idx IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS popular_in_category_share
FROM hard h JOIN items_enc a ON a.item_idx = h.item_idx JOIN items_enc b ON b.item_idx = h.neg_item_idx
LEFT JOIN topc t ON t.item_idx = h.neg_item_idx""")
def q_fn_risk(spark, sf):
    f = features(spark, sf)
    negs = N.hard_negatives(f.pairs, _items(f))
    out = N.false_negative_risk(negs, _items(f), f.pairs)
    return out.select("n_negatives", rnd("same_cat_brand_share", 6).alias("same_cat_brand_share"),
                      rnd("popular_in_category_share", 6).alias("popular_in_category_share"))


@register("in_batch_negative_difficulty", with_(FEATURES) + """,
nb AS (SELECT CAST(ceil(count(*) / 256.0) AS BIGINT) AS n FROM pairs),
b AS (SELECT p.user_idx, p.item_idx, (p.user_idx * 7919 + p.item_idx * 104729) % (SELECT n FROM nb) AS batch,
             i.cat_l2_idx FROM pairs p JOIN items_enc i USING (item_idx)),
pc AS (SELECT batch, cat_l2_idx, count(*) AS n_c FROM b GROUP BY 1, 2),
same AS (SELECT batch, sum(n_c * (n_c - 1)) AS same_pairs, sum(n_c) AS size FROM pc GROUP BY 1),
pop AS (SELECT item_idx, row_number() OVER (ORDER BY count(*) DESC, item_idx) AS r FROM pairs GROUP BY 1),
top AS (SELECT item_idx FROM pop WHERE r <= ceil((SELECT count(*) FROM pop) * 0.1)),
popular AS (SELECT batch, count(t.item_idx) AS n_popular FROM b LEFT JOIN top t USING (item_idx) GROUP BY 1)
SELECT s.batch, s.size,
       round(CASE WHEN s.size > 1 THEN s.same_pairs / (s.size * (s.size - 1)) ELSE 0.0 END, 6) AS same_category_pair_rate,
       round(p.n_popular / s.size, 6) AS popular_share
FROM same s JOIN popular p USING (batch)""")
def q_batch(spark, sf):
    f = features(spark, sf)
    out = N.in_batch_difficulty(f.pairs, _items(f), 256)
    return out.select(F.col("batch").cast("long"), F.col("size").cast("long"),
                      rnd("same_category_pair_rate", 6).alias("same_category_pair_rate"),
                      rnd("popular_share", 6).alias("popular_share"))
