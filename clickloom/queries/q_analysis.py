"""Feature-decision analysis queries."""

from __future__ import annotations

from clickloom.operators import analysis as A
from clickloom.queries import register
from clickloom.queries.common import features
from clickloom.queries.sql_base import FEATURES, with_

STATS = """,
ist AS (SELECT product_id, sum(confidence_score) AS total_confidence, sum(n_views) AS n_views,
               sum(n_purchases) AS n_purchases, count(DISTINCT user_id) AS n_users,
               CASE WHEN sum(n_views) = 0 THEN NULL ELSE sum(n_purchases) / sum(n_views) END AS purchase_rate
        FROM inter_train GROUP BY product_id)"""


def _bins_sql(metric: str) -> str:
    edges = " + ".join(f"CAST(r > 1 + (n - 1) * {j} / 5 AS INTEGER)" for j in range(1, 5))
    return with_(FEATURES) + STATS + f""",
rk AS (SELECT *, row_number() OVER (ORDER BY {metric}, product_id) AS r, count(*) OVER () AS n FROM ist),
bn AS (SELECT *, {edges} AS bin FROM rk)
SELECT (['very_cold', 'cold', 'medium', 'warm', 'hot'])[bin + 1] AS bin_label, bin, count(*) AS n_items,
       round(avg({metric}), 4) AS avg_metric, round(avg(CAST(n_purchases > 0 AS DOUBLE)), 4) AS pct_purchased,
       round(avg(purchase_rate), 4) AS avg_purchase_rate
FROM bn GROUP BY bin"""


def _f(spark, sf):
    return features(spark, sf)


@register("popularity_quintiles_users", _bins_sql("n_users"))
def q_bins_users(spark, sf):
    return A.quintile_bins(A.item_stats(_f(spark, sf).inter), "n_users")


@register("popularity_quintiles_confidence", _bins_sql("total_confidence"))
def q_bins_conf(spark, sf):
    return A.quintile_bins(A.item_stats(_f(spark, sf).inter), "total_confidence")


@register("purchase_concentration", with_(FEATURES) + STATS + """,
p AS (SELECT * FROM ist WHERE n_purchases > 0),
g AS (SELECT n_purchases AS n, count(*) AS c FROM p GROUP BY 1),
gc AS (SELECT n, c, coalesce(sum(n * c) OVER (ORDER BY n DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              AS cum_before,
              coalesce(sum(c) OVER (ORDER BY n DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS items_before
       FROM g),
tt AS (SELECT sum(n_purchases) AS tot_p, count(*) AS tot_items FROM p),
th AS (SELECT * FROM (VALUES (0.5), (0.8), (0.9)) t(share))
SELECT CAST(th.share AS DOUBLE) AS share, CAST(min(items_before + greatest(ceil((CAST(th.share AS DOUBLE) * tot_p - cum_before) / n), 1)) AS BIGINT) AS rank,
       round(min(items_before + greatest(ceil((CAST(th.share AS DOUBLE) * tot_p - cum_before) / n), 1)) * 100.0 / max(tot_items), 6) AS pct_items
FROM th CROSS JOIN gc CROSS JOIN tt
WHERE greatest(ceil((CAST(th.share AS DOUBLE) * tot_p - cum_before) / n), 1) <= c
GROUP BY th.share""")
def q_conc(spark, sf):
    return A.purchase_concentration(A.item_stats(_f(spark, sf).inter))


@register("top_category_concentration", with_(FEATURES) + """,
e AS (SELECT t.user_id, f.cat_l1 FROM train t JOIN item_feats f USING (product_id)),
per AS (SELECT user_id, cat_l1, count(*) AS n FROM e GROUP BY 1, 2),
u AS (SELECT user_id, max(n) / sum(n) AS share FROM per GROUP BY 1)
SELECT count(*) AS n_users, round(avg(share), 6) AS mean_share, count_if(share < 0.5) AS lt_50,
       count_if(share >= 0.5 AND share < 0.7) AS from_50_to_70, count_if(share >= 0.7 AND share < 0.85) AS from_70_to_85,
       count_if(share >= 0.85) AS ge_85 FROM u""")
def q_topcat(spark, sf):
    f = _f(spark, sf)
    return A.top_category_concentration(f.train, f.items)


MATCH = """,
mp AS (SELECT t.user_id, f.cat_l1, CAST(f.cat_l1 = u.top_category AS DOUBLE) AS m
       FROM test t JOIN user_feats u USING (user_id) JOIN item_feats f USING (product_id)
       WHERE t.event_type = 'purchase'),
mt AS (SELECT 'overall' AS category, count(*) AS n_purchases, round(avg(m), 6) AS match_rate FROM mp
       UNION ALL SELECT cat_l1 AS category, count(*), round(avg(m), 6) FROM mp GROUP BY cat_l1)"""


@register("top_category_match_rate", with_(FEATURES) + MATCH + "\nSELECT *, match_rate > 0.3 AS include FROM mt")
def q_match(spark, sf):
    f = _f(spark, sf)
    return A.top_category_match(f.split("test"), f.users, f.items)


@register("price_tier_consistency", with_(FEATURES) + """,
p AS (SELECT t.user_id, f.price_bucket FROM train t JOIN item_feats f USING (product_id) WHERE t.event_type = 'purchase'),
u AS (SELECT user_id, count(*) AS n, stddev_samp(price_bucket) AS sd FROM p GROUP BY 1 HAVING count(*) >= 2)
SELECT CASE WHEN sd = 0 THEN 'single_tier' WHEN sd <= 0.5 THEN 'tight' WHEN sd <= 1.0 THEN 'moderate' ELSE 'wide' END
         AS price_tier_class, count(*) AS n_users FROM u GROUP BY 1""")
def q_tier(spark, sf):
    f = _f(spark, sf)
    return A.price_tier_consistency(f.train, f.items)


STAB = """,
pt AS (SELECT user_id, avg(price) AS p_train FROM train WHERE event_type = 'purchase' GROUP BY 1),
pe AS (SELECT user_id, avg(price) AS p_test FROM test WHERE event_type = 'purchase' GROUP BY 1),
stab AS (SELECT count(*) AS n_users, round(corr(p_train, p_test), 6) AS corr FROM pt JOIN pe USING (user_id))"""


@register("price_stability", with_(FEATURES) + STAB + "\nSELECT *, corr > 0.4 AS include FROM stab")
def q_stab(spark, sf):
    f = _f(spark, sf)
    return A.price_stability(f.train, f.split("test"))


@register("feature_decision_table", with_(FEATURES) + STATS + MATCH + STAB + """,
rk AS (SELECT *, row_number() OVER (ORDER BY n_users, product_id) AS r, count(*) OVER () AS n FROM ist),
bn AS (SELECT *, """ + " + ".join(f"CAST(r > 1 + (n - 1) * {j} / 5 AS INTEGER)" for j in range(1, 5)) + """ AS bin FROM rk),
bins AS (SELECT bin, round(avg(purchase_rate), 4) AS apr FROM bn GROUP BY bin),
steps AS (SELECT apr - lag(apr) OVER (ORDER BY bin) AS d FROM bins),
buyers AS (SELECT DISTINCT user_id FROM train WHERE event_type = 'purchase')
SELECT 'popularity_bin' AS feature, 'increasing_steps_of_4' AS metric, CAST(count_if(d > 0) AS DOUBLE) AS value,
       count_if(d > 0) = 4 AS include FROM steps
UNION ALL
SELECT 'has_purchase_history', 'zero_purchase_pct',
       round(count_if(user_id NOT IN (SELECT user_id FROM buyers)) * 100.0 / count(*), 6),
       round(count_if(user_id NOT IN (SELECT user_id FROM buyers)) * 100.0 / count(*), 6) > 40
FROM user_feats
UNION ALL
SELECT 'top_category', 'match_rate', match_rate, match_rate > 0.3 FROM mt WHERE category = 'overall'
UNION ALL
SELECT 'avg_purchase_price', 'train_test_corr', corr, corr > 0.4 FROM stab""")
def q_decision(spark, sf):
    f = _f(spark, sf)
    st = A.item_stats(f.inter)
    return A.decision_table(A.quintile_bins(st, "n_users"), f.users.select("user_id"), f.train,
                            A.top_category_match(f.split("test"), f.users, f.items),
                            A.price_stability(f.train, f.split("test")))
