"""Recommender and evaluation queries.

Oracles are brute force: every eval user against every item, seen items
removed with NOT EXISTS, ranked by a window. The Spark side uses the
linear-work forms in ``operators.retrieval``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from clickloom.functions.columns import rnd
from clickloom.operators import ranking as Rk
from clickloom.operators import retrieval as Rt
from clickloom.queries import register
from clickloom.queries.common import features, input_version
from clickloom.queries.sql_base import FEATURES, with_
from clickloom.session import cut_lineage

K = 20


def gains_sql(k: int) -> str:
    vals = ", ".join(f"({r}, {g!r}, {i!r})" for r, g, i in Rk.gains(k))
    return f"gains_{k} AS (SELECT * FROM (VALUES {vals}) t(rank, gain, idcg))"


def _seen(u: str, i: str) -> str:
    return f"NOT EXISTS (SELECT 1 FROM pairs s WHERE s.user_idx = {u} AND s.item_idx = {i})"


EVAL = FEATURES + ",\n" + gains_sql(10) + ",\n" + gains_sql(20) + ",\n" + gains_sql(100) + f""",
gt AS (SELECT DISTINCT v.user_idx, i.item_idx FROM test t JOIN user_vocab v USING (user_id)
       JOIN item_vocab i USING (product_id) WHERE t.event_type IN ('cart', 'purchase')),
eval_users AS (SELECT DISTINCT user_idx FROM gt),
pop AS (SELECT item_idx, CAST(sum(confidence_score) AS DOUBLE) AS popularity,
               row_number() OVER (ORDER BY sum(confidence_score) DESC, item_idx) AS pop_rank
        FROM pairs GROUP BY item_idx),
glob_all AS (SELECT u.user_idx, p.item_idx, p.pop_rank FROM eval_users u CROSS JOIN pop p
             WHERE {_seen('u.user_idx', 'p.item_idx')}),
pop_recs AS (SELECT user_idx, item_idx, rank FROM (
  SELECT user_idx, item_idx, row_number() OVER (PARTITION BY user_idx ORDER BY pop_rank) AS rank FROM glob_all)
  WHERE rank <= {K}),
pop_recs100 AS (SELECT user_idx, item_idx, rank FROM (
  SELECT user_idx, item_idx, row_number() OVER (PARTITION BY user_idx ORDER BY pop_rank) AS rank FROM glob_all)
  WHERE rank <= 100),
item_cat AS (SELECT item_idx, cat_l2_idx FROM items_enc),
ucs AS (SELECT p.user_idx, c.cat_l2_idx, sum(p.confidence_score) AS s FROM pairs p JOIN item_cat c USING (item_idx)
        GROUP BY 1, 2),
utop AS (SELECT user_idx, cat_l2_idx FROM (
  SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY s DESC, cat_l2_idx) AS rn FROM ucs) WHERE rn = 1),
cpop AS (SELECT c.cat_l2_idx, p.item_idx,
                row_number() OVER (PARTITION BY c.cat_l2_idx ORDER BY sum(p.confidence_score) DESC, p.item_idx) AS cr
         FROM pairs p JOIN item_cat c USING (item_idx) GROUP BY 1, 2),
incat AS (SELECT * FROM (
  SELECT u.user_idx, c.item_idx, c.cr, row_number() OVER (PARTITION BY u.user_idx ORDER BY c.cr) AS k
  FROM eval_users e JOIN utop u USING (user_idx) JOIN cpop c USING (cat_l2_idx)
  WHERE {_seen('u.user_idx', 'c.item_idx')}) WHERE k <= {K}),
cat_both AS (SELECT user_idx, item_idx, 0 AS pri, cr AS r FROM incat
             UNION ALL SELECT user_idx, item_idx, 1 AS pri, pop_rank AS r FROM glob_all),
cat_recs AS (SELECT user_idx, item_idx, rank FROM (
  SELECT user_idx, item_idx, row_number() OVER (PARTITION BY user_idx ORDER BY min(pri), min_by(r, pri)) AS rank
  FROM (SELECT user_idx, item_idx, pri, r FROM cat_both) GROUP BY user_idx, item_idx) WHERE rank <= {K}),
reps AS (SELECT user_idx, item_idx AS rep_item FROM (
  SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY confidence_score DESC, item_idx) AS rn FROM pairs)
  WHERE rn = 1),
ev_reps AS (SELECT r.* FROM reps r JOIN eval_users USING (user_idx)),
cooc AS (SELECT a.item_idx AS rep_item, b.item_idx, count(*) AS cooc
         FROM pairs a JOIN pairs b ON a.user_idx = b.user_idx AND a.item_idx <> b.item_idx
         WHERE a.item_idx IN (SELECT rep_item FROM ev_reps) GROUP BY 1, 2),
nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rep_item ORDER BY cooc DESC, item_idx) AS nb_rank
                      FROM cooc) WHERE nb_rank <= 500),
cand AS (SELECT * FROM (
  SELECT e.user_idx, n.item_idx, n.nb_rank, row_number() OVER (PARTITION BY e.user_idx ORDER BY n.nb_rank) AS k
  FROM ev_reps e JOIN nb n USING (rep_item) WHERE {_seen('e.user_idx', 'n.item_idx')}) WHERE k <= {K}),
co_both AS (SELECT user_idx, item_idx, 0 AS pri, nb_rank AS r FROM cand
            UNION ALL SELECT user_idx, item_idx, 1 AS pri, pop_rank AS r FROM glob_all),
co_recs AS (SELECT user_idx, item_idx, rank FROM (
  SELECT user_idx, item_idx, row_number() OVER (PARTITION BY user_idx ORDER BY min(pri), min_by(r, pri)) AS rank
  FROM co_both GROUP BY user_idx, item_idx) WHERE rank <= {K})"""


def metrics_sql(recs: str, k: int, name: str, den: str = "min") -> str:
    d = "n_ideal" if den == "min" else "gt_size"
    return f"""{name} AS (
  SELECT g.user_idx, g.gt_size, coalesce(h.hits, 0) AS hits,
         coalesce(h.hits, 0) / {d} AS recall, coalesce(h.hits, 0) / {k} AS precision,
         coalesce(h.dcg, 0.0) / i.idcg AS ndcg, CAST(coalesce(h.hits, 0) > 0 AS INTEGER) AS hit
  FROM (SELECT user_idx, count(*) AS gt_size, least(count(*), {k}) AS n_ideal FROM gt GROUP BY 1) g
  LEFT JOIN (SELECT r.user_idx, count(*) AS hits, sum(gn.gain) AS dcg FROM {recs} r
             JOIN gt USING (user_idx, item_idx) JOIN gains_{k} gn ON gn.rank = r.rank
             WHERE r.rank <= {k} GROUP BY 1) h USING (user_idx)
  JOIN gains_{k} i ON i.rank = g.n_ideal)"""


def summary_sql(m: str, k: int, labels: str = "") -> str:
    return (f"SELECT {labels}count(*) AS n_users, round(avg(recall), 6) AS recall_at_{k}, "
            f"round(avg(precision), 6) AS precision_at_{k}, round(avg(ndcg), 6) AS ndcg_at_{k}, "
            f"round(avg(hit) * 100, 6) AS hit_rate_pct_at_{k} FROM {m}")


_EVALS: dict = {}


def _eval(spark, sf):
    """The evaluation bundle of (application, input directory), shared by queries."""
    key = (spark.sparkContext.applicationId, sf, input_version(spark, sf))
    if key not in _EVALS:
        _EVALS[key] = _EvalBundle(spark, sf)
    return _EVALS[key]


class _EvalBundle:
    def __init__(self, spark, sf):
        self.spark, self.sf = spark, sf
        self.f = features(spark, sf)

    @cached_property
    def gt(self):
        return cut_lineage(Rk.ground_truth(self.f.split("test"), self.f.user_vocab, self.f.item_vocab))

    @cached_property
    def users(self):
        return self.gt.select("user_idx").distinct()

    @cached_property
    def ranks(self):
        return cut_lineage(Rt.popularity_ranks(self.f.pairs))

    def pop_recs(self, k=K):
        return Rt.popularity_recs(self.users, self.f.pairs, self.ranks, k)

    @cached_property
    def all_recs(self):
        """Each strategy's top-K list; the comparison reads each one once (every
        cutoff is scored in the same pass), so they are not materialised."""
        return {"popularity": self.pop_recs(), "category_popularity": self.cat_recs(),
                "cooccurrence": self.co_recs()}

    @cached_property
    def item_cat(self):
        return self.f.items_enc.select("item_idx", "cat_l2_idx")

    def cat_recs(self):
        return Rt.category_popularity_recs(self.users, self.f.pairs, self.item_cat, self.ranks, K)

    def co_recs(self):
        return Rt.cooccurrence_recs(self.users, self.f.pairs, self.ranks, K)


@register("ground_truth_test", with_(EVAL) + "\nSELECT * FROM gt")
def q_gt(spark, sf):
    return _eval(spark, sf).gt


@register("popularity_ranks", with_(EVAL) + "\nSELECT * FROM pop")
def q_pop_ranks(spark, sf):
    return _eval(spark, sf).ranks


@register("popularity_recs_top20", with_(EVAL) + "\nSELECT * FROM pop_recs")
def q_pop_recs(spark, sf):
    return _eval(spark, sf).pop_recs()


@register("category_popularity_recs_top20", with_(EVAL) + "\nSELECT * FROM cat_recs")
def q_cat_recs(spark, sf):
    return _eval(spark, sf).cat_recs()


@register("cooccurrence_counts", with_(EVAL) + "\nSELECT rep_item, item_idx, cooc FROM cooc")
def q_cooc(spark, sf):
    e = _eval(spark, sf)
    reps = e.users.join(Rt.representative_items(e.f.pairs), "user_idx")
    return Rt.cooccurrence_counts(e.f.pairs, reps)


@register("cooccurrence_recs_top20", with_(EVAL) + "\nSELECT * FROM co_recs")
def q_co_recs(spark, sf):
    return _eval(spark, sf).co_recs()


@register("per_user_metrics_popularity_at_20", with_(EVAL, metrics_sql("pop_recs", 20, "m")) + """
SELECT user_idx, gt_size, hits, round(recall, 6) AS recall, round(precision, 6) AS precision,
       round(ndcg, 6) AS ndcg, hit FROM m""")
def q_user_metrics(spark, sf):
    e = _eval(spark, sf)
    m = Rk.user_metrics(e.pop_recs(), e.gt, 20)
    return m.select("user_idx", "gt_size", "hits", rnd("recall", 6).alias("recall"),
                    rnd("precision", 6).alias("precision"), rnd("ndcg", 6).alias("ndcg"), "hit")


@register("popularity_metrics_at_10", with_(EVAL, metrics_sql("pop_recs", 10, "m")) + "\n" + summary_sql("m", 10))
def q_pop_m10(spark, sf):
    e = _eval(spark, sf)
    return Rk.summarize(Rk.user_metrics(e.pop_recs(), e.gt, 10), 10)


def _comparison_sql() -> str:
    ctes, sels = [], []
    for strat, recs in (("popularity", "pop_recs"), ("category_popularity", "cat_recs"),
                        ("cooccurrence", "co_recs")):
        for k in (10, 20):
            name = f"m_{strat}_{k}"
            ctes.append(metrics_sql(recs, k, name, den="gt"))
            sels.append(f"SELECT '{strat}' AS strategy, {k} AS k, count(*) AS n_users, "
                        f"round(avg(recall), 6) AS recall, round(avg(ndcg), 6) AS ndcg, "
                        f"round(avg(hit) * 100, 6) AS hit_rate_pct FROM {name}")
    return with_(EVAL, *ctes) + "\n" + "\nUNION ALL\n".join(sels)


@register("recommender_comparison", _comparison_sql())
def q_compare(spark, sf):
    e = _eval(spark, sf)
    return Rk.compare_strategies(e.all_recs, e.gt, (10, 20), recall_denominator="gt")


COH = """
coh AS (SELECT user_idx, count(*) AS n_train_pairs,
               CASE WHEN count(*) BETWEEN 3 AND 10 THEN 'cold' WHEN count(*) BETWEEN 11 AND 50 THEN 'medium'
                    WHEN count(*) BETWEEN 51 AND 1000000000 THEN 'warm' END AS cohort
        FROM pairs GROUP BY user_idx)"""


@register("stratified_metrics_popularity_at_20", with_(EVAL, metrics_sql("pop_recs", 20, "m"), COH) + """,
ex AS (SELECT 'overall' AS c, m.* FROM m UNION ALL
       SELECT coh.cohort AS c, m.* FROM m JOIN coh USING (user_idx) WHERE coh.cohort IS NOT NULL),
agg AS (SELECT c, count(*) AS n_users, round(avg(recall), 6) AS recall_at_20, round(avg(ndcg), 6) AS ndcg_at_20,
               round(avg(hit) * 100, 6) AS hit_rate_pct_at_20 FROM ex GROUP BY c)
SELECT g.cohort, coalesce(a.n_users, 0) AS n_users, coalesce(a.recall_at_20, 0.0) AS recall_at_20,
       coalesce(a.ndcg_at_20, 0.0) AS ndcg_at_20, coalesce(a.hit_rate_pct_at_20, 0.0) AS hit_rate_pct_at_20
FROM (VALUES ('overall'), ('cold'), ('medium'), ('warm')) g(cohort) LEFT JOIN agg a ON a.c = g.cohort""")
def q_strat(spark, sf):
    e = _eval(spark, sf)
    return Rk.stratified_metrics(Rk.user_metrics(e.pop_recs(), e.gt, 20), e.f.pairs, 20)


@register("seen_filter_diagnostic", with_(EVAL, COH) + """,
fl AS (SELECT g.user_idx, g.item_idx, CASE WHEN EXISTS (SELECT 1 FROM pairs s WHERE s.user_idx = g.user_idx
                                                    AND s.item_idx = g.item_idx) THEN 1 END AS seen FROM gt g),
ex AS (SELECT 'overall' AS c, fl.* FROM fl UNION ALL
       SELECT coh.cohort AS c, fl.* FROM fl JOIN coh USING (user_idx) WHERE coh.cohort IS NOT NULL)
SELECT c AS cohort, count(*) AS gt_items, count(seen) AS gt_seen, round(count(seen) * 100.0 / count(*), 6) AS pct_gt_seen
FROM ex GROUP BY c""")
def q_seen_diag(spark, sf):
    e = _eval(spark, sf)
    return Rk.seen_filter_diagnostic(e.gt, e.f.pairs, e.f.pairs)


@register("coverage_waterfall", with_(EVAL) + """,
b AS (SELECT DISTINCT user_id FROM test WHERE event_type IN ('cart', 'purchase')),
v AS (SELECT b.user_id, u.user_idx FROM b JOIN user_vocab u USING (user_id))
SELECT '1_buyers' AS stage, count(*) AS n_users FROM b UNION ALL
SELECT '2_in_vocab', count(*) FROM v UNION ALL
SELECT '3_has_features', count(*) FROM v WHERE user_idx IN (SELECT user_idx FROM users_enc)""")
def q_waterfall(spark, sf):
    e = _eval(spark, sf)
    return Rk.coverage_waterfall(e.f.split("test"), e.f.user_vocab, e.f.users_enc)


@register("per_user_diagnostics_popularity", with_(EVAL, metrics_sql("pop_recs", 20, "m"), COH) + """
SELECT coalesce(c.cohort, 'under_3') AS cohort, count(*) AS n_users, round(avg(m.gt_size), 6) AS mean_gt_size,
       round(avg(m.hit) * 100, 6) AS hit_rate_pct, count_if(m.hits = 0 AND m.gt_size <= 5) AS zero_hit_small_gt
FROM m LEFT JOIN coh c USING (user_idx) GROUP BY 1""")
def q_user_diag(spark, sf):
    e = _eval(spark, sf)
    return Rk.per_user_diagnostics(Rk.user_metrics(e.pop_recs(), e.gt, 20), e.f.pairs)


@register("test_item_coverage", with_(EVAL) + """,
t AS (SELECT DISTINCT product_id FROM test), tr AS (SELECT DISTINCT product_id FROM train)
SELECT n_test_items, n_in_train, n_new, round(n_in_train * 100.0 / n_test_items, 6) AS pct_covered
FROM (SELECT count(*) AS n_test_items FROM t)
CROSS JOIN (SELECT count(*) AS n_in_train FROM t WHERE product_id IN (SELECT product_id FROM tr))
CROSS JOIN (SELECT count(*) AS n_new FROM t WHERE product_id NOT IN (SELECT product_id FROM tr))""")
def q_item_cov(spark, sf):
    f = features(spark, sf)
    return Rk.item_coverage(f.split("test"), f.train)


@register("first_hit_ranks_popularity", with_(EVAL) + """,
fh AS (SELECT r.user_idx, min(r.rank) AS first_hit_rank FROM pop_recs100 r JOIN gt USING (user_idx, item_idx)
       GROUP BY 1),
per AS (SELECT g.user_idx, g.gt_size, fh.first_hit_rank FROM
        (SELECT user_idx, count(*) AS gt_size FROM gt GROUP BY 1) g LEFT JOIN fh USING (user_idx))
SELECT count(*) AS n_users, round(avg(gt_size), 6) AS mean_gt_per_user,
       round(avg(first_hit_rank), 6) AS mean_first_hit_rank,
       count_if(first_hit_rank <= 10) AS users_hit_top_10, count_if(first_hit_rank <= 20) AS users_hit_top_20,
       count_if(first_hit_rank <= 100) AS users_hit_top_100 FROM per""")
def q_first_hit(spark, sf):
    e = _eval(spark, sf)
    return Rk.first_hit_ranks(e.pop_recs(100), e.gt)
