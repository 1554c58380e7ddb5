"""Vector retrieval queries (R1-R3, R7, R19, R20, A28) over the ``embeddings`` table.

Item vectors: ``embeddings.vec_id`` is the item (product) id. For the
clickstream items (products 0..99) the same id selects their vector.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions.columns import rnd
from clickloom.operators import ranking as Rk
from clickloom.operators import vectors as V
from clickloom.operators.sequences import eval_prefix_target
from clickloom.queries import register
from clickloom.queries.common import features
from clickloom.queries.q_ranking import gains_sql
from clickloom.queries.q_sequences import SEQ, _Seq
from clickloom.queries.sql_base import with_
from clickloom.sources.testdata import table

DIM = 64


def _emb(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id"), F.col("embedding").alias("vec"), "label")


def _round_arr(c):
    return F.transform(c, lambda x: rnd(x, 6))


TOPK_SQL = """
SELECT query_id, item_id, round(score, 6) AS score, rank FROM (
  SELECT a.vec_id AS query_id, b.vec_id AS item_id, {f}(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS score,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY {f}(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) DESC,
                            b.vec_id) AS rank
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
WHERE rank <= 10"""


@register("vector_topk_exact", TOPK_SQL.format(f="list_inner_product"))
def q_topk(spark, sf):
    e = _emb(spark, sf)
    out = V.exact_topk(e.select(F.col("vec_id").alias("query_id"), "vec"),
                       e.select(F.col("vec_id").alias("item_id"), "vec"), 10, metric="ip", exclude_self=True)
    return out.select("query_id", "item_id", rnd("score", 6).alias("score"), "rank")


@register("vector_topk_cosine", TOPK_SQL.format(f="list_cosine_similarity"))
def q_topk_cos(spark, sf):
    e = _emb(spark, sf)
    out = V.exact_topk(e.select(F.col("vec_id").alias("query_id"), "vec"),
                       e.select(F.col("vec_id").alias("item_id"), "vec"), 10, metric="cosine", exclude_self=True)
    return out.select("query_id", "item_id", rnd("score", 6).alias("score"), "rank")


# Many ties: eight dimensions of +1 or -1, so scores are small integers and the
# order rests on the item id.
@register("vector_topk_tied", """
WITH v AS (SELECT vec_id, list_transform(embedding[1:8], lambda x: CASE WHEN x > 0 THEN 1.0 ELSE -1.0 END)::DOUBLE[] AS e FROM embeddings)
SELECT query_id, item_id, round(score, 6) AS score, rank FROM (
  SELECT a.vec_id AS query_id, b.vec_id AS item_id, list_inner_product(a.e, b.e) AS score,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY list_inner_product(a.e, b.e) DESC, b.vec_id) AS rank
  FROM v a JOIN v b ON a.vec_id <> b.vec_id)
WHERE rank <= 10""")
def q_topk_tied(spark, sf):
    sign = F.transform(F.slice("vec", 1, 8), lambda x: F.when(x > 0, 1.0).otherwise(-1.0))
    e = _emb(spark, sf).select("vec_id", sign.alias("vec"))
    out = V.exact_topk(e.select(F.col("vec_id").alias("query_id"), "vec"),
                       e.select(F.col("vec_id").alias("item_id"), "vec"), 10, exclude_self=True, block_rows=100)
    return out.select("query_id", "item_id", rnd("score", 6).alias("score"), "rank")


# R4 over R1: each user's embedding retrieval with the items of the training
# pairs removed before the cut.
@register("user_recs_embedding_unseen", with_(SEQ) + f""",
good AS (SELECT user_id, product_id FROM inter_train WHERE confidence_score >= 2),
ex AS (SELECT g.user_id, i.i, avg(e.embedding[i.i]) AS m
       FROM good g JOIN embeddings e ON e.vec_id = g.product_id CROSS JOIN range(1, {DIM + 1}) i(i) GROUP BY 1, 2),
u AS (SELECT user_id, list(m ORDER BY i) AS w FROM ex GROUP BY 1),
it AS (SELECT v.product_id, e.embedding::DOUBLE[] AS e FROM item_vocab v JOIN embeddings e ON e.vec_id = v.product_id)
SELECT user_id, product_id, rank FROM (
  SELECT u.user_id, it.product_id,
         row_number() OVER (PARTITION BY u.user_id ORDER BY list_cosine_similarity(u.w, it.e) DESC, it.product_id) AS rank
  FROM u CROSS JOIN it
  WHERE NOT EXISTS (SELECT 1 FROM inter_train t WHERE t.user_id = u.user_id AND t.product_id = it.product_id))
WHERE rank <= 20""")
def q_unseen(spark, sf):
    f = features(spark, sf)
    vecs = _emb(spark, sf).select(F.col("vec_id").alias("product_id"), "vec")
    users = V.mean_vectors(f.inter.filter(F.col("confidence_score") >= 2), vecs, "user_id", "product_id", DIM)
    out = V.exact_topk(users, f.item_vocab.join(vecs, "product_id").select("product_id", "vec"), 20, metric="cosine",
                       query_col="user_id", item_col="product_id", seen=f.inter.select("user_id", "product_id"))
    return out.select("user_id", "product_id", "rank")


def _sides(e):
    return e.select(F.col("vec_id").alias("query_id"), "vec"), e.select(F.col("vec_id").alias("item_id"), "vec")


# R2: lists are visited until their bounds rule out the rest.
@register("vector_topk_ivf", TOPK_SQL.format(f="list_inner_product"))
def q_ivf(spark, sf):
    out = V.ivf_exact_topk(*_sides(_emb(spark, sf)), 10, n_lists=16, exclude_self=True)
    return out.select("query_id", "item_id", rnd("score", 6).alias("score"), "rank")


@register("ivf_concordance", "SELECT count(*) AS n_queries, CAST(1.0 AS DOUBLE) AS concordance FROM embeddings")
def q_conc(spark, sf):
    q, it = _sides(_emb(spark, sf))
    return V.concordance(V.exact_topk(q, it, 10, exclude_self=True), V.ivf_exact_topk(q, it, 10, n_lists=16, exclude_self=True), 10)


# The embeddings drawn together around their label: clusters as trained items have.
CLUSTERED = """
c AS (SELECT vec_id, label, list_transform(embedding::DOUBLE[], lambda x, i: 0.25 * x + CASE WHEN i = label + 1 THEN 4.0 ELSE 0.0 END) AS embedding
      FROM embeddings)"""


def _clustered(spark, sf):
    vec = F.transform("vec", lambda x, i: 0.25 * x.cast("double") + F.when(i == F.col("label"), 4.0).otherwise(0.0))
    return _emb(spark, sf).select("vec_id", "label", vec.alias("vec"))


@register("vector_topk_ivf_clustered", "WITH" + CLUSTERED + TOPK_SQL.format(f="list_inner_product").replace("FROM embeddings a JOIN embeddings b", "FROM c a JOIN c b"))
def q_ivf_clustered(spark, sf):
    out = V.ivf_exact_topk(*_sides(_clustered(spark, sf)), 10, n_lists=16, exclude_self=True, block_rows=40)
    return out.select("query_id", "item_id", rnd("score", 6).alias("score"), "rank")


# The share of all scores that the bounded search computed there.
@register("ivf_clustered_work", "SELECT CAST(count(*) AS BIGINT) AS n_vectors, true AS under_a_quarter FROM embeddings")
def q_ivf_work(spark, sf):
    work, c = [], _clustered(spark, sf)
    V.ivf_exact_topk(*_sides(c), 10, n_lists=16, exclude_self=True, work=work)
    scores = sum(w[3] for w in work)
    return c.agg(F.count(F.lit(1)).alias("n_vectors"), (F.lit(4 * scores) < F.count(F.lit(1)) * F.count(F.lit(1))).alias("under_a_quarter"))


# R1 by falling length: the embeddings stretched, as items' lengths grow with their popularity.
STRETCHED = """
c AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x * (1 + 20.0 / (1 + vec_id * 7919 % 97))) AS embedding FROM embeddings)"""


def _stretched(spark, sf):
    by = 1 + F.lit(20.0) / (1 + F.col("vec_id") * 7919 % 97)
    return _emb(spark, sf).select("vec_id", F.transform("vec", lambda x: x.cast("double") * by).alias("vec"))


@register("vector_topk_norm_ordered", "WITH" + STRETCHED + TOPK_SQL.format(f="list_inner_product").replace("FROM embeddings a JOIN embeddings b", "FROM c a JOIN c b"))
def q_norm_ordered(spark, sf):
    out = V.norm_ordered_topk(*_sides(_stretched(spark, sf)), 10, exclude_self=True, block_rows=32)
    return out.select("query_id", "item_id", rnd("score", 6).alias("score"), "rank")


# R2 with a fixed number of lists. K-means has no SQL form, so its concordance is held against 0.9
# where the clusters are, with 4 lists of 16.
@register("ivf_fixed_probes_clustered", "SELECT count(*) AS n_queries, true AS concordant FROM embeddings")
def q_ivf_fixed(spark, sf):
    q, it = _sides(_clustered(spark, sf))
    found = V.concordance(V.exact_topk(q, it, 10, exclude_self=True), V.ivf_topk(q, it, 10, n_lists=16, n_probe=4, exclude_self=True), 10)
    return found.select("n_queries", (F.col("concordance") >= 0.9).alias("concordant"))


# Probing every list is exact search: what k-means found does not matter then.
@register("vector_topk_ivf_all_lists", TOPK_SQL.format(f="list_inner_product"))
def q_ivf_all(spark, sf):
    e = _emb(spark, sf)
    out = V.ivf_topk(e.select(F.col("vec_id").alias("query_id"), "vec"), e.select(F.col("vec_id").alias("item_id"), "vec"), 10,
                     n_lists=8, n_probe=8, exclude_self=True, block_rows=100)
    return out.select("query_id", "item_id", rnd("score", 6).alias("score"), "rank")


@register("ivf_concordance_all_lists", "SELECT count(*) AS n_queries, CAST(1.0 AS DOUBLE) AS concordance FROM embeddings")
def q_conc_all(spark, sf):
    e = _emb(spark, sf)
    q, it = e.select(F.col("vec_id").alias("query_id"), "vec"), e.select(F.col("vec_id").alias("item_id"), "vec")
    return V.concordance(V.exact_topk(q, it, 10, exclude_self=True), V.ivf_topk(q, it, 10, n_lists=8, n_probe=8, exclude_self=True), 10)


@register("user_embedding_centroids", with_(SEQ) + f""",
good AS (SELECT user_id, product_id FROM inter_train WHERE confidence_score >= 2),
ex AS (SELECT g.user_id, i.i, e.embedding[i.i] AS x
       FROM good g JOIN embeddings e ON e.vec_id = g.product_id CROSS JOIN range(1, {DIM + 1}) i(i)),
c AS (SELECT user_id, list(m ORDER BY i) AS vec FROM (SELECT user_id, i, avg(x) AS m FROM ex GROUP BY 1, 2)
      GROUP BY user_id)
SELECT u.user_id, list_transform(coalesce(c.vec, list_resize([]::DOUBLE[], {DIM}, 0.0)), lambda x: round(x, 6)) AS vec
FROM (SELECT DISTINCT user_id FROM inter_train) u LEFT JOIN c USING (user_id)""")
def q_centroids(spark, sf):
    f = features(spark, sf)
    vecs = _emb(spark, sf).select(F.col("vec_id").alias("product_id"), "vec")
    out = V.user_centroids(f.inter, vecs, f.inter, DIM, user_col="user_id", item_col="product_id")
    return out.select("user_id", _round_arr(F.col("vec")).alias("vec"))


@register("embedding_cosine_moments", """
SELECT count(DISTINCT a.vec_id) AS n, round(avg(c), 6) AS mean_cosine, round(stddev_pop(c), 6) AS std_cosine
FROM (SELECT a.vec_id, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS c
      FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) a""")
def q_moments(spark, sf):
    out = V.offdiagonal_cosine_moments(_emb(spark, sf), DIM)
    return out.select("n", rnd("mean_cosine", 6).alias("mean_cosine"), rnd("std_cosine", 6).alias("std_cosine"))


@register("embedding_cosine_quantiles", """
SELECT unnest([0.1, 0.5, 0.9]::DOUBLE[]) AS prob, round(unnest(quantile_cont(c, [0.1, 0.5, 0.9]::DOUBLE[])), 6) AS value, count(*) AS n_pairs
FROM (SELECT list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS c
      FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)""")
def q_cosine_quantiles(spark, sf):
    out = V.offdiagonal_cosine_quantiles(_emb(spark, sf), block_rows=150)
    return out.select("prob", rnd("value", 6).alias("value"), "n_pairs")


def _session_query_sql() -> str:
    return f""",
iv AS (SELECT v.item_idx, e.embedding FROM item_vocab v JOIN embeddings e ON e.vec_id = v.product_id),
pref AS (SELECT session_idx, item_seq[-1] AS target_item, unnest(item_seq[1:len(item_seq) - 1]) AS item_idx
         FROM s_test),
qx AS (SELECT p.session_idx, i.i, avg(iv.embedding[i.i]) AS m FROM pref p JOIN iv USING (item_idx)
       CROSS JOIN range(1, {DIM + 1}) i(i) GROUP BY 1, 2),
qv AS (SELECT session_idx, list(m ORDER BY i) AS vec FROM qx GROUP BY 1),
recs AS (SELECT * FROM (
  SELECT q.session_idx, iv.item_idx,
         row_number() OVER (PARTITION BY q.session_idx ORDER BY list_cosine_similarity(q.vec, iv.embedding::DOUBLE[])
                            DESC, iv.item_idx) AS rank
  FROM qv q CROSS JOIN iv) WHERE rank <= 20),
tg AS (SELECT session_idx, item_seq[-1] AS item_idx FROM s_test),
{gains_sql(20)}"""


@register("session_recs_embedding_hr_ndcg", with_(SEQ) + _session_query_sql() + """
SELECT count(*) AS n, round(avg(CASE WHEN r.rank IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS hr_at_20,
       round(avg(coalesce(g.gain, 0.0)), 6) AS ndcg_at_20
FROM tg LEFT JOIN recs r USING (session_idx, item_idx) LEFT JOIN gains_20 g ON g.rank = r.rank""")
def q_session_recs(spark, sf):
    s = _Seq(spark, sf)
    f = s.f
    vecs = _emb(spark, sf).select(F.col("vec_id").alias("product_id"), "vec")
    item_vecs = f.item_vocab.join(vecs, "product_id").select("item_idx", "vec")
    sessions = s.sessions("test")
    ev = eval_prefix_target(sessions)
    prefix = sessions.select("session_idx", F.explode(F.slice("item_seq", 1, F.size("item_seq") - 1)).alias("item_idx"))
    qv = V.mean_vectors(prefix, item_vecs, "session_idx", "item_idx", DIM)
    recs = V.exact_topk(qv.select(F.col("session_idx").alias("query_id"), "vec"),
                        item_vecs.select(F.col("item_idx").alias("item_id"), "vec"), 20, metric="cosine")
    recs = recs.select(F.col("query_id").alias("session_idx"), F.col("item_id").alias("item_idx"), "rank")
    targets = ev.select("session_idx", F.col("target_item").alias("item_idx"))
    return Rk.single_target_metrics(recs, targets, 20)


GAP_COLS = ("user_pos", "item_same", "item_diff", "user_same", "user_diff", "gap_pos_vs_same", "gap_same_vs_diff",
            "gap_pos_vs_diff", "item_gap")


@register("embedding_score_gaps", with_(SEQ) + f""",
iv AS (SELECT e.vec_id AS product_id, e.label, e.embedding::DOUBLE[] AS v FROM embeddings e
       WHERE e.vec_id IN (SELECT product_id FROM item_vocab)),
good AS (SELECT user_id, product_id FROM inter_train WHERE confidence_score >= 2),
ex AS (SELECT g.user_id, i.i, e.embedding[i.i] AS x
       FROM good g JOIN embeddings e ON e.vec_id = g.product_id CROSS JOIN range(1, {DIM + 1}) i(i)),
uc AS (SELECT user_id, list(m ORDER BY i) AS w FROM (SELECT user_id, i, avg(x) AS m FROM ex GROUP BY 1, 2)
       GROUP BY user_id),
pos AS (SELECT t.user_id, t.product_id FROM inter_train t JOIN uc USING (user_id)
        WHERE t.product_id IN (SELECT product_id FROM iv)),
per AS (
  SELECT p.user_id, p.product_id,
         any_value(list_cosine_similarity(u.w, a.v)) AS user_pos,
         avg(CASE WHEN b.label = a.label THEN list_cosine_similarity(a.v, b.v) END) AS item_same,
         avg(CASE WHEN b.label <> a.label THEN list_cosine_similarity(a.v, b.v) END) AS item_diff,
         avg(CASE WHEN b.label = a.label THEN list_cosine_similarity(u.w, b.v) END) AS user_same,
         avg(CASE WHEN b.label <> a.label THEN list_cosine_similarity(u.w, b.v) END) AS user_diff
  FROM pos p JOIN iv a ON a.product_id = p.product_id JOIN uc u USING (user_id)
  JOIN iv b ON b.product_id <> a.product_id
  GROUP BY p.user_id, p.product_id),
m AS (SELECT count(*) AS n_pairs, avg(user_pos) AS user_pos, avg(item_same) AS item_same,
             avg(item_diff) AS item_diff, avg(user_same) AS user_same, avg(user_diff) AS user_diff FROM per)
SELECT n_pairs, round(user_pos, 6) AS user_pos, round(item_same, 6) AS item_same, round(item_diff, 6) AS item_diff,
       round(user_same, 6) AS user_same, round(user_diff, 6) AS user_diff,
       round(user_pos - user_same, 6) AS gap_pos_vs_same, round(user_same - user_diff, 6) AS gap_same_vs_diff,
       round(user_pos - user_diff, 6) AS gap_pos_vs_diff, round(item_same - item_diff, 6) AS item_gap FROM m""")
def q_gaps(spark, sf):
    f = features(spark, sf)
    emb = _emb(spark, sf)
    items = (f.item_vocab.join(emb.withColumnRenamed("vec_id", "product_id"), "product_id")
             .select(F.col("product_id").alias("item_id"), "label", "vec"))
    vecs = emb.select(F.col("vec_id").alias("product_id"), "vec")
    good = f.inter.filter(F.col("confidence_score") >= 2)
    users = V.mean_vectors(good, vecs, "user_id", "product_id", DIM)
    pairs = f.inter.select("user_id", F.col("product_id").alias("item_id"))
    out = V.score_gaps(pairs, items, users, DIM)
    return out.select("n_pairs", *[rnd(c, 6).alias(c) for c in GAP_COLS])
