"""Copies and group sizes of the block products, whatever the blocks asked for."""
import math

import numpy as np
from pyspark.sql import functions as F

from clickloom.operators import vectors as V


def _vectors(spark, n, dim=4, seed=3):
    r = np.random.default_rng(seed)
    return spark.createDataFrame([(int(i), [float(x) for x in r.normal(size=dim)]) for i in range(n)], "id long, vec array<double>")


def _sides(e):
    return e.select(F.col("id").alias("query_id"), "vec"), e.select(F.col("id").alias("item_id"), "vec")


def _watched(monkeypatch):
    seen, product = [], V._block_product

    def watch(q, it, keys, k, exclude_self):
        seen.append((keys, q, it))
        return product(q, it, keys, k, exclude_self)

    monkeypatch.setattr(V, "_block_product", watch)
    return seen


def test_small_blocks_do_not_copy_quadratically(spark, monkeypatch):
    seen, (q, it) = _watched(monkeypatch), _sides(_vectors(spark, 400))
    V.exact_topk(q, it, 3, exclude_self=True, block_rows=4)
    V.ivf_topk(q, it, 3, n_lists=2, n_probe=2, exclude_self=True, block_rows=4)
    for _, left, right in seen:
        assert left.count() <= 400 * V.MOST_BLOCKS and right.count() <= 400 * V.MOST_BLOCKS


def test_blocks_by_length_are_few_and_the_result_stays(spark):
    q, it = _sides(_vectors(spark, 300))
    work: list = []
    got = V.norm_ordered_topk(q, it, 3, exclude_self=True, block_rows=1, work=work)
    assert sum(w[2] for w in work) <= 300 * V.MOST_LISTS
    want = V.exact_topk(q, it, 3, exclude_self=True)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_queries_of_a_list_are_cut_too(spark, monkeypatch):
    monkeypatch.setattr(V, "FULL_BLOCK", 50)
    seen, (q, it) = _watched(monkeypatch), _sides(_vectors(spark, 300))
    got = V.ivf_topk(q, it, 3, n_lists=2, n_probe=2, exclude_self=True)
    keys, left, right = seen[0]
    for side in (left, right):
        assert side.groupBy(*keys).count().agg(F.max("count")).first()[0] <= 100
    want = V.exact_topk(q, it, 3, exclude_self=True)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_unit_vectors_cost_one_pass(spark):
    wide = spark.range(2).select(F.array_repeat(F.lit(1.0), 4).alias("vec")).select(V.l2_normalize("vec").alias("u"))
    assert [r["u"] for r in wide.collect()] == [[0.5] * 4] * 2
    odd = spark.createDataFrame([([0.0, 0.0],), (None,), ([3.0, None],)], "vec array<double>").select(V.l2_normalize("vec").alias("u"))
    assert [r["u"] for r in odd.collect()] == [[0.0, 0.0], None, [0.0, 0.0]]
    # the length must not lie inside the function applied to each element
    plan = wide._jdf.queryExecution().analyzed().toString()
    assert plan.count("SQRT") + plan.count("sqrt") == 1


def test_scores_of_quantile_blocks(spark):
    e = _vectors(spark, 120).withColumnRenamed("id", "vec_id")
    rows = np.array([r["vec"] for r in e.collect()])
    u = rows / np.sqrt((rows * rows).sum(axis=1))[:, None]
    cos = (u @ u.T)[~np.eye(120, dtype=bool)]
    got = {r["prob"]: r["value"] for r in V.offdiagonal_cosine_quantiles(e, block_rows=2).collect()}
    for p, v in got.items():
        assert math.isclose(v, np.quantile(cos, p), abs_tol=1e-9)
