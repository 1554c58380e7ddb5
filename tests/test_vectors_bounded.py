import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators import vectors as V


def _table(spark, m, col, first=0, **more):
    return spark.createDataFrame([(first + i, [float(x) for x in v], *(x[i] for x in more.values())) for i, v in enumerate(m)],
                                 ", ".join([f"{col} long", "vec array<double>", *(f"{n} long" for n in more)]))


def _rows(df):
    return sorted((r["query_id"], r["rank"], r["item_id"], round(r["score"], 9)) for r in df.collect())


def _clusters(rng, n, dim, k):
    return np.eye(dim)[rng.integers(0, k, n)] * 5 + rng.normal(size=(n, dim)) * 0.3


@pytest.mark.parametrize("shape", ["clustered", "shapeless", "tied"])
def test_bounded_search_is_exact(spark, shape):
    rng = np.random.default_rng(4)
    m = {"clustered": _clusters(rng, 400, 12, 8), "shapeless": rng.normal(size=(400, 12)), "tied": rng.integers(-1, 2, (400, 4)).astype(float)}[shape]
    items, queries, work = _table(spark, m, "item_id"), _table(spark, m[:150], "query_id"), []
    got = V.ivf_exact_topk(queries, items, 7, n_lists=10, exclude_self=True, block_rows=30, work=work)
    assert _rows(got) == _rows(V.exact_topk(queries, items, 7, exclude_self=True))
    scores = sum(w[3] for w in work)
    assert scores <= 150 * 400 and [w[0] for w in work] == list(range(1, len(work) + 1)) and len(work) <= 5
    assert work[0][1] == 150 and all(a[1] >= b[1] for a, b in zip(work, work[1:]))  # finished queries drop out
    if shape == "clustered":
        assert scores < 150 * 400 / 4


def test_bounded_search_with_few_items_and_without_any(spark):
    items = _table(spark, [[1.0, 0.0], [0.0, 0.0], [-1.0, 2.0]], "item_id").unionByName(spark.createDataFrame([(9, None)], "item_id long, vec array<double>"))
    queries = _table(spark, [[1.0, 1.0], [0.0, 0.0]], "query_id").unionByName(spark.createDataFrame([(9, None)], "query_id long, vec array<double>"))
    got = V.ivf_exact_topk(queries, items, 5, n_lists=2)
    assert [(r[0], r[2]) for r in _rows(got)] == [(0, 0), (0, 2), (0, 1), (1, 0), (1, 1), (1, 2)]
    assert V.ivf_exact_topk(queries, items.limit(0), 5, n_lists=2).count() == 0
    assert V.ivf_exact_topk(queries.limit(0), items, 5, n_lists=2).count() == 0


@pytest.mark.parametrize("block_rows", [1000, 17])
def test_cosine_quantiles_of_all_pairs(spark, block_rows):
    rng = np.random.default_rng(8)
    m = rng.normal(size=(90, 5))
    m[10:40] = m[3]  # many equal values
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    every = (u @ u.T)[~np.eye(len(m), dtype=bool)]
    probs = (0.0, 0.1, 0.33, 0.5, 0.9, 1.0)
    got = V.offdiagonal_cosine_quantiles(_table(spark, m, "vec_id"), probs, block_rows=block_rows, bins=64, passes=5).orderBy("prob").collect()
    assert np.allclose([r["value"] for r in got], np.quantile(every, probs), atol=1e-8) and {r["n_pairs"] for r in got} == {90 * 89}
    plan_rows = V.offdiagonal_cosine_quantiles(_table(spark, m[:1], "vec_id"), (0.5,)).collect()
    assert [tuple(r) for r in plan_rows] == [(0.5, None, 0)]


def test_score_distributions_draw_from_the_right_items(spark):
    # category c lies along axis c; category 2 holds one item only
    label = [0] * 6 + [1] * 5 + [2]
    items = _table(spark, np.eye(3)[label], "item_id", label=label)
    users = _table(spark, [[1.0, 0, 0], [0, 0, 1.0]], "user_id")
    pairs = spark.createDataFrame([(0, 2), (0, 7), (1, 11), (1, 500), (7, 3)], "user_id long, item_id long")
    got = {r["group"]: r for r in V.score_distributions(pairs, items, users, n_draws=4).collect()}
    # user 0: positives in categories 0 and 1, user 1 in category 2, where nothing else can be drawn
    assert got["positive"]["n"] == 3 and got["same_category"]["n"] == 8 and got["other_category"]["n"] == 12
    assert got["same_category"]["mean"] == pytest.approx(0.5) and got["same_category"]["std"] == pytest.approx(0.5)
    assert got["positive"]["p50"] == pytest.approx(1.0)
    again = {r["group"]: r for r in V.score_distributions(pairs.repartition(5), items.repartition(3), users, n_draws=4).collect()}
    assert again == got
    none = {r["group"]: r["n"] for r in V.score_distributions(pairs.limit(0), items, users).collect()}
    assert none == {"positive": 0, "same_category": 0, "other_category": 0}


def test_truth_distribution_takes_each_user_once(spark):
    items = _table(spark, [[1.0, 0], [0, 1.0], [1.0, 1.0]], "item_id")
    users = _table(spark, [[1.0, 0], [0, 1.0]], "user_id")
    truth = spark.createDataFrame([(0, 0), (0, 0), (0, 1), (1, 1), (1, 99), (5, 1)], "user_id long, item_id long")
    got = {r["group"]: r for r in V.truth_score_distributions(truth, users, items, n_draws=500).collect()}
    assert got["truth"]["n"] == got["random"]["n"] == 2 and got["truth"]["mean"] == pytest.approx(0.75)
    assert got["random"]["mean"] == pytest.approx((1 + 0.5**0.5) / 3, abs=0.05)


def test_list_bounds_hold_every_item(spark):
    rng = np.random.default_rng(6)
    items = _table(spark, rng.normal(size=(60, 4)), "item_id")
    cents = V.kmeans_centroids(items, 5)
    lists = V.nearest_clusters(items, cents, 1, "item_id")
    bounds = {r["cluster"]: r for r in V.list_bounds(lists, cents).collect()}
    centre = {r["cluster"]: np.array(r["centroid"]) for r in cents.collect()}
    for r in lists.collect():
        assert np.linalg.norm(np.array(r["vec"]) - centre[r["cluster"]]) <= bounds[r["cluster"]]["radius"] + 1e-12
        assert np.linalg.norm(r["vec"]) <= bounds[r["cluster"]]["longest"] + 1e-12
    assert sum(b["n"] for b in bounds.values()) == 60 and lists.agg(F.count_distinct("cluster")).first()[0] == len(bounds)


@pytest.mark.parametrize("shape", ["spread", "equal", "tied"])
def test_norm_ordered_search_is_exact_and_skips_blocks(spark, shape):
    rng = np.random.default_rng(12)
    m = rng.normal(size=(300, 6))
    if shape == "spread":
        m *= rng.pareto(1.0, (300, 1)) + 0.01
    if shape == "tied":
        m = rng.integers(-2, 3, (300, 3)).astype(float)
    items, queries, work = _table(spark, m, "item_id"), _table(spark, m[::3], "query_id"), []
    got = V.norm_ordered_topk(queries, items, 5, exclude_self=True, block_rows=20, work=work)
    assert _rows(got) == _rows(V.exact_topk(queries, items, 5, exclude_self=True))
    products = sum(w[2] for w in work)  # (query, block) products of 100 x 15
    assert products < 100 * 15 / 2 if shape == "spread" else products <= 100 * 15
    assert V.norm_ordered_topk(queries, items.limit(0), 5).count() == 0 and V.norm_ordered_topk(queries.limit(0), items, 5).count() == 0
