"""Score distributions: draws travel as places, vectors once a cell."""
from clickloom.operators import vectors as V


def _tables(spark):
    items = spark.createDataFrame([(i, i % 3, [float(i % 5 + 1), float(i % 7), 1.0]) for i in range(30)], "item_id long, label int, vec array<double>")
    users = spark.createDataFrame([(u, [1.0, float(u), 2.0]) for u in range(6)], "user_id long, vec array<double>")
    pairs = spark.createDataFrame([(u, i) for u in range(6) for i in range(30) if u == 0 or (u + i) % 4 == 0], "user_id long, item_id long")
    return pairs, items, users


def _rounded(df):
    return {r["group"]: [r["n"], *[round(r[c], 9) for c in ("mean", "std", "p10", "p50", "p90")]] for r in df.collect()}


def test_draws_carry_no_vectors(spark, monkeypatch):
    pairs, items, users = _tables(spark)
    join = V.lookup_join

    def watch(rows, small, *args, **more):
        assert not any(t.startswith("array") for _, t in rows.dtypes + small.dtypes)
        return join(rows, small, *args, **more)

    monkeypatch.setattr(V, "lookup_join", watch)
    got = _rounded(V.score_distributions(pairs, items, users, n_draws=3))
    assert got["same_category"][0] == 3 * pairs.count()


def test_cells_of_any_size_give_the_same(spark, monkeypatch):
    pairs, items, users = _tables(spark)
    draws, truth = (lambda: _rounded(V.score_distributions(pairs, items, users, n_draws=4)),
                    lambda: _rounded(V.truth_score_distributions(pairs, users, items.select("item_id", "vec"), n_draws=50)))
    want = draws(), truth()
    monkeypatch.setattr(V, "CELL_ROWS", 7)
    monkeypatch.setattr(V, "CELL_DRAWS", 40)
    assert (draws(), truth()) == want


def test_places_that_come_twice_or_never_are_joined_as_rows():
    import numpy as np
    first, n = V._runs(np.array([5, 3, 5]), np.array([5, 4, 3]))
    assert first.tolist() == [1, 1, 0] and n.tolist() == [2, 0, 1]
    assert V._each(n).tolist() == [0, 0, 2] and V._within(n).tolist() == [0, 1, 0]


def test_items_given_twice_count_twice(spark):
    pairs, items, users = _tables(spark)
    once = _rounded(V.truth_score_distributions(pairs, users, items.select("item_id", "vec"), n_draws=20))
    twice = _rounded(V.truth_score_distributions(pairs, users, items.select("item_id", "vec").union(items.select("item_id", "vec")), n_draws=20))
    assert once["truth"] == twice["truth"]
