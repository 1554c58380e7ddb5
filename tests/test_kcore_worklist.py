import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import cleaning as C


def by_rounds(rows, k, max_rounds=10):
    """The plain loop: count everybody again, drop, repeat."""
    history = []
    for i in range(1, max_rounds + 1):
        users, items = {}, {}
        for u, p in rows:
            users[u] = users.get(u, 0) + 1
            items[p] = items.get(p, 0) + 1
        kept = [(u, p) for u, p in rows if u is not None and p is not None and users[u] >= k and items[p] >= k]
        history.append((i, len(kept), len({u for u, _ in kept}), len({p for _, p in kept})))
        same, rows = len(kept) == len(rows), kept
        if same:
            break
    return sorted(rows), history


def table(spark, rows):
    return spark.createDataFrame(rows, "user_id long, product_id long").withColumn("event", F.monotonically_increasing_id())


def run(spark, rows, k, **options):
    history, work = [], []
    out = C.kcore(table(spark, rows), k=k, history=history, work=work, **options)
    return sorted((r["user_id"], r["product_id"]) for r in out.collect()), history, work


@pytest.mark.parametrize("seed, k, per_bucket", [(1, 3, 1 << 20), (2, 4, 20), (3, 5, 7)])
def test_worklist_equals_plain_rounds(spark, seed, k, per_bucket):
    draw = random.Random(seed)
    rows = [(draw.randrange(70), int(draw.paretovariate(0.8)) % 50) for _ in range(330)]
    rows += [(None, 3), (5, None), (None, None), (900, None), (900, None), (None, 901)] + [(1000, 2000)] * 6
    kept, history = by_rounds(rows, k)
    assert len(history) >= 3
    assert run(spark, rows, k, pairs_a_bucket=per_bucket)[:2] == (kept, history)


def test_later_rounds_read_what_falls(spark):
    # a core of 40 x 40, and a path that loses its two ends in every round
    rows = [(u, p) for u in range(40) for p in range(40)]
    rows += [x for i in range(12) for x in ((1000 + i, 1000 + i), (1000 + i, 1001 + i))]
    kept, history = by_rounds(rows, 2, 20)
    got = run(spark, rows, 2, max_rounds=20, pairs_a_bucket=16)
    assert got[:2] == (kept, history) and len(history) > 6
    pairs = len(set(rows))
    assert all(read < pairs / 4 for _, read in got[2]) and [w[0] for w in got[2]] == list(range(1, len(history)))


def test_cut_off_null_only_and_empty(spark):
    rows = [(i + j, i) for i in range(10) for j in range(2)]
    for most in (1, 2, 3):
        assert run(spark, rows, 2, max_rounds=most)[:2] == by_rounds(rows, 2, most)
    assert run(spark, [(None, 1), (1, None)], 1)[:2] == by_rounds([(None, 1), (1, None)], 1)
    assert run(spark, [], 3)[:2] == ([], [(1, 0, 0, 0)])
