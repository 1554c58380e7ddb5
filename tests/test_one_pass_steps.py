"""Steps that many queries share: how often they read, shuffle and sort, and that their rows stay."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickloom.operators import cleaning as C
from clickloom.operators import ordering as O
from clickloom.operators import sequences as Sq
from clickloom.operators import vectors as V
from clickloom.sources import testdata as T

START = dt.datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(monkeypatch):
    """The plans of the tables that a module stores, in order."""
    def watch(module):
        plans, keep = [], module.cut_lineage
        monkeypatch.setattr(module, "cut_lineage", lambda df: plans.append(plan(df)) or keep(df))
        return plans
    return watch


def visits(spark):
    """(id, user, time): nulls, ties, gaps of 29 to 31 minutes."""
    rows = []
    for u in (1, 2, 3, None):
        t = START
        for k in range(40):
            t += dt.timedelta(minutes=(0, 29, 30, 31, 200)[(k * 7 + (u or 0)) % 5])
            rows.append((len(rows), u, None if k % 13 == 5 else t))
    return spark.createDataFrame(rows, "id long, u long, t timestamp_ntz")


def test_sessions_are_numbered_in_one_shuffle_and_alike_for_hot_users(spark):
    df = visits(spark)
    plain = T.sessionize(df, "u", "t", "id", 1800)
    assert plan(plain).count("Exchange hashpartitioning") == 1 and plan(plain).count("Sort [") == 1
    # the same by two steps: the gap test in time buckets, then the running count
    steps = O.previous_within(df.withColumn("_s", F.unix_timestamp("t")), "u", "t", "id", ["_s"], 1800, out="_p", bucket_seconds=3600).drop("_tb")
    steps = O.running_sum(steps, "u", "t", "id", (F.col("_p").isNull() | (F.col("_s") - F.col("_p._s") > 1800)).cast("long"), "session_no")
    numbers = lambda df: {r.id: r.session_no for r in df.collect()}
    assert numbers(plain) == numbers(steps) and plain.count() == 160
    timed = df.where("t is not null")
    hot = T.sessionize(timed, "u", "t", "id", 1800, hot_rows=10)
    assert numbers(hot) == numbers(T.sessionize(timed, "u", "t", "id", 1800))
    assert {r.session_no for r in plain.where("u = 1 and t is null").collect()} == {1}
    assert plain.columns == hot.columns == ["id", "u", "t", "session_no"]


def test_clean_events_deduplicates_once(spark, stored):
    row = lambda **x: {"event_time": START, "event_type": "view", "product_id": 1, "category_id": 1, "category_code": "a.b",
                       "brand": "x", "price": 5.0, "user_id": 1, "user_session": "1-1"} | x
    rows = [row(), row(price=6.0), row(event_time=START + dt.timedelta(seconds=1)), row(event_time=START + dt.timedelta(seconds=9)),
            row(user_session=None), row(user_id=2, price=0.5), row(user_id=3, brand=None)]
    rows += [row(user_id=4, event_time=START + dt.timedelta(seconds=60 * k)) for k in range(301)]
    schema = "event_time timestamp_ntz, event_type string, product_id long, category_id long, category_code string, brand string, price double, user_id long, user_session string"
    plans = stored(C)
    out = C.clean_events(spark.createDataFrame([tuple(r.values()) for r in rows], schema))
    assert len(plans) == 1 and "Aggregate" in plans[0]
    # what is left to run reads the stored rows: no deduplication, neither for the rows nor for the bots
    assert "SortAggregate" not in plan(out) and "Window" not in plan(out)
    assert sorted((r.user_id, r.event_time.second, r.price, r.brand) for r in out.collect()) == [(1, 0, 5.0, "x"), (1, 9, 5.0, "x"), (3, 0, 5.0, "unknown")]


def test_number_rows_numbers_whole_rows_like_dense_index(spark):
    df = spark.createDataFrame([(k * 37 % 101 if k else None, f"v{k}") for k in range(101)], "k long, v string")
    want = {r.k: r.i for r in O.dense_index(df, "k", "i", start=3).collect()}
    got = O.number_rows(df, "k", "i", start=3)
    assert {r.k: r.i for r in got.collect()} == want and sorted(want.values()) == list(range(3, 104))
    assert {(r.k, r.v) for r in got.collect()} == {(r.k, r.v) for r in df.collect()}


def clicks(spark):
    rows = []
    for u in range(12):
        for k in range(u * 4 + 1):
            rows.append((u, None if u == 5 else f"{u}-{k // 30}", START + dt.timedelta(seconds=k // 2 * 10), (k * k + u) % 4, 1 + k % 3))
    return spark.createDataFrame(rows, "user_idx long, user_session string, event_time timestamp_ntz, item_idx long, event_idx long")


def by_hand(rows, max_len, min_len):
    groups = {}
    for r in rows:
        groups.setdefault((r.user_idx, r.user_session), []).append((r.event_time, r.item_idx, r.event_idx))
    out = []
    for key, events in groups.items():
        events.sort()
        kept = [e for i, e in enumerate(events) if not i or events[i - 1][1] != e[1]][-max_len:]
        if len(kept) >= min_len:
            out.append((key, kept))
    out.sort(key=lambda x: (x[0][0], x[0][1] or ""))
    return [(n, key[0], [e[1] for e in kept], [e[2] for e in kept], len(kept)) for n, (key, kept) in enumerate(out) if key[1] is not None]


def test_sessions_are_ordered_once_and_numbered_without_a_join(spark, stored):
    df = clicks(spark)
    plans = stored(Sq)
    out = Sq.session_sequences(df, max_len=6)
    assert [tuple(r) for r in out.orderBy("session_idx").collect()] == by_hand(df.collect(), 6, 2)
    assert "SortMergeJoin" not in plan(out) and "ShuffledHashJoin" not in plan(out)
    # one order of the events serves the previous item and the last events
    ordered = next(p for p in plans if "collect_list" in p)
    assert sum("event_time" in line for line in ordered.splitlines() if "Sort [" in line) == 1
    assert ordered.count("Exchange hashpartitioning") == 1


def test_mean_vectors_are_hashed_and_dealt_out(spark):
    vecs = spark.createDataFrame([(i, [float(i), float(i * i % 7), -1.0 / (i + 1)]) for i in range(20)], "item_id long, vec array<double>")
    pairs = spark.createDataFrame([(u, i) for u in range(6) for i in range(25) if (u + i) % 3 == 0 and u != 4], "user_id long, item_id long")
    out = V.mean_vectors(pairs, vecs, "user_id", "item_id", 3)
    assert "ObjectHashAggregate" not in plan(out) and "SortAggregate" not in plan(out)
    assert "REPARTITION_BY_NUM" in plan(out)
    of = {r.item_id: r.vec for r in vecs.collect()}
    for r in out.collect():
        mine = [of[p.item_id] for p in pairs.collect() if p.user_id == r.user_id and p.item_id in of]
        assert r.vec == pytest.approx([sum(x) / len(mine) for x in zip(*mine, strict=True)])
    assert out.count() == 5


def test_truth_vs_random_works_out_wanted_users_once(spark, stored):
    users = spark.createDataFrame([(u, [1.0 + u, 2.0, -1.0 * u]) for u in range(8)], "user_id long, vec array<double>")
    items = spark.createDataFrame([(i, [1.0, float(i), -0.5 * i]) for i in range(10)], "item_id long, vec array<double>")
    truth = spark.createDataFrame([(1, 2), (1, 3), (2, 5), (9, 1), (3, 77)], "user_id long, item_id long")
    plans = stored(V)
    out = V.truth_vs_random(truth, users, items).first()
    assert len(plans) == 1 and "LeftSemi" in plans[0]
    unit = lambda v: [x / sum(y * y for y in v) ** 0.5 for x in v]
    cos = lambda a, b: sum(x * y for x, y in zip(unit(a), unit(b), strict=True))
    user, item = {r.user_id: r.vec for r in users.collect()}, {r.item_id: r.vec for r in items.collect()}
    own = {1: (cos(user[1], item[2]) + cos(user[1], item[3])) / 2, 2: cos(user[2], item[5])}
    rand = {u: sum(cos(user[u], v) for v in item.values()) / 10 for u in own}
    assert out.n_users == 2 and out.mean_truth == pytest.approx(sum(own.values()) / 2) and out.mean_random == pytest.approx(sum(rand.values()) / 2)
    assert out.share_above == sum(own[u] > rand[u] for u in own) / 2


def test_kcore_keeps_its_tables_of_users_and_items_off_the_driver(spark, stored):
    rows = [(u, i) for u in range(40) for i in range(u, u + 8)]  # loses both ends in every round
    df = spark.createDataFrame(rows, "user_id long, product_id long")
    plans = stored(C)
    history = []
    out = C.kcore(df, k=6, history=history)
    assert len(history) > 2
    # of who falls, at most once each, keys may be broadcast; counts, and who has gone in all rounds, never
    counts = [p for p in plans if "_lost" in p]
    assert counts and not any("Broadcast" in p for p in counts)
    left = {(r.user_id, r.product_id) for r in out.collect()}
    for _ in range(10):
        users, items = {}, {}
        for u, i in rows:
            users[u], items[i] = users.get(u, 0) + 1, items.get(i, 0) + 1
        rows = [(u, i) for u, i in rows if users[u] >= 6 and items[i] >= 6]
    assert left == set(rows)
