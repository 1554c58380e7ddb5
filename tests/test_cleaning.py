from clickloom.operators import cleaning as C
from tests.helpers import events


def test_fill_and_drop_null_session(spark):
    df = events(spark, [(0, "view", 1, 1, "s1", 5.0, None, None), (1, "view", 1, 1, None)])
    out = C.drop_null_session(C.fill_unknown(df)).collect()
    assert len(out) == 1
    assert out[0]["category_code"] == "unknown" and out[0]["brand"] == "unknown"


def test_exact_dedup_deterministic(spark):
    df = events(spark, [(0, "view", 1, 1, "s", 9.0), (0, "view", 1, 1, "s", 3.0), (0, "cart", 1, 1, "s", 3.0)])
    out = C.exact_dedup(df).orderBy("event_type").collect()
    assert [(r.event_type, r.price) for r in out] == [("cart", 3.0), ("view", 3.0)]


def test_near_dup_chain_collapses_to_first(spark):
    # chain at 0, 1, 2 s: each is within 1 s of the previous input row -> only t=0 survives
    df = events(spark, [(0, "view", 1, 1, "s"), (1, "view", 1, 1, "s"), (2, "view", 1, 1, "s"),
                        (4, "view", 1, 1, "s")])
    out = sorted(r.event_time.second for r in C.near_dedup(df).collect())
    assert out == [0, 4]


def test_near_dup_equal_timestamps_tiebreak(spark):
    df = events(spark, [(0, "view", 1, 1, "s2"), (0, "view", 1, 1, "s1")])
    out = C.near_dedup(df).collect()
    assert [r.user_session for r in out] == ["s1"]


def test_near_dup_across_bucket_boundary(spark):
    # 3599.5 s and 3600.2 s straddle an hour bucket: whole-second gap is 1 -> dropped
    df = events(spark, [(3599.5, "view", 1, 1, "s"), (3600.2, "view", 1, 1, "s")])
    assert C.near_dedup(df, bucket_seconds=3600).count() == 1


def test_price_floor_and_bots(spark):
    rows = [(i, "view", 1, 7, "s") for i in range(0, 40, 2)] + [(0, "view", 2, 8, "t", 0.5)]
    df = events(spark, rows)
    assert C.price_floor(df).count() == 20
    bots = C.bot_users(df, threshold=10).collect()
    assert [r.user_id for r in bots] == [7]
    assert C.drop_bots(df, threshold=10).count() == 1


def _kcore_rows():
    # users 1..3 form a dense core on items 10..12; user 4 hangs on item 13 only,
    # item 13 only survives while user 4 exists: removing user 4 (2 events) removes item 13,
    # which removes user 5 (who then drops below k) -> three rounds
    rows = []
    for u in (1, 2, 3):
        for it in (10, 11, 12):
            rows.append((len(rows), "view", it, u, f"s{u}"))
    rows += [(100, "view", 13, 4, "s4"), (101, "view", 13, 4, "s4")]
    rows += [(200, "view", 13, 5, "s5"), (201, "view", 10, 5, "s5"), (202, "view", 11, 5, "s5")]
    return rows


def test_kcore_multi_round(spark):
    df = events(spark, _kcore_rows())
    hist = []
    out = C.kcore(df, k=3, history=hist)
    assert sorted({r.user_id for r in out.collect()}) == [1, 2, 3]
    assert len(hist) >= 3


def test_kcore_empties(spark):
    df = events(spark, _kcore_rows())
    assert C.kcore(df, k=10).count() == 0


def test_kcore_max_rounds_cutoff(spark):
    df = events(spark, _kcore_rows())
    hist = []
    C.kcore(df, k=3, max_rounds=1, history=hist)
    assert len(hist) == 1


def test_kcore_report_rows(spark):
    df = events(spark, _kcore_rows())
    rep = C.kcore_fixed_rounds_report(df, k=3, rounds=2).orderBy("step").collect()
    assert [r.stage for r in rep] == ["raw", "r1", "r2"]
    assert rep[0].n_rows == 14
