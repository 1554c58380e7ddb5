import datetime as dt
import math

import pytest

from clickloom.operators import drift as D
from clickloom.operators import ranking as Rk
from clickloom.operators import retrieval as Rt


def _recs(spark, rows):
    return spark.createDataFrame(rows, "user_idx long, item_idx long, rank int")


def _gt(spark, rows):
    return spark.createDataFrame(rows, "user_idx long, item_idx long")


def test_metrics_single_target_rank_1_k_and_k_plus_1(spark):
    k = 3
    recs = _recs(spark, [(1, 10, 1), (2, 20, 3), (3, 30, 4)])
    gt = _gt(spark, [(1, 10), (2, 20), (3, 30), (4, 40)])  # user 4: empty recommendations
    m = {r.user_idx: r for r in Rk.user_metrics(recs, gt, k).collect()}
    assert m[1].ndcg == pytest.approx(1.0) and m[1].recall == 1.0
    assert m[2].ndcg == pytest.approx(1 / math.log2(4)) and m[2].hit == 1
    assert m[3].hits == 0 and m[3].ndcg == 0.0
    assert m[4].hits == 0 and m[4].recall == 0.0


def test_metrics_ground_truth_larger_than_k(spark):
    recs = _recs(spark, [(1, 1, 1), (1, 2, 2)])
    gt = _gt(spark, [(1, i) for i in range(1, 6)])
    r = Rk.user_metrics(recs, gt, 2).first()
    assert r.recall == 1.0  # hits / min(|GT|, k)
    r2 = Rk.user_metrics(recs, gt, 2, recall_denominator="gt").first()
    assert r2.recall == pytest.approx(2 / 5)


def test_cohorts_emit_zero_rows(spark):
    per = spark.createDataFrame([(1, 1.0, 1.0, 1)], "user_idx long, recall double, ndcg double, hit int")
    pairs = spark.createDataFrame([(1, i, 1) for i in range(5)], "user_idx long, item_idx long, confidence_score long")
    out = {r.cohort: r.n_users for r in Rk.stratified_metrics(per, pairs, 20).collect()}
    assert out == {"overall": 1, "cold": 1, "medium": 0, "warm": 0}


def _counts(spark, rows):
    return spark.createDataFrame(rows, "item long, n long")


def test_jsd_identical_disjoint_one_sided(spark):
    a = _counts(spark, [(1, 5), (2, 5)])
    assert D.jsd_smoothed(a, a).first().jsd == pytest.approx(0.0, abs=1e-9)
    assert D.jsd_masked(a, a).first().jsd == pytest.approx(0.0, abs=1e-12)
    b = _counts(spark, [(3, 5), (4, 5)])
    assert D.jsd_smoothed(a, b).first().jsd == pytest.approx(1.0, abs=1e-6)
    assert D.jsd_masked(a, b).first().jsd == pytest.approx(1.0)
    c = _counts(spark, [(1, 5), (2, 5), (3, 10)])
    v = D.jsd_masked(a, c).first().jsd
    assert 0 < v < 1


def test_weekly_gate_fold(spark):
    w = spark.createDataFrame([(1, 500, 80, 0.02, 0.10), (2, 500, 80, 0.05, 0.20), (3, 500, 80, 0.2, 0.1003), (4, 500, 80, 0.3, 0.101),
                               (5, 99, 80, 0.9, 0.9), (6, 500, 49, 0.9, 0.9), (7, 99, 9, 0.0, 0.9), (8, 500, 80, 0.1, None)],
                              "week int, n_events long, n_sessions long, jsd double, ndcg double")
    out = {r.week: (r.action, r.retrained, r.promoted, r.best_after) for r in D.weekly_gate(w).collect()}
    assert out[1] == ("promoted", True, True, 0.10)            # week 1 is always retrained
    assert out[2] == ("no_finetune", False, False, 0.10)       # low drift: skipped although better
    assert out[3] == ("not_promoted", True, False, 0.10)       # gain below 0.0005
    assert out[4] == ("promoted", True, True, 0.101)
    assert out[5] == ("too_few_events", False, False, 0.101)
    assert out[6] == ("too_few_sessions", False, False, 0.101)
    assert out[7] == ("too_few_events", False, False, 0.101)
    assert out[8] == ("trained_no_eval", True, False, 0.101)   # drift of exactly the threshold is not below it


def test_weekly_jsd_against_its_baseline(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    rows = [(day(1), 1), (day(2), 2), (day(9), 1), (day(9), 2), (day(16), 1), (day(16), 1), (day(30), 3)]
    ev = spark.createDataFrame(rows, "event_time timestamp_ntz, product_id long")
    tagged = D.weekly_windows(ev, day(8))
    assert D.week_count(tagged) == 4
    got = {r.week: r.jsd for r in D.weekly_jsd(tagged, ev, [(1, day(1), day(8)), (None, day(8), day(15))]).collect()}
    assert got[1] == pytest.approx(0.0, abs=1e-12)   # same mix as 1-7 January
    assert got[4] == pytest.approx(1.0)              # disjoint from 8-14 January
    want = 0.5 * (0.5 * math.log(0.5 / 0.75) + 0.5 * math.log(0.5 / 0.25)) + 0.5 * math.log(1 / 0.75)
    assert got[2] == pytest.approx(want / math.log(2))


def test_drift_alert_is_strict(spark):
    a = spark.createDataFrame([(i,) for i in (1, 1, 2)], "product_id long")
    b = spark.createDataFrame([(i,) for i in (1, 2, 2)], "product_id long")
    jsd = D.drift_report(a, b).first().jsd
    value = D.jsd_smoothed(D.item_counts(a), D.item_counts(b)).first().jsd
    assert jsd == pytest.approx(value, abs=1e-6)
    assert D.drift_report(a, b, alert=value).first().alert is False
    assert D.drift_report(a, b, alert=value - 1e-9).first().alert is True


def test_popularity_recs_exclude_seen_and_history_unbounded(spark):
    pairs = spark.createDataFrame([(1, i, 10 - i) for i in range(1, 9)] + [(2, 1, 1)],
                                  "user_idx long, item_idx long, confidence_score long")
    ranks = Rt.popularity_ranks(pairs)
    recs = Rt.popularity_recs(spark.createDataFrame([(1,), (2,)], "user_idx long"), pairs, ranks, k=3)
    got = {(r.user_idx, r.rank): r.item_idx for r in recs.collect()}
    assert (1, 1) not in got  # user 1 has seen every item
    assert [got[(2, i)] for i in (1, 2, 3)] == [2, 3, 4]


@pytest.mark.parametrize("head", [2, 5, 4096])
def test_popularity_recs_head_broadcast_and_tail_join_agree(spark, monkeypatch, head):
    # Ranks inside the broadcast head and past it (shuffle join) give the brute-force answer.
    monkeypatch.setattr(Rt, "HEAD_RANKS", head)
    rows = [(u, i, (u * 7 + i * 3) % 5 + 1) for u in range(1, 7) for i in range(1, 13) if (u + i) % 3 != 0]
    pairs = spark.createDataFrame(rows, "user_idx long, item_idx long, confidence_score long")
    ranks = Rt.popularity_ranks(pairs)
    users = spark.createDataFrame([(u,) for u in range(1, 8)], "user_idx long")
    got = {(r.user_idx, r.rank): r.item_idx for r in Rt.popularity_recs(users, pairs, ranks, k=4).collect()}
    order = [r.item_idx for r in ranks.orderBy("pop_rank").collect()]
    seen = {}
    for u, i, _ in rows:
        seen.setdefault(u, set()).add(i)
    want = {}
    for u in range(1, 8):
        for n, i in enumerate([i for i in order if i not in seen.get(u, set())][:4], start=1):
            want[(u, n)] = i
    assert got == want


@pytest.mark.parametrize("pairs_a_key", [2, 7, 2_000_000])
def test_cooccurrence_counts_salted_hot_users_exact(spark, monkeypatch, pairs_a_key):
    # Splitting users by their pair work leaves every count exact.
    monkeypatch.setattr(Rt, "PAIRS_A_KEY", pairs_a_key)
    rows = [(u, i, 1) for u in range(1, 6) for i in range(1, 9) if (u * i) % 4 != 0 or u == 1]
    pairs = spark.createDataFrame(rows, "user_idx long, item_idx long, confidence_score long")
    reps = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "user_idx long, rep_item long")
    got = {(r.rep_item, r.item_idx): r.cooc for r in Rt.cooccurrence_counts(pairs, reps).collect()}
    items = {}
    for u, i, _ in rows:
        items.setdefault(u, set()).add(i)
    want = {}
    for rep in (1, 2, 3):
        for its in items.values():
            if rep in its:
                for i in its - {rep}:
                    want[(rep, i)] = want.get((rep, i), 0) + 1
    assert got == want
