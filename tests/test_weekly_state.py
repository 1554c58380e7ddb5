import datetime as dt
import os
import random

import pytest

from clickloom.operators import drift as D
from clickloom.operators import weekly_state as S
from helpers import T0, events

START = T0 + dt.timedelta(days=7)
BASELINES = [(1, T0, START), (None, T0, START + dt.timedelta(days=7))]


@pytest.fixture(scope="module")
def log(spark):
    draw = random.Random(11)
    week = 7 * 86400
    rows = []
    for w in range(5):  # the baseline week, then four; the third is nearly empty
        for _ in range(30 if w == 3 else 1200):
            user, item = draw.randrange(60), int(draw.paretovariate(0.7 + 0.2 * w)) % 40
            rows.append((w * week + draw.randrange(week), draw.choice(["view", "view", "cart", "purchase"]), item, user, f"s{user}-{w}-{draw.randrange(3)}"))
    return events(spark, rows).cache()


def listed(df):
    # sums of doubles may differ in their last place
    return sorted(tuple(round(x, 10) if isinstance(x, float) else x for x in r) for r in df.collect())


def test_resumed_runs_equal_one_run(spark, log, tmp_path):
    once = listed(S.advance(log, str(tmp_path / "once"), START, BASELINES))
    assert [r[0] for r in once] == [1, 2, 3, 4] and once[2][6] == "too_few_events"
    state = str(tmp_path / "twice")
    assert [r[0] for r in listed(S.advance(log, state, START, BASELINES, weeks=[1, 2]))] == [1, 2]
    assert listed(S.advance(log, state, START, BASELINES)) == once
    files = {p for p in os.listdir(os.path.join(state, "pairs")) if p.startswith("week=")}
    assert files == {"week=3", "week=4"}
    # a finished week is not touched by the next run, and judged again it gives the same
    stamp = {w: sorted(os.listdir(os.path.join(state, "history", f"week={w}"))) for w in (1, 2, 4)}
    assert listed(S.advance(log, state, START, BASELINES)) == once
    assert {w: sorted(os.listdir(os.path.join(state, "history", f"week={w}"))) for w in (1, 2, 4)} == stamp
    assert listed(S.advance(log, state, START, BASELINES, weeks=[4, 2], redo=[2, 4])) == once
    # the gate over all weeks at once agrees
    gate = {r["week"]: (r["action"], r["best_after"]) for r in D.weekly_gate(D.weekly_report(log, START, BASELINES)).collect()}
    assert {r[0]: (r[6], r[10]) for r in once} == {w: (a, round(b, 10)) for w, (a, b) in gate.items()}


def test_a_week_resumes_from_its_stored_pairs(spark, log, tmp_path):
    state, first_week = str(tmp_path / "state"), [(None, T0, START)]
    S.advance(log, state, START, first_week, weeks=[1, 2])
    whole = listed(S.advance(log, str(tmp_path / "whole"), START, first_week))
    # weeks 3 and 4 with the events of week 1 gone from the log
    kept = log.where(f"event_time < '{START + dt.timedelta(days=7)}' OR event_time >= '{START + dt.timedelta(days=14)}'")
    assert listed(S.advance(kept, state, START, first_week)) == whole


def test_a_failing_week_leaves_the_state_readable(spark, log, tmp_path, monkeypatch):
    state = str(tmp_path / "state")
    before = listed(S.advance(log, state, START, BASELINES, weeks=[1]))
    monkeypatch.setattr(S, "_evaluate", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        S.advance(log, state, START, BASELINES)
    assert listed(S.read_history(spark, state)) == before
    monkeypatch.undo()
    assert listed(S.advance(log, state, START, BASELINES)) == listed(S.advance(log, str(tmp_path / "one"), START, BASELINES))


def test_no_events_no_history(spark, log, tmp_path):
    assert S.advance(log.limit(0), str(tmp_path / "s"), START, BASELINES).count() == 0
