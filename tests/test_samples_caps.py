"""Samples without a merge in one task, sequences and replays without caps."""

from pyspark.sql import functions as F

from clickloom.operators import ordering as O
from clickloom.operators import sampling as S
from clickloom.operators import sequences as Sq
from clickloom.sources.testdata import sessionize
from tests.helpers import ts


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_samples_do_not_merge_in_one_task(spark):
    df = spark.range(20_000).select(F.col("id").alias("user_id"))
    plan = _plan(S.hash_user_sample(df, 15_000))
    assert "TakeOrderedAndProject" not in plan and "GlobalLimit" not in plan
    plan = _plan(S.row_budget_sample(df, 10_000, min_events=1))
    assert "TakeOrderedAndProject" not in plan and "GlobalLimit" not in plan


def test_exactly_n_users_and_seed_matters(spark):
    df = spark.range(300).select((F.col("id") % 100).alias("user_id"), "id")
    one, two = ({r.user_id for r in S.hash_user_sample(df, 37, seed=s).collect()} for s in (1, 2))
    assert len(one) == len(two) == 37 and one != two
    assert S.hash_user_sample(df, 37, seed=1).count() == 111
    assert S.hash_user_sample(df, 1000).count() == 300


def test_first_n_takes_ties_by_key(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(10)], "k long, g long")
    assert sorted(r.k for r in O.first_n(df, "k", F.col("g"), 6).collect()) == [0, 1, 2, 4, 6, 8]


def test_user_sequences_keep_everything_in_chunks(spark):
    rows = [(1, "s", ts(i), 100 + i, "view", 1) for i in range(130)] + [(2, "s", ts(0), 5, "view", 1)]
    df = spark.createDataFrame(rows, "user_idx long, user_session string, event_time timestamp_ntz, item_idx long, event_type string, event_idx long")
    whole = Sq.user_sequences(df).collect()
    assert [(r.user_idx, r.chunk, r.seq_len, r.item_seq) for r in whole] == [(1, 0, 130, list(range(100, 230)))]
    parts = sorted(Sq.user_sequences(df, chunk=50).collect(), key=lambda r: r.chunk)
    assert [len(r.item_seq) for r in parts] == [50, 50, 30] and sum((r.item_seq for r in parts), []) == whole[0].item_seq
    assert {r.seq_len for r in parts} == {130}


def test_replay_takes_what_the_ratio_asks(spark):
    new = spark.range(70).select(F.col("id").alias("session_idx"), F.lit("new").alias("src"))
    old = spark.range(1000).select(F.col("id").alias("session_idx"), F.lit("old").alias("src"))
    out = Sq.replay_mix(new, old, 0.3, 42, ["session_idx"])
    assert out.where("src = 'old'").count() == int(70 * 0.3 / 0.7) and out.where("src = 'new'").count() == 70
    assert Sq.replay_mix(new, old.limit(5), 0.3, 42, ["session_idx"]).where("src = 'old'").count() == 5


def test_null_group_keys_are_one_group(spark):
    rows = [(None, ts(0), 1), (None, ts(4000), 2), (None, ts(90_000), 3), (7, ts(10), 4)]
    df = spark.createDataFrame(rows, "u long, t timestamp_ntz, id long")
    for hot_rows in (100, 1):
        prev = {r.id: r._prev for r in O.previous_row(df, "u", "t", "id", "id", bucket_seconds=3600, hot_rows=hot_rows).collect()}
        assert prev[1] is None and prev[2].id == 1 and prev[3].id == 2 and prev[4] is None
        sums = {r.id: r.s for r in O.running_sum(df, "u", "t", "id", F.lit(1), "s", hot_rows=hot_rows).collect()}
        assert sums == {1: 1, 2: 2, 3: 3, 4: 1}
    sessions = {r.id: r.session_no for r in sessionize(df, "u", "t", "id", 5000).collect()}
    assert sessions == {1: 1, 2: 1, 3: 2, 4: 1}


def test_lookup_join_is_a_plain_join_spread_out(spark):
    rows = spark.range(200).select("id", F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("k"))
    small = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    for how in ("inner", "left"):
        got = sorted((r.id, r.v or "") for r in O.lookup_join(rows, small, "k", F.col("id"), salts=7, how=how).collect())
        assert got == sorted((r.id, r.v or "") for r in rows.join(small, "k", how).collect())
