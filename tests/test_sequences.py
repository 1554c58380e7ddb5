import datetime as dt

from pyspark.sql import functions as F

from clickloom.operators import sampling as S
from clickloom.operators import sequences as Sq
from tests.helpers import ts


def _mapped(spark, rows):
    """rows: (user_idx, session, seconds, item_idx, event_type)"""
    codes = {"view": 1, "cart": 2, "purchase": 3}
    data = [(u, s, ts(t), i, e, codes[e]) for u, s, t, i, e in rows]
    return spark.createDataFrame(data, "user_idx long, user_session string, event_time timestamp_ntz, "
                                       "item_idx long, event_type string, event_idx long")


def test_repeats_removed_keep_first_type(spark):
    # [A,A,A,B,B,C] with types [v,v,c,v,c,v] -> items [A,B,C], events [v,v,v]
    rows = [(1, "s", 0, 10, "view"), (1, "s", 1, 10, "view"), (1, "s", 2, 10, "cart"),
            (1, "s", 3, 11, "view"), (1, "s", 4, 11, "cart"), (1, "s", 5, 12, "view")]
    out = Sq.session_sequences(_mapped(spark, rows)).collect()
    assert [(r.item_seq, r.event_seq, r.seq_len) for r in out] == [([10, 11, 12], [1, 1, 1], 3)]


def test_collapse_to_one_dropped_and_length_two_kept(spark):
    rows = [(1, "a", 0, 10, "view"), (1, "a", 1, 10, "view"),
            (2, "b", 0, 10, "view"), (2, "b", 1, 11, "view")]
    out = Sq.session_sequences(_mapped(spark, rows)).collect()
    assert [(r.user_idx, r.item_seq, r.session_idx) for r in out] == [(2, [10, 11], 0)]


def test_length_21_keeps_last_20(spark):
    rows = [(1, "s", i, 100 + i, "view") for i in range(21)]
    out = Sq.session_sequences(_mapped(spark, rows)).first()
    assert out.seq_len == 20 and out.item_seq == list(range(101, 121))


def test_session_crossing_split_becomes_two(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(1, "s", 0, 10, "view"), (1, "s", 10, 11, "view"), (1, "s", 20, 12, "view"), (1, "s", 30, 13, "view")]
    mapped = _mapped(spark, rows)
    lab = S.split_label(mapped, base + dt.timedelta(seconds=15), base + dt.timedelta(days=9))
    out = Sq.session_sequences(lab, extra_group=["split"]).orderBy("split").collect()
    assert [(r.split, r.item_seq) for r in out] == [("train", [10, 11]), ("val", [12, 13])]


def test_padding_training_and_eval_instances(spark):
    rows = [(1, "s", 0, 5, "view"), (1, "s", 1, 6, "cart"), (1, "s", 2, 7, "purchase")]
    sess = Sq.session_sequences(_mapped(spark, rows))
    tr = Sq.training_instances(sess, max_len=5).first()
    assert tr.input_seq == [0, 0, 5, 6] and tr.target_seq == [0, 5, 6, 7]
    assert tr.target_mask == [False, True, True, True]
    ev = Sq.eval_prefix_target(sess, max_len=5).first()
    assert ev.target_item == 7 and ev.prefix_items == [0, 0, 5, 6] and ev.prefix_events == [0, 0, 1, 2]


def test_invariants_clean(spark):
    rows = [(1, "s", i, 10 + (i % 3), "view") for i in range(7)]
    inv = Sq.session_invariants(Sq.session_sequences(_mapped(spark, rows))).first()
    assert inv.bad_length == 0 and inv.consecutive_repeats == 0 and inv.last_is_pad == 0


def test_val_targets_first_event(spark):
    rows = [(1, "s", 5, 10, "purchase"), (1, "s", 2, 10, "cart"), (1, "s", 1, 11, "view")]
    df = _mapped(spark, rows).withColumn("product_id", F.col("item_idx")).withColumn("user_id", F.col("user_idx"))
    out = Sq.val_targets(df).collect()
    assert [(r.item_idx, r.event_type) for r in out] == [(10, "cart")]
