"""Sequence queries."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from clickloom.functions.columns import rnd
from clickloom.operators import sequences as Sq
from clickloom.operators.profiling import percentiles
from clickloom.queries import register
from clickloom.queries.common import features
from clickloom.queries.sql_base import FEATURES, with_

ORD = "event_time, item_idx, event_idx"
ORD_DESC = "event_time DESC, item_idx DESC, event_idx DESC"


def mapped_sql(src: str, p: str) -> str:
    return (f"{p}_m AS (SELECT s.*, v.user_idx, i.item_idx, CAST(CASE s.event_type WHEN 'view' THEN 1 "
            f"WHEN 'cart' THEN 2 WHEN 'purchase' THEN 3 END AS BIGINT) AS event_idx "
            f"FROM {src} s JOIN user_vocab v USING (user_id) JOIN item_vocab i USING (product_id))")


def sessions_sql(src: str, p: str, group: str = "", max_len: int = 20) -> str:
    g = f"{group}, " if group else ""
    return mapped_sql(src, p) + f""",
{p}_l AS (SELECT *, lag(item_idx) OVER (PARTITION BY {g}user_idx, user_session ORDER BY {ORD}) AS prev_item
          FROM {p}_m WHERE event_idx IS NOT NULL),
{p}_d AS (SELECT *, row_number() OVER (PARTITION BY {g}user_idx, user_session ORDER BY {ORD_DESC}) AS rk
          FROM {p}_l WHERE prev_item IS NULL OR prev_item <> item_idx),
{p}_g AS (SELECT {g}user_idx, user_session, list(item_idx ORDER BY {ORD}) AS item_seq,
                 list(event_idx ORDER BY {ORD}) AS event_seq, count(*) AS seq_len
          FROM {p}_d WHERE rk <= {max_len} GROUP BY {g}user_idx, user_session HAVING count(*) >= 2),
{p} AS (SELECT {g}row_number() OVER (ORDER BY {g}user_idx, user_session) - 1 AS session_idx,
               user_idx, item_seq, event_seq, seq_len FROM {p}_g)"""


SEQ = FEATURES + ",\n" + sessions_sql("train", "s_train") + ",\n" + sessions_sql("val", "s_val") + \
    ",\n" + sessions_sql("test", "s_test") + ",\n" + sessions_sql("labelled", "s_all", group="split")


class _Seq:
    def __init__(self, spark, sf):
        self.f = features(spark, sf)
        self.spark, self.sf = spark, sf

    def mapped(self, df):
        return Sq.map_to_vocab(df, self.f.user_vocab, self.f.item_vocab)

    def sessions(self, name):
        return Sq.session_sequences(self.mapped(self.f.split(name)))

    @cached_property
    def all_splits(self):
        return Sq.session_sequences(self.mapped(self.f.labelled), extra_group=["split"])


@register("session_sequences_train", with_(SEQ) + "\nSELECT * FROM s_train")
def q_sess_train(spark, sf):
    return _Seq(spark, sf).sessions("train")


@register("session_sequences_test", with_(SEQ) + "\nSELECT * FROM s_test")
def q_sess_test(spark, sf):
    return _Seq(spark, sf).sessions("test")


# Sessions crossing a split boundary become one session per split.
@register("session_sequences_by_split", with_(SEQ) + "\nSELECT * FROM s_all")
def q_sess_all(spark, sf):
    return _Seq(spark, sf).all_splits


@register("user_sequences_train", with_(SEQ) + f"""
SELECT user_idx, CAST(0 AS BIGINT) AS chunk, list(item_idx ORDER BY {ORD}) AS item_seq, list(event_idx ORDER BY {ORD}) AS event_seq,
       count(*) AS seq_len
FROM s_train_m WHERE event_idx IS NOT NULL GROUP BY user_idx HAVING count(*) >= 2""")
def q_user_seq(spark, sf):
    s = _Seq(spark, sf)
    return Sq.user_sequences(s.mapped(s.f.train))


# The same in short chunks, as a very long history would come.
@register("user_sequences_chunked", with_(SEQ) + f""",
um AS (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY {ORD}) - 1 AS p, count(*) OVER (PARTITION BY user_idx) AS seq_len
       FROM s_train_m WHERE event_idx IS NOT NULL)
SELECT user_idx, p // 7 AS chunk, list(item_idx ORDER BY {ORD}) AS item_seq, list(event_idx ORDER BY {ORD}) AS event_seq,
       any_value(seq_len) AS seq_len
FROM um WHERE seq_len >= 2 GROUP BY 1, 2""")
def q_user_seq_chunked(spark, sf):
    s = _Seq(spark, sf)
    return Sq.user_sequences(s.mapped(s.f.train), chunk=7)


@register("user_sequence_positions", with_(SEQ) + f"""
SELECT user_idx, item_idx, event_idx, event_time,
       row_number() OVER (PARTITION BY user_idx ORDER BY {ORD}) AS pos
FROM s_train_m WHERE event_idx IS NOT NULL""")
def q_user_pos(spark, sf):
    s = _Seq(spark, sf)
    return (Sq.user_sequence_events(s.mapped(s.f.train))
            .select("user_idx", "item_idx", "event_idx", "event_time", "pos"))


@register("val_targets", with_(SEQ) + f"""
SELECT user_idx, item_idx, event_type, product_id, event_time, user_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_idx, item_idx ORDER BY {ORD}) AS rk
  FROM s_val_m WHERE event_type IN ('cart', 'purchase') AND event_idx IS NOT NULL)
WHERE rk = 1""")
def q_val_targets(spark, sf):
    s = _Seq(spark, sf)
    return Sq.val_targets(s.mapped(s.f.split("val")))


PAD20 = "list_concat(list_resize([]::BIGINT[], {n} - len({a}), 0), {a})"


def _pad(a: str, n: int) -> str:
    kept = f"(CASE WHEN len({a}) > {n} THEN ({a})[-{n}:] ELSE {a} END)"
    return PAD20.format(n=n, a=kept)


@register("training_instances_train", with_(SEQ) + f""",
p AS (SELECT session_idx, user_idx, {_pad('item_seq', 20)} AS items, {_pad('event_seq', 20)} AS events
      FROM s_train)
SELECT session_idx, user_idx, items[1:19] AS input_seq, events[1:19] AS input_event_seq,
       items[2:20] AS target_seq, list_transform(items[2:20], lambda x: x <> 0) AS target_mask FROM p""")
def q_train_inst(spark, sf):
    return Sq.training_instances(_Seq(spark, sf).sessions("train"))


@register("eval_prefix_target_test", with_(SEQ) + f"""
SELECT session_idx, user_idx, item_seq[-1] AS target_item,
       {_pad('item_seq[1:len(item_seq) - 1]', 19)} AS prefix_items,
       {_pad('event_seq[1:len(event_seq) - 1]', 19)} AS prefix_events
FROM s_test""")
def q_eval_prefix(spark, sf):
    return Sq.eval_prefix_target(_Seq(spark, sf).sessions("test"))


@register("replay_mix_val_train", with_(SEQ) + """,
n AS (SELECT CAST(floor((SELECT count(*) FROM s_val) * CAST(0.3 AS DOUBLE) / (1 - CAST(0.3 AS DOUBLE))) AS BIGINT) AS n),
h AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws(':', '42', CAST(user_idx AS VARCHAR),
                                                      CAST(session_idx AS VARCHAR))), user_idx, session_idx) AS rk
      FROM s_train)
SELECT session_idx, user_idx, item_seq, event_seq, seq_len FROM s_val
UNION ALL
SELECT session_idx, user_idx, item_seq, event_seq, seq_len FROM h WHERE rk <= (SELECT n FROM n)""")
def q_replay(spark, sf):
    s = _Seq(spark, sf)
    return Sq.replay_mix(s.sessions("val"), s.sessions("train"), 0.3, 42, ["user_idx", "session_idx"])


@register("user_history_last20", with_(SEQ) + f""",
hp AS (SELECT v.user_idx, i.item_idx, t.last_interaction FROM inter_train t JOIN user_vocab v USING (user_id)
       JOIN item_vocab i USING (product_id)),
lastn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY last_interaction DESC,
                                                      item_idx DESC) AS rk FROM hp) WHERE rk <= 20),
g AS (SELECT user_idx, list(item_idx ORDER BY last_interaction, item_idx) AS h, count(*) AS n_history
      FROM lastn GROUP BY user_idx)
SELECT user_idx, {PAD20.format(n=20, a='h')} AS history, CAST(n_history AS INTEGER) AS n_history FROM g""")
def q_history(spark, sf):
    f = features(spark, sf)
    pairs = (f.inter.join(f.user_vocab, "user_id").join(f.item_vocab, "product_id")
             .select("user_idx", "item_idx", "last_interaction"))
    return Sq.user_history(pairs, 20)


@register("session_invariants", with_(SEQ) + """
SELECT count(*) AS n_sessions, count_if(seq_len < 2 OR seq_len > 20) AS bad_length,
       count_if(item_seq[-1] = 0) AS last_is_pad,
       count_if(len(list_filter(range(2, len(item_seq) + 1), lambda i: item_seq[i] = item_seq[i - 1])) > 0)
         AS consecutive_repeats,
       count_if(seq_len <> len(item_seq)) AS len_mismatch,
       count_if(len(item_seq) <> len(event_seq)) AS event_len_mismatch
FROM s_all""")
def q_invariants(spark, sf):
    return Sq.session_invariants(_Seq(spark, sf).all_splits)


@register("session_length_stats", with_(SEQ) + """
SELECT min(seq_len) AS min_len, max(seq_len) AS max_len, round(avg(seq_len), 6) AS mean_len,
       count(*) AS n_sequences, count(DISTINCT user_idx) AS n_users,
       round(count(*) * 1.0 / count(DISTINCT user_idx), 6) AS sessions_per_user
FROM s_train""")
def q_len_stats(spark, sf):
    st = Sq.length_stats(_Seq(spark, sf).sessions("train"))
    return st.select("min_len", "max_len", rnd("mean_len", 6).alias("mean_len"), "n_sequences", "n_users",
                     rnd(F.col("n_sequences") / F.col("n_users"), 6).alias("sessions_per_user"))


@register("session_length_quantiles", with_(SEQ) + """
SELECT 'seq_len' AS metric, round(unnest([0.5, 0.9, 0.99]::DOUBLE[]), 6) AS prob,
       round(unnest(quantile_cont(seq_len, [0.5, 0.9, 0.99]::DOUBLE[])), 6) AS value FROM s_train""")
def q_len_q(spark, sf):
    return percentiles(_Seq(spark, sf).sessions("train"), "seq_len", [0.5, 0.9, 0.99], "seq_len")
