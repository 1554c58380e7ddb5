"""Session and user sequences, padding, training/eval instances, replay.

Sequences are built with bounded collections only: consecutive repeats are
removed with a skew-safe lag, the most recent ``max_len`` events are selected
with a per-group limit that Spark applies partially before the shuffle, and
only then are at most ``max_len`` structs collected per group and sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import EVENT_CODES, event_code
from clickloom.operators.ordering import first_n, number_rows, previous_row, running_sum, top_k_per_group
from clickloom.session import cut_lineage

PAD = 0
MAX_SESSION_LEN = 20
MIN_SESSION_LEN = 2
#: events of one array of a user's sequence; longer histories go on in further chunks
USER_CHUNK = 10_000


def map_to_vocab(events: DataFrame, user_vocab: DataFrame, item_vocab: DataFrame,
                 codes: dict[str, int] = EVENT_CODES) -> DataFrame:
    """user/item ids -> dense indices (inner joins drop out-of-vocabulary
    rows), event type -> code (unmapped types dropped)."""
    return (events.join(user_vocab, "user_id").join(item_vocab, "product_id")
            .withColumn("event_idx", event_code(F.col("event_type"), codes))
            .filter(F.col("event_idx").isNotNull()))


def _order(desc: bool = False) -> list[Column]:
    cols = ["event_time", "item_idx", "event_idx"]
    return [F.desc(c) if desc else F.asc(c) for c in cols]


def drop_consecutive_repeats(mapped: DataFrame, group: Sequence[str], latest_first: bool = False) -> DataFrame:
    """Removes an event whose item equals the previous event's item in the same
    group (event type ignored; the first occurrence is kept)."""
    prev = previous_row(mapped, list(group), "event_time", ["item_idx", "event_idx"], ["item_idx"], out="_p", latest_first=latest_first)
    return prev.filter(F.col("_p").isNull() | (F.col("_p.item_idx") != F.col("item_idx"))).drop("_p")


def _collect_sorted(df: DataFrame, group: Sequence[str]) -> DataFrame:
    # sort_array and field access are compiled; array_sort and transform call a lambda for every element
    s = F.sort_array(F.collect_list(F.struct("event_time", "item_idx", "event_idx")))
    return df.groupBy(*group).agg(s.alias("_s")).select(
        *group, F.col("_s.item_idx").alias("item_seq"), F.col("_s.event_idx").alias("event_seq"))


def session_sequences(mapped: DataFrame, max_len: int = MAX_SESSION_LEN, min_len: int = MIN_SESSION_LEN,
                      session_col: str = "user_session", extra_group: Sequence[str] = ()) -> DataFrame:
    """M7 + W6: per (user, session) the item and event sequences in time order,
    consecutive repeats removed, the last ``max_len`` kept, sessions shorter
    than ``min_len`` dropped, numbered 0.. by (extra_group, user, session)."""
    group = list(extra_group) + ["user_idx", session_col]
    # narrow and stored: counted for hot sessions, then ordered
    mapped = cut_lineage(mapped.select(*group, "event_time", "item_idx", "event_idx"))
    dedup = drop_consecutive_repeats(mapped, group, latest_first=True)
    last = top_k_per_group(dedup, group, _order(desc=True), max_len, rank_col=None)
    seqs = _collect_sorted(last, group).withColumn("seq_len", F.size("item_seq").cast("long"))
    seqs = cut_lineage(seqs.filter(F.col("seq_len") >= min_len))  # read twice: for the ranges and for the rows
    seqs = number_rows(seqs, group, "session_idx", start=0).dropna(subset=group)  # a session without a key only takes a number
    return seqs.select(*extra_group, "session_idx", "user_idx", "item_seq", "event_seq", "seq_len")


def user_sequences(mapped: DataFrame, min_len: int = 2, chunk: int = USER_CHUNK) -> DataFrame:
    """M8: per user the whole chronological sequence (no repeat removal), in
    arrays of at most ``chunk`` events numbered by ``chunk`` 0, 1, ...: a user
    of ordinary length has one row, a user with very many events several, and
    no array grows with a history. ``seq_len`` is the user's number of events;
    users with fewer than ``min_len`` are dropped. Consumers truncate at load."""
    placed = user_sequence_events(mapped).withColumn("chunk", F.floor((F.col("pos") - 1) / chunk).cast("long"))
    counts = mapped.groupBy("user_idx").agg(F.count(F.lit(1)).alias("seq_len")).filter(F.col("seq_len") >= min_len)
    return (_collect_sorted(placed, ["user_idx", "chunk"]).join(counts, "user_idx")
            .select("user_idx", "chunk", "item_seq", "event_seq", "seq_len"))


def user_sequence_events(mapped: DataFrame) -> DataFrame:
    """M8 (flat form): every event of every user with its 1-based position in
    the user's chronology; the unbounded sequence as rows, not one array."""
    return running_sum(mapped, "user_idx", "event_time", ["item_idx", "event_idx"], F.lit(1), "pos")


def val_targets(mapped_window: DataFrame, types: Sequence[str] = ("cart", "purchase")) -> DataFrame:
    """M9: cart/purchase events of the window, one row per (user, item): the
    first by time (then event code)."""
    t = mapped_window.filter(F.col("event_type").isin(list(types)))
    first = top_k_per_group(t, ["user_idx", "item_idx"], _order(), 1, rank_col=None)
    return first.select("user_idx", "item_idx", "event_type", "product_id", "event_time", "user_id")


def keep_last(arr: Column, n: int) -> Column:
    """The last ``n`` elements."""
    return F.when(F.size(arr) > n, F.slice(arr, F.size(arr) - n + 1, F.lit(n))).otherwise(arr)


def pad_left(arr: Column, n: int, pad: int = PAD) -> Column:
    """Keep the last ``n`` elements, left-pad with ``pad`` to length ``n``."""
    kept = keep_last(arr, n)
    fill = F.array_repeat(F.lit(pad).cast("long"), F.lit(n) - F.size(kept))
    return F.concat(fill, kept.cast("array<long>"))


def training_instances(sessions: DataFrame, max_len: int = MAX_SESSION_LEN) -> DataFrame:
    """Padded rows of length ``max_len``; input = all but the last
    position, target = all but the first, mask = target is not padding."""
    items = pad_left(F.col("item_seq"), max_len)
    events = pad_left(F.col("event_seq"), max_len)
    return sessions.select(
        "session_idx", "user_idx",
        F.slice(items, 1, max_len - 1).alias("input_seq"),
        F.slice(events, 1, max_len - 1).alias("input_event_seq"),
        F.slice(items, 2, max_len - 1).alias("target_seq")).withColumn(
        "target_mask", F.transform("target_seq", lambda x: x != PAD))


def eval_prefix_target(sessions: DataFrame, max_len: int = MAX_SESSION_LEN) -> DataFrame:
    """target = last item; prefix = the items before it, last
    ``max_len - 1`` kept, left-padded to ``max_len - 1`` (same for events)."""
    n = F.size("item_seq")
    prefix_items = F.slice("item_seq", 1, n - 1)
    prefix_events = F.slice("event_seq", 1, n - 1)
    return sessions.select("session_idx", "user_idx",
                           F.element_at("item_seq", -1).alias("target_item"),
                           pad_left(prefix_items, max_len - 1).alias("prefix_items"),
                           pad_left(prefix_events, max_len - 1).alias("prefix_events"))


def replay_mix(new: DataFrame, history: DataFrame, ratio: float, seed: int,
               key_cols: Sequence[str]) -> DataFrame:
    """Appends ``min(int(n_new * r / (1 - r)), n_history)`` history rows
    chosen by a seeded hash order of ``key_cols``, which identify a row."""
    new, history = cut_lineage(new), cut_lineage(history)
    n = int(new.count() * ratio / (1 - ratio))
    if n <= 0:
        return new
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols]))
    return new.unionByName(history.join(first_n(history, list(key_cols), key, n), list(key_cols), "left_semi").select(*new.columns))


def user_history(pairs: DataFrame, max_len: int = 20, order_col: str = "last_interaction") -> DataFrame:
    """Per user the last ``max_len`` interacted items ordered by
    ``order_col`` (then item), left-padded."""
    last = top_k_per_group(pairs, ["user_idx"], [F.desc(order_col), F.desc("item_idx")], max_len, rank_col=None)
    s = F.array_sort(F.collect_list(F.struct(order_col, "item_idx")))
    return (last.groupBy("user_idx").agg(s.alias("_s"))
            .select("user_idx", pad_left(F.transform("_s", lambda x: x["item_idx"]), max_len).alias("history"),
                    F.size("_s").alias("n_history")))


def session_invariants(sessions: DataFrame, min_len: int = MIN_SESSION_LEN,
                       max_len: int = MAX_SESSION_LEN) -> DataFrame:
    """Q1: violation counts per rule (all zero when the table is valid)."""
    items = F.col("item_seq")
    repeats = F.exists(F.sequence(F.lit(2), F.greatest(F.size(items), F.lit(2))),
                       lambda i: (i <= F.size(items)) & (F.element_at(items, i) == F.element_at(items, i - 1)))
    return sessions.agg(
        F.count(F.lit(1)).alias("n_sessions"),
        F.count_if((F.col("seq_len") < min_len) | (F.col("seq_len") > max_len)).alias("bad_length"),
        F.count_if(F.element_at(items, -1) == PAD).alias("last_is_pad"),
        F.count_if(repeats).alias("consecutive_repeats"),
        F.count_if(F.col("seq_len") != F.size(items)).alias("len_mismatch"),
        F.count_if(F.size(items) != F.size("event_seq")).alias("event_len_mismatch"))


def length_stats(seqs: DataFrame, per_user: bool = True) -> DataFrame:
    """A29 (scalars): min, max, mean length, sessions and users."""
    return seqs.agg(F.min("seq_len").alias("min_len"), F.max("seq_len").alias("max_len"),
                    F.avg("seq_len").alias("mean_len"), F.count(F.lit(1)).alias("n_sequences"),
                    F.count_distinct("user_idx").alias("n_users"))
