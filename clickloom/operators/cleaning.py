"""Event-log cleaning: null fill, exact and near dedup, price floor, bots, k-core."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.ordering import previous_within
from clickloom.session import cut_lineage, scratch_path

# Fixed values of the cleaning job.
PRICE_FLOOR = 1.0
BOT_EVENTS_PER_DAY = 300
KCORE_K = 3
KCORE_MAX_ROUNDS = 10
NEAR_DUP_SECONDS = 1
# Pairs of one bucket of the k-core's pair tables, and their most buckets.
PAIRS_A_BUCKET = 1 << 20
MAX_BUCKETS = 1024
EXACT_DUP_KEYS = ("event_time", "event_type", "product_id", "user_id", "user_session")
NEAR_DUP_GROUP = ("user_id", "product_id", "event_type")


def fill_unknown(df: DataFrame, cols: Sequence[str] = ("category_code", "brand"),
                 value: str = "unknown") -> DataFrame:
    """null strings in ``cols`` become ``value``."""
    return df.fillna(value, subset=list(cols))


def drop_null_session(df: DataFrame, col: str = "user_session") -> DataFrame:
    """F2."""
    return df.filter(F.col(col).isNotNull())


def exact_dedup(df: DataFrame, keys: Sequence[str] = EXACT_DUP_KEYS) -> DataFrame:
    """one row per key set.

    Among duplicates the row with the smallest remaining columns is kept, so the
    result is deterministic (``dropDuplicates`` keeps an arbitrary one). The
    ``max``/``min`` of a struct is partially aggregated map-side, so a key
    repeated a billion times never reaches one task whole.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    agg = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in rest])).alias("_r"))
    return agg.select(*[F.col(c) for c in df.columns if c in keys] +
                      [F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def near_dedup(df: DataFrame, group: Sequence[str] = NEAR_DUP_GROUP,
               ts_col: str = "event_time", tiebreak: Sequence[str] = ("user_session", "price"),
               max_gap_seconds: int = NEAR_DUP_SECONDS, bucket_seconds: int = 3600) -> DataFrame:
    """keeps an event when it is the first of its (user, item, type) group
    or comes more than ``max_gap_seconds`` (whole seconds) after the previous
    event of the group. The comparison is with the previous *input* row, so a
    chain 1 s apart collapses to its first row.

    One window pass over (user, item, type, hour bucket) with the last
    second of each bucket copied into the next (``ordering.previous_within``):
    a hot (user, item, type) group is spread over its hours, no self-join.
    """
    secs = F.unix_timestamp(F.col(ts_col))
    base = df.withColumn("_secs", secs)
    prev = previous_within(base, list(group), ts_col, list(tiebreak), ["_secs"], max_gap_seconds, out="_p",
                           bucket_seconds=bucket_seconds)
    keep = F.col("_p").isNull() | ((F.col("_secs") - F.col("_p._secs")) > max_gap_seconds)
    return prev.filter(keep).select(*df.columns)


def price_floor(df: DataFrame, floor: float = PRICE_FLOOR, col: str = "price") -> DataFrame:
    """F5."""
    return df.filter(F.col(col) >= floor)


def bot_users(df: DataFrame, threshold: float = BOT_EVENTS_PER_DAY,
              user_col: str = "user_id", ts_col: str = "event_time") -> DataFrame:
    """Users whose mean events per active day exceeds ``threshold``.

    Two partial aggregations; the (user, day) step is map-side combined."""
    daily = (df.groupBy(user_col, F.to_date(ts_col).alias("_day"))
             .agg(F.count(F.lit(1)).alias("_n")))
    return (daily.groupBy(user_col).agg(F.avg("_n").alias("avg_events_per_day"))
            .filter(F.col("avg_events_per_day") > threshold))


def drop_bots(df: DataFrame, threshold: float = BOT_EVENTS_PER_DAY,
              user_col: str = "user_id", ts_col: str = "event_time") -> DataFrame:
    """anti join with :func:`bot_users`."""
    bots = bot_users(df, threshold, user_col, ts_col).select(user_col)
    return df.join(bots, user_col, "left_anti")


def clean_events(df: DataFrame, price_min: float = PRICE_FLOOR,
                 bot_threshold: float = BOT_EVENTS_PER_DAY) -> DataFrame:
    """F1-F6 in the order of the cleaning job. What the bots are sought in and
    taken out of is stored before: read twice, deduplicated once."""
    out = drop_null_session(fill_unknown(df))
    out = exact_dedup(out)
    out = near_dedup(out)
    out = cut_lineage(price_floor(out, price_min))
    return drop_bots(out, bot_threshold)


def kcore_round(pairs: DataFrame, k: int, user_col: str, item_col: str, weight_col: str) -> DataFrame:
    """One k-core round: users and items with at least ``k`` events, both judged
    on the same snapshot, then both filters applied."""
    users = (pairs.groupBy(user_col).agg(F.sum(weight_col).alias("_n"))
             .filter(F.col("_n") >= k).select(user_col))
    items = (pairs.groupBy(item_col).agg(F.sum(weight_col).alias("_n"))
             .filter(F.col("_n") >= k).select(item_col))
    return pairs.join(users, user_col, "left_semi").join(items, item_col, "left_semi")


def _apart(df: DataFrame) -> DataFrame:
    """``df`` for the right side of a join that stays a shuffle join: tables of as
    many keys as there are users or items don't go through the driver."""
    return df.hint("merge")


class _Adjacency:
    """The pair table dealt into buckets by one of its keys, so that the pairs of
    a few keys are read from their buckets' files alone."""

    def __init__(self, pairs: DataFrame, key: str, other: str, buckets: int):
        self.key, self.buckets = key, buckets
        self.pairs, self.rows = pairs, None
        if buckets > 1:
            path = scratch_path(pairs.sparkSession, f"pairs-by-{key}-{uuid.uuid4().hex}")
            # a hot key's bucket is written by several tasks
            part = F.pmod(F.xxhash64(other), F.lit(4))
            dealt = pairs.withColumn("_b", self.bucket()).repartition(buckets, "_b", part).sortWithinPartitions("_b", key)
            dealt.write.partitionBy("_b").parquet(path)
            self.pairs = pairs.sparkSession.read.parquet(path)

    def bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def of(self, keys: DataFrame) -> tuple[DataFrame, list[int] | None]:
        """The pairs of ``keys`` and the buckets that are read for them (None: all there is)."""
        if self.buckets == 1:
            return self.pairs.join(keys.select(self.key), self.key, "left_semi"), None
        read = [r[0] for r in keys.select(self.bucket()).distinct().collect()]  # at most ``buckets`` numbers
        own = self.pairs.where(F.col("_b").isin(read)).drop("_b") if read else self.pairs.drop("_b").limit(0)
        return own.join(keys.select(self.key), self.key, "left_semi"), read

    def rows_of(self, read: list[int] | None) -> int:
        if self.rows is None:
            by = self.pairs.groupBy("_b") if self.buckets > 1 else self.pairs.groupBy(F.lit(0).alias("_b"))
            self.rows = {r["_b"]: r["count"] for r in by.count().collect()}
        return sum(self.rows.get(b, 0) for b in (self.rows if read is None else read))


class _Side:
    """Users or items: their counts at the start, and of those that lost rows
    the count now, the round it changed in and whether they are gone."""

    def __init__(self, pairs: DataFrame, key: str, k: int):
        self.key, self.k = key, k
        self.start = cut_lineage(pairs.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("_w").alias("_n")))
        self.alive = self.start.count()
        self.changed = self.start.select(key, "_n", F.lit(0).alias("_r"), F.lit(False).alias("_gone")).limit(0)
        self.falling = self.start.where(F.col("_n") < k)
        self.n_falling = self.falling.count()

    def gone(self) -> DataFrame:
        """All that are gone, this round's included."""
        return self.changed.where("_gone").select(self.key).unionByName(self.falling.select(self.key))

    def decrement(self, removed: DataFrame, i: int) -> None:
        """Takes the removed pairs' rows off; who falls below ``k`` goes in the next round."""
        key, k = self.key, self.k
        lost = removed.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("_w").alias("_lost")).join(_apart(self.gone()), key, "left_anti")
        count = F.coalesce("_n", "_n0") - F.col("_lost")
        fell = (lost.join(_apart(self.changed.select(key, "_n")), key, "left").join(_apart(self.start.withColumnRenamed("_n", "_n0")), key)
                .select(key, count.alias("_n"), F.lit(i).alias("_r"), F.lit(False).alias("_gone")))
        now = fell.unionByName(self.falling.select(key, "_n", F.lit(i).alias("_r"), F.lit(True).alias("_gone")))
        rest = self.changed.join(_apart(lost), key, "left_anti").join(_apart(self.falling), key, "left_anti")
        self.alive -= self.n_falling
        self.changed = cut_lineage(now.unionByName(rest))
        latest = self.changed.where((F.col("_r") == i) & ~F.col("_gone"))
        self.falling = latest.where((F.col("_n") > 0) & (F.col("_n") < k))
        counted = latest.agg(F.count_if(F.col("_n") == 0).alias("empty"), F.count_if((F.col("_n") > 0) & (F.col("_n") < k)).alias("falling")).first()
        self.alive -= counted["empty"]  # all their partners are gone
        self.n_falling = counted["falling"]


def kcore(df: DataFrame, k: int = KCORE_K, max_rounds: int = KCORE_MAX_ROUNDS,
          user_col: str = "user_id", item_col: str = "product_id",
          history: list | None = None, work: list | None = None, pairs_a_bucket: int = PAIRS_A_BUCKET) -> DataFrame:
    """iterative k-core on events, until the row count is stable or
    ``max_rounds`` rounds ran. A round judges users and items on the same
    snapshot and then removes the rows of both.

    Counts are taken once, from the (user, item, n_events) pair table. After
    that a round is a worklist: users and items that fell below ``k`` go, the
    pairs they still had are read from the buckets that hold them and taken off
    their partners' counts, and only partners that lost rows are judged again.
    Later rounds so cost what is removed, not what is left. Each round's counts
    are written into the shared checkpoint folder, which bounds the lineage and
    survives executor loss. Rows without a user or item go in the first round.
    ``history`` (optional list) receives ``(round, rows, users, items)``,
    ``work`` (round, pairs read)."""
    df = cut_lineage(df)  # the pre-k-core table: read twice (pairs, final filter), computed once
    pairs = cut_lineage(df.groupBy(user_col, item_col).agg(F.count(F.lit(1)).alias("_w")))
    null = F.col(user_col).isNull() | F.col(item_col).isNull()
    size = pairs.agg(F.coalesce(F.sum("_w"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("pairs"), F.count_if(null).alias("nulls")).first()
    rows = int(size["rows"])
    users, items = _Side(pairs, user_col, k), _Side(pairs, item_col, k)
    by_user = by_item = None
    for i in range(1, max_rounds + 1):
        before = rows
        if users.n_falling or items.n_falling or (i == 1 and size["nulls"]):
            if by_user is None:
                buckets = max(1, min(MAX_BUCKETS, size["pairs"] // pairs_a_bucket))
                by_user, by_item = _Adjacency(pairs, user_col, item_col, buckets), _Adjacency(pairs, item_col, user_col, buckets)
            of_users, read_u = by_user.of(users.falling)
            of_items, read_i = by_item.of(items.falling)
            if i > 1:
                of_users, of_items = of_users.where(F.col(item_col).isNotNull()), of_items.where(F.col(user_col).isNotNull())
            # pairs that an earlier round removed have a partner that is gone; a pair with both ends falling counts once
            removed = (of_users.join(_apart(items.changed.where("_gone")), item_col, "left_anti")
                       .unionByName(of_items.join(_apart(users.gone()), user_col, "left_anti")))
            if i == 1 and size["nulls"]:
                # those of a falling user or item are there already
                rest = pairs.where(null).join(_apart(users.falling), user_col, "left_anti").join(_apart(items.falling), item_col, "left_anti")
                removed = removed.unionByName(rest)
            removed = cut_lineage(removed.select(user_col, item_col, "_w"))
            rows -= int(removed.agg(F.coalesce(F.sum("_w"), F.lit(0))).first()[0])
            users.decrement(removed, i)
            items.decrement(removed, i)
            if work is not None:
                work.append((i, by_user.rows_of(read_u) + by_item.rows_of(read_i)))
        if history is not None:
            history.append((i, rows, users.alive, items.alive))
        if rows == before:
            break
    if rows == size["rows"]:
        return df
    out = df.where(F.col(user_col).isNotNull() & F.col(item_col).isNotNull())
    # what fell in a last round that max_rounds cut off still stays
    return (out.join(users.changed.where("_gone").select(user_col), user_col, "left_anti")
            .join(items.changed.where("_gone").select(item_col), item_col, "left_anti"))


def kcore_fixed_rounds_report(df: DataFrame, k: int = 5, rounds: int = 3,
                              user_col: str = "user_id", item_col: str = "product_id") -> DataFrame:
    """F8: rows/users/items of the raw table and after each of ``rounds`` fixed
    k-core rounds, as one labelled table (``stage`` raw, r1, r2, ...)."""
    pairs = df.groupBy(user_col, item_col).agg(F.count(F.lit(1)).alias("_w"))
    frames = []
    current = pairs
    for i in range(rounds + 1):
        if i > 0:
            current = cut_lineage(kcore_round(current, k, user_col, item_col, "_w"))
        label = "raw" if i == 0 else f"r{i}"
        frames.append(current.agg(
            F.coalesce(F.sum("_w"), F.lit(0)).cast("long").alias("n_rows"),
            F.count_distinct(user_col).alias("n_users"),
            F.count_distinct(item_col).alias("n_items"))
            .select(F.lit(i).alias("step"), F.lit(label).alias("stage"), "*"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
