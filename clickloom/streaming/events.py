"""Structured Streaming forms of the same operators (optional extensions).

The reference is batch-only; these are the streaming counterparts a Spark user
would run on a live event feed with the same semantics where streaming allows:

* near-duplicate removal by the batch rule itself (``near_dedup``): events are held
  until the watermark passes them and then compared with the one before;
* a cheaper form within a watermark (``dropDuplicatesWithinWatermark``) keyed by
  (user, item, type, whole second), which compares with any row of the same second;
* event-time windowed item popularity (the input of the drift monitor);
* inactivity-gap sessions with ``session_window``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickloom.operators.cleaning import NEAR_DUP_GROUP, NEAR_DUP_SECONDS


def stream_events(spark, path: str, schema, max_files_per_trigger: int = 1) -> DataFrame:
    """Parquet directory as a stream (new files are new micro-batches)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


def _instant(events: DataFrame, ts_col: str) -> DataFrame:
    """Watermarks need TIMESTAMP; zone-less event times are read in the session zone."""
    return events.withColumn(ts_col, F.col(ts_col).cast("timestamp"))


def dedup_within_watermark(events: DataFrame, delay: str = "10 minutes", ts_col: str = "event_time") -> DataFrame:
    """Streaming near-dedup: one event per (user, item, type, second) within the watermark."""
    return (_instant(events, ts_col).withWatermark(ts_col, delay)
            .withColumn("_sec", F.date_trunc("second", F.col(ts_col)))
            .dropDuplicatesWithinWatermark(["user_id", "product_id", "event_type", "_sec"])
            .drop("_sec"))


class _PreviousEvent(StatefulProcessor):
    """One (user, item, type): the events that the watermark has not passed, and
    the time of the last one that it has."""

    def __init__(self, schema: T.StructType, ts_col: str, tiebreak: Sequence[str], max_gap_seconds: int):
        self.schema, self.ts_col, self.tiebreak, self.gap = schema, ts_col, list(tiebreak), max_gap_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.schema)
        self.last = handle.getValueState("last", "secs long")

    def _ms(self, row) -> int:
        return -int(-row[self.ts_col].timestamp() * 1000 // 1)

    def _order(self, row) -> tuple:
        # nulls first, as in the batch rule's window
        return (row[self.ts_col], *((row[c] is not None, row[c]) for c in self.tiebreak))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        rows = list(rows)
        self.waiting.appendList([tuple(r) for r in rows])
        for ms in {self._ms(r) for r in rows}:
            self.handle.registerTimer(ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        mark = timerValues.getCurrentWatermarkInMs()
        rows = [Row(**dict(zip(self.schema.names, r, strict=True))) for r in self.waiting.get()]
        # an event at or before the watermark can have no other before it that is still to come
        done = sorted((r for r in rows if self._ms(r) <= mark), key=self._order)
        if not done:
            # the time when the next event would be kept whatever came before
            if not rows and self.last.exists() and (self.last.get()[0] + self.gap + 1) * 1000 <= mark:
                self.last.clear()
            return
        rest = [tuple(r) for r in rows if self._ms(r) > mark]
        self.waiting.clear()
        if rest:
            self.waiting.put(rest)
        last = self.last.get()[0] if self.last.exists() else None
        for row in done:
            secs = int(row[self.ts_col].timestamp() // 1)
            if last is None or secs - last > self.gap:
                yield row
            last = secs
        self.last.update((last,))
        self.handle.registerTimer(max(mark + 1, (last + self.gap + 1) * 1000))

    def close(self) -> None:
        pass


def near_dedup(events: DataFrame, group: Sequence[str] = NEAR_DUP_GROUP, ts_col: str = "event_time",
               tiebreak: Sequence[str] = ("user_session", "price"), max_gap_seconds: int = NEAR_DUP_SECONDS,
               delay: str = "10 minutes") -> DataFrame:
    """F4 on a stream: keeps an event when it is the first of its (user, item, type)
    or more than ``max_gap_seconds`` whole seconds after the event before it,
    kept or not, in the order of time and ``tiebreak`` - the rows that the batch
    rule keeps, whatever order and micro-batches events come in, as long as they
    come within ``delay``; later ones are dropped.

    An event is held until the watermark has passed it and comes out then. A
    group's state is its events of the last ``delay`` and one time, which a
    timer clears once it cannot matter any more. Needs the RocksDB state store
    (``use_rocksdb``). Groups with a null key are groups like others."""
    instant = _instant(events, ts_col)
    processor = _PreviousEvent(instant.schema, ts_col, tiebreak, max_gap_seconds)
    return (instant.withWatermark(ts_col, delay).groupBy(*group)
            .transformWithState(processor, outputStructType=instant.schema, outputMode="Append", timeMode="EventTime"))


def use_rocksdb(spark) -> None:
    """The state store that ``near_dedup`` needs, for queries started from now on."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def windowed_popularity(events: DataFrame, window: str = "1 day", delay: str = "1 hour",
                        ts_col: str = "event_time") -> DataFrame:
    """Event counts per (window, item) with a watermark (append mode emits closed windows)."""
    return (_instant(events, ts_col).withWatermark(ts_col, delay)
            .groupBy(F.window(ts_col, window).alias("w"), "product_id")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "product_id", "n"))


def gap_sessions(events: DataFrame, gap: str = "12 hours", delay: str = "1 day", ts_col: str = "event_time") -> DataFrame:
    """Inactivity-gap sessions per user with ``session_window``."""
    return (_instant(events, ts_col).withWatermark(ts_col, delay)
            .groupBy("user_id", F.session_window(ts_col, gap).alias("s"))
            .agg(F.count(F.lit(1)).alias("n_events"))
            .select("user_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    "n_events"))
