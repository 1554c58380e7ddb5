"""Order-dependent primitives that stay correct and balanced under key skew.

A plain ``Window.partitionBy(user)`` sends every row of a user to one task;
one bot holding a third of the data then becomes a single straggler task
(and a single spill). The helpers here split each group by a time bucket,
solve the problem inside (group, bucket), and stitch the buckets together
through a per-(group, bucket) summary that has at most one row per bucket.
Results are exactly those of the unsplit window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import cut_lineage

_B = "_tb"  # time-bucket column
# Rows of a group beyond which its order is worked out in time buckets.
HOT_ROWS = 5_000_000


def _cols(names: Sequence[str] | str) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join in which null keys match: a window groups null keys together,
    and the summaries joined back must do the same."""
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(right, same, "left").drop(*[f"_r_{k}" for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The keys with more than ``hot_rows`` rows (at most one for every ``hot_rows``
    rows of ``df``), counted with a map-side combine; None if there are none."""
    found = cut_lineage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).select(*keys))
    return None if found.isEmpty() else found


def _sliced(df: DataFrame, keys: Sequence[str], ts_col: str, bucket_seconds: int, hot: DataFrame) -> DataFrame:
    """Adds the slice of a row's key: its time bucket for a hot key, else null."""
    b = F.floor(F.unix_timestamp(F.col(ts_col)) / F.lit(bucket_seconds)).cast("long")
    # one row for every hot_rows rows at most: small against any row's task
    marked = _join_null_safe(df, F.broadcast(hot.withColumn("_hot", F.lit(True))), list(keys))
    return marked.withColumn(_B, F.when(F.col("_hot"), b)).drop("_hot")


def previous_row(df: DataFrame, keys: Sequence[str] | str, ts_col: str,
                 tiebreak: Sequence[str] | str, values: Sequence[str] | str,
                 out: str = "_prev", bucket_seconds: int = 3600, hot_rows: int = HOT_ROWS,
                 latest_first: bool = False) -> DataFrame:
    """``lag(struct(values))`` over ``keys`` ordered by ``(ts_col, *tiebreak)``, as struct
    column ``out`` (null for the first row of a group). ``latest_first`` reads the
    groups backwards, so that a window in that order that follows sorts nothing.

    One window pass over the groups. Groups of more than ``hot_rows`` rows, if
    there are any, are cut into time buckets: the previous row is then either in
    the same bucket or the last row of the closest earlier one that has rows,
    which a table of those buckets alone tells."""
    keys, tiebreak, values = _cols(keys), _cols(tiebreak), _cols(values)
    order = [ts_col] + tiebreak
    payload = F.struct(*[F.col(v) for v in values])
    hot = hot_keys(df, keys, hot_rows)
    if hot is None and latest_first:
        return df.withColumn(out, F.lead(payload).over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])))
    if hot is None:
        return df.withColumn(out, F.lag(payload).over(Window.partitionBy(*keys).orderBy(*order)))
    b = _sliced(df, keys, ts_col, bucket_seconds, hot)
    b = b.withColumn("_lag_in", F.lag(payload).over(Window.partitionBy(*keys, _B).orderBy(*order)))
    last_key = F.struct(*[F.col(c) for c in order], *[F.col(v).alias(f"_v_{v}") for v in values])
    summary = b.where(F.col(_B).isNotNull()).groupBy(*keys, _B).agg(F.max(last_key).alias("_last"))
    w_b = Window.partitionBy(*keys).orderBy(_B)
    summary = summary.select(
        *keys, _B,
        F.lag(F.struct(*[F.col(f"_last._v_{v}").alias(v) for v in values])).over(w_b)
        .alias("_lag_bucket"))
    joined = _join_null_safe(b, summary, keys + [_B])
    return (joined
            .withColumn(out, F.when(F.col("_lag_in").isNotNull(), F.col("_lag_in"))
                        .otherwise(F.col("_lag_bucket")))
            .drop("_lag_in", "_lag_bucket", _B))


def running_sum(df: DataFrame, keys: Sequence[str] | str, ts_col: str,
                tiebreak: Sequence[str] | str, value: Column, out: str,
                bucket_seconds: int = 3600, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Cumulative ``sum(value)`` over ``keys`` ordered by ``(ts_col, *tiebreak)``,
    rows from the first to the current one. One window pass; groups of more than
    ``hot_rows`` rows are cut into time buckets, whose totals are added up."""
    keys, tiebreak = _cols(keys), _cols(tiebreak)
    order = [ts_col] + tiebreak
    upto = lambda *by: Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return df.withColumn("_v", value).withColumn(out, F.sum("_v").over(upto(*keys))).drop("_v")
    df = _sliced(df, keys, ts_col, bucket_seconds, hot)
    df = df.withColumn("_v", value).withColumn("_cum_in", F.sum("_v").over(upto(*keys, _B)))
    totals = df.where(F.col(_B).isNotNull()).groupBy(*keys, _B).agg(F.sum("_v").alias("_tot"))
    w_b = (Window.partitionBy(*keys).orderBy(_B)
           .rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select(*keys, _B, F.coalesce(F.sum("_tot").over(w_b), F.lit(0)).alias("_before"))
    return (_join_null_safe(df, totals, keys + [_B])
            .withColumn(out, F.col("_cum_in") + F.coalesce("_before", F.lit(0)))
            .drop("_v", "_cum_in", "_before", _B))


def top_k_per_group(df: DataFrame, keys: Sequence[str] | str, order: Sequence[Column],
                    k: int, rank_col: str | None = "rank") -> DataFrame:
    """Keeps the first ``k`` rows per group by a total order.

    ``row_number() <= k`` is planned by Spark as a partial WindowGroupLimit
    before the shuffle, so a hot group ships at most ``k`` rows per map task.
    """
    keys = _cols(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    name = rank_col or "_rk"
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def dense_index(df: DataFrame, key_cols: Sequence[str] | str, index_col: str,
                start: int = 1, num_partitions: int | None = None) -> DataFrame:
    """Distinct keys numbered ``start, start+1, ...`` in ascending key order.

    Distributed form of "sort then number": range-partition the distinct keys,
    tag each row with its position inside its partition
    (``monotonically_increasing_id`` = partition << 33 | position), cut the
    lineage so the numbering cannot change on recomputation, then add each
    partition's offset (one row per partition, so the broadcast is bounded by
    the partition count). No single-partition window.
    """
    key_cols = _cols(key_cols)
    return number_rows(df.select(*key_cols).distinct(), key_cols, index_col, start, num_partitions)


def number_rows(df: DataFrame, key_cols: Sequence[str] | str, index_col: str, start: int = 1,
                num_partitions: int | None = None) -> DataFrame:
    """``df``, whose rows differ in ``key_cols``, numbered like ``dense_index``:
    the whole rows are ordered once, and no key is joined back to its row."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *_cols(key_cols))
              .sortWithinPartitions(*_cols(key_cols))
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = cut_lineage(ranged)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (ranged.join(F.broadcast(offsets), "_pid")
            .select(*df.columns, (F.col("_off") + pos + F.lit(start)).cast("long").alias(index_col)))


def lookup_join(rows: DataFrame, small: DataFrame, keys: Sequence[str] | str, spread: Column, salts: int = 32,
                how: str = "inner") -> DataFrame:
    """``rows`` joined with ``small`` on a few hot keys (price buckets, days).

    Joined plainly, all rows would be shuffled onto as many tasks as there are
    keys. Here a row's key gets one of ``salts`` salts by the hash of ``spread``
    and ``small``, one row a key, is copied to each."""
    keys = _cols(keys)
    salted = rows.withColumn("_lk", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = small.withColumn("_lk", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, keys + ["_lk"], how).drop("_lk")


def first_n(df: DataFrame, key_cols: Sequence[str] | str, order_col: Column, n: int) -> DataFrame:
    """The ``n`` distinct keys that come first by (``order_col``, keys).

    Numbered by ``dense_index`` and filtered, so a large ``n`` is as spread out
    as a small one: an ordered limit would merge every task's first ``n`` rows
    in a single task."""
    key_cols = _cols(key_cols)
    ordered = df.select(order_col.alias("_order"), *key_cols)
    return dense_index(ordered, ["_order", *key_cols], "_place").filter(F.col("_place") <= n).select(*key_cols)


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float],
                    num_partitions: int | None = None, ranks: Sequence[tuple[int, int, float]] | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (``quantile_cont``) of ``col``,
    one row ``(prob, value)`` per probability. Nulls are ignored. ``ranks`` gives
    each quantile's place among the rows (lower and upper rank, weight of the
    upper) where they are a known part of a larger table.

    Distributed: values are first reduced to (value, count) with a partial
    aggregation, range-partitioned and sorted; each partition computes its
    running counts in place (no second shuffle), partition offsets come from a
    one-row-per-partition table, and only the rows holding the needed ranks
    are picked. No task ever holds more than one range partition.
    """
    import math

    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    vc = (df.select(F.col(col).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
          .groupBy("_x").agg(F.count(F.lit(1)).alias("_c")))
    ranged = (vc.repartitionByRange(n, "_x").sortWithinPartitions("_x")
              .withColumn("_pid", F.spark_partition_id()))

    def running(it):
        total = 0
        for pdf in it:
            cum = pdf["_c"].cumsum() + total
            total = int(cum.iloc[-1]) if len(cum) else total
            yield pdf.assign(_cum=cum)

    ranged = cut_lineage(ranged.mapInPandas(running, "_x double, _c long, _pid int, _cum long"))
    totals = ranged.groupBy("_pid").agg(F.sum("_c").alias("_t"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", F.coalesce(F.sum("_t").over(w), F.lit(0)).alias("_off"))
    placed = (ranged.join(F.broadcast(offsets), "_pid")
              .select("_x", (F.col("_off") + F.col("_cum") - F.col("_c")).alias("_start"),
                      (F.col("_off") + F.col("_cum")).alias("_end")))
    total = totals.agg(F.sum("_t")).first()[0] or 0
    rows = []
    for i, p in enumerate(probs):
        if total == 0:
            rows.append((float(p), -1, -1, 0.0))
            continue
        if ranks is not None:
            rows.append((float(p), *ranks[i]))
            continue
        h = float(p) * (total - 1)
        lo, hi = math.floor(h), math.ceil(h)
        rows.append((float(p), lo, hi, h - lo))
    want = spark.createDataFrame(rows, "prob double, lo long, hi long, frac double")
    # The rank table has 2 rows per probability: a proven bound, safe to broadcast.
    lo_v = placed.join(F.broadcast(want), (F.col("lo") >= F.col("_start")) & (F.col("lo") < F.col("_end")))
    lo_v = lo_v.select("prob", "frac", F.col("_x").alias("_lo"))
    hi_v = placed.join(F.broadcast(want.select("prob", "hi")),
                       (F.col("hi") >= F.col("_start")) & (F.col("hi") < F.col("_end")))
    hi_v = hi_v.select(F.col("prob").alias("_p2"), F.col("_x").alias("_hi"))
    res = lo_v.join(hi_v, lo_v.prob == hi_v._p2)
    value = F.col("_lo") + F.col("frac") * (F.col("_hi") - F.col("_lo"))
    return want.select("prob").join(res.select("prob", value.alias("value")), "prob", "left")


def previous_within(df: DataFrame, keys: Sequence[str] | str, ts_col: str, tiebreak: Sequence[str] | str,
                    values: Sequence[str] | str, max_gap_seconds: int, out: str = "_prev",
                    bucket_seconds: int | None = None) -> DataFrame:
    """The previous row of the group, for rules that only look back at most
    ``max_gap_seconds`` (whole seconds): one window pass, no self-join.

    Rows are partitioned by (group, time bucket). Each row lying in the last
    ``max_gap_seconds`` of its bucket is also emitted once more (``explode``,
    same pass) as a "ghost" into the next bucket, so every predecessor within
    the gap sits in the same window partition as its successor. The struct
    ``out`` is exact whenever the true previous row is within the gap; when it
    is further back the result is that row or null, and either way the gap
    test of the caller gives the same answer. A hot group is spread over its
    time buckets.
    """
    keys, tiebreak, values = _cols(keys), _cols(tiebreak), _cols(values)
    bsize = bucket_seconds or max(3600, 2 * max_gap_seconds)
    if bsize < max_gap_seconds:
        raise ValueError("bucket_seconds must be >= max_gap_seconds")
    secs = F.unix_timestamp(F.col(ts_col))
    b = F.floor(secs / F.lit(bsize)).cast("long")
    near_end = secs >= (b + 1) * F.lit(bsize) - F.lit(max_gap_seconds)
    tags = F.when(near_end, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    tagged = df.select("*", b.alias(_B), F.explode(tags).alias("_ghost"))
    tagged = tagged.withColumn(_B, F.col(_B) + F.col("_ghost"))
    w = Window.partitionBy(*keys, _B).orderBy(*([ts_col] + tiebreak))
    lagged = tagged.withColumn(out, F.lag(F.struct(*[F.col(v) for v in values])).over(w))
    return lagged.filter(F.col("_ghost") == 0).drop("_ghost")
