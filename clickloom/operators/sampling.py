"""User samples, time filters and temporal splits."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import attach, distinct_counts, rnd
from clickloom.operators.ordering import first_n


def hash_key(col: str, seed: int | None = None) -> Column:
    """Deterministic order key: md5 of the id as text (same in SQL engines)."""
    txt = F.col(col).cast("string")
    if seed is not None:
        txt = F.concat(F.lit(f"{seed}:"), txt)
    return F.md5(txt)


def hash_user_sample(df: DataFrame, n_users: int, user_col: str = "user_id",
                     seed: int | None = None) -> DataFrame:
    """W2 + J3, and with a ``seed`` W9: exactly ``n_users`` users (all, if there
    are fewer), the first in md5 order of their id, with all their events.

    Reproducible and partition-count independent; the users are numbered by a
    distributed sort and joined back with a semi join.
    """
    users = first_n(df.where(F.col(user_col).isNotNull()), user_col, hash_key(user_col, seed), n_users)
    return df.join(users, user_col, "left_semi")


def seeded_user_sample(df: DataFrame, fraction: float, seed: int = 42,
                       user_col: str = "user_id") -> DataFrame:
    """Each user kept with probability ``fraction``, decided by an md5 of (seed,
    user). No shuffle at all; stable across runs and layouts."""
    u = F.conv(F.substring(hash_key(user_col, seed), 1, 15), 16, 10).cast("long")
    return df.filter(F.pmod(u, F.lit(1_000_000)) < F.lit(int(round(fraction * 1_000_000))))


def row_budget_sample(df: DataFrame, target_rows: int, min_events: int = 5,
                      user_col: str = "user_id", seed: int | None = None) -> DataFrame:
    """Users with at least ``min_events`` events; the number of users is
    ``ceil(target_rows / mean events per eligible user)``; those users are the
    first in hash order, and all their events are returned."""
    per_user = df.groupBy(user_col).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_events)
    stats = per_user.agg(F.avg("_n").alias("m")).first()
    mean = stats["m"] or 1.0
    n_users = max(1, int(-(-target_rows // mean)))  # ceil
    return df.join(first_n(per_user, user_col, hash_key(user_col, seed), n_users), user_col, "left_semi")


def month_start(month: str) -> dt.datetime:
    y, m = (int(x) for x in month.split("-"))
    return dt.datetime(y, m, 1)


def next_month(month: str) -> dt.datetime:
    y, m = (int(x) for x in month.split("-"))
    return dt.datetime(y + (m == 12), m % 12 + 1, 1)


def month_filter(df: DataFrame, months: Sequence[str], ts_col: str = "event_time") -> DataFrame:
    """events whose month is in ``months`` ("YYYY-MM"), written as half-open
    timestamp ranges so Parquet min/max statistics can prune row groups (a
    formatted-string predicate cannot be pushed down)."""
    cond = None
    for m in months:
        c = time_range_cond(ts_col, month_start(m), next_month(m))
        cond = c if cond is None else (cond | c)
    return df.filter(cond)


def time_range_cond(ts_col: str, start: dt.datetime, end: dt.datetime) -> Column:
    lo = F.lit(start.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    hi = F.lit(end.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return (F.col(ts_col) >= lo) & (F.col(ts_col) < hi)


def time_range(df: DataFrame, start: dt.datetime, end: dt.datetime, ts_col: str = "event_time") -> DataFrame:
    """``[start, end)``."""
    return df.filter(time_range_cond(ts_col, start, end))


def split_label(df: DataFrame, val_start: dt.datetime, test_start: dt.datetime,
                ts_col: str = "event_time", out: str = "split") -> DataFrame:
    """train before ``val_start``, val before ``test_start``, test after."""
    vs = F.lit(val_start.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    ts = F.lit(test_start.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    c = F.col(ts_col)
    return df.withColumn(out, F.when(c < vs, "train").when(c < ts, "val").otherwise("test"))


def split_overlap(train: DataFrame, test: DataFrame, user_col: str = "user_id",
                  gate: tuple[float, float] = (65.0, 85.0)) -> DataFrame:
    """A23 + Q5: one row of train/test users, overlap and the 65-85 % gate.

    One-row aggregates of each side (J12), attached as scalar subqueries."""
    tr = train.select(user_col).distinct()
    te = test.select(user_col).distinct()
    a = tr.agg(F.count(F.lit(1)).alias("train_users"))
    b = te.agg(F.count(F.lit(1)).alias("test_users"))
    c = tr.join(te, user_col, "inner").agg(F.count(F.lit(1)).alias("overlap_users"))
    out = attach(a, b, c)
    pct = rnd(F.col("overlap_users") * 100.0 / F.col("test_users"), 6)
    return out.select("train_users", "test_users", "overlap_users", pct.alias("overlap_pct"),
                      ((pct >= gate[0]) & (pct <= gate[1])).alias("gate_pass"))


# The event table's columns and their types.
EVENT_TYPES = {"event_time": "timestamp", "event_type": "string", "product_id": "bigint", "category_id": "bigint", "category_code": "string",
               "brand": "string", "price": "double", "user_id": "bigint", "user_session": "string"}


def _same_type(found: str | None, expected: str) -> bool:
    """Times with and without a zone are both timestamps; text is not."""
    return found == expected or (expected == "timestamp" and found in ("timestamp_ntz", "timestamp_ltz"))


def schema_validation(df: DataFrame, expected: dict[str, str] = EVENT_TYPES) -> DataFrame:
    """One row a column, expected or found: ``column, expected_type, found_type,
    status`` (ok, wrong_type, missing, unexpected). Read from the schema: no data is scanned."""
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    rows = [(c, expected.get(c), found.get(c), "missing" if c not in found else "unexpected" if c not in expected
             else "ok" if _same_type(found[c], expected[c]) else "wrong_type") for c in sorted({*expected, *found})]
    return df.sparkSession.createDataFrame(rows, "column string, expected_type string, found_type string, status string")


def table_validation(df: DataFrame, user_col: str = "user_id", item_col: str = "product_id",
                     ts_col: str = "event_time", price_col: str = "price", session_col: str = "user_session",
                     type_col: str = "event_type", price_floor: float = 1.0, bot_threshold: float = 300.0,
                     null_cols: Sequence[str] = ("category_code", "brand"),
                     types: Sequence[str] = ("view", "cart", "purchase")) -> DataFrame:
    """One row of users, events, items, time range, rows below the price
    floor, nulls by column, events by type (and of no known type), the number of
    users whose mean events a day exceed ``bot_threshold``, and whether the time
    column is a timestamp and every column of ``EVENT_TYPES`` there with its type."""
    one = df.agg(F.count(F.lit(1)).alias("n_events"),
                 F.min(ts_col).alias("min_time"), F.max(ts_col).alias("max_time"),
                 F.count_if(F.col(price_col) < price_floor).alias("n_below_price_floor"),
                 F.count_if(F.col(user_col).isNull()).alias("n_null_users"),
                 F.count_if(F.col(session_col).isNull()).alias("n_null_sessions"),
                 *[F.count_if(F.col(c).isNull()).alias(f"n_null_{c}") for c in null_cols],
                 *[F.count_if(F.col(type_col) == t).alias(f"n_{t}") for t in types],
                 F.count_if(F.coalesce(~F.col(type_col).isin(list(types)), F.lit(True))).alias("n_other_types"))
    daily = df.groupBy(user_col, F.to_date(ts_col).alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    bots = daily.groupBy(user_col).agg(F.avg("_n").alias("_a")).filter(F.col("_a") > bot_threshold)
    found = dict(df.dtypes)
    typed = all(_same_type(found.get(c), t) for c, t in EVENT_TYPES.items())
    out = attach(one, distinct_counts(df, n_users=user_col, n_items=item_col), bots.agg(F.count(F.lit(1)).alias("n_bot_users")))
    return out.withColumns({"time_is_timestamp": F.lit(_same_type(found.get(ts_col), "timestamp")), "schema_ok": F.lit(typed)})


def sample_profile(frames: dict[str, DataFrame], type_col: str = "event_type",
                   null_cols: Sequence[str] = ("category_code", "brand")) -> DataFrame:
    """Event-type mix and null shares per labelled frame (full vs samples),
    one row per (label, metric)."""
    out = None
    for label, df in frames.items():
        total = F.count(F.lit(1))
        aggs = [rnd(F.count_if(F.col(type_col) == t) * 100.0 / total, 6).alias(f"pct_{t}")
                for t in ("view", "cart", "purchase")]
        aggs += [rnd(F.count_if(F.col(c).isNull()) * 100.0 / total, 6).alias(f"pct_null_{c}")
                 for c in null_cols]
        one = df.agg(total.alias("n_events"), *aggs).select(F.lit(label).alias("label"), "*")
        out = one if out is None else out.unionByName(one)
    return out
