"""Scalar column helpers (JVM-side expressions only)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Event-type codes of the sequence tensors (0 is padding).
EVENT_CODES = {"view": 1, "cart": 2, "purchase": 3}

# Upper bounds (exclusive) of price buckets 0-6; 7 above the last.
PRICE_BUCKET_EDGES = (10, 50, 100, 200, 500, 1000, 2000)


def event_code(col: Column, codes: dict[str, int] = EVENT_CODES) -> Column:
    """Event type -> integer code (null for unmapped types)."""
    m = F.create_map(*[x for k, v in codes.items() for x in (F.lit(k), F.lit(v))])
    return m[col].cast("long")


def price_bucket(price: Column) -> Column:
    """F13 price_bucket 0-7 from the bucket edges."""
    expr = None
    for i, edge in enumerate(PRICE_BUCKET_EDGES):
        expr = F.when(price < edge, F.lit(i)) if expr is None else expr.when(price < edge, F.lit(i))
    return expr.otherwise(F.lit(len(PRICE_BUCKET_EDGES)))


def bucket_label(value: Column, edges: Sequence[float]) -> Column:
    """struct(order, label) of the half-open bucket ``[edges[i], edges[i+1])``
    holding ``value``; the last bucket is open ended (``"e+"``)."""
    def fmt(x):
        return str(int(x)) if float(x).is_integer() else str(x)

    expr = None
    for i in range(len(edges) - 1, -1, -1):
        lo = edges[i]
        label = (f"{fmt(lo)}+" if i == len(edges) - 1 else f"{fmt(lo)}-{fmt(edges[i + 1])}")
        s = F.struct(F.lit(i + 1).alias("order"), F.lit(label).alias("label"))
        expr = F.when(value >= lo, s) if expr is None else expr.when(value >= lo, s)
    return expr.otherwise(F.struct(F.lit(0).alias("order"), F.lit(f"<{fmt(edges[0])}").alias("label")))


def bucket_sql(value: str, edges: Sequence[float]) -> tuple[str, str]:
    """The same bucketing as SQL CASE expressions (order, label) for oracles."""
    def fmt(x):
        return str(int(x)) if float(x).is_integer() else str(x)

    o, lab = ["CASE"], ["CASE"]
    for i in range(len(edges) - 1, -1, -1):
        lo = edges[i]
        label = (f"{fmt(lo)}+" if i == len(edges) - 1 else f"{fmt(lo)}-{fmt(edges[i + 1])}")
        o.append(f"WHEN {value} >= {lo} THEN {i + 1}")
        lab.append(f"WHEN {value} >= {lo} THEN '{label}'")
    o.append("ELSE 0 END")
    lab.append(f"ELSE '<{fmt(edges[0])}' END")
    return " ".join(o), " ".join(lab)


def category_level(code: Column, level: int, default: str = "unknown") -> Column:
    """the ``level``-th dotted segment (1-based), ``default`` when absent."""
    parts = F.split(F.coalesce(code, F.lit(default)), r"\.")
    return F.coalesce(F.get(parts, level - 1), F.lit(default))


def normalise_brand(col: Column) -> Column:
    """trim(lower(coalesce(brand, '')))."""
    return F.trim(F.lower(F.coalesce(col, F.lit(""))))


# Words written upper case when brands are title-cased.
BRAND_ACRONYMS = ("lg", "hp", "aeg", "tcl", "bmw", "kia", "cpu", "ssd", "led", "rgb", "usb",
                  "hdmi", "tv", "jbl", "msn")


def title_brand(col: Column, acronyms: Sequence[str] = BRAND_ACRONYMS) -> Column:
    """display form of a brand: empty -> "Unknown", else each
    whitespace-separated word title-cased, listed acronyms upper-cased. In title
    case every run of letters begins with a capital, also after a hyphen, an
    apostrophe or a digit (``D-Link``, ``L'Oreal``, ``3M``)."""
    acr = F.array(*[F.lit(a) for a in acronyms])
    norm = normalise_brand(col)
    words = F.filter(F.split(norm, r"\s+"), lambda w: w != "")

    def title(word: Column) -> Column:
        runs = F.regexp_extract_all(word, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
        return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1 << 30))), "")

    cased = F.transform(words, lambda w: F.when(F.array_contains(acr, w), F.upper(w)).otherwise(title(w)))
    return F.when(norm == "", F.lit("Unknown")).otherwise(F.array_join(cased, " "))


def safe_divide(num: Column, den: Column) -> Column:
    """SAFE_DIVIDE: null when the denominator is 0 or null."""
    return F.try_divide(num, den)


def cyclic_dow(dow: Column) -> tuple[Column, Column]:
    """M6: sin and cos of 2*pi*d/7 with d = dayofweek - 1 (Sunday = 0)."""
    d = (dow - 1).cast("double")
    ang = d * (2 * math.pi / 7)
    return F.sin(ang), F.cos(ang)


def rnd(col, digits: int = 0) -> Column:
    """Round half away from zero on the binary value: ``round(x * 10^d) / 10^d``.

    ``F.round`` rounds the shortest decimal text of a double (HALF_UP), which
    splits decimal ties differently from SQL engines that scale the binary
    value; this form gives the same double as those engines."""
    c = F.col(col) if isinstance(col, str) else col
    m = float(10 ** digits)
    return F.signum(c) * F.floor(F.abs(c) * F.lit(m) + F.lit(0.5)) / F.lit(m)


def exact_mean(col, decimals: int = 2, when: Column | None = None) -> Column:
    """Mean of a fixed-point quantity (prices in cents, ...) from an exact
    integer sum: independent of summation order, so every engine and every
    partitioning yields the same double. ``when`` restricts the rows (the
    conditional ``AVG(CASE WHEN ...)``); no qualifying row gives null."""
    c = F.col(col) if isinstance(col, str) else col
    if when is not None:
        c = F.when(when, c)
    m = float(10 ** decimals)
    units = F.round(c * F.lit(m)).cast("decimal(20,0)")  # their sum has 30 digits: it cannot overflow
    return F.try_divide(F.sum(units).cast("double"), F.count(c) * F.lit(m))


def attach(df: DataFrame, *one_row: DataFrame) -> DataFrame:
    """Adds the columns of one-row global aggregates (totals, counts, packed
    bounded arrays) to every row of ``df`` as uncorrelated scalar subqueries:
    no join, each aggregate runs once (Spark merges subqueries over the same
    plan) and its value is inlined into the projection."""
    return df.select("*", *[o.select(c).scalar().alias(c) for o in one_row for c in o.columns])


def distinct_counts(df: DataFrame, **columns: str) -> DataFrame:
    """One row with the number of distinct non-null values of each column, under
    the given names. Each column is reduced map-side on its own: several
    ``count_distinct`` in one aggregate would copy every row once a column."""
    counts = [df.where(F.col(c).isNotNull()).select(c).distinct().agg(F.count(F.lit(1)).alias(name)) for name, c in columns.items()]
    return attach(counts[0], *counts[1:])
