"""File sources and sinks.

Raw CSV is read with an explicit schema (no inference pass), tolerant of bad
records up to a limit, and timestamps are parsed with their zone. Sinks are
plain DataFrameWriter calls; intermediate tables go under the shared
checkpoint folder (on a cluster always the one that spark.checkpoint.dir names).
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss z"

RAW_SCHEMA = T.StructType([
    T.StructField("event_time", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("category_id", T.LongType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("user_session", T.StringType()),
])

CORRUPT = "_corrupt_record"


def read_raw_csv(spark: SparkSession, paths: Sequence[str] | str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """S1 + S13: multi-file CSV with header and a fixed schema; malformed rows
    are kept (PERMISSIVE) with their text in ``_corrupt_record``; empty
    fields are nulls."""
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE")
            .option("nullValue", "").option("columnNameOfCorruptRecord", CORRUPT)
            .csv(list(paths) if not isinstance(paths, str) else paths))


def parse_event_time(df: DataFrame, col: str = "event_time", fmt: str = RAW_TIME_FORMAT) -> DataFrame:
    """Zone-aware string -> timestamp (null when unparsable, never an error)."""
    return df.withColumn(col, F.try_to_timestamp(F.col(col), F.lit(fmt)))


def check_bad_records(df: DataFrame, max_bad: int = 1000) -> int:
    """Number of malformed rows; raises when above ``max_bad``.

    All data columns are read along: the CSV reader parses only the columns it
    is asked for, and so finds nothing malformed in the others."""
    every = F.max(F.xxhash64(*[c for c in df.columns if c != CORRUPT]))
    n = df.agg(F.count_if(F.col(CORRUPT).isNotNull()).alias("bad"), every).first()["bad"]
    if n > max_bad:
        raise ValueError(f"{n} malformed rows exceed the tolerance of {max_bad}")
    return n


def months_from_file_stem(df: DataFrame, months: Sequence[str], exclude: bool = True) -> DataFrame:
    """Route hold-out months away by the source file name (``2020-Jan``-style
    stems, a part number ``-part7`` aside). Apply directly on the scan: a cached
    frame no longer knows its files."""
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:-part[0-9]+)?\.csv(?:\.gz)?$", 1)
    hit = stem.isin(list(months))
    return df.filter(~hit if exclude else hit)


def name_parts(spark: SparkSession, path: str, stem: str, target: str) -> int:
    """Move the part files under ``path`` to ``target`` as ``<stem>-part<i>.csv``;
    their number. Names only: no data passes through the driver."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(fs_path(target))
    found = fs.globStatus(fs_path(path + "/part-*"))
    for i, status in enumerate(found):
        fs.rename(status.getPath(), fs_path(f"{target}/{stem}-part{i}.csv"))
    return len(found)


def write_raw_csv(df: DataFrame, path: str) -> None:
    """Writes events in the raw CSV layout (event_time text with zone)."""
    out = df.withColumn("event_time", F.concat(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")))
    out.select(*[f.name for f in RAW_SCHEMA.fields]).write.mode("overwrite").option("header", True).csv(path)


def load_month_window(df: DataFrame, month: str, ts_col: str = "event_time") -> DataFrame:
    """One calendar month; the item column is ``item_id`` or, when absent,
    ``product_id`` (both accepted, coalesced)."""
    from clickloom.operators.sampling import month_filter
    cols = [c for c in ("item_id", "product_id") if c in df.columns]
    item = F.coalesce(*[F.col(c) for c in cols]) if len(cols) > 1 else F.col(cols[0])
    rest = [c for c in df.columns if c not in ("item_id", "product_id")]
    return month_filter(df, [month], ts_col).select(*rest, item.alias("item_id"))


def write_parquet(df: DataFrame, path: str, n_files: int | None = None, partition_by: Sequence[str] = ()) -> None:
    """Overwrite Parquet; ``n_files`` repartitions first (AQE otherwise)."""
    w = (df.repartition(n_files) if n_files else df).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def export_parquet(df: DataFrame, path: str, columns: Sequence, order_by: Sequence[str] = ()) -> None:
    """Export a column list (with casts) in a given order."""
    out = df.select(*columns)
    if order_by:
        out = out.orderBy(*order_by)
    out.write.mode("overwrite").parquet(path)


def save_table(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None) -> None:
    """S7 + S8: create-or-replace a table; with ``path`` an external one there."""
    w = df.write.mode(mode)
    (w.option("path", path) if path else w).saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, by: str, buckets: int, path: str | None = None) -> None:
    """A table dealt into ``buckets`` by the hash of ``by`` and sorted by it in
    each. Aggregates and joins on that key then need no exchange, and neither do
    those between tables of the same key and number of buckets. The rows are
    dealt before the write: one file a bucket. Size buckets for one task each."""
    dealt = df.repartition(buckets, by).write.mode("overwrite").bucketBy(buckets, by).sortBy(by)
    (dealt.option("path", path) if path else dealt).saveAsTable(name)


def to_json_lines(df: DataFrame) -> DataFrame:
    """One JSON document per row (column ``json``)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("json"))


def write_json(df: DataFrame, path: str) -> None:
    """JSON sink."""
    df.write.mode("overwrite").json(path)


def load_bundle(spark: SparkSession, directory: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """The Parquet artifacts of a directory, by name."""
    return {n: spark.read.parquet(os.path.join(directory, n)) for n in names}


def read_month_in_vocab(spark: SparkSession, paths: Sequence[str] | str, user_vocab: DataFrame,
                        item_vocab: DataFrame, fmt: str = RAW_TIME_FORMAT) -> DataFrame:
    """S3: a month of raw CSV with ids read as text and coerced (``try_cast``: dirty
    ids become null and are dropped), restricted to known users and items and
    mapped to dense indices by joins. Plain files are split into tasks; a gzip
    file cannot be and is one task up to the joins, which deal its rows out: split
    a month into several files."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW_SCHEMA.fields])
    raw = spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE").csv(
        list(paths) if not isinstance(paths, str) else paths)
    typed = raw.select(F.try_to_timestamp(F.col("event_time"), F.lit(fmt)).alias("event_time"), "event_type",
                       F.expr("try_cast(product_id AS BIGINT)").alias("product_id"),
                       F.expr("try_cast(user_id AS BIGINT)").alias("user_id"),
                       F.expr("try_cast(price AS DOUBLE)").alias("price"), "user_session")
    clean = typed.filter(F.col("user_id").isNotNull() & F.col("product_id").isNotNull()
                         & F.col("event_time").isNotNull())
    return clean.join(user_vocab, "user_id").join(item_vocab, "product_id")
