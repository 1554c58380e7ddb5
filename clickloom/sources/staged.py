"""Staged writes (S7, S8, S13): new rows are written beside what they replace,
checked, and only then take its place.

Data moves by renames of folders in the table's own file system; nothing is
copied and nothing passes through the driver. A job that dies while writing
leaves the old rows readable and a staging folder that the next call removes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickloom.sources.files import CORRUPT, read_raw_csv

Check = Callable[[DataFrame], None]


class _Folders:
    """The few file-system calls a swap needs."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)

    def move(self, source: str, target: str) -> None:
        self.fs.mkdirs(self.path(target).getParent())
        if not self.fs.rename(self.path(source), self.path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def beside(self, path: str, kind: str) -> list[str]:
        """Folders that earlier calls for ``path`` left: its name, ``kind`` and an id."""
        where = self.path(path)
        found = self.fs.globStatus(self.path(where.getParent(), f"{where.getName()}.{kind}-*"))
        return [s.getPath().toString() for s in found or []]


def _swap(folders: _Folders, staging: str, path: str) -> None:
    """``staging`` takes the place of ``path``; if it cannot, ``path`` is as before."""
    old = f"{path}.old-{uuid.uuid4().hex}"
    was_there = folders.exists(path)
    if was_there:
        folders.move(path, old)
    try:
        folders.move(staging, path)
    except Exception:
        if was_there:
            folders.move(old, path)
        raise
    if was_there:
        folders.delete(old)


def _recover(folders: _Folders, path: str) -> None:
    """Puts back a table that a call died on between its two moves, removes staging."""
    old = folders.beside(path, "old")
    if old and not folders.exists(path):
        folders.move(old[0], path)
    for left in (folders.beside(path, "old") if folders.exists(path) else []) + folders.beside(path, "staging"):
        folders.delete(left)


def replace_parquet(df: DataFrame, path: str, check: Check | None = None, partition_by: Sequence[str] = ()) -> None:
    """The Parquet table at ``path`` becomes ``df``.

    The rows are written to a staging folder, read back and given to ``check``,
    which raises to refuse them; two renames then swap the folders. ``df`` may
    read the old table. One writer at a time; a reader that listed the old files
    must list them again."""
    spark = df.sparkSession
    folders = _Folders(spark, path)
    _recover(folders, path)
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    try:
        w = df.write
        (w.partitionBy(*partition_by) if partition_by else w).parquet(staging)
        if check is not None:
            check(spark.read.parquet(staging))
        _swap(folders, staging, path)
    finally:
        if folders.exists(staging):
            folders.delete(staging)


def replace_table(df: DataFrame, name: str, path: str, check: Check | None = None) -> None:
    """S7 + S8: the external table ``name`` over ``path`` becomes ``df``, also with
    another schema. The catalog entry is made anew once the rows are in place:
    no rows are lost with it."""
    spark = df.sparkSession
    replace_parquet(df, path, check)
    if spark.catalog.tableExists(name):
        if [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in df.schema]:
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path, source="parquet")


def reload_partitions(df: DataFrame, path: str, by: str = "month", only: Sequence | None = None) -> list:
    """Replaces the partitions of ``path`` (column ``by``) that ``df`` holds and
    leaves the files of all others as they are; the partitions replaced.

    With ``only``, a row of any other partition is refused before anything is
    written. Spark stages the files and moves them at commit, so a job that fails
    replaces nothing. An empty ``df`` replaces nothing."""
    held = sorted(r[0] for r in df.select(by).distinct().collect())  # a calendar
    if only is not None and set(held) - set(only):
        raise ValueError(f"rows of {sorted(set(held) - set(only))} in a reload of {sorted(only)}")
    if held:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    return held


def load_csv(spark: SparkSession, paths: Sequence[str] | str, path: str, quarantine: str, max_bad: int = 1000,
             prepare: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, int]:
    """Raw CSV into the Parquet table at ``path``, malformed rows into
    ``quarantine`` (their text in ``_corrupt_record``), with one scan.

    Both are written to a staging folder in the same job; an observation on that
    write counts the rows. Up to ``max_bad`` malformed rows the load is committed:
    the good rows replace ``path``. Beyond, ValueError is raised and ``path`` stays as
    it is; the rejects can be read in ``quarantine`` either way. ``prepare`` maps
    the rows before they are written (it must keep ``_corrupt_record``). Returns
    the number of good and bad rows."""
    folders = _Folders(spark, path)
    for table in (path, quarantine):
        _recover(folders, table)
    raw = read_raw_csv(spark, paths)
    rows = (raw if prepare is None else prepare(raw)).withColumn("_bad", F.col(CORRUPT).isNotNull())
    seen = Observation(f"load-{uuid.uuid4().hex}")
    counted = rows.observe(seen, F.count_if(F.col("_bad")).alias("bad"), F.count_if(~F.col("_bad")).alias("good"))
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    try:
        counted.write.partitionBy("_bad").parquet(staging)
        n = {"good": int(seen.get["good"]), "bad": int(seen.get["bad"])}
        parts = {table: f"{staging}/_bad={flag}" for table, flag in ((path, "false"), (quarantine, "true"))}
        for table, part in parts.items():
            if not folders.exists(part):  # no such row: an empty table of the same columns
                rows.drop("_bad").limit(0).write.parquet(part)
        _swap(folders, parts[quarantine], quarantine)
        if n["bad"] > max_bad:
            raise ValueError(f"{n['bad']} malformed rows exceed the tolerance of {max_bad}")
        _swap(folders, parts[path], path)
        return n
    finally:
        if folders.exists(staging):
            folders.delete(staging)
