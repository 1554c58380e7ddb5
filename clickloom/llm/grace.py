"""Exact deduplication by Grace hashing.

Texts are equal when identical after lower-casing A-Z. Records are partitioned
by a hash of that text; within a bucket an open-addressing table compares the
complete content. A table that is full admits no further contents: records of
contents it holds are still absorbed, all others go to spill files chosen by
the next hash bits, and each file is then treated the same way with an empty
table, until every bucket has fitted (hybrid Grace hashing).

The same routine runs twice. First inside each input partition, so that a
group of copies - it may hold a third of all rows - travels as at most one
record a partition; then, after an exchange by hash, over those records. Spill
files live in the task's own temporary folder only while the task runs, as a
sort's would; a lost executor's tasks simply run again.

Results go back to the documents by (digest, salt). A document's salt is a hash
of its doc_id over a number of salts that follows the row count, so one join
key holds about ``ROWS_PER_SALT`` rows of a group at most.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.textops import fresh, map_batches

#: bytes of distinct contents one table may hold before it spills
TABLE_BYTES = 48 << 20
#: memory of one salt in a set, about
SALT_BYTES = 64
#: spill files a level, and levels before a bucket is taken as it is (its hashes
#: agree in every bit used, so further partitioning could not part them)
FAN_OUT_BITS, MAX_DEPTH = 4, 12
#: rows of a group that share a salt, at most (in the mean)
ROWS_PER_SALT = 8192

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: hash, content, largest doc_id, rows, salts
Record = tuple[int, bytes, int, int, frozenset]


class OpenTable:
    """Open addressing with linear probing; equal means equal content."""

    def __init__(self):
        self.slots = np.full(1024, -1, np.int64)
        self.hash: list[int] = []
        self.content: list[bytes] = []
        self.keep: list[int] = []
        self.rows: list[int] = []
        self.salts: list[set] = []
        self.bytes = 0

    def _slot(self, h: int, content: bytes) -> int:
        mask = len(self.slots) - 1
        at = h & mask
        while (i := int(self.slots[at])) >= 0 and not (self.hash[i] == h and self.content[i] == content):
            at = (at + 1) & mask
        return at

    def absorb(self, record: Record, admit: bool) -> bool:
        """Add the record to its content's entry; a new entry only if ``admit``."""
        h, content, keep, rows, salts = record
        at = self._slot(h, content)
        i = int(self.slots[at])
        if i < 0:
            if not admit:
                return False
            if 2 * len(self.hash) >= len(self.slots):
                self._grow()
                at = self._slot(h, content)
            self.slots[at] = len(self.hash)
            self.hash.append(h)
            self.content.append(content)
            self.keep.append(keep)
            self.rows.append(rows)
            self.salts.append(set(salts))
            self.bytes += len(content) + 200 + SALT_BYTES * len(salts)
            return True
        self.keep[i] = max(self.keep[i], keep)
        self.rows[i] += rows
        self.bytes -= SALT_BYTES * len(self.salts[i])
        self.salts[i] |= salts
        self.bytes += SALT_BYTES * len(self.salts[i])
        return True

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for i, h in enumerate(self.hash):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = i

    def groups(self) -> Iterator[Record]:
        yield from zip(self.hash, self.content, self.keep, self.rows, map(frozenset, self.salts), strict=True)


def _unspill(path: str) -> Iterator[Record]:
    with open(path, "rb") as file:
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return


def grace(records: Iterable[Record], table_bytes: int = TABLE_BYTES, depth: int = 0) -> Iterator[Record]:
    """One record for each distinct content of ``records``."""
    table = OpenTable()
    # the executor's own spill folders, which Spark names to its Python workers
    spill = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
    with tempfile.TemporaryDirectory(prefix="grace-", dir=spill) as folder:
        files: dict[int, object] = {}
        try:
            for r in records:
                if not table.absorb(r, table.bytes < table_bytes or depth >= MAX_DEPTH):
                    part = (r[0] >> (64 - FAN_OUT_BITS * (depth + 1))) & ((1 << FAN_OUT_BITS) - 1)
                    if part not in files:
                        files[part] = open(os.path.join(folder, str(part)), "wb")  # noqa: SIM115
                    pickle.dump(r, files[part], pickle.HIGHEST_PROTOCOL)
        finally:
            for f in files.values():
                f.close()
        yield from table.groups()
        del table
        for part in sorted(files):
            path = os.path.join(folder, str(part))
            yield from grace(_unspill(path), table_bytes, depth + 1)
            os.unlink(path)


def _hash(content: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "little")


def _normalised(docs: DataFrame) -> DataFrame:
    """doc_id, the text all rows of a group agree in, and the row's salt."""
    salts = 1 + docs.count() // ROWS_PER_SALT
    return docs.select(
        "doc_id", F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER).alias("norm"),
        F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1))), F.lit(salts)).alias("salt"))


def _chunks(rows: Iterator, schema: pa.Schema, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    part, size = [], 0
    for width, row in rows:
        part.append(row)
        size += width
        if size >= limit or len(part) >= 8192:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)
            part, size = [], 0
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)


_LOCAL = pa.schema([("h", pa.int64()), ("norm", pa.binary()), ("keep_id", pa.int64()), ("n", pa.int64()), ("salts", pa.list_(pa.int64()))])
_FOUND = pa.schema([("text_sha256", pa.string()), ("salt", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


def groups(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``text_sha256, salt, keep_id, group_size``: a row for each distinct content
    and salt that occurs in it."""
    bits = (1 << 64) - 1

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[Record]:
            for b in batches:
                for norm, doc, salt in zip(b.column("norm").to_pylist(), b.column("doc_id").to_pylist(), b.column("salt").to_pylist(), strict=True):
                    content = norm.encode("utf-8", "surrogatepass")
                    yield _hash(content), content, -(1 << 63) if doc is None else doc, 1, frozenset((salt,))

        yield from _chunks(((len(r[1]) + 50, (r[0] - (1 << 64) if r[0] >> 63 else r[0], r[1], r[2], r[3], sorted(r[4])))
                            for r in grace(records(), table_bytes)), _LOCAL)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[Record]:
            for b in batches:
                for h, content, keep, n, salts in zip(*(b.column(c).to_pylist() for c in _LOCAL.names), strict=True):
                    yield h & bits, content, keep, n, frozenset(salts)

        def rows() -> Iterator:
            for _, content, keep, n, salts in grace(records(), table_bytes):
                digest = hashlib.sha256(content).hexdigest()
                for salt in sorted(salts):
                    yield 100, (digest, salt, keep, n)

        yield from _chunks(rows(), _FOUND)

    parts = map_batches(_normalised(docs), within, "h long, norm binary, keep_id long, n long, salts array<long>")
    return map_batches(parts.repartition("h"), across, "text_sha256 string, salt long, keep_id long, group_size long")


def dedup(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts (null counts as empty) the largest doc_id stays. Rows that
    repeat doc_id and text are counted one by one and all bear the group's
    verdict; a null doc_id is never kept beside another (if all are null,
    keep_id is the least long and none is kept). An empty table gives no rows;
    other columns are not read."""
    rows = _normalised(docs).select("doc_id", F.sha2("norm", 256).alias("text_sha256"), "salt")
    return (rows.join(groups(docs, table_bytes), ["text_sha256", "salt"])
            .select("doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
                    "text_sha256"))


def keep_one(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: one for each distinct text."""
    sha, here, keep, kept_sha = fresh(docs, "sha", "here", "keep", "kept_sha")
    kept = groups(docs, table_bytes).select(F.col("keep_id").alias(keep), F.col("text_sha256").alias(kept_sha)).distinct()
    digest = F.sha2(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), 256)
    # a group whose doc_ids are all null is kept under the least long
    rows = docs.withColumns({sha: digest, here: F.coalesce("doc_id", F.lit(-(1 << 63)))})
    found = rows.join(kept, (F.col(here) == F.col(keep)) & (F.col(sha) == F.col(kept_sha)), "left_semi")
    # by the join's own columns: the texts are not shuffled again
    return found.dropDuplicates([here, sha]).select(*docs.columns)
