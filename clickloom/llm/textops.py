"""Helpers shared by the text operators: bounded Arrow batches and vectorised
word hashing.

``mapInArrow`` hands a task its rows in record batches, so a task holds one
batch of texts at a time whatever the partition size is.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: rows and bytes of one Arrow batch; bounds a Python worker's memory
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20

U64 = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for texts of any length mix."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def map_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` over bounded batches."""
    bound_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads a 64-bit value over all bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: running products of the base and of its inverse (they wrap modulo 2**64,
#: the ring the hash lives in); grown to the longest batch seen
_POWERS = [np.ones(1, U64), np.ones(1, U64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) <= n:
        for i, base in enumerate((_P, _P_INV)):
            factors = np.full(2 * n + 1, base, U64)
            factors[0] = 1
            _POWERS[i] = np.multiply.accumulate(factors)
    return _POWERS


def _class_table(separators: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    is_word = np.ones(256, bool)
    is_word[list(separators)] = False
    value = np.arange(256, dtype=U64)
    if lower:
        value[65:91] += U64(32)
    return is_word, value + U64(1)


#: white space as in ``[\x20\x09-\x0D]``
SPACES = bytes([32, 9, 10, 11, 12, 13])
#: every ASCII byte that is neither a letter nor a digit
PUNCTUATION = bytes(b for b in range(128) if not chr(b).isalnum())


class Words:
    """Word hashes of a batch of texts.

    ``hash`` holds one 64-bit hash a word, ``doc`` the index of its text,
    ``start`` the position of the first word of each text (with the total as
    last entry). Words are the maximal runs of bytes outside ``separators`` in
    UTF-8; a word's hash depends on its bytes only (A-Z lower-cased when
    ``lower``), so equal words hash equally in every task.
    """

    def __init__(self, texts: Iterable[str | None], separators: bytes = SPACES, lower: bool = True):
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        sep = bytes([separators[0]])
        buf = np.frombuffer(sep.join(raw) + sep, np.uint8)
        ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64) if raw else np.zeros(0, np.int64)
        is_word, value = _class_table(separators, lower)
        word = is_word[buf]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
        lo, hi = edge[0::2], edge[1::2]
        self.lo, self.hi = lo, hi
        n = len(buf)
        powers, inverse = _powers(n)
        total = np.zeros(n + 1, U64)
        np.cumsum(value[buf] * powers[:n], out=total[1:])
        self.hash = mix((total[hi] - total[lo]) * inverse[lo] + (hi - lo).astype(U64))
        self.doc = np.searchsorted(ends, lo, side="right")
        self.start = np.searchsorted(self.doc, np.arange(len(raw) + 1))

    def counts(self) -> np.ndarray:
        return np.diff(self.start)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, text index) of every run of ``k`` words; a text with fewer
        words (but at least one) gives a single shorter run."""
        n = len(self.hash)
        out = np.zeros(n, U64)
        last = self.start[self.doc + 1] if n else np.zeros(0, np.int64)
        first = self.start[self.doc] if n else np.zeros(0, np.int64)
        at = np.arange(n)
        factor = 1
        for i in range(k):
            inside = at + i < last
            out[inside] += self.hash[(at + i)[inside]] * U64(factor)
            factor = factor * 0xD6E8FEB86659FD93 % (1 << 64)
        keep = (at + k <= last) | (at == first)
        return mix(out[keep] + U64(k)), self.doc[keep]


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's strings, null as the empty string."""
    return ["" if t is None else t for t in batch.column(column).to_pylist()]
