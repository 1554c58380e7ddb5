"""Packing examples into training sequences by vector bin packing.

A sequence has three limits at once: tokens, segments and loss-bearing tokens.
The dot-product heuristic fills one sequence at a time: of the waiting examples
that fit every limit it takes the one whose vector of demands points most in
the direction of what the sequence has left, each dimension weighted by how
scarce it is among the waiting ones. When none fits, the example with the most
tokens is cut to fill what is left, and its rest waits on. A sequence is so
full unless segments or loss run out first.

Each task packs its own partition as it streams by, with a bounded pool of
waiting examples and no shuffle. A sequence that stops short, as those of many
short examples and those at a partition's end do, is cut into sequences whose
lengths are powers of two, which need no padding.

Sequence ids are the partition's number in the high bits and a count in the
low ones. A task that runs again, on a scan of the same files, packs the same
sequences again.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from clickloom.llm.textops import map_batches, texts_of

#: limits of one sequence: tokens, segments, loss-bearing tokens
MAX_TOKENS, MAX_SEGMENTS, MAX_LOSS = 2048, 64, 2048
#: a sequence is cut rather than padded beyond 1 in so many of its tokens
PADDING_PART = 64
#: examples and tokens that may wait in a task
POOL_EXAMPLES, POOL_TOKENS = 256, 1 << 20
#: id put after each document
END_ID = 1
#: low bits of a sequence id that count within a partition
COUNT_BITS = 33

_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@dataclass
class Example:
    """What is left of an example: its ids, and how many of the first n bear loss."""

    doc_id: int | None
    ids: np.ndarray
    loss: np.ndarray
    start: int = 0

    def size(self) -> tuple[int, int]:
        return len(self.ids) - self.start, int(self.loss[-1] - self.loss[self.start])

    def take(self, tokens: int, loss: int) -> int:
        """The most tokens from here within both limits."""
        most = int(np.searchsorted(self.loss, self.loss[self.start] + loss, side="right")) - 1 - self.start
        return max(0, min(tokens, most, len(self.ids) - self.start))


def example(doc_id: int | None, ids: np.ndarray, bears_loss: np.ndarray) -> Example:
    return Example(doc_id, ids, np.concatenate(([0], np.cumsum(bears_loss, dtype=np.int64))))


Piece = tuple[Example, int, int]


class Packer:
    """Turns a stream of examples into sequences, each a list of pieces."""

    def __init__(self, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_LOSS):
        self.limits = np.array([max_tokens, max_segments, max_loss], float)
        self.pool: list[Example] = []
        self.tokens = 0

    def add(self, one: Example) -> Iterator[list[Piece]]:
        self.pool.append(one)
        self.tokens += len(one.ids)
        while len(self.pool) > POOL_EXAMPLES or self.tokens > POOL_TOKENS:
            yield from self._cut(self._fill())

    def _demand(self) -> np.ndarray:
        size = np.array([e.size() for e in self.pool], float)
        return np.column_stack((size[:, 0], np.ones(len(size)), size[:, 1]))

    def _fill(self) -> list[Piece]:
        """One sequence from the pool."""
        demand = self._demand()
        waiting = np.ones(len(self.pool), bool)
        weight = demand.sum(0) / self.limits
        weight /= max(weight.sum(), 1e-9)
        left = self.limits.copy()
        out: list[Piece] = []
        while left[0] >= 1 and left[1] >= 1 and waiting.any():
            fits = waiting & (demand <= left).all(axis=1)
            if fits.any():
                toward = (demand / self.limits) @ (weight * left / self.limits)
                i = int(np.argmax(np.where(fits, toward, -1.0)))
                tokens = int(demand[i, 0])
            else:
                i = int(np.argmax(np.where(waiting, demand[:, 0], -1.0)))
                tokens = self.pool[i].take(int(left[0]), int(left[2]))
                if not tokens:
                    break
            one = self.pool[i]
            out.append((one, one.start, tokens))
            before = one.loss[one.start]
            one.start += tokens
            left -= (tokens, 1, one.loss[one.start] - before)
            demand[i] = one.size()[0], 1, one.size()[1]
            waiting[i] = False
        if not out:
            # a single token bears more loss than the limit allows: it goes alone
            one = self.pool[0]
            out.append((one, one.start, 1))
            one.start += 1
        self.tokens -= sum(n for _, _, n in out)
        self.pool = [e for e in self.pool if e.start < len(e.ids)]
        return out

    def _cut(self, pieces: list[Piece]) -> Iterator[list[Piece]]:
        """The sequence itself if hardly any of it is padding; one that stops short
        (its segments or loss are used up, or nothing waits) is cut at powers of two."""
        total = sum(n for _, _, n in pieces)
        size = int(self.limits[0])
        if size - total <= size // PADDING_PART:
            yield pieces
            return
        while pieces:
            while size > total:
                size = 1 << ((size - 1).bit_length() - 1)
            part, room = [], size
            while room and pieces:
                one, start, n = pieces.pop(0)
                part.append((one, start, min(n, room)))
                if n > room:
                    pieces.insert(0, (one, start + room, n - room))
                room -= min(n, room)
            total -= size
            yield part

    def finish(self) -> Iterator[list[Piece]]:
        """Sequences of what still waits."""
        while self.pool:
            yield from self._cut(self._fill())


def read_encoding(vocabulary: str, added: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ranks, and the added tokens of the vocabulary's JSON form. Those must be
    plain ones: cut out of the text as they stand, white space around them kept."""
    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    with open(added, encoding="utf-8") as form:
        tokens = json.load(form)["added_tokens"]
    for t in tokens:
        if t["lstrip"] or t["rstrip"] or t["single_word"]:
            raise ValueError(f"added token {t['content']!r} takes more of the text than itself")
    return ranks, {t["content"]: t["id"] for t in tokens}


_LOADED: dict[str, tiktoken.Encoding] = {}


def _encoding(pattern: str, ranks: dict[bytes, int], added: dict[str, int]) -> tiktoken.Encoding:
    """One encoder a worker, whatever the number of its tasks."""
    key = hashlib.sha256(repr((pattern, sorted(added.items()))).encode() + b"".join(ranks)).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
    return _LOADED[key]


def pack_examples(rows: Iterator[Example], partition: int, with_ids: bool = False) -> Iterator[pa.RecordBatch]:
    """Pieces of a partition's examples, a few thousand rows a batch."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    columns: list[list] = [[] for _ in names]
    ids: list[np.ndarray] = []
    packer, count = Packer(), 0

    def batch() -> pa.RecordBatch:
        arrays = [pa.array(c, pa.int64()) for c in columns]
        out = pa.RecordBatch.from_arrays([*arrays, *([pa.array(ids, pa.list_(pa.int32()))] if with_ids else [])],
                                         [*names, *(["ids"] if with_ids else [])])
        for c in columns:
            c.clear()
        ids.clear()
        return out

    def write(pieces: list[Piece]) -> None:
        nonlocal count
        offset = 0
        for one, start, n in pieces:
            part = one.ids[start:start + n]
            row = one.doc_id, start, n, zlib.crc32(part.tobytes()), len(one.ids), (partition << COUNT_BITS) + count, offset
            for c, v in zip(columns, row, strict=True):
                c.append(v)
            if with_ids:
                ids.append(part.astype(np.int32))
            offset += n
        count += 1

    for one in rows:
        for pieces in packer.add(one):
            write(pieces)
        if len(columns[0]) >= 2048:
            yield batch()
    for pieces in packer.finish():
        write(pieces)
    if columns[0]:
        yield batch()


def pack_documents(docs: DataFrame, vocabulary: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """All documents in pieces: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` (and the ids themselves with ``with_ids``).

    A document's ids are those of the byte-level BPE of the rank file with the
    added tokens of the JSON form beside it (same name, ``.json``), as the
    tokenizers library gives them without its own special tokens, then
    ``END_ID``; its first id bears no loss. A null or empty text is the end id alone; repeated
    rows are packed one by one; an empty table gives no rows; other columns are
    not read."""
    ranks, added = read_encoding(vocabulary, os.path.splitext(vocabulary)[0] + ".json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(pattern, ranks, added).encode_to_numpy

        def examples() -> Iterator[Example]:
            for b in batches:
                for doc, text in zip(b.column("doc_id").to_pylist(), texts_of(b), strict=True):
                    ids = np.concatenate((encode(text, allowed_special="all").astype("<u4"), np.array([END_ID], "<u4")))
                    bears = np.ones(len(ids), np.int8)
                    bears[0] = 0
                    yield example(doc, ids, bears)

        yield from pack_examples(examples(), TaskContext.get().partitionId(), with_ids)

    return map_batches(docs.select("doc_id", "text"), run, _SCHEMA + (", ids array<int>" if with_ids else ""))
