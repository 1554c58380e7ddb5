"""Near-duplicates by ProbMinHash signatures, banding and exact verification.

Elements are the five-word shingles of a text (lower-cased), weighted by
1 + ln(count). For every element exponential waiting times at the rate of its
weight produce arrivals, each in a random one of ``SLOTS`` slots; a slot keeps
the element of its earliest arrival. An element stops as soon as its next
arrival is later than every slot's earliest, so long texts need little more
than one arrival an element. Two texts agree in a slot with the probability
Jaccard similarity of their weighted shingles.

Links are judged by plain sets, so a text that repeats a passage is signed a
second time with all weights 1; the bands of both signatures are its keys, and
those of a text without repeats, whose signatures are equal, stand for both.
Texts that agree in all slots of a band are candidates; a pair is a link when
the Jaccard similarity of its shingle sets, computed exactly, is at least
``SIMILAR`` / ``OF``. Classes are the components of the links.

Scale: texts of equal words first fall together as one content. A band's bucket
is compared in two steps, neither of which lists its pairs. First every member
meets the bucket's leader (the least id, from a grouped minimum) in a join that
splits large keys. What that leaves in more than one class is dealt in blocks:
a bucket of m members gives about (m / ``BLOCK``) ** 2 / 2 groups of two blocks
each, whose shingle sets are intersected by one matrix product a group, and a
group returns only links between classes it does not yet know to be connected.
Every candidate pair is so either compared or already known to be of one class,
whatever a bucket's size, and no task holds a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.components import components
from clickloom.llm.textops import SPACES, U64, Words, map_batches, mix, texts_of
from clickloom.session import cut_lineage

SHINGLE = 5
#: least Jaccard similarity of a link, as a fraction
SIMILAR, OF = 4, 5
#: documents of a block, shingles of a block (in the mean), columns of a matrix product
BLOCK, BLOCK_SHINGLES, COLUMNS = 512, 500_000, 8192
#: at similarity 0.8 a pair misses every band with probability 5e-5
BANDS, ROWS = 25, 5
SLOTS = BANDS * ROWS


def signatures(element: np.ndarray, owner: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """[text, slot] element hashes; ``element`` i belongs to text ``owner`` i."""
    first = np.full(n * SLOTS, np.inf)
    winner = np.zeros(n * SLOTS, U64)
    last = np.full(n, np.inf)
    at = np.arange(len(element))
    time = np.zeros(len(element))
    arrival = 0
    while len(at):
        arrival += 1
        draw = mix(element[at] + U64(arrival * 0x9E3779B97F4A7C15 % (1 << 64)))
        time[at] -= np.log(((draw >> U64(11)).astype(float) + 0.5) / (1 << 53)) / weight[at]
        at = at[time[at] < last[owner[at]]]
        slot = (mix(element[at] ^ U64(arrival * 0xD6E8FEB86659FD93 % (1 << 64))) % U64(SLOTS)).astype(np.int64)
        cell = owner[at] * SLOTS + slot
        np.minimum.at(first, cell, time[at])
        won = first[cell] == time[at]
        winner[cell[won]] = element[at[won]]
        last = first.reshape(n, SLOTS).max(axis=1)
    return winner.reshape(n, SLOTS)


def band_keys(signed: np.ndarray) -> np.ndarray:
    """[text, band] keys of signatures [text, slot]."""
    signed = signed.reshape(len(signed), BANDS, ROWS)
    keys = np.zeros((len(signed), BANDS), U64) + np.arange(1, BANDS + 1, dtype=U64)
    for r in range(ROWS):
        keys = mix(keys + signed[:, :, r])
    return keys


def _elements(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (shingle, text) with counts, by text."""
    shingle, doc = words.shingles(SHINGLE)
    key = mix(shingle + doc.astype(U64) * U64(0x9E3779B97F4A7C15))
    _, at, count = np.unique(key, return_index=True, return_counts=True)
    order = np.argsort(at)
    return shingle[at[order]], doc[at[order]], count[order]


_SIGNED = "doc_id long, c1 long, c2 long, n long, bands array<long>"


def sign(docs: DataFrame) -> DataFrame:
    """doc_id, the words' digest (c1, c2), the number of distinct shingles, band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = texts_of(b)
            words = Words(texts, SPACES, True)
            k = len(texts)
            place = (np.arange(len(words.hash)) - words.start[words.doc]).astype(U64)
            digest = []
            for a, c in ((0xA0761D6478BD642F, 0xE7037ED1A0B428DB), (0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)):
                total = np.concatenate((np.zeros(1, U64), np.cumsum(mix(words.hash * U64(a | 1) + place * U64(c)), dtype=U64)))
                digest.append((total[words.start[1:]] - total[words.start[:-1]]).view(np.int64))
            element, owner, count = _elements(words, k)
            keys = band_keys(signatures(element, owner, 1 + np.log(count), k))
            n = np.bincount(owner, minlength=k)
            bands = [row if m else [] for row, m in zip(keys.view(np.int64), n, strict=True)]
            # with all weights 1 only texts that repeat a shingle are signed otherwise
            again = np.unique(owner[count > 1])
            if len(again):
                part = np.isin(owner, again)
                plain = signatures(element[part], np.searchsorted(again, owner[part]), np.ones(part.sum()), len(again))
                for i, row in zip(again, band_keys(plain).view(np.int64), strict=True):
                    bands[i] = np.union1d(bands[i], row)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(digest[0]), pa.array(digest[1]), pa.array(n),
                                              pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "c1", "c2", "n", "bands"])

    return map_batches(docs.select("doc_id", "text"), run, _SIGNED)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``doc, shingles array<int>``: 32 bits of every distinct shingle's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = texts_of(b)
            words = Words(texts, SPACES, True)
            element, owner, _ = _elements(words, len(texts))
            low = np.unique((owner.astype(U64) << U64(32)) | (element & U64(0xFFFFFFFF)))
            ends = np.searchsorted(low, np.arange(len(texts) + 1, dtype=U64) << U64(32))
            low = low.astype(np.uint32).view(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(low))],
                                             ["doc", "shingles"])

    return map_batches(docs.select("doc", "text"), run, "doc long, shingles array<int>")


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar enough."""
    one = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(one, "a").join(two, "b")
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    union = F.size("sa") + F.size("sb") - common
    return both.where(OF * common >= SIMILAR * union).select("a", "b")


def block_links(doc: np.ndarray, label: np.ndarray, block: np.ndarray, shingles: pa.ListArray) -> list[tuple[int, int]]:
    """Links between rows of different blocks (of one block, if there is only
    one) that connect classes not connected yet, by exact similarity."""
    n = len(doc)
    ends = np.asarray(shingles.offsets) - shingles.offsets[0].as_py()
    size = np.diff(ends)
    _, column, count = np.unique(np.asarray(shingles.flatten()), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), size)
    # columns of shingles that two rows share, numbered anew
    shared = count > 1
    number = np.cumsum(shared) - 1
    use = shared[column]
    row, column = row[use], number[column[use]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((n, n), np.float32)
    for at in range(0, int(shared.sum()), COLUMNS):
        lo, hi = np.searchsorted(column, (at, at + COLUMNS))
        part = np.zeros((n, min(COLUMNS, int(shared.sum()) - at)), np.float32)
        part[row[lo:hi], column[lo:hi] - at] = 1
        common += part @ part.T
    common = common.astype(np.int64)
    alike = OF * common >= SIMILAR * (size[:, None] + size[None, :] - common)
    alike &= label[:, None] != label[None, :]
    if block.min() != block.max():
        alike &= block[:, None] != block[None, :]
    into: dict[int, int] = {}

    def top(x: int) -> int:
        while into.get(x, x) != x:
            x = into[x]
        return x

    out = []
    for i, j in np.argwhere(np.triu(alike)):
        a, b = top(int(label[i])), top(int(label[j]))
        if a != b:
            into[max(a, b)] = min(a, b)
            out.append((int(doc[i]), int(doc[j])))
    return out


def _compare_blocks(state: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) inside the buckets of ``state`` (key, doc, n, label)."""
    sized = state.groupBy("key").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    rows = state.join(sized, "key").join(sets, "doc").withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    dealt = rows.select("key", "doc", "label", "shingles", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "doc", "label", "block", "shingles")

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids = [group.column(c).to_numpy() for c in ("doc", "label", "block")]
        found = block_links(*ids, group.column("shingles").chunk(0)) if group.num_rows > 1 else []
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return dealt.groupBy("key", "lo", "hi").applyInArrow(run, "a long, b long").distinct()


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, content_id, n_shingles`` of every row of ``docs``.

    class_id is the least doc_id of the text's class, content_id the least of
    those with the same words. Texts without a word (null, empty, white space)
    are one content; a text of fewer than five words is a single shingle.
    Repeated rows get the same class. A row without doc_id takes the class of
    its content, null if no other row has it. An empty table gives no rows;
    other columns are not read."""
    signed = cut_lineage(sign(docs))
    contents = cut_lineage(signed.where(F.col("doc_id").isNotNull()).groupBy("c1", "c2")
                           .agg(F.min(F.struct("doc_id", "n", "bands")).alias("m"))
                           .select("c1", "c2", F.col("m.doc_id").alias("doc"), F.col("m.n").alias("n"), F.col("m.bands").alias("bands")))
    members = contents.select(F.explode("bands").alias("key"), "doc", "n")
    shared = members.groupBy("key").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where(F.col("least") < F.col("most"))
    members = cut_lineage(members.join(shared.select("key"), "key"))
    labels = _label(docs, members)
    known = contents.select("c1", "c2", F.col("doc").alias("id"))
    if labels is not None:
        known = known.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    else:
        known = known.withColumn("label", F.col("id"))
    known = known.select("c1", "c2", F.col("label").alias("class_id"), F.col("id").alias("content_id"))
    return (signed.select("doc_id", "c1", "c2", F.col("n").alias("n_shingles")).join(known, ["c1", "c2"], "left")
            .select("doc_id", "class_id", "content_id", "n_shingles"))


def _label(docs: DataFrame, members: DataFrame) -> DataFrame | None:
    """``id, label`` of linked contents, from the buckets' members (key, doc, n)."""
    if members.isEmpty():
        return None
    wanted = members.select("doc").distinct()
    texts = docs.select(F.col("doc_id").alias("doc"), "text").join(wanted, "doc", "left_semi")
    sets = cut_lineage(shingle_sets(texts.dropDuplicates(["doc"])))
    # every member against its bucket's leader
    leaders = members.groupBy("key").agg(F.min(F.struct("doc", "n")).alias("m")).select("key", F.col("m.doc").alias("b"), F.col("m.n").alias("m"))
    fits = (F.col("doc") != F.col("b")) & (OF * F.least("n", "m") >= SIMILAR * F.greatest("n", "m"))
    pairs = members.join(leaders, "key").where(fits).select(F.col("doc").alias("a"), "b").distinct()
    links = cut_lineage(_links(pairs, sets))
    labels = None if links.isEmpty() else components(links)
    # what is left in a bucket, its leader aside, with more than one class in it
    rest = members.join(leaders.select("key", F.col("b").alias("doc")), ["key", "doc"], "left_anti")
    if labels is None:
        rest = rest.withColumn("label", F.col("doc"))
    else:
        rest = rest.join(labels.select(F.col("id").alias("doc"), "label"), "doc", "left").withColumn("label", F.coalesce("label", "doc"))
    rest = cut_lineage(rest)
    mixed = rest.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where(F.col("lo") < F.col("hi")).select("key")
    more = cut_lineage(_compare_blocks(rest.join(mixed, "key"), sets))
    return labels if more.isEmpty() else _merge(labels, more)


def _merge(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels after the new links."""
    if labels is None:
        return components(links)
    ends = links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id"))).distinct()
    old = ends.join(labels, "id", "left").select("id", F.coalesce("label", "id").alias("label"))
    old = cut_lineage(old)
    edges = (links.join(old.select(F.col("id").alias("a"), F.col("label").alias("la")), "a")
             .join(old.select(F.col("id").alias("b"), F.col("label").alias("lb")), "b")
             .where(F.col("la") != F.col("lb")).select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct())
    merged = components(edges).select(F.col("id").alias("label"), F.col("label").alias("into"))
    every = labels.unionByName(old.join(labels, "id", "left_anti"))
    return cut_lineage(every.join(merged, "label", "left").select("id", F.coalesce("into", "label").alias("label")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their class (the least
    doc_id), and rows without doc_id."""
    gone = classes(docs).where(F.col("doc_id") != F.col("class_id")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id", "text"]).select(*docs.columns)
