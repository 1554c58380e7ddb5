"""Collocation mining with an FM-index over word ids in every shard.

Documents are dealt into shards of bounded text by a hash. A shard's texts of
one language become one sequence of word ids with a 0 between pieces, indexed
in both reading directions: suffixes sorted by their first words, the
Burrows-Wheeler column before them, and rank queries on it. A phrase is a pair
of intervals, one in each index; extending it by a word to the left or right is
one rank query in one index and a running count in the other, done for all
phrases of a length at once. Counts are interval lengths; shards' counts are
summed by Spark.

Most phrases are rare, so texts are read twice. First every shard enumerates
words and pairs as hashes: some bits deal them into buckets of bounded size, 32
more tell them apart there. A bucket adds the shards' counts up and hands back
to each shard those of its hashes whose counts sum to ``least``. Then every
shard names its survivors exactly and extends pairs on their left to triples
where both pairs survived: a frequent triple has no rare part. A colliding hash
can only spare a rare phrase, which the exact sums then drop.
"""

from __future__ import annotations

from functools import cached_property
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.textops import U64, bound_batches, mix, texts_of
from clickloom.llm.wordarrays import WordArray
from clickloom.operators.ordering import top_k_per_group
from clickloom.session import cut_lineage

#: occurrences a phrase needs, share of them (of 100) inside a longer phrase that drops it, phrases of a language
LEAST, COVERED, FIRST = 10, 50, 2000
#: words of the longest phrase
LONGEST = 3
#: bytes of text of one shard, and of the texts whose hashes make up one bucket (mean)
SHARD_BYTES, BUCKET_BYTES = 8 << 20, 16 << 20
#: phrases with one part in common that one task joins, about
PHRASES_A_KEY = 1 << 17
#: salts of a language's ranking
TOP_SALTS = 16
SCALE = 1_000_000

BLANKS, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"


class _Column:
    """One direction: the Burrows-Wheeler column of a word-id sequence, its
    suffixes sorted by their first ``depth`` ids, and the mapping of each row to
    that of the suffix one id longer."""

    def __init__(self, ids: np.ndarray, depth: int, size: int):
        n = len(ids)
        tail = np.concatenate((ids, np.zeros(depth, np.int64)))
        key = ids
        for d in range(1, depth):
            if d > 1:
                key = np.unique(key, return_inverse=True)[1]
            key = key * size + tail[d:d + n]
        order = np.argsort(key, kind="stable")
        self.before = np.concatenate((ids[-1:], ids[:-1]))[order]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(ids, minlength=size))))

    @cached_property
    def longer(self) -> np.ndarray:
        """The row of the suffix that begins one id earlier: the rows before
        which a word stands keep their order among that word's suffixes."""
        out = np.empty(len(self.before), np.int64)
        out[np.argsort(self.before, kind="stable")] = np.arange(len(out))
        return out


class Phrases:
    """Phrases of one length: word ids (a column a word) and both intervals."""

    def __init__(self, words: np.ndarray, lo: np.ndarray, back: np.ndarray, count: np.ndarray):
        self.words, self.lo, self.back, self.count = words, lo, back, count

    def of(self, keep: np.ndarray) -> Phrases:
        return Phrases(self.words[keep], self.lo[keep], self.back[keep], self.count[keep])


class BidirectionalIndex:
    """The FM-index of a sequence of word ids 1.. with 0 between pieces, and that
    of the sequence read backwards, for phrases of up to ``depth`` words (the
    extensions of those are counted, but have no intervals)."""

    def __init__(self, ids: np.ndarray, n_words: int, depth: int):
        self.ids, self.n_words, self.depth = ids, n_words, depth

    @cached_property
    def forward(self) -> _Column:
        return _Column(self.ids, self.depth, self.n_words + 1)

    @cached_property
    def backward(self) -> _Column:
        return _Column(self.ids[::-1].copy(), self.depth, self.n_words + 1)

    def words(self) -> Phrases:
        count = np.bincount(self.ids, minlength=self.n_words + 1)
        lo = np.cumsum(count)[:-1]
        return Phrases(np.arange(1, self.n_words + 1)[:, None], lo, lo.copy(), count[1:])

    def _extend(self, column: _Column, p: Phrases, lo: np.ndarray, other: np.ndarray):
        """(phrase, word, interval here, in the other index, count) of every extension."""
        phrase = np.repeat(np.arange(len(lo)), p.count)
        row = np.arange(len(phrase)) - np.repeat(np.cumsum(p.count) - p.count, p.count) + lo[phrase]
        size = self.n_words + 1
        if last := p.words.shape[1] == self.depth:
            key, n = np.unique(phrase * size + column.before[row], return_counts=True)
            at = np.zeros(len(key), np.int64)
        else:
            key, at, n = np.unique(phrase * size + column.before[row], return_index=True, return_counts=True)
        phrase, word = key // size, key % size
        # the other index sorts a phrase's extensions by the word: a running count within the phrase
        above = np.cumsum(n) - n
        above -= above[np.searchsorted(phrase, phrase)]
        real = word > 0
        here = at[real] if last else column.longer[row[at[real]]]
        return phrase[real], word[real], here, other[phrase[real]] + above[real], n[real]

    def left(self, p: Phrases) -> Phrases:
        """Every phrase that is one of ``p`` with a word before it."""
        at, word, lo, back, n = self._extend(self.forward, p, p.lo, p.back)
        return Phrases(np.column_stack((word, p.words[at])), lo, back, n)

    def right(self, p: Phrases) -> Phrases:
        """Every phrase that is one of ``p`` with a word after it."""
        at, word, back, lo, n = self._extend(self.backward, p, p.back, p.lo)
        return Phrases(np.column_stack((p.words[at], word)), lo, back, n)


def _languages(t: pa.Table):
    """(language, its index, its dictionary, hashes of the dictionary) in a shard's texts."""
    langs = t["lang"].to_pylist()
    texts = texts_of(t)
    for lang in sorted(set(langs)):
        found = WordArray([x for x, of in zip(texts, langs, strict=True) if of == lang], BLANKS + BREAKS, BREAKS)
        if not len(found.words):
            continue
        coded = found.words.dictionary_encode()
        # ids in the order of the words: phrases come out sorted, which packs well
        order = pc.sort_indices(coded.dictionary).to_numpy()
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(1, len(order) + 1)
        gaps = np.flatnonzero(np.diff(found.breaks)) + 1
        ids = np.append(np.insert(number[coded.indices.to_numpy()], gaps, 0), 0)
        dictionary = coded.dictionary.take(pa.array(order))
        names = dictionary.to_numpy(zero_copy_only=False)
        seed = pd.util.hash_array(np.array([lang], object), categorize=False)[0]
        yield lang, BidirectionalIndex(ids, len(names), LONGEST - 1), dictionary, mix(pd.util.hash_array(names, categorize=False) ^ seed)


def _hashes(p: Phrases, of_word: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each phrase above 32 bits that tell phrases of it apart."""
    out = np.full(len(p.words), p.words.shape[1], U64)
    for c in range(p.words.shape[1]):
        out = mix(out * U64(0xD6E8FEB86659FD93) + of_word[p.words[:, c] - 1])
    return ((out >> U64(32)) % U64(buckets) << U64(32)) | (out & U64(0xFFFFFFFF))


def _named(p: Phrases, names: pa.Array) -> pa.Array:
    """The phrases, each with an end of line."""
    said = [names.take(pa.array(p.words[:, c] - 1)) for c in range(p.words.shape[1])]
    said[-1] = pc.binary_join_element_wise(said[-1], pa.scalar("", names.type), pa.scalar("\n", names.type))
    return pc.binary_join_element_wise(*said, pa.scalar(" ", names.type)) if len(said) > 1 else said[0]


def _shards(docs: DataFrame, shard_bytes: int) -> tuple[DataFrame, int]:
    """``shard, lang, text`` and the bytes of text; texts in shards by their hash,
    so that a shard is the same rows whenever it is made."""
    lang, text = F.coalesce(F.col("lang").cast("string"), F.lit("und")), F.coalesce("text", F.lit(""))
    rows = docs.select(lang.alias("lang"), text.alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc_id")).where(F.col("text") != "")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, ceil(size / shard_bytes)))).cast("int")
    return rows.select(shard.alias("shard"), "lang", "text"), size


_HASHED = "bucket int, shard int, hashes binary, counts binary"
_SURVIVORS = "shard int, bucket int, hashes binary"
_NAMED = "bucket int, lang string, width long, names binary, counts binary"
_COUNTED = "lang string, phrase string, n long"


def _hashed(buckets: int, least: int):
    """A shard's words and pairs as hashes, a row a bucket; counts of ``least`` and more are all one."""
    def run(t: pa.Table) -> pa.Table:
        found = []
        for _, index, _, of_word in _languages(t):
            words = index.words()
            found += [(_hashes(p, of_word, buckets), p.count) for p in (words, index.right(words))]
        h = np.concatenate([h for h, _ in found]) if found else np.zeros(0, U64)
        n = np.minimum(np.concatenate([n for _, n in found]), least).astype(np.int64) if found else np.zeros(0, np.int64)
        order = np.argsort(h)
        h, n = h[order], n[order].astype("<u1" if least < 256 else "<i8")
        bucket, start = np.unique((h >> U64(32)).astype(np.int32), return_index=True)
        cuts = list(zip(start, [*start[1:], len(h)], strict=True))
        low = (h & U64(0xFFFFFFFF)).astype("<u4")
        return pa.table({"bucket": pa.array(bucket), "shard": pa.array([t["shard"][0].as_py()] * len(bucket), pa.int32()),
                         "hashes": pa.array([low[i:j].tobytes() for i, j in cuts], pa.binary()),
                         "counts": pa.array([n[i:j].tobytes() for i, j in cuts], pa.binary())})

    return run


def _surviving(least: int):
    """Of a bucket's hashes those whose counts sum to ``least``, back to the shards that hold them."""
    def run(t: pa.Table) -> pa.Table:
        low = [np.frombuffer(b, "<u4") for b in t["hashes"].to_pylist()]
        n = np.concatenate([np.frombuffer(b, "<u1" if least < 256 else "<i8") for b in t["counts"].to_pylist()])
        h = np.concatenate(low)
        order = np.argsort(h, kind="stable")
        start = np.flatnonzero(np.concatenate(([True], np.diff(h[order]) != 0)))
        alive = np.empty(len(h), bool)
        alive[order] = np.repeat(np.add.reduceat(n[order].astype(np.int64), start) >= least, np.diff(np.append(start, len(h))))
        ends = np.cumsum([len(x) for x in low])
        kept = [x[alive[e - len(x):e]].tobytes() for x, e in zip(low, ends, strict=True)]
        return pa.table({"shard": t["shard"], "bucket": t["bucket"], "hashes": pa.array(kept, pa.binary())})

    return run


def _counted(buckets: int):
    """A shard's surviving words and pairs and their triples, by name, with
    counts: a packed row for each bucket and language."""
    def run(t: pa.Table, survivors: pa.Table) -> pa.Table:
        alive = np.sort(np.concatenate([np.zeros(0, U64)] + [
            (np.frombuffer(low, "<u4").astype(U64) | U64(b << 32)) for b, low in zip(survivors["bucket"].to_pylist(), survivors["hashes"].to_pylist(), strict=True)]))
        out = []
        for lang, index, names, of_word in _languages(t) if len(t) else ():
            words = index.words()
            total = words.count.sum(keepdims=True)
            pairs = index.right(words)
            words, pairs = (p.of(_member(_hashes(p, of_word, buckets), alive)) for p in (words, pairs))
            del index.backward
            triples = index.left(pairs)
            size = len(names) + 1
            known = pairs.words[:, 0] * size + pairs.words[:, 1]
            triples = triples.of(_member(triples.words[:, 0] * size + triples.words[:, 1], np.sort(known)))
            triples = triples.of(np.lexsort(triples.words.T[::-1]))
            found = [words, pairs, triples]
            bucket = np.concatenate([np.zeros(1, U64), *(_hashes(p, of_word, buckets) >> U64(32) for p in found)])
            phrases = pa.concat_arrays([pa.array(["\n"], names.type), *(_named(p, names) for p in found)])
            order = np.argsort(bucket, kind="stable")
            phrases = phrases.take(pa.array(order))
            ends = np.frombuffer(phrases.buffers()[1], np.int64, len(phrases) + 1)
            text = memoryview(phrases.buffers()[2])
            n = np.concatenate([total, *(p.count for p in found)])[order].astype("<i4")
            held, start = np.unique(bucket[order], return_index=True)
            for b, i, j in zip(held.tolist(), start, [*start[1:], len(n)], strict=True):
                out.append((b, lang, int(ends[j] - ends[i]), pa.compress(text[ends[i]:ends[j]], "zstd", asbytes=True), pa.compress(n[i:j].tobytes(), "zstd", asbytes=True)))
        types = (pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, ty) for c, ty in zip(zip(*out, strict=True) if out else [[]] * 5, types, strict=True)],
                        names=["bucket", "lang", "width", "names", "counts"])

    return run


def _summed(least: int):
    """A bucket's phrases with the sums of their counts, those below ``least`` left out."""
    def run(t: pa.Table) -> pa.Table:
        parts = []
        for lang in sorted(set(t["lang"].to_pylist())):
            own = t.filter(pc.equal(t["lang"], lang))
            text = np.frombuffer(b"".join(pa.decompress(b, w, "zstd", asbytes=True) for b, w in zip(own["names"].to_pylist(), own["width"].to_pylist(), strict=True)), np.uint8)
            ends = np.concatenate(([0], np.flatnonzero(text == 10) + 1))
            said = [np.count_nonzero(text[e - w:e] == 10) for e, w in zip(np.cumsum(own["width"].to_numpy()), own["width"].to_numpy(), strict=True)]
            n = np.frombuffer(b"".join(pa.decompress(b, 4 * k, "zstd", asbytes=True) for b, k in zip(own["counts"].to_pylist(), said, strict=True)), "<i4")
            phrases = pa.Array.from_buffers(pa.large_string(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(text)])
            total = pa.table({"phrase": phrases, "n": n.astype(np.int64)}).group_by("phrase").aggregate([("n", "sum")])
            total = total.filter(pc.or_(pc.greater_equal(total["n_sum"], least), pc.equal(total["phrase"], "\n")))
            parts.append(pa.table({"lang": pa.array([lang] * len(total), pa.string()), "phrase": pc.utf8_rtrim(total["phrase"], "\n").cast(pa.string()), "n": total["n_sum"]}))
        return pa.concat_tables(parts)

    return run


def _member(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(values), bool)
    return ascending[np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)] == values


def phrase_counts(docs: DataFrame, least: int = LEAST, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``lang, phrase, size, n``: words and phrases of two and three words with at
    least ``least`` occurrences, and under size 0 a language's number of words."""
    bound_batches(docs.sparkSession)
    shards, size = _shards(docs, shard_bytes)
    buckets = max(1, ceil(size / BUCKET_BYTES))
    hashed = shards.groupBy("shard").applyInArrow(_hashed(buckets, least), _HASHED)
    survivors = hashed.groupBy("bucket").applyInArrow(_surviving(least), _SURVIVORS)
    found = shards.groupBy("shard").cogroup(survivors.groupBy("shard")).applyInArrow(_counted(buckets), _NAMED)
    # the number of a language's words is in bucket 0 under the empty phrase
    summed = found.groupBy("bucket").applyInArrow(_summed(least), _COUNTED)
    size = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return summed.withColumn("size", size).select("lang", "phrase", "size", "n")


def _with_part(cuts: DataFrame, part: DataFrame) -> DataFrame:
    """``cuts`` with the count of their part. A frequent word begins or ends very
    many phrases: parts with more than ``PHRASES_A_KEY`` are salted, alone."""
    salts = (F.col("load") / PHRASES_A_KEY).cast("int") + 1
    load = cuts.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("load")).where(F.col("load") > PHRASES_A_KEY).select("lang", "part", salts.alias("salts"))
    load = cut_lineage(load)  # one row for every PHRASES_A_KEY rows of cuts at most
    rows = cuts.join(load, ["lang", "part"], "left").withColumn("salt", F.pmod(F.xxhash64("phrase"), F.coalesce("salts", F.lit(1))).cast("int"))
    copies = part.join(load, ["lang", "part"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
    return rows.drop("salts").join(copies.drop("salts"), ["lang", "part", "salt"]).drop("salt")


def mine(docs: DataFrame, least: int = LEAST, covered: int = COVERED, first: int = FIRST, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``first`` phrases of
    two and three words.

    a counts the phrase, l and r its two parts at the cut with the lowest score
    ``SCALE * a * a div (l * r)`` (the earliest such cut), n the language's words. A phrase
    goes when at least ``covered`` of 100 of its occurrences lie in one longer
    candidate. Order: score and a descending, phrase by its bytes. A null lang
    is ``und``; null and empty texts have no words; repeated rows count as often
    as they are there; an empty table gives no rows. Only doc_id, lang and
    text are read."""
    counts = cut_lineage(phrase_counts(docs, least, shard_bytes))
    part = counts.where(F.col("size").between(1, LONGEST - 1)).select("lang", F.col("phrase").alias("part"), F.col("n").alias("part_n"))
    words = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1))
    cuts = counts.where(F.col("size") > 1).select("lang", "phrase", "size", F.col("n").alias("a"), cut.alias("k"))
    cuts = cuts.withColumns({"left": F.array_join(F.slice(words, F.lit(1), F.col("k")), " "),
                             "right": F.array_join(F.slice(words, F.col("k") + 1, F.col("size")), " ")})
    for side, n in (("left", "l"), ("right", "r")):
        cuts = _with_part(cuts.withColumnRenamed(side, "part"), part).withColumnsRenamed({"part": side, "part_n": n})
    score = F.expr(f"(cast({SCALE} AS decimal(7,0)) * cast(a AS decimal(15,0)) * cast(a AS decimal(15,0))) div (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))")
    lowest = cuts.select("lang", "phrase", "size", F.struct(score.alias("score"), "k", "a", "l", "r").alias("c")).groupBy("lang", "phrase", "size").agg(F.min("c").alias("c"))
    longer = counts.where(F.col("size") == LONGEST).select("lang", "n", F.explode(F.array(
        F.array_join(F.slice(words, 1, LONGEST - 1), " "), F.array_join(F.slice(words, 2, LONGEST - 1), " "))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("n").alias("inside"))
    stays = F.col("inside").isNull() | (100 * F.col("inside") < covered * F.col("c.a"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").where(stays).select("lang", "phrase", "c.a", "c.l", "c.r", "c.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may hold most phrases: the first of each of its salts, then of those
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(TOP_SALTS)))
    ranked = top_k_per_group(top_k_per_group(salted, ["lang", "salt"], order, first, rank_col=None), "lang", order, first, rank_col="rank")
    total = counts.where(F.col("size") == 0).select("lang", "n")
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
