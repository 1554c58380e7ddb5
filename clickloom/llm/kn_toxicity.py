"""Toxicity by two class-conditional Kneser-Ney models.

For each class a word-bigram model is interpolated down to a lower order both
classes share:

    P_c(w | v) = (1 - l(v)) * disc(c_c(v, w)) / sum disc(c_c(v, .)) + l(v) * P_c(w)
    P_c(w)     = (1 - l)    * disc(c_c(w))    / sum disc(c_c(.))    + l    * P_s(w)

``disc`` takes off the absolute discount D, ``P_s`` is the Kneser-Ney continuation
probability (distinct left neighbours, counted without labels over all
documents). The backoff weights are those of both classes' counts together,
l(v) = D * N1+(v .) / c(v .), so that a class does not back off more for having
fewer texts; every distribution sums to one. What may be chance backs off to
shared counts altogether: unless the split between the classes is beyond chance
both classes' count is halved, for a pair split like its second word, and how far
beyond is chosen, at every size, by the likelihood of texts the models have not
counted. An expression
counts once a class of near-duplicates, so that a family of near copies is no
evidence for what it repeats.

The score of a text is the difference of its two length-normalised
log-likelihoods - over the whole text and over its most toxic run of
``RUN_WORDS`` words - put through a logistic curve fitted on labelled texts the
models have not counted.

Fitting uses a bounded sample: at most about ``PER_CLASS`` labelled texts a
class, chosen by a hash of doc_id, whole texts. Near-duplicates go to the same
part of it. Counting runs in Spark; only n-grams met at least ``MIN_COUNT``
times, the continuation counts of their words, and three numbers a model of each
text kept for the curve reach the driver. Every text is scored whole. Labels of held-out rows, crc32(doc_id) mod 3 = 1, are never read by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import probminhash
from clickloom.llm.textops import PUNCTUATION, U64, Words, map_batches, mix, texts_of
from clickloom.session import cut_lineage

#: labelled texts a class the models and the curve are fitted on, at most (in the mean)
PER_CLASS = 3000
#: n-grams met less often in the sample have no entry of their own
MIN_COUNT = 2
#: words of the run whose mean counts beside the text's
RUN_WORDS = 40
#: the absolute discount
DISCOUNT = 0.75
#: evidence (about chi-square) below which a count is shared by the classes; the
#: likelihood of the texts kept for the curve chooses
EVIDENCE = (6.0, 10.0, 20.0, 40.0)
#: distinct pairs a task holds before it hands them on
PAIRS_HELD = 1 << 21
#: bits of a left neighbour's hash that tell it from a word's others
LEFT_BITS = 40
#: share of the sample kept for the curve, 1 in so many
CURVE_PART = 4
THRESHOLD = 0.7
#: weights (constant, mean, best run) when there are no labels to fit them on
NO_CURVE = np.array([-2.0, 1.0, 1.0])


def held_out():
    """Rows whose labels are not learnt from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1


def _pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(v * U64(0x9FB21C651E98DF25) + w)


@dataclass
class Model:
    """Log-ratio tables, sorted by hash, and the curve's weights. ``context_ratio``
    is that of each word's backoff weight, ``unknown`` that of a word not in ``word``."""

    word: np.ndarray
    word_ratio: np.ndarray
    context_ratio: np.ndarray
    unknown: float
    pair: np.ndarray
    pair_ratio: np.ndarray
    weights: np.ndarray

    def ratios(self, words: Words) -> np.ndarray:
        """log P_toxic - log P_ordinary of each word after its predecessor."""
        h = words.hash
        if not len(h) or not len(self.word):
            return np.full(len(h), self.unknown)
        place = np.minimum(np.searchsorted(self.word, h), len(self.word) - 1)
        known = self.word[place] == h
        out = np.where(known, self.word_ratio[place], self.unknown)
        follows = np.flatnonzero((words.doc[1:] == words.doc[:-1]) & known[:-1]) + 1
        out[follows] += self.context_ratio[place[follows - 1]]
        if len(self.pair):
            both = follows[known[follows]]
            key = _pair(h[both - 1], h[both])
            at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
            found = self.pair[at] == key
            out[both[found]] = self.pair_ratio[at[found]]
        return out

    def features(self, texts: list[str]) -> np.ndarray:
        words = Words(texts, PUNCTUATION, True)
        r = self.ratios(words)
        total = np.concatenate(([0.0], np.cumsum(r)))
        lo, hi = words.start[:-1], words.start[1:]
        n = hi - lo
        mean = (total[hi] - total[lo]) / np.maximum(n, 1)
        best = np.full(len(texts), -np.inf)
        if len(r):
            first = np.arange(len(r))
            last = np.minimum(first + RUN_WORDS, hi[words.doc])
            # a run at a text's end starts early enough to be whole, if the text is that long
            first = np.maximum(np.minimum(first, last - RUN_WORDS), lo[words.doc])
            np.maximum.at(best, words.doc, (total[last] - total[first]) / RUN_WORDS)
        best[n == 0] = 0.0
        return np.column_stack((np.ones(len(texts)), 100 * mean, RUN_WORDS * best))

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.weights, -40, 40)))


def _has(keys: np.ndarray, h: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(h), bool)
    return keys[np.minimum(np.searchsorted(keys, h), len(keys) - 1)] == h


def _own(counts: np.ndarray, evidence: float) -> np.ndarray:
    """Counts [entry, class] that a class may call its own: where the split
    between the classes is no chance (squared difference over sum, about
    chi-square, reaches ``evidence``) the class's, else half of both classes'."""
    both = counts.sum(1)
    split = (counts[:, 0] - counts[:, 1]) ** 2 / np.maximum(both, 1) >= evidence
    return np.where(split[:, None], counts, both[:, None] / 2)


def _own_pairs(counts: np.ndarray, p: np.ndarray, evidence: float) -> np.ndarray:
    """The same for pairs, whose chance split is that of their second word: where
    the likelihood ratio against it stays below ``evidence``, both classes' count
    is split like the word's probabilities ``p`` [pair, class]."""
    chance = counts.sum(1, keepdims=True) * p / p.sum(1, keepdims=True)
    surprise = 2 * (counts * np.log(np.where(counts > 0, counts / np.maximum(chance, 1e-300), 1))).sum(1)
    return np.where((surprise >= evidence)[:, None], counts, chance)


def build(words: np.ndarray, uni: np.ndarray, cont: np.ndarray, pairs: np.ndarray, left: np.ndarray, right: np.ndarray,
          bi: np.ndarray, rare: np.ndarray, evidence: float) -> Model:
    """Log-ratio tables from counts. ``words`` sorted hashes with ``uni`` [word,
    class] and ``cont`` (distinct left neighbours); ``pairs`` sorted hashes with
    ``left``/``right`` word hashes and ``bi`` [pair, class]; ``rare`` [word] counts each
    word's other pairs, which have no entry."""
    if not len(words):
        none = np.zeros(0)
        return Model(words, none, none, 0.0, words, none, NO_CURVE)
    p, rest = unigrams(uni, cont, evidence)
    i, j = (np.minimum(np.searchsorted(words, x), len(words) - 1) for x in (left, right))
    there = (words[i] == left) & (words[j] == right)
    i, j = i[there], j[there]
    cond, back = bigrams(i, j, bi[there], rare, p, evidence)
    ratio = lambda x: np.log(x[:, 0]) - np.log(x[:, 1])
    word_ratio, context_ratio, pair_ratio = ratio(p), ratio(back), ratio(cond)
    # a pair that says what its parts say needs no entry
    tells = np.abs(pair_ratio - context_ratio[i] - word_ratio[j]) > 1e-9
    return Model(words, word_ratio, context_ratio, float(np.log(rest[0]) - np.log(rest[1])), pairs[there][tells], pair_ratio[tells], NO_CURVE)


def unigrams(uni: np.ndarray, cont: np.ndarray, evidence: float) -> tuple[np.ndarray, np.ndarray]:
    """P_c(w) [word, class], and what of each class backs off to P_s."""
    shared = np.maximum(cont, 1) / np.maximum(cont, 1).sum()
    both = uni.sum(1)
    rest = 1 - np.maximum(both - DISCOUNT, 0).sum() / max(both.sum(), 1e-300)
    kept = np.maximum(_own(uni, evidence) - DISCOUNT, 0)
    total = kept.sum(0)
    # a class that keeps nothing backs off whole
    back = np.where(total > 0, rest, 1.0)
    return (1 - back) * kept / np.where(total > 0, total, 1) + back * shared[:, None], back


def bigrams(i: np.ndarray, j: np.ndarray, bi: np.ndarray, rare: np.ndarray, p: np.ndarray, evidence: float) -> tuple[np.ndarray, np.ndarray]:
    """P_c(w | v) of the pairs (v, w), numbers ``i`` and ``j`` of words, and what of
    each class backs off after v [word, class]. Pairs without an entry (``rare``:
    their counts after each word) belong to their context and back off whole."""
    both, n = bi.sum(1), len(p)
    context = np.bincount(i, both, n) + rare
    rest = 1 - np.bincount(i, np.maximum(both - DISCOUNT, 0), n) / np.where(context > 0, context, 1)
    kept = np.maximum(_own_pairs(bi, p[j], evidence) - DISCOUNT, 0)
    total = np.column_stack([np.bincount(i, kept[:, c], n) for c in (0, 1)])
    back = np.where(total > 0, rest[:, None], 1.0)
    return (1 - back[i]) * kept / np.where(total > 0, total, 1)[i] + back[i] * p[j], back


def fit_curve(x: np.ndarray, y: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic weights by Newton steps with a small ridge, classes weighted
    alike and texts within them by ``share``, and the mean loss."""
    weight = 0.5 * share / np.where(y == 1, share[y == 1].sum(), share[y == 0].sum())
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6, 1e-3, 1e-3])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge @ w
        step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, grad)
        w = w - np.clip(step, -2, 2)
    p = np.clip(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))), 1e-9, 1 - 1e-9)
    return w, float(-(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum())


def sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``text, toxic, family, curve`` of a bounded sample of the rows that may be
    learnt from: about ``per_class`` a class, by a hash of doc_id. ``family`` is
    the text's class of near-duplicates; all of it is in the curve part or none."""
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.lit("toxicity sample"), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    # as many texts of one class as of the other: a count then means the same in both
    n = min(per_class, sizes.get(0, 0), sizes.get(1, 0))
    share = F.when(F.col("toxic") == 1, n / max(1, sizes.get(1, 0))).otherwise(n / max(1, sizes.get(0, 0)))
    chosen = known.where(draw < share).select(F.col("doc_id").alias("_id"), "toxic")
    # at most about 2 * per_class ids: a proven bound for the broadcast
    texts = (docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
             .select(F.coalesce("text", F.lit("")).alias("text"), "toxic")
             .groupBy("text").agg(F.max("toxic").alias("toxic")))
    # numbered by the text itself: rows of one doc_id may differ
    texts = cut_lineage(texts.withColumn("doc_id", F.xxhash64("text")))
    family = probminhash.classes(texts).select("doc_id", F.col("class_id").alias("family"))
    curve = F.pmod(F.xxhash64(F.lit("curve part"), "family"), F.lit(CURVE_PART)) == 0
    return texts.join(family, "doc_id").select("text", "toxic", "family", curve.alias("curve"))


def count(texts: DataFrame) -> DataFrame:
    """n-gram counts ``v, w, t, o`` (toxic and ordinary) of ``text, toxic,
    family``; v is null for single words. An n-gram counts once a family and
    label, so that neither a text which repeats itself nor a family of near
    copies has more say than another text."""
    schema = pa.schema([("v", pa.int64()), ("w", pa.int64()), ("toxic", pa.int32()), ("family", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label = np.array(b.column("toxic").to_pylist(), np.int32)
            family = np.array(b.column("family").to_pylist(), np.int64)
            words = Words(texts_of(b), PUNCTUATION, True)
            h = words.hash.view(np.int64)
            follows = np.flatnonzero(words.doc[1:] == words.doc[:-1]) + 1
            one = np.unique(np.column_stack((words.doc, h)), axis=0)
            two = np.unique(np.column_stack((words.doc[follows], h[follows - 1], h[follows])), axis=0)
            for doc, v, w in ((one[:, 0], pa.nulls(len(one), pa.int64()), one[:, 1]), (two[:, 0], pa.array(two[:, 1]), two[:, 2])):
                yield pa.RecordBatch.from_arrays([v, pa.array(w), pa.array(label[doc]), pa.array(family[doc])], schema=schema)

    parts = map_batches(texts.select("text", F.col("toxic").cast("int").alias("toxic"), "family"), run,
                        "v long, w long, toxic int, family long")
    return (parts.distinct().groupBy("v", "w").agg(F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("t"),
                                                   F.sum(F.when(F.col("toxic") == 0, 1).otherwise(0)).alias("o")))


def continuations(docs: DataFrame, words: np.ndarray) -> DataFrame:
    """``w, cont``: the number of distinct words before each of ``words`` (sorted
    hashes; ``w`` is the place there) over all rows of ``docs``. A pair crosses
    the exchange as one number: the place, above it ``LEFT_BITS`` of the hash of the
    word before (a million different ones collide once, and count one less)."""
    bits = max(1, len(words) - 1).bit_length()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for b in batches:
            said = Words(texts_of(b), PUNCTUATION, True)
            at = np.flatnonzero(said.doc[1:] == said.doc[:-1]) + 1
            at = at[_has(words, said.hash[at])]
            place = np.searchsorted(words, said.hash[at]).astype(U64)
            held.append(np.unique(((said.hash[at - 1] & U64((1 << LEFT_BITS) - 1)) << U64(bits)) | place))
            if sum(map(len, held)) > PAIRS_HELD:
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(held)).view(np.int64))], ["pair"])
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(held)).view(np.int64))], ["pair"])

    place = F.col("pair").bitwiseAND(F.lit((1 << bits) - 1))
    return (map_batches(docs.select("text"), run, "pair long").distinct()
            .groupBy(place.alias("w")).agg(F.count("*").alias("cont")))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """The model with the evidence and curve of the least loss on the curve part."""
    texts = cut_lineage(sample(docs, labels, per_class))
    counted = texts.where(~F.col("curve"))
    grams = cut_lineage(count(counted))
    often = F.col("t") + F.col("o") >= MIN_COUNT
    single = grams.where(F.col("v").isNull() & often).select("w", "t", "o").toPandas()
    double = grams.where(F.col("v").isNotNull() & often).select("v", "w", "t", "o").toPandas()

    words = single["w"].to_numpy(np.int64).view(U64)
    order = np.argsort(words)
    words, uni = words[order], single[["t", "o"]].to_numpy(float)[order]
    conts = np.zeros(len(words))
    if len(words):
        cont = continuations(docs, words).toPandas()
        conts[cont["w"].to_numpy()] = cont["cont"].to_numpy(float)
    # families of either class may be more: a count then means the same in both
    families = {r["toxic"]: r["n"] for r in counted.groupBy("toxic").agg(F.countDistinct("family").alias("n")).collect()}
    scale = np.array([sum(families.values()) / (2 * families[c]) if len(families) == 2 else 1.0 for c in (1, 0)])
    left, right = double["v"].to_numpy(np.int64).view(U64), double["w"].to_numpy(np.int64).view(U64)
    pairs = _pair(left, right)
    order = np.argsort(pairs)
    bi = double[["t", "o"]].to_numpy(float)
    # what the words' contexts hold beside those pairs
    whole = grams.where(F.col("v").isNotNull() & ~often).groupBy("v").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    whole = whole.join(grams.where(F.col("v").isNull() & often).select(F.col("w").alias("v")), "v", "left_semi").toPandas()
    rare = np.zeros(len(words))
    rare[np.searchsorted(words, whole["v"].to_numpy(np.int64).view(U64))] = whole[["t", "o"]].to_numpy(float) @ scale
    args = words, uni * scale, conts, pairs[order], left[order], right[order], bi[order] * scale, rare
    models = [build(*args, evidence) for evidence in EVIDENCE]
    held = curve_features(texts.where("curve"), models).toPandas()
    y = held["toxic"].to_numpy(float)
    if len(set(y.tolist())) < 2:
        return models[0]
    share = 1 / held.groupby(["family", "toxic"])["toxic"].transform("size").to_numpy(float)
    x = np.array(held["x"].tolist()).reshape(len(held), len(models), -1)
    losses = []
    for m, model in enumerate(models):
        model.weights, loss = fit_curve(x[:, m], y, share)
        losses.append(loss)
    return models[int(np.argmin(losses))]


def curve_features(texts: DataFrame, models: list[Model]) -> DataFrame:
    """``toxic, family, x``: each text's features under every model, one after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            said = texts_of(b)
            x = np.column_stack([m.features(said) for m in models])
            yield pa.RecordBatch.from_arrays([b.column("toxic"), b.column("family"), pa.array(x.tolist(), pa.list_(pa.float64()))], ["toxic", "family", "x"])

    return map_batches(texts.select("text", F.col("toxic").cast("int").alias("toxic"), "family"), run, "toxic int, family long, x array<double>")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text.

    Null and empty texts get the curve's value at no evidence; repeated rows
    give repeated rows; an empty table gives no rows. Without labels of both
    classes the ratios are nothing and every text has the same low score."""
    held = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(held.scores(texts_of(b)), pa.float64())],
                ["doc_id", "held_out", "score"])

    rows = docs.select("doc_id", "text", F.coalesce(held_out(), F.lit(False)).alias("held_out"))
    return (map_batches(rows, run, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def keep_ordinary(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below the threshold."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(model.scores(texts_of(b)) < THRESHOLD))

    return map_batches(docs, run, schema)
