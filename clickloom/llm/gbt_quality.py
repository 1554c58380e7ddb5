"""Document quality: counted rules, then gradient-boosted trees over document
statistics.

The trees are grown here, on a bounded sample of labelled rows, by histograms
of ``BINS`` quantile bins and logistic loss. Chosen features are monotone: more
symbols, repeats, capitals or repeated lines never raise a text's score; a
split that would is not made, and the bounds it sets pass to its children. The
grown forest is flattened into numpy node arrays (feature, threshold, children,
value); scoring walks all rows down one level at a time.

Fitting reads at most about ``PER_CLASS`` labelled texts a class, whole texts,
chosen by a hash of doc_id; the statistics of every text are taken over the
whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.textops import SPACES, U64, Words, map_batches, mix, texts_of

#: labelled texts a class the trees are grown on, at most (in the mean)
PER_CLASS = 4000
TREES, DEPTH, RATE, BINS = 60, 3, 0.2, 32
#: regularisation: added to a node's second derivatives, and the least of them in a leaf
RIDGE, LEAST_WEIGHT = 1.0, 2.0
SYMBOLS = b"#*$%&|<>"
WINDOW = 5

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: features with the sign of their effect on the score (0: free)
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "capital_share": -1,
    "digit_share": 0, "mark_share": 0, "bang_share": -1, "distinct_share": 0, "top_word_share": -1, "line_words": 0,
    "adjacent_repeat_share": -1,
}

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, quality_score double")


def _per_text(flags: np.ndarray, start: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[start[1:]] - total[start[:-1]]


def _dup_lines(text: str) -> int:
    seen: set[str] = set()
    dups = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            if line in seen:
                dups += 1
            else:
                seen.add(line)
    return dups


def statistics(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(counts [text, BASE], features [text, FEATURES]) of whole texts."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    words = Words(texts, SPACES, False)
    n = words.counts()
    k = len(texts)
    doc, h = words.doc, words.hash
    buf = np.frombuffer(b"".join(raw), np.uint8)
    start = np.concatenate(([0], np.cumsum([len(r) for r in raw], dtype=np.int64)))
    of = lambda chars: _per_text(np.isin(buf, np.frombuffer(chars, np.uint8)), start)
    points = _per_text((buf & 0xC0) != 0x80, start)
    word_chars = points - of(SPACES)
    symbols = of(SYMBOLS)
    dups = np.array([_dup_lines(t) for t in texts], np.int64).reshape(k)
    # windows of five words found twice or more in their text
    whole = np.flatnonzero(np.arange(len(h)) + WINDOW <= words.start[doc + 1]) if len(h) else np.zeros(0, np.int64)
    repeat = np.zeros(k, np.int64)
    if len(whole):
        key = doc[whole].astype(U64) * U64(0x9E3779B97F4A7C15)
        for i in range(WINDOW):
            key = mix(key + h[whole + i])
        _, which, times = np.unique(key, return_inverse=True, return_counts=True)
        twice = whole[times[which] > 1]
        cover = np.zeros(len(h) + 1, np.int64)
        np.add.at(cover, twice, 1)
        np.add.at(cover, twice + WINDOW, -1)
        repeat = np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=k)
    counts = np.column_stack((n, word_chars, symbols, dups, repeat)).astype(np.int64).reshape(k, len(BASE))

    per = np.maximum(n, 1)
    chars = np.maximum(word_chars, 1)
    distinct = np.zeros(k)
    top = np.zeros(k)
    adjacent = np.zeros(k)
    if len(h):
        _, first, times = np.unique(mix(h + doc.astype(U64) * U64(0x9E3779B97F4A7C15)), return_index=True, return_counts=True)
        owner = doc[first]
        distinct = np.bincount(owner, minlength=k)
        np.maximum.at(top, owner, times)
        adjacent = np.bincount(doc[1:][(doc[1:] == doc[:-1]) & (h[1:] == h[:-1])], minlength=k)
    lines = of(b"\n") + 1
    letters = np.maximum(_per_text(((buf | 32) >= 97) & ((buf | 32) <= 122) & (buf < 128), start), 1)
    features = np.column_stack((
        np.log1p(n), word_chars / per, symbols / chars, dups / lines, repeat / per,
        _per_text((buf >= 65) & (buf <= 90), start) / letters, of(b"0123456789") / chars, of(b".,;:?'\"()-") / chars,
        of(b"!") / chars, distinct / per, top / per, n / lines, adjacent / per)).astype(float).reshape(k, len(FEATURES))
    return counts, features


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < 10) | (100 * counts[:, 4] > 20 * counts[:, 0])


@dataclass
class Forest:
    """Node arrays of all trees; ``roots`` are the trees' first nodes, a leaf is
    its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    bias: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality of each row of features."""
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(DEPTH):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total += self.value[at]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


class _Nodes:
    def __init__(self):
        self.rows: list[list[float]] = []

    def leaf(self, value: float) -> int:
        at = len(self.rows)
        self.rows.append([0, np.inf, at, at, value])
        return at


def _grow(nodes: _Nodes, x: np.ndarray, binned: np.ndarray, edges: list[np.ndarray], grad: np.ndarray, hess: np.ndarray,
          signs: np.ndarray, rows: np.ndarray, depth: int, low: float, high: float) -> int:
    """Grow one node over ``rows``; its value stays within [low, high]."""
    g, h = grad[rows].sum(), hess[rows].sum()
    value = float(np.clip(-g / (h + RIDGE), low, high))
    at = nodes.leaf(RATE * value)
    if depth == 0 or h < 2 * LEAST_WEIGHT:
        return at
    best = (1e-6, -1, 0, 0.0, 0.0)
    for f, cuts in enumerate(edges):
        if not len(cuts):
            continue
        gl = np.cumsum(np.bincount(binned[rows, f], grad[rows], len(cuts) + 1))[:-1]
        hl = np.cumsum(np.bincount(binned[rows, f], hess[rows], len(cuts) + 1))[:-1]
        gr, hr = g - gl, h - hl
        vl, vr = np.clip(-gl / (hl + RIDGE), low, high), np.clip(-gr / (hr + RIDGE), low, high)
        gain = gl * gl / (hl + RIDGE) + gr * gr / (hr + RIDGE) - g * g / (h + RIDGE)
        gain[(hl < LEAST_WEIGHT) | (hr < LEAST_WEIGHT) | (signs[f] * (vr - vl) < 0)] = -1
        i = int(np.argmax(gain))
        if gain[i] > best[0]:
            best = (float(gain[i]), f, i, float(vl[i]), float(vr[i]))
    _, f, i, vl, vr = best
    if f < 0:
        return at
    goes_left = binned[rows, f] <= i
    middle = (vl + vr) / 2
    bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[int(signs[f])]
    left = _grow(nodes, x, binned, edges, grad, hess, signs, rows[goes_left], depth - 1, *bounds[0])
    right = _grow(nodes, x, binned, edges, grad, hess, signs, rows[~goes_left], depth - 1, *bounds[1])
    nodes.rows[at] = [f, edges[f][i], left, right, RATE * value]
    return at


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, signs: np.ndarray, trees: int = TREES) -> Forest:
    """Boosted trees for P(y = 1 | x) with monotone signs a feature."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)]) if len(x) else np.zeros(x.shape, int)
    mean = float(np.clip((weight * y).sum() / max(weight.sum(), 1e-9), 1e-3, 1 - 1e-3)) if len(x) else 0.5
    bias = float(np.log(mean / (1 - mean)))
    nodes, roots, total = _Nodes(), [], np.full(len(x), bias)
    if len(set(y.tolist())) == 2:
        for _ in range(trees):
            p = 1 / (1 + np.exp(-total))
            first = len(nodes.rows)
            roots.append(_grow(nodes, x, binned, edges, weight * (p - y), weight * p * (1 - p), signs, np.arange(len(x)), DEPTH, -np.inf, np.inf))
            total += _forest(nodes.rows[first:], [0], 0.0, first).margin(x)
    return _forest(nodes.rows, roots, bias, 0).forest


class _forest:  # noqa: N801 - a small builder
    def __init__(self, rows: list[list[float]], roots: list[int], bias: float, offset: int):
        a = np.array(rows, float).reshape(len(rows), 5)
        ints = lambda c, o=0: a[:, c].astype(np.int64) - o
        self.forest = Forest(ints(0), a[:, 1], ints(2, offset), ints(3, offset), a[:, 4], np.array(roots, np.int64), bias)

    def margin(self, x: np.ndarray) -> np.ndarray:
        f, rows = self.forest, np.arange(len(x))
        at = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            at = np.where(x[rows, f.feature[at]] <= f.threshold[at], f.left[at], f.right[at])
        return f.value[at]


def sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``text, quality, weight`` of about ``per_class`` labelled rows a class; the
    weights restore the classes' shares."""
    known = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    sizes = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.lit("quality sample"), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    share = [min(1.0, per_class / max(1, sizes.get(c, 0))) for c in (0, 1)]
    part = F.when(F.col("quality") == 1, share[1]).otherwise(share[0])
    chosen = known.where(draw < part).select(F.col("doc_id").alias("_id"), "quality", (1 / part).alias("weight"))
    # at most about 2 * per_class ids: a proven bound for the broadcast
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
            .select(F.coalesce("text", F.lit("")).alias("text"), "quality", "weight"))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Forest:
    """The forest grown on the labelled sample; its statistics are taken on the
    executors, one short row a text comes to the driver."""
    names = list(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, x = statistics(texts_of(b))
            yield pa.RecordBatch.from_arrays([b.column("quality"), b.column("weight"), *(pa.array(c) for c in x.T)], ["quality", "weight", *names])

    rows = map_batches(sample(docs, labels, per_class).select("text", F.col("quality").cast("int").alias("quality"), F.col("weight").cast("double").alias("weight")), run,
                       "quality int, weight double, " + ", ".join(f"{n} double" for n in names)).toPandas()
    # row order follows the partitions; sorted, the same rows grow the same trees
    rows = rows.sort_values([*names, "quality"], kind="stable")
    weight = rows["weight"].to_numpy(float)
    return grow(rows[names].to_numpy(float), rows["quality"].to_numpy(float), weight / max(weight.mean(), 1e-9) if len(weight) else weight,
                np.array(list(FEATURES.values())))


def judge(docs: DataFrame, forest: Forest) -> DataFrame:
    """Base counts, base_failed and kept of every whole text.

    Null and empty texts have no words and fail the base rules; repeated rows
    give repeated rows; an empty table gives no rows. Without labels of both
    classes the forest has no trees and the base rules alone decide."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, x = statistics(texts_of(b))
            failed = base_failed(counts)
            score = forest.scores(x)
            good = score >= 0.5 if len(forest.roots) else np.ones(len(x), bool)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c) for c in counts.T), pa.array(failed), pa.array(~failed & good), pa.array(score)],
                ["doc_id", *BASE, "base_failed", "kept", "quality_score"])

    return map_batches(docs.select("doc_id", "text"), run, SCHEMA)
