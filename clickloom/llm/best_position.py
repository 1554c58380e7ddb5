"""Ranked lexical search with the Best Position Algorithm.

Every text is read once and leaves a row of its counts of the queries' terms.
A shard of those rows is inverted into impact lists: for each term the documents
that hold it, by falling impact. A query reads its lists side by side. Each
document it meets is looked up in all its lists (direct access), which gives
its whole score and its place in each. A list's best position is the last place
up to which every place has been met, by whichever list; the threshold sums the
impacts at the best positions. No document unmet can score more, so the search
ends once the threshold is strictly below the k-th score: a document that ties
with it may still win by its doc_id. As places are also met through direct
access, the threshold falls faster than one over the places last read.

A task goes through its documents shard by shard and keeps the k best of every
query, so later shards stop earlier, and hands on k rows a query. Queries are
taken in blocks of bounded terms; all documents meet every block.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from clickloom.llm.textops import PUNCTUATION, map_batches, texts_of
from clickloom.llm.wordarrays import WordArray
from clickloom.operators.ordering import top_k_per_group
from clickloom.session import cut_lineage

K = 20
#: documents of one shard of impact lists, and postings that close a shard early
SHARD_DOCS, SHARD_POSTINGS = 1 << 15, 1 << 23
#: terms (with repeats) and queries of one block of queries
BLOCK_TERMS, BLOCK_QUERIES = 1 << 17, 1 << 12
#: places read from each list in the first round; doubled up to the second number
FIRST_READ, MOST_READ = 32, 1024

_COUNTS = "doc_id long, n long, terms array<int>, tfs array<long>"
_BEST = "query int, doc_id long, no_id boolean, score long"
#: order of a document without an id among ties: after all ids
_NO_ID = (1 << 63) - 1


class Queries:
    """A block of queries: ``items`` are their rows, ``terms`` the distinct terms,
    ``lists[q]`` the (term numbers, repeats) of query q."""

    def __init__(self, rows: list[Row]):
        found = WordArray([r["text"] for r in rows], PUNCTUATION)
        coded = found.words.dictionary_encode()
        self.terms = coded.dictionary
        ids = coded.indices.to_numpy().astype(np.int64)
        self.items = [r["item_id"] for r in rows]
        self.lists = [np.unique(ids[found.doc == q], return_counts=True) for q in range(len(rows))]


def query_blocks(queries: DataFrame, most: int = BLOCK_TERMS) -> Iterator[Queries]:
    """The queries in blocks; one block at a time is on the driver."""
    block, size = [], 0
    for row in queries.select("item_id", "text").toLocalIterator():
        block.append(row)
        size += len(row["text"] or "") // 2 + 1
        if size >= most or len(block) == BLOCK_QUERIES:
            yield Queries(block)
            block, size = [], 0
    if block:
        yield Queries(block)


def term_counts(docs: DataFrame, terms: pa.Array) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every row: its terms with repeats, and which
    of ``terms`` it holds (their numbers, ascending) how often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = WordArray(texts_of(b), PUNCTUATION)
            n = found.counts()
            at = pc.index_in(found.words, value_set=terms)
            known = pc.is_valid(at).to_numpy(zero_copy_only=False)
            keys = found.doc[known] * len(terms) + at.drop_null().to_numpy().astype(np.int64)
            keys, tf = np.unique(keys, return_counts=True)
            offsets = pa.array(np.searchsorted(keys, np.arange(found.texts + 1) * max(1, len(terms))).astype(np.int32))
            held = pa.array((keys % max(1, len(terms))).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n), pa.ListArray.from_arrays(offsets, held), pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int64)))],
                ["doc_id", "n", "terms", "tfs"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, _COUNTS)


class Lists:
    """A shard's impact lists, before a query's weights."""

    def __init__(self, doc_ids: np.ndarray, no_id: np.ndarray, impact: np.ndarray, doc: np.ndarray, term: np.ndarray, n_terms: int):
        # documents are numbered by id, so that a smaller number wins a tie
        rank = np.lexsort((no_id, doc_ids))
        self.doc_ids, self.no_id = doc_ids[rank], no_id[rank]
        number = np.empty(len(rank), np.int64)
        number[rank] = np.arange(len(rank))
        doc = number[doc]
        order = np.lexsort((doc, term))
        self.doc, self.impact, term = doc[order], impact[order], term[order]
        self.start = np.searchsorted(term, np.arange(n_terms + 1))
        # by falling impact within each term; ``place`` is the inverse
        self.by_impact = np.lexsort((-self.impact, term))
        self.place = np.empty(len(order), np.int64)
        self.place[self.by_impact] = np.arange(len(order))

    def best(self, terms: np.ndarray, weight: np.ndarray, k: int, least: tuple[int, int] | None) -> tuple[np.ndarray, np.ndarray, int]:
        """(document numbers, scores, places read) of the query's ``k`` best with a
        score above 0, at least; ``least`` is a score that k others are known to reach."""
        lists = [(int(self.start[t]), int(self.start[t + 1]), int(w)) for t, w in zip(terms, weight, strict=True)
                 if w > 0 and self.start[t] < self.start[t + 1]]
        met = np.zeros(len(self.doc_ids), bool)
        seen = [np.zeros(hi - lo + 1, bool) for lo, hi, _ in lists]  # the last entry stays False: it ends the run
        position = [0] * len(lists)
        docs, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        kth = least if least is not None else 0
        at, step, read = 0, FIRST_READ, 0
        while lists:
            fresh = [self.doc[self.by_impact[lo + at:min(lo + at + step, hi)]] for lo, hi, _ in lists]
            read += sum(map(len, fresh))
            new = np.unique(np.concatenate(fresh))
            new = new[~met[new]]
            met[new] = True
            if len(new):
                score = np.zeros(len(new), np.int64)
                for i, (lo, hi, w) in enumerate(lists):
                    # direct access: the list's postings by document number
                    row = np.searchsorted(self.doc[lo:hi], new)
                    row[row == hi - lo] = 0
                    held = self.doc[lo + row] == new
                    row = lo + row[held]
                    score[held] += w * self.impact[row]
                    seen[i][self.place[row] - lo] = True
                docs.append(new)
                scores.append(score)
                every = np.concatenate(scores)
                if len(every) >= k:
                    kth = max(kth, int(np.partition(every, len(every) - k)[len(every) - k]))
            threshold = 0
            for i, (lo, hi, w) in enumerate(lists):
                position[i] += int(np.argmin(seen[i][position[i]:]))
                # every place before ``position`` has been met; an unmet document has at most its impact
                if lo + position[i] < hi:
                    threshold += w * int(self.impact[self.by_impact[lo + max(0, position[i] - 1)]])
            at, step = at + step, min(2 * step, MOST_READ)
            # a list wholly met adds nothing to an unmet document
            if threshold < kth or threshold == 0:
                break
        docs, scores = np.concatenate(docs), np.concatenate(scores)
        order = np.lexsort((docs, -scores))
        order = order[scores[order] > 0][:k]
        return docs[order], scores[order], read


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """What a weight of one adds to the score: ``(10**9 tf) div (1000 tf + 12 m)``."""
    m = 100 - 25 + (25 * n * docs) // terms
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _search(counts: DataFrame, queries: Queries, weight: np.ndarray, docs: int, terms: int, k: int,
            shard_docs: int, shard_postings: int) -> DataFrame:
    lists = [(t, weight[t] * r) for t, r in queries.lists]
    n_terms = len(queries.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int, bool]]] = [[] for _ in lists]

        def shard(held: list[pa.RecordBatch]) -> None:
            t = pa.Table.from_batches(held)
            size = pc.list_value_length(t["terms"]).to_numpy()
            doc = np.repeat(np.arange(len(t)), size)
            tf, term = (pc.list_flatten(t[c]).to_numpy().astype(np.int64) for c in ("tfs", "terms"))
            no_id = pc.is_null(t["doc_id"]).to_numpy(zero_copy_only=False)
            ids = pc.fill_null(t["doc_id"], _NO_ID).to_numpy()
            made = Lists(ids, no_id, impacts(tf, t["n"].to_numpy()[doc], docs, terms), doc, term, n_terms)
            for q, (ts, ws) in enumerate(lists):
                kth = -best[q][k - 1][0] if len(best[q]) >= k else None
                found, score, _ = made.best(ts, ws, k, kth)
                mine = [(-int(s), int(made.doc_ids[d]), bool(made.no_id[d])) for d, s in zip(found, score, strict=True)]
                best[q] = sorted(best[q] + mine, key=lambda x: (x[0], x[2], x[1]))[:k]

        held, rows, postings = [], 0, 0
        for b in batches:
            held.append(b)
            rows, postings = rows + len(b), postings + len(b.column("terms").flatten())
            if rows >= shard_docs or postings >= shard_postings:
                shard(held)
                held, rows, postings = [], 0, 0
        if rows:
            shard(held)
        out = [(q, d, none, -s) for q, b in enumerate(best) for s, d, none in b]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.bool_(), pa.int64()), strict=True)],
                                             ["query", "doc_id", "no_id", "score"])

    return map_batches(counts, run, _BEST)


def search(docs: DataFrame, queries: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS,
           shard_docs: int = SHARD_DOCS, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """``item_id, rank, doc_id, score``: for every row of ``queries`` (item_id, text)
    its ``k`` documents with the highest score above 0, ties by doc_id.

    A null or empty document has no terms and is never found; a query without
    terms finds nothing. Repeated documents are ranked one by one (ranks stay
    unique), a document without doc_id after its ties; a repeated query row gives
    its list again. Empty tables give no rows; other columns are not read."""
    out = None
    for block in query_blocks(queries, block_terms):
        counts = cut_lineage(term_counts(docs, block.terms))
        total = counts.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        # at most one row for each term of the block
        df = {r["t"]: r["df"] for r in counts.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).toLocalIterator()}
        weight = np.array([floor(1000 * log((2 * total["docs"] + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(block.terms))], np.int64)
        found = _search(counts, block, weight, total["docs"], max(1, total["terms"]), k, shard_docs, shard_postings)
        ranked = top_k_per_group(found, "query", [F.desc("score"), F.asc("no_id"), F.asc("doc_id")], k, rank_col="rank")
        ids = F.array(*[F.lit(i) for i in block.items])
        part = ranked.select(F.get(ids, F.col("query")).alias("item_id"), F.col("rank").cast("int").alias("rank"),
                             F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return queries.select("item_id").limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    return out
