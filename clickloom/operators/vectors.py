"""Vector retrieval and embedding statistics.

Exact search scores every query against every item in blocks: both sides are
cut into numbered blocks of at most about ``block_rows`` rows, a query block
meets every item block in a co-grouped Arrow/numpy matrix product, and each
pair of blocks hands on a partial top-k per query. Partials are merged with a
per-query limit that Spark applies before the shuffle. Neither side is ever
collected, and a query's ties are broken by item id before any cut, so the
result is the same for every block size.

The inverted file clusters items with Spark ML KMeans; a query meets the items
of a list in the same block product, one group per (list, salt). ``ivf_topk``
looks into a fixed number of nearest lists and is approximate;
``ivf_exact_topk`` bounds what a list can hold and goes on until no list can
hold anything better, so it is exact and its work follows the data;
``norm_ordered_topk`` does the same with blocks of items by falling length.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import attach
from clickloom.operators.ordering import dense_index, exact_quantiles, lookup_join, top_k_per_group
from clickloom.session import cut_lineage

SCORE_BUDGET = 2_000_000  # scores materialised per matmul chunk (~16 MB of float64)
FULL_BLOCK = 50_000  # rows of one side of a block product at most
MOST_BLOCKS = 16  # blocks a side while none is above FULL_BLOCK: each costs a copy of the other side
MOST_LISTS = 32  # blocks by length while none is above FULL_BLOCK


def _n_blocks(rows: int, block_rows: int, most: int = MOST_BLOCKS) -> int:
    """Blocks of about ``block_rows`` rows, but no more than ``most`` as long as
    these hold ``FULL_BLOCK`` rows or fewer: a row is copied for every block of
    the other side, so blocks of a fixed small size would copy quadratically."""
    return max(1, min(math.ceil(rows / block_rows), most), math.ceil(rows / FULL_BLOCK))


def l2_normalize(col) -> F.Column:
    """Unit-length version of an array<float|double> column (double elements);
    the zero vector stays zero. Pure JVM expression."""
    c = F.col(col) if isinstance(col, str) else col
    norm = F.sqrt(F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    # the length is bound first: inside the inner transform it would be summed up anew for every element
    unit = F.transform(F.array(norm), lambda n: F.transform(c, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0))))
    return F.get(unit, 0)


def dot(a, b) -> F.Column:
    """Inner product of two equal-length array columns (JVM expression)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                       lambda acc, x: acc + x)


def block_top_k(q: np.ndarray, qids: np.ndarray, m: np.ndarray, ids: np.ndarray, k: int,
                exclude_self: bool = False, seen: tuple[np.ndarray, np.ndarray] | None = None
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, item id, score) of each query's ``k`` best rows of ``m`` by
    inner product, ties by item id; ``seen`` are (row of q, row of m) to leave out.

    The matrix product (of vectors scaled to length 1 at most, in single
    precision) only proposes: rows within its error of the k-th score are scored
    again in double precision and a fixed order of summation, so equal vectors get
    equal scores and a score does not depend on the block it was computed in."""
    dim = q.shape[1]
    kk = min(k, len(ids))
    if not kk or not len(q):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    norms, lengths = np.sqrt(np.einsum("ij,ij->i", m, m)).max(initial=0.0), np.sqrt(np.einsum("ij,ij->i", q, q))
    if np.isfinite(norms) and np.isfinite(lengths).all():
        short_m, scale = (m / max(norms, 1e-150)).astype(np.float32), 1 / np.maximum(lengths, 1e-150)
        margin = np.full(len(q), 4 * (dim + 4) * 2.0 ** -24)  # |q.x| <= 1: twice what rounding can move a sum
    else:
        short_m, scale, margin = m, np.ones(len(q)), 1e-12 * dim * np.maximum(1e-300, norms * lengths)
    own = np.isin(qids, ids) if exclude_self else np.zeros(len(qids), bool)
    # the k-th best of the columns' maxima is no better than the k-th best score: it tells
    # nearly all columns away without ordering them
    width = len(ids) // max(8 * kk, 256)
    whole = len(ids) - len(ids) % max(1, width)
    out, step = [], max(1, SCORE_BUDGET // len(ids))
    for at in range(0, len(q), step):
        part, pids = q[at:at + step], qids[at:at + step]
        rough = (part * scale[at:at + step, None]).astype(short_m.dtype) @ short_m.T
        if seen is not None:
            here = (seen[0] >= at) & (seen[0] < at + step)
            rough[seen[0][here] - at, seen[1][here]] = -np.inf
        if own[at:at + step].any():
            mine = np.flatnonzero(own[at:at + step])
            row, col = np.nonzero(pids[mine, None] == ids[None, :])
            rough[mine[row], col] = -np.inf
        top = rough if width < 2 else rough[:, :whole].reshape(len(part), width, -1).max(axis=1)
        kth = np.partition(top, top.shape[1] - kk, axis=1)[:, top.shape[1] - kk]
        least = np.where(np.isfinite(kth), kth - margin[at:at + step], -np.inf).astype(short_m.dtype)
        row, col = np.nonzero(rough >= least[:, None])
        finite = np.isfinite(rough[row, col])
        row, col = row[finite], col[finite]
        score = np.zeros(len(row))
        for d in range(dim):
            score += part[row, d] * m[col, d]
        order = np.lexsort((ids[col], -score, row))
        row, col, score = row[order], col[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        best = place < kk
        out.append((pids[row[best]], ids[col[best]], score[best]))
    return tuple(np.concatenate(c) for c in zip(*out))


_PARTIAL = "query_id long, item_id long, score double"


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _rows_of(ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``wanted``, row of ``ids``) of every wanted id that is there."""
    order = np.argsort(ids, kind="stable")
    at = np.searchsorted(ids[order], wanted)
    there = at < len(ids)
    there[there] = ids[order][at[there]] == wanted[there]
    return np.flatnonzero(there), order[at[there]]


def _block_product(queries: DataFrame, items: DataFrame, keys: list[str], k: int, exclude_self: bool) -> DataFrame:
    """Partial top-k rows of every group that ``queries`` (query_id, vec) and
    ``items`` (item_id, vec) share by ``keys``. Item rows with a ``seen_by``
    carry no vector: they name a query that must not get the item."""
    def run(q: pa.Table, it: pa.Table) -> pa.Table:
        found = [], [], []
        if len(q) and len(it):
            is_item = pc.is_null(it["seen_by"])
            pairs, it = it.filter(pc.invert(is_item)), it.filter(is_item)
            qids, ids = q["query_id"].to_numpy(), it["item_id"].to_numpy()
            seen = None
            if len(pairs):
                known, rows = _rows_of(qids, pairs["seen_by"].to_numpy())
                also, cols = _rows_of(ids, pairs["item_id"].to_numpy()[known])
                seen = rows[also], cols
            if len(it):
                found = block_top_k(_matrix(q["vec"]), qids, _matrix(it["vec"]), ids, k, exclude_self, seen)
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "item_id": pa.array(found[1], pa.int64()),
                         "score": pa.array(found[2], pa.float64())})

    if "seen_by" not in items.columns:
        items = items.withColumn("seen_by", F.lit(None).cast("long"))
    return queries.groupBy(*keys).cogroup(items.groupBy(*keys)).applyInArrow(run, _PARTIAL)


def _numbered(df: DataFrame, id_col: str, block_rows: int, block: str) -> tuple[DataFrame, int]:
    """``df`` with a block number by a hash of the id, and the number of blocks."""
    n = _n_blocks(df.count(), block_rows)
    return df.withColumn(block, F.pmod(F.xxhash64(id_col), F.lit(n)).cast("int")), n


def exact_topk(queries: DataFrame, items: DataFrame, k: int, metric: str = "ip", exclude_self: bool = False,
               block_rows: int = 50_000, query_col: str = "query_id", item_col: str = "item_id",
               vec_col: str = "vec", seen: DataFrame | None = None) -> DataFrame:
    """Per query the ``k`` items with the highest inner product (or cosine
    when ``metric='cosine'``), ties by item id; ``rank`` 1..k.

    ``items`` are the items that may be returned: padding and untrained items
    are left out by the caller. Blocks hold about ``block_rows`` rows of either
    side, more where that would make more than ``MOST_BLOCKS`` (``_n_blocks``); a
    row is sent once for every block of the other side. ``exclude_self``
    drops the item equal to the query id. Rows without a vector take no part.

    R4: pairs of ``seen`` (query id, item id) are left out before the cut, so a
    query gets ``k`` unseen items as long as there are any. A seen pair travels
    to the one block product it belongs to.
    """
    unit = (lambda c: l2_normalize(c)) if metric == "cosine" else F.col
    q = queries.where(F.col(vec_col).isNotNull()).select(F.col(query_col).cast("long").alias("query_id"), unit(vec_col).cast("array<double>").alias("vec"))
    it = items.where(F.col(vec_col).isNotNull()).select(F.col(item_col).cast("long").alias("item_id"), unit(vec_col).cast("array<double>").alias("vec"))
    q, n_q = _numbered(q, "query_id", block_rows, "qb")
    it, n_i = _numbered(it, "item_id", block_rows, "ib")
    q = q.withColumn("ib", F.explode(F.sequence(F.lit(0), F.lit(n_i - 1))))
    it = it.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    if seen is not None:
        block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
        pairs = seen.select(F.col(query_col).cast("long").alias("seen_by"), F.col(item_col).cast("long").alias("item_id")).dropna().distinct()
        pairs = pairs.select("item_id", F.lit(None).cast("array<double>").alias("vec"), block("item_id", n_i).alias("ib"),
                             block("seen_by", n_q).alias("qb"), "seen_by")
        it = it.withColumn("seen_by", F.lit(None).cast("long")).unionByName(pairs)
    partials = _block_product(q, it, ["qb", "ib"], k, exclude_self)
    out = top_k_per_group(partials, "query_id", [F.desc("score"), F.asc("item_id")], k, rank_col="rank")
    return out.select(F.col("query_id").alias(query_col), F.col("item_id").alias(item_col), "score", "rank")


def kmeans_centroids(items: DataFrame, n_clusters: int, seed: int = 42, vec_col: str = "vec",
                     max_iter: int = 20) -> DataFrame:
    """Cluster centroids (``cluster``, ``centroid``) with Spark ML KMeans."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    feats = items.select(array_to_vector(F.col(vec_col).cast("array<double>")).alias("features"))
    model = KMeans(k=n_clusters, seed=seed, maxIter=max_iter, initSteps=2).fit(feats)
    centers = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return items.sparkSession.createDataFrame(centers, "cluster int, centroid array<double>")


def nearest_clusters(df: DataFrame, centroids: DataFrame, n: int, id_col: str, vec_col: str = "vec") -> DataFrame:
    """Each row's ``n`` nearest centroids by inner product, with its vector:
    one matrix product a batch against the ``nlist`` centroids (a bounded table
    that every task holds), ties by cluster number."""
    rows = centroids.orderBy("cluster").collect()
    ids = np.array([r["cluster"] for r in rows], np.int64)
    mat = np.array([r["centroid"] for r in rows], float).reshape(len(rows), -1)

    def run(batches):
        for b in batches:
            for b in _slices(b, n):
                q = _matrix(pa.chunked_array([b.column("vec")]))
                found = block_top_k(q, np.arange(len(q)), mat, ids, n) if len(q) else ([], [], [])
                at = pa.array(found[0], pa.int64())
                yield pa.RecordBatch.from_arrays([b.column("id").take(at), b.column("vec").take(at), pa.array(found[1], pa.int64()).cast(pa.int32())],
                                                 ["id", "vec", "cluster"])

    out = (df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
           .mapInArrow(run, "id long, vec array<double>, cluster int"))
    return out.withColumnsRenamed({"id": id_col, "vec": vec_col})


def _slices(batch: pa.RecordBatch, copies: int):
    """``batch`` in pieces that hold at most about 20,000 rows when each row is copied ``copies`` times."""
    step = max(1, 20_000 // max(1, copies))
    for at in range(0, max(1, batch.num_rows), step):
        yield batch.slice(at, step)


def _by_cluster(numbers: dict[int, int]) -> Column:
    """``numbers`` by cluster (those above 1), 1 for any other."""
    known = F.create_map(*[F.lit(x) for c, n in numbers.items() if n > 1 for x in (c, n)] or [F.lit(-1), F.lit(1)])
    return F.coalesce(F.try_element_at(known, F.col("cluster")), F.lit(1))


def _list_products(probes: DataFrame, lists: DataFrame, visits: dict[int, int], parts: dict[int, int], k: int, exclude_self: bool) -> DataFrame:
    """Partial top-k of the ``probes`` (query_id, vec, cluster; ``visits``: their number by
    cluster) in the ``lists`` (item_id, vec, cluster) they name. Both sides of a
    list are cut, its items into ``parts`` by a salt and its queries into parts of
    ``FULL_BLOCK`` rows, each by its own number: no group holds more, however crowded a list."""
    salts, asked = _by_cluster(parts), _by_cluster({c: math.ceil(n / FULL_BLOCK) for c, n in visits.items()})
    q = (probes.withColumn("part", F.pmod(F.xxhash64("query_id"), asked).cast("int"))
         .withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))))
    it = (lists.where(F.col("cluster").isin(*visits)).withColumn("salt", F.pmod(F.xxhash64("item_id"), salts).cast("int"))
          .withColumn("part", F.explode(F.sequence(F.lit(0), asked - 1))))
    return _block_product(q, it, ["cluster", "salt", "part"], k, exclude_self)


def _counts(rows: DataFrame) -> dict[int, int]:
    """Rows by cluster."""
    return {r["cluster"]: r["n"] for r in rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}


def ivf_topk(queries: DataFrame, items: DataFrame, k: int, n_lists: int, n_probe: int, seed: int = 42,
             query_col: str = "query_id", item_col: str = "item_id", vec_col: str = "vec",
             exclude_self: bool = False, block_rows: int = 50_000) -> DataFrame:
    """R2: inverted-file search by inner product: items live in their nearest
    centroid's list; a query scores only the items of its ``n_probe`` nearest
    lists, then keeps the top ``k``. A list longer than ``block_rows`` is split
    by a salt, so a crowded list is not one task's work; a query meets no more
    than ``MOST_BLOCKS`` such parts as long as they hold ``FULL_BLOCK`` rows or fewer."""
    q = queries.select(F.col(query_col).alias("query_id"), F.col(vec_col).alias("vec"))
    it = items.select(F.col(item_col).alias("item_id"), F.col(vec_col).alias("vec"))
    cents = kmeans_centroids(it, n_lists, seed)
    lists = cut_lineage(nearest_clusters(it, cents, 1, "item_id"))
    probes = cut_lineage(nearest_clusters(q, cents, n_probe, "query_id"))
    parts = {c: _n_blocks(n, block_rows, max(1, MOST_BLOCKS // n_probe)) for c, n in _counts(lists).items()}
    cand = _list_products(probes, lists, _counts(probes), parts, k, exclude_self)
    out = top_k_per_group(cand, "query_id", [F.desc("score"), F.asc("item_id")], k, rank_col="rank")
    return out.select(F.col("query_id").alias(query_col), F.col("item_id").alias(item_col), "score", "rank")


def list_bounds(lists: DataFrame, centroids: DataFrame) -> DataFrame:
    """``cluster, n, radius, longest`` of every list that has items: how far its
    items (item_id, vec, cluster) lie from the centroid and how long they are, at most."""
    rows = centroids.collect()  # n_lists rows
    centre = {r["cluster"]: np.array(r["centroid"], float) for r in rows}

    def partial(batches):
        for b in batches:
            m, cluster = _matrix(pa.chunked_array([b.column("vec")])), b.column("cluster").to_numpy()
            out = []
            for c in np.unique(cluster):
                own = m[cluster == c]
                out.append((int(c), len(own), float(np.sqrt(((own - centre[c]) ** 2).sum(axis=1)).max()), float(np.sqrt((own * own).sum(axis=1)).max())))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.float64(), pa.float64()))],
                                                 ["cluster", "n", "radius", "longest"])

    parts = lists.select("vec", "cluster").mapInArrow(partial, "cluster int, n long, radius double, longest double")
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.max("radius").alias("radius"), F.max("longest").alias("longest"))


def _next_lists(queries: DataFrame, tables: tuple[np.ndarray, ...], start: int, end: int) -> DataFrame:
    """Each query's (query_id, vec, kth) lists at the places ``start`` to ``end`` in the
    order of what they can score at most, those that cannot reach ``kth`` left out."""
    ids, mat, radius, longest = tables

    def run(batches):
        for b in (s for b in batches for s in _slices(b, max(len(ids), end - start))):
            q = _matrix(pa.chunked_array([b.column("vec")]))
            if not len(q):
                continue
            norm = np.sqrt((q * q).sum(axis=1))[:, None]
            # x = c + d with |d| <= radius: q.x = q.c + q.d; and q.x <= |q| |x|
            bound = np.minimum(q @ mat.T + norm * radius, norm * longest)
            bound += 1e-9 * (np.abs(bound) + norm * (longest + radius))  # above what rounding can take away
            order = np.lexsort((np.broadcast_to(ids, bound.shape), -bound), axis=1)[:, start:end]
            kth = pc.fill_null(b.column("kth"), float("-inf")).to_numpy(zero_copy_only=False)
            row, place = np.nonzero(np.take_along_axis(bound, order, axis=1) >= kth[:, None])
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([b.column("query_id").take(at), b.column("vec").take(at), pa.array(ids[order[row, place]], pa.int32())],
                                             ["query_id", "vec", "cluster"])

    return queries.select("query_id", "vec", "kth").mapInArrow(run, "query_id long, vec array<double>, cluster int")


def ivf_exact_topk(queries: DataFrame, items: DataFrame, k: int, n_lists: int, seed: int = 42, query_col: str = "query_id",
                   item_col: str = "item_id", vec_col: str = "vec", exclude_self: bool = False, block_rows: int = 50_000,
                   work: list | None = None) -> DataFrame:
    """R2: the exact ``k`` best items by inner product, from an inverted file.

    A list's items lie within its radius of the centroid and are no longer than
    its longest, which bounds any query's score in it. A query visits lists by
    falling bound: one at first, then as many again as it has visited, and stops
    where the next bound is below its k-th score (a list whose bound equals it
    may hold a tie and is visited). How many lists that takes follows from the
    data, from one in clear clusters to all where there are none; never more
    than ``log2(n_lists) + 1`` rounds. Queries that are done drop out of later rounds.

    Ties go by item id as in ``exact_topk``; rows without a vector take no part;
    an empty side gives no rows. Per-list numbers (``n_lists`` rows) are all that
    tasks share. ``work`` (optional list) receives (round, queries asking, lists
    visited, scores computed)."""
    q = queries.where(F.col(vec_col).isNotNull()).select(F.col(query_col).cast("long").alias("query_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    it = items.where(F.col(vec_col).isNotNull()).select(F.col(item_col).cast("long").alias("item_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    if it.isEmpty():
        return _renamed(q.sparkSession.createDataFrame([], _RANKED), query_col, item_col)
    cents = kmeans_centroids(it, n_lists, seed)
    lists = cut_lineage(nearest_clusters(it, cents, 1, "item_id"))
    known = cents.join(list_bounds(lists, cents), "cluster").orderBy("cluster").collect()  # n_lists rows
    tables = (np.array([r["cluster"] for r in known], np.int64), np.array([r["centroid"] for r in known], float).reshape(len(known), -1),
              np.array([r["radius"] for r in known]), np.array([r["longest"] for r in known]))
    return _renamed(_bounded_search(q, lists, tables, {r["cluster"]: r["n"] for r in known}, k, exclude_self, block_rows, work), query_col, item_col)


_RANKED = "query_id long, item_id long, score double, rank int"


def _renamed(found: DataFrame, query_col: str, item_col: str) -> DataFrame:
    return found.select(F.col("query_id").alias(query_col), F.col("item_id").alias(item_col), "score", "rank")


def _bounded_search(q: DataFrame, lists: DataFrame, tables: tuple[np.ndarray, ...], size: dict[int, int], k: int, exclude_self: bool,
                    block_rows: int, work: list | None) -> DataFrame:
    """The exact ``k`` best of ``lists`` (item_id, vec, cluster) for each of ``q``, list
    after list by falling bound (``tables``: numbers, centroids, radii, longest), twice
    as many lists from round to round."""
    q = cut_lineage(q)
    best = q.sparkSession.createDataFrame([], _RANKED)
    # a query may visit every list: all their parts together stay within MOST_LISTS where FULL_BLOCK allows
    parts = {c: _n_blocks(n, block_rows, max(1, MOST_LISTS // len(size))) for c, n in size.items()}
    start, end = 0, 1
    while start < len(size):
        kth = best.where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
        probes = cut_lineage(_next_lists(q.join(kth, "query_id", "left"), tables, start, end))
        visits = _counts(probes)
        if not visits:
            break
        if work is not None:
            work.append((len(work) + 1, probes.select("query_id").distinct().count(), sum(visits.values()), sum(n * size[c] for c, n in visits.items())))
        found = _list_products(probes, lists, visits, parts, k, exclude_self)
        merged = best.select("query_id", "item_id", "score").unionByName(found)
        best = cut_lineage(top_k_per_group(merged, "query_id", [F.desc("score"), F.asc("item_id")], k, rank_col="rank"))
        start, end = end, 2 * end
    return best


def norm_ordered_topk(queries: DataFrame, items: DataFrame, k: int, query_col: str = "query_id", item_col: str = "item_id",
                      vec_col: str = "vec", exclude_self: bool = False, block_rows: int = 50_000, work: list | None = None) -> DataFrame:
    """The exact ``k`` best items by inner product, longest items first.

    Items are cut into blocks of ``block_rows`` by falling length, of more where that
    would make more than ``MOST_LISTS`` (``_n_blocks``). No score in a block exceeds the
    query's length times the block's longest, so a query that has ``k`` better
    scores skips that block and all after it: where lengths differ (popular
    items' often do) most block products are never made. Rounds, ties, missing
    vectors and ``work`` as in ``ivf_exact_topk``; with equal lengths every block is
    visited, as ``exact_topk`` does at once. One row a block is all that tasks share."""
    q = queries.where(F.col(vec_col).isNotNull()).select(F.col(query_col).cast("long").alias("query_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    it = items.where(F.col(vec_col).isNotNull()).select(F.col(item_col).cast("long").alias("item_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    if it.isEmpty():
        return _renamed(q.sparkSession.createDataFrame([], _RANKED), query_col, item_col)
    it = cut_lineage(it.withColumn("shorter", -F.sqrt(dot("vec", "vec"))))
    place = dense_index(it.select("shorter", "item_id"), ["shorter", "item_id"], "place", start=0)
    n = it.count()
    rows = max(1, min(FULL_BLOCK, max(block_rows, math.ceil(n / MOST_LISTS))))
    lists = cut_lineage(it.join(place, ["shorter", "item_id"]).withColumn("cluster", F.floor(F.col("place") / rows).cast("int")))
    known = lists.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max(-F.col("shorter")).alias("longest"), F.first(F.size("vec")).alias("dim")).orderBy("cluster").collect()
    longest = np.array([r["longest"] for r in known])
    # a block is a list around the origin
    tables = (np.array([r["cluster"] for r in known], np.int64), np.zeros((len(known), known[0]["dim"])), longest, longest)
    lists = lists.select("item_id", "vec", "cluster")
    return _renamed(_bounded_search(q, lists, tables, {r["cluster"]: r["n"] for r in known}, k, exclude_self, block_rows, work), query_col, item_col)


def concordance(exact: DataFrame, approx: DataFrame, k: int, query_col: str = "query_id",
                item_col: str = "item_id") -> DataFrame:
    """Per query |exact top-k ∩ approximate top-k| / k, and its mean."""
    shared = exact.select(query_col, item_col).join(approx.select(query_col, item_col), [query_col, item_col])
    per = (exact.select(query_col).distinct()
           .join(shared.groupBy(query_col).agg(F.count(F.lit(1)).alias("shared")), query_col, "left")
           .fillna(0, ["shared"]))
    return per.agg(F.count(F.lit(1)).alias("n_queries"), F.avg(F.col("shared") / k).alias("concordance"))


def vector_sums(rows: DataFrame, key_col: str, vec_col: str, kind: str = "mean") -> DataFrame:
    """Element-wise ``mean`` or ``sum`` of the vectors of each key. Spark ML's
    Summarizer keeps one running vector per key and combines map-side, so
    nothing is exploded to scalars."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    feats = rows.select(key_col, array_to_vector(F.col(vec_col).cast("array<double>")).alias("_v"))
    agg = Summarizer.mean if kind == "mean" else Summarizer.sum
    return feats.groupBy(key_col).agg(agg(F.col("_v")).alias("_m")).select(key_col, vector_to_array("_m").alias(vec_col))


def mean_vectors(pairs: DataFrame, vectors: DataFrame, key_col: str, item_col: str, dim: int,
                 vec_col: str = "vec") -> DataFrame:
    """Per key the element-wise mean of its items' vectors, of ``dim`` elements
    (0: not known).

    The elements are plain sums, which Spark keeps in its hash table and combines
    map-side; a summary object a key would be sorted and serialised row by row.
    The pairs lie in few files, each of which stands for many vectors: dealt out
    by key first, while they are narrow."""
    if not dim:
        return vector_sums(pairs.select(key_col, item_col).join(vectors.select(item_col, vec_col), item_col), key_col, vec_col, "mean")
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.select(key_col, item_col).repartition(tasks, key_col)
    ex = dealt.join(vectors.select(F.col(item_col), F.col(vec_col)), item_col)
    sums = [F.sum(F.get(vec_col, i).cast("double")).alias(f"_s{i}") for i in range(dim)]
    found = ex.groupBy(key_col).agg(F.count(F.lit(1)).alias("_n"), *sums)
    return found.select(key_col, F.array(*[F.col(f"_s{i}") / F.col("_n") for i in range(dim)]).alias(vec_col))


def user_centroids(pairs: DataFrame, vectors: DataFrame, users: DataFrame, dim: int, min_conf: int = 2,
                   user_col: str = "user_id", item_col: str = "item_id", vec_col: str = "vec") -> DataFrame:
    """Mean vector of each user's items with confidence >= ``min_conf``;
    users without such items get the zero vector."""
    good = pairs.filter(F.col("confidence_score") >= min_conf)
    cents = mean_vectors(good, vectors, user_col, item_col, dim, vec_col)
    zero = F.array_repeat(F.lit(0.0), dim)
    return (users.select(user_col).distinct().join(cents, user_col, "left")
            .select(user_col, F.coalesce(F.col(vec_col), zero).alias(vec_col)))


def offdiagonal_cosine_moments(vectors: DataFrame, dim: int, vec_col: str = "vec") -> DataFrame:
    """Mean and standard deviation of the cosine similarity over all
    ordered pairs i != j, computed exactly from sums, without forming pairs:
    with unit vectors u_i, S = sum_i u_i and G = sum_i u_i u_i^T,
    sum_{i!=j} u_i.u_j = |S|^2 - n and sum_{i!=j} (u_i.u_j)^2 = |G|_F^2 - sum_i |u_i|^4."""
    u = vectors.select(l2_normalize(vec_col).alias("u"))

    def partial(batches):
        # a task's own count, sum of fourth powers, S and G: one short row each
        n, self4, total, gram = 0, 0.0, np.zeros(dim), np.zeros((dim, dim))
        for b in batches:
            m = _matrix(pa.chunked_array([b.column("u")]))
            if len(m):
                n, self4 = n + len(m), self4 + float(((m * m).sum(axis=1) ** 2).sum())
                total, gram = total + m.sum(axis=0), gram + m.T @ m
        yield pa.RecordBatch.from_pydict({"n": [n], "self4": [self4], "v": [np.concatenate((total, gram.ravel())).tolist()]},
                                         pa.schema([("n", pa.int64()), ("self4", pa.float64()), ("v", pa.list_(pa.float64()))]))

    parts = cut_lineage(u.mapInArrow(partial, "n long, self4 double, v array<double>"))
    n_and_self = parts.agg(F.sum("n").alias("n"), F.sum("self4").alias("self4"))
    each = parts.select(F.posexplode("v").alias("p", "x")).groupBy("p").agg(F.sum("x").alias("x"))
    s2 = each.where(F.col("p") < dim).agg(F.sum(F.col("x") * F.col("x")).alias("s2"))
    g2 = each.where(F.col("p") >= dim).agg(F.sum(F.col("x") * F.col("x")).alias("g2"))
    t = attach(n_and_self, s2, g2)
    pairs = F.col("n") * (F.col("n") - 1)
    mean = (F.col("s2") - F.col("n")) / pairs
    mean_sq = (F.col("g2") - F.col("self4")) / pairs
    return t.select("n", mean.alias("mean_cosine"),
                    F.sqrt(F.greatest(mean_sq - mean * mean, F.lit(0.0))).alias("std_cosine"))


def _quantile_ranks(probs: Sequence[float], n: int) -> list[tuple[int, int, float]]:
    """(lower rank, upper rank, weight of the upper) of each quantile among ``n`` values."""
    out = []
    for p in probs:
        h = float(p) * (n - 1)
        out.append((math.floor(h), math.ceil(h), h - math.floor(h)))
    return out


def offdiagonal_cosine_quantiles(vectors: DataFrame, probs: Sequence[float] = (0.1, 0.5, 0.9), id_col: str = "vec_id", vec_col: str = "vec",
                                 block_rows: int = 20_000, bins: int = 4096, passes: int = 3) -> DataFrame:
    """Quantiles (linear interpolation) of the cosine similarity over all
    ordered pairs i != j: rows ``prob, value``, and ``n_pairs``.

    No pair leaves a task. Each product of two blocks gives a histogram; the
    histograms are added up and tell which bins hold the wanted ranks. The next
    pass counts within those bins alone, ``bins`` times finer; three passes fix
    a value to 3e-11. Each unordered pair of blocks is multiplied once and counts
    twice. What reaches the driver is at most ``bins`` counts for each wanted rank.
    A row is copied for each block: blocks grow with the table before their number
    does (``_n_blocks``), up to ``FULL_BLOCK`` rows.

    Zero vectors have cosine 0 to all; rows without a vector take no part; fewer
    than two rows give null values. Equal vectors are pairs like any others."""
    spark = vectors.sparkSession
    unit = vectors.where(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("item_id"), l2_normalize(vec_col).alias("vec"))
    n = unit.count()
    blocked, n_blocks = _numbered(cut_lineage(unit), "item_id", block_rows, "block")
    every = F.sequence(F.lit(0), F.lit(n_blocks - 1))
    other = F.col("other")
    left = blocked.withColumn("other", F.explode(every)).where(other >= F.col("block")).select(F.col("block").alias("a"), other.alias("b"), "item_id", "vec")
    right = blocked.withColumn("other", F.explode(every)).where(other <= F.col("block")).select(other.alias("a"), F.col("block").alias("b"), "item_id", "vec")

    def histogram(spans: list[tuple[float, float]]):
        # a span of the whole range takes every score; of a narrow one's, the few that can lie in it are picked first
        edges = [(lo - 1e-3 * width, lo + width + 1e-3 * width) for lo, width in spans]

        def run(key, x: pa.Table, y: pa.Table) -> pa.Table:
            total = np.zeros((len(spans), bins), np.int64)
            if len(x) and len(y):
                p, q = _matrix(x["vec"]), _matrix(y["vec"])
                step = max(1, SCORE_BUDGET // len(q))
                inner = key[0].as_py() == key[1].as_py()
                if inner:
                    p, q = (m[np.argsort(t["item_id"].to_numpy(), kind="stable")] for m, t in ((p, x), (q, y)))
                for at in range(0, len(p), step):
                    score = p[at:at + step] @ q.T
                    if inner:  # a pair of one block is met twice, a row with itself once: above the diagonal only
                        score = score[np.arange(len(q))[None, :] > np.arange(at, at + len(score))[:, None]]
                    for i, (lo, width) in enumerate(spans):
                        if score.size and lo <= score.min() and score.max() < lo + width * (1 - 1e-9):
                            here = ((score.ravel() - lo) * (bins / width)).astype(np.int32)  # none outside, no fraction below 0
                        else:
                            near = score[(score >= edges[i][0]) & (score <= edges[i][1])]
                            here = np.floor((near - lo) * (bins / width))
                            here = here[(here >= 0) & (here < bins)].astype(np.int32)
                        total[i] += np.bincount(here, minlength=bins)
            span, at = np.nonzero(total)
            return pa.table({"span": pa.array(span, pa.int32()), "at": pa.array(at, pa.int32()), "n": pa.array(total[span, at])})

        found = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInArrow(run, "span int, at int, n long")
        counts = np.zeros((len(spans), bins), np.int64)
        for r in found.groupBy("span", "at").agg(F.sum("n").alias("n")).collect():  # at most bins a span
            counts[r["span"], r["at"]] = r["n"]
        return counts

    pairs = n * (n - 1)
    schema = "prob double, value double, n_pairs long"
    if not pairs:
        return spark.createDataFrame([(float(p), None, pairs) for p in probs], schema)
    ranks = _quantile_ranks(probs, pairs)
    # wanted rank among unordered pairs -> (its span, ranks below the span)
    where = {r // 2: ((-1.0 - 1e-6, 2.0 + 2e-6), 0) for lo, hi, _ in ranks for r in (lo, hi)}
    for _ in range(passes):
        spans = sorted({span for span, _ in where.values()})
        counts = histogram(spans)
        for r, (span, below) in where.items():
            own = np.cumsum(counts[spans.index(span)])
            at = min(int(np.searchsorted(own, r - below, side="right")), bins - 1)
            width = span[1] / bins
            where[r] = ((span[0] + at * width, width), below + (int(own[at - 1]) if at else 0))
    middle = {r: span[0] + span[1] / 2 for r, (span, _) in where.items()}
    rows = [(float(p), middle[lo // 2] + w * (middle[hi // 2] - middle[lo // 2]), pairs) for p, (lo, hi, w) in zip(probs, ranks, strict=True)]
    return spark.createDataFrame(rows, schema)


def _label_sums(items: DataFrame, dim: int) -> DataFrame:
    """Per label the element-wise sum of unit item vectors and the item count."""
    counts = items.groupBy("label").agg(F.count(F.lit(1)).alias("n_label"))
    return vector_sums(items, "label", "u", "sum").withColumnRenamed("u", "s_label").join(counts, "label")


def score_gaps(pairs: DataFrame, items: DataFrame, users: DataFrame, dim: int) -> DataFrame:
    """R20 (paired rows) + R21: for every positive (user, item) pair, cosine of
    user->positive, mean cosine of the positive item and of the user to the
    other items of the same category and to the items of other categories;
    means over all pairs and the gaps between them.

    Exact without forming (pair, item) rows: a mean of dot products with a
    set of unit vectors is a dot product with their sum, so only per-category
    sums (one row per category) are needed.
    ``pairs``: (user_id, item_id); ``items``: (item_id, label, vec); ``users``: (user_id, vec).
    """
    it = items.select("item_id", "label", l2_normalize("vec").alias("u"))
    ls = _label_sums(it, dim)
    total = ls.select(F.posexplode("s_label").alias("p", "x"), "label").groupBy("p").agg(F.sum("x").alias("t")) \
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "t"))), lambda t: t["t"]).alias("s_total"))
    n_all = it.agg(F.count(F.lit(1)).alias("n_total"))
    us = users.select("user_id", l2_normalize("vec").alias("w"))
    # one row a category, which may hold most pairs: salted; total and n_all are one row each
    j = lookup_join(pairs.select("user_id", "item_id").join(it, "item_id").join(us, "user_id"), ls, "label", F.xxhash64("user_id", "item_id"))
    j = attach(j, total, n_all)
    s_other = F.zip_with("s_total", "s_label", lambda a, b: a - b)
    s_same_wo = F.zip_with("s_label", "u", lambda a, b: a - b)
    n_same = F.col("n_label") - 1
    n_diff = F.col("n_total") - F.col("n_label")
    per = j.select(
        dot("w", "u").alias("user_pos"),
        F.try_divide(dot("u", s_same_wo), n_same).alias("item_same"),
        F.try_divide(dot("u", s_other), n_diff).alias("item_diff"),
        F.try_divide(dot("w", s_same_wo), n_same).alias("user_same"),
        F.try_divide(dot("w", s_other), n_diff).alias("user_diff"))
    m = per.agg(F.count(F.lit(1)).alias("n_pairs"), *[F.avg(c).alias(c) for c in
                                                      ("user_pos", "item_same", "item_diff", "user_same", "user_diff")])
    return m.select("*", (F.col("user_pos") - F.col("user_same")).alias("gap_pos_vs_same"),
                    (F.col("user_same") - F.col("user_diff")).alias("gap_same_vs_diff"),
                    (F.col("user_pos") - F.col("user_diff")).alias("gap_pos_vs_diff"),
                    (F.col("item_same") - F.col("item_diff")).alias("item_gap"))


def paired_cosines(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """R20 (paired rows): ``user_id, item_id, cosine`` of each pair. ``users``:
    (user_id, vec); ``items``: (item_id, vec)."""
    u = users.select("user_id", l2_normalize("vec").alias("w"))
    i = items.select("item_id", l2_normalize("vec").alias("u"))
    return pairs.select("user_id", "item_id").join(i, "item_id").join(u, "user_id").select("user_id", "item_id", dot("w", "u").alias("cosine"))


def truth_vs_random(truth: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """users' mean cosine to their ground-truth items against that to the
    whole catalogue (what random items have in the mean, exactly: a dot product
    with the items' sum). One row: users, both means, their gap, and the share
    of users whose truth scores above random. Users without a vector and truth
    outside the items are left out."""
    # of the users only those who are asked for; stored: joined to their truth and again to its mean
    own = cut_lineage(users.join(truth.select("user_id").distinct(), "user_id", "left_semi").select("user_id", l2_normalize("vec").alias("w")))
    unit = items.select("item_id", l2_normalize("vec").alias("u"))
    scored = truth.select("user_id", "item_id").join(unit, "item_id").join(own, "user_id").select("user_id", dot("w", "u").alias("cosine"))
    per = scored.groupBy("user_id").agg(F.avg("cosine").alias("truth"))
    total = vector_sums(unit.withColumn("one", F.lit(1)), "one", "u", "mean").select(F.col("u").alias("mean_item"))
    rows = attach(per.join(own, "user_id"), total)
    rows = rows.select("truth", dot("w", "mean_item").alias("random"))
    return rows.agg(F.count(F.lit(1)).alias("n_users"), F.avg("truth").alias("mean_truth"), F.avg("random").alias("mean_random"),
                    (F.avg("truth") - F.avg("random")).alias("gap"), F.avg((F.col("truth") > F.col("random")).cast("double")).alias("share_above"))


def _group_quantiles(scores: DataFrame, group: str, known, probs: Sequence[float], bins: int = 4096) -> DataFrame:
    """Exact quantiles of one group's scores (``known``: their number, least and
    greatest). A histogram tells the bins that hold the wanted ranks; only their
    scores, a small share, are ordered."""
    own = scores.where((F.col("group") == group) & F.col("score").isNotNull())
    if known is None or not known["n"] or not math.isfinite(width := (known["high"] - known["low"]) / bins) or width <= 0:
        return exact_quantiles(own, "score", probs)
    own = own.withColumn("bin", F.least(F.floor((F.col("score") - F.lit(known["low"])) / F.lit(width)), F.lit(bins - 1)))
    count = np.zeros(bins, np.int64)
    for r in own.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).collect():  # at most ``bins`` rows
        count[r["bin"]] = r["n"]
    upto = np.cumsum(count)
    wanted = _quantile_ranks(probs, known["n"])
    at = {r: int(np.searchsorted(upto, r, side="right")) for lo, hi, _ in wanted for r in (lo, hi)}
    kept = sorted(set(at.values()))
    first = {b: int(count[kept[:i]].sum()) for i, b in enumerate(kept)}  # ranks among the kept bins' scores
    place = {r: first[b] + r - int(upto[b] - count[b]) for r, b in at.items()}
    ranks = [(place[lo], place[hi], w) for lo, hi, w in wanted]
    return exact_quantiles(own.where(F.col("bin").isin(kept)), "score", probs, ranks=ranks)


def describe_scores(scores: DataFrame, groups: Sequence[str], probs: Sequence[float] = (0.1, 0.5, 0.9)) -> DataFrame:
    """One row for each of ``groups``: ``group, n, mean, std`` (of the whole
    population) and ``p10, p50, ...`` of the scores (``group, score``). The
    quantiles are exact and distributed; a group without scores has n 0."""
    scores = cut_lineage(scores.select("group", "score"))
    one = cut_lineage(scores.groupBy("group").agg(F.count("score").alias("n"), F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"),
                                                  F.min("score").alias("low"), F.max("score").alias("high")))
    known = {r["group"]: r for r in one.where(F.col("group").isin(*groups)).collect()}
    names = scores.sparkSession.createDataFrame([(g,) for g in groups], "group string")
    out, quantiles = names.join(one.drop("low", "high"), "group", "left").fillna(0, ["n"]), None
    for g in groups:
        own = _group_quantiles(scores, g, known.get(g), probs).withColumn("group", F.lit(g))
        quantiles = own if quantiles is None else quantiles.unionByName(own)
    wide = quantiles.groupBy("group").agg(*[F.max(F.when(F.col("prob") == float(p), F.col("value"))).alias(f"p{round(100 * p)}") for p in probs])
    return out.join(wide, "group").select("group", "n", "mean", "std", *[f"p{round(100 * p)}" for p in probs])


def _runs(ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``wanted`` the place of its first row among the sorted ``ids``, and their number."""
    ids = np.sort(ids, kind="stable")
    first = np.searchsorted(ids, wanted)
    return first, np.searchsorted(ids, wanted, side="right") - first


def _each(n: np.ndarray) -> np.ndarray:
    """0 ``n[0]`` times, 1 ``n[1]`` times, ..."""
    return np.repeat(np.arange(len(n)), n)


def _within(n: np.ndarray) -> np.ndarray:
    """0 to ``n[0]`` - 1, 0 to ``n[1]`` - 1, ..."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


CELL_ROWS = 20_000  # users, or items, whose vectors a cell holds
CELL_DRAWS = 4_000_000  # places scored in a cell, about


def _drawn_scores(rows: DataFrame, users: DataFrame, placed: DataFrame, groups: Sequence[str], asked: DataFrame, means: bool = False) -> DataFrame:
    """``group, score`` of every place in ``rows`` (user_id, code, places), ``code`` a
    number in ``groups``; ``asked`` (user_id, n) tells how many places a user has; with ``means`` the mean score
    of each user and group (user_id, group, score).

    Only ids and places travel with the draws. Users and items are dealt into
    blocks; a cell gets one block of either, a vector once, and the draws
    between them. A block of users with more than its share of draws (hot users)
    is cut by a salt."""
    users = cut_lineage(users.where(F.col("user_id").isNotNull() & F.col("vec").isNotNull()).select(F.col("user_id").cast("long").alias("user_id"), l2_normalize("vec").alias("vec")))
    rows = rows.where(F.col("user_id").isNotNull()).withColumn("user_id", F.col("user_id").cast("long"))
    n_ib = max(1, math.ceil(placed.count() / CELL_ROWS))
    draws = asked.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n_ub = max(1, math.ceil(users.count() / CELL_ROWS), math.ceil(draws / CELL_DRAWS))
    ub = F.pmod(F.xxhash64("user_id"), F.lit(n_ub)).cast("int").alias("cluster")
    sizes = {r["cluster"]: r["n"] for r in asked.select(F.col("user_id").cast("long").alias("user_id"), "n").groupBy(ub).agg(F.sum("n").alias("n")).collect()}  # one row a block of users
    salts = _by_cluster({c: math.ceil(n / (2 * CELL_DRAWS)) for c, n in sizes.items()})
    each = F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt")

    block = lambda p: F.floor(p / F.lit(CELL_ROWS)).cast("int")
    x = rows.select("user_id", "code", "places", ub).withColumn("salt", F.pmod(F.xxhash64("user_id", "code", "places"), salts).cast("int"))
    x = x.withColumn("ib", F.explode(F.array_distinct(F.transform("places", block))) if n_ib > 1 else F.lit(0))
    here = F.filter("places", lambda p: block(p) == F.col("ib")) if n_ib > 1 else F.col("places")
    x = x.select("cluster", "salt", "ib", "user_id", "code", F.transform(here, lambda p: (p - F.col("ib") * F.lit(CELL_ROWS)).cast("int")).alias("places"))
    w = (users.select(ub, "user_id", "vec").select("cluster", each, "user_id", "vec")
         .withColumn("ib", F.explode(F.sequence(F.lit(0), F.lit(n_ib - 1)))).select("cluster", "salt", "ib", "user_id", F.lit(None).cast("int").alias("at"), "vec"))
    u = (placed.select(block(F.col("place")).alias("ib"), "place", F.col("u").alias("vec"))
         .withColumn("cluster", F.explode(F.sequence(F.lit(0), F.lit(n_ub - 1)))).select("cluster", each, "ib", "place", "vec")
         .select("cluster", "salt", "ib", F.lit(None).cast("long").alias("user_id"), F.pmod(F.col("place"), F.lit(CELL_ROWS)).cast("int").alias("at"), "vec"))

    def run(x: pa.Table, y: pa.Table) -> pa.Table:
        is_user = pc.is_valid(y["user_id"])
        own, it = y.filter(is_user), y.filter(pc.invert(is_user))
        found, drawn = [np.zeros(0)], [np.zeros(0, np.int64)]
        code, who = np.zeros(0, np.int32), np.zeros(0, np.int64)
        if len(x) and len(own) and len(it):
            # as in a join: an id or place that comes twice is met twice, one that is not there not at all
            first, n = _runs(own["user_id"].to_numpy(), x["user_id"].to_numpy())
            row, place = _each(n), it["at"].to_numpy()
            w = _matrix(own["vec"])[np.argsort(own["user_id"].to_numpy(), kind="stable")][first[row] + _within(n)]
            u = _matrix(it["vec"])[np.argsort(place, kind="stable")]
            copies = np.bincount(place, minlength=CELL_ROWS)
            start = np.cumsum(copies) - copies
            x = x.take(pa.array(row))
            lists = x["places"].combine_chunks()
            who, code = x["user_id"].to_numpy(), x["code"].to_numpy()
            row, places = _each(pc.list_value_length(lists).to_numpy().astype(np.int64)), lists.flatten().to_numpy()
            for at in range(0, len(places), 100_000):
                wanted, n = places[at:at + 100_000], copies[places[at:at + 100_000]]
                pick = _each(n)
                drawn.append(row[at:at + 100_000][pick])
                found.append(np.einsum("ij,ij->i", w[drawn[-1]], u[start[wanted[pick]] + _within(n)]))
        score, row = np.concatenate(found), np.concatenate(drawn)
        if not means:
            return pa.table({"code": pa.array(code[row], pa.int32()), "score": pa.array(score)})
        n = np.bincount(row, minlength=len(who))
        total, there = np.bincount(row, weights=score, minlength=len(who)), n > 0
        return pa.table({"user_id": pa.array(who[there], pa.int64()), "code": pa.array(code[there], pa.int32()),
                         "total": pa.array(total[there], pa.float64()), "n": pa.array(n[there], pa.int64())})

    keys = ["cluster", "salt", "ib"]
    cells = x.groupBy(*keys).cogroup(w.unionByName(u).groupBy(*keys))
    group = F.element_at(F.array(*[F.lit(g) for g in groups]), F.col("code") + 1).alias("group")
    if not means:
        return cells.applyInArrow(run, "code int, score double").select(group, "score")
    sums = cells.applyInArrow(run, "user_id long, code int, total double, n long").groupBy("user_id", "code").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return sums.select("user_id", group, (F.col("total") / F.col("n")).alias("score"))


def _placed(items: DataFrame) -> DataFrame:
    """Items (item_id, label, vec) in the order of label and id, ``place`` from 0."""
    rows = items.where(F.col("vec").isNotNull()).select("item_id", "label", l2_normalize("vec").alias("u"))
    return cut_lineage(rows.join(dense_index(rows.select("label", "item_id"), ["label", "item_id"], "place", start=0), ["label", "item_id"]))


def score_distributions(pairs: DataFrame, items: DataFrame, users: DataFrame, n_draws: int = 20, seed: int = 42) -> DataFrame:
    """The distribution of users' cosines to their positives, to ``n_draws``
    items of the positive's category and to ``n_draws`` of other categories, drawn
    for every pair by place (md5 of seed, pair and slot: the same in any run).

    ``pairs``: (user_id, item_id); ``items``: (item_id, label, vec); ``users``: (user_id,
    vec). One row a group as in ``describe_scores``, of groups positive,
    same_category, other_category. A draw never gives the positive itself; where
    a category holds nothing else, or there is no other, nothing is drawn. Pairs
    whose user or item has no vector take no part; a repeated pair draws the
    same items again."""
    from clickloom.operators.negatives import draw
    placed = _placed(items)
    labels = placed.groupBy("label").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n_label"))
    spread = F.xxhash64("user_id", "item_id")
    known = lookup_join(pairs.select("user_id", "item_id"), placed.select("item_id", "place", "label"), "item_id", F.col("user_id"), salts=8)
    rows = cut_lineage(attach(lookup_join(known, labels, "label", spread), placed.agg(F.count(F.lit(1)).alias("n_all"))))

    def drawn(group: str, free: Column, place) -> Column:
        slots = F.transform(F.sequence(F.lit(0), F.lit(n_draws - 1)), lambda slot: F.pmod(draw(seed, F.col("user_id"), F.col("item_id"), slot, group), free))
        return F.when(free > 0, F.transform(slots, place)).otherwise(F.array().cast("array<long>"))

    own = F.col("place") - F.col("first")
    same = drawn("same_category", F.col("n_label") - 1, lambda u: F.col("first") + u + (u >= own).cast("long"))
    other = drawn("other_category", F.col("n_all") - F.col("n_label"), lambda u: u + F.when(u >= F.col("first"), F.col("n_label")).otherwise(0))
    every = [F.struct(F.lit(i).alias("code"), places.alias("places")) for i, places in enumerate((F.array("place"), same, other))]
    drawn_rows = rows.select("user_id", F.inline(F.array(*every)))
    groups = ("positive", "same_category", "other_category")
    return describe_scores(_drawn_scores(drawn_rows, users, placed, groups, rows.select("user_id", F.lit(1 + 2 * n_draws).alias("n"))), groups)


def truth_score_distributions(truth: DataFrame, users: DataFrame, items: DataFrame, n_draws: int = 1000, seed: int = 42) -> DataFrame:
    """Over users, the distribution of the mean cosine to their ground truth
    (``truth``: user_id, item_id) and to ``n_draws`` items drawn from the
    catalogue by place, with replacement: one row each (groups truth, random) as
    in ``describe_scores``. Users without a vector or any truth inside the items
    take no part."""
    from clickloom.operators.negatives import draw
    placed = _placed(items.select("item_id", F.lit(0).alias("label"), "vec"))
    rows = cut_lineage(lookup_join(truth.select("user_id", "item_id").distinct(), placed.select("item_id", "place"), "item_id", F.col("user_id"), salts=8))
    own = rows.select("user_id", F.lit(0).alias("code"), F.array("place").alias("places"))
    asked = attach(rows.select("user_id").distinct(), placed.agg(F.count(F.lit(1)).alias("n_all")))
    places = F.transform(F.sequence(F.lit(0), F.lit(n_draws - 1)), lambda slot: F.pmod(draw(seed, F.col("user_id"), slot, "random"), F.col("n_all")))
    random = asked.select("user_id", F.lit(1).alias("code"), places.alias("places"))
    groups = ("truth", "random")
    n = rows.select("user_id", F.lit(1).alias("n")).unionByName(asked.select("user_id", F.lit(n_draws).alias("n")))
    return describe_scores(_drawn_scores(own.unionByName(random), users, placed, groups, n, means=True), groups)


def session_requests(events: DataFrame, item_vocab: DataFrame, max_len: int = 20, session_col: str = "user_session") -> DataFrame:
    """What the recommender is asked per session: the last ``max_len`` known
    items in time order with their type codes (an unknown type counts as a
    view), the number of events and of known ones. Items outside the vocabulary
    are dropped; a session without a known item gives no row."""
    from clickloom.functions.columns import event_code
    from clickloom.operators.sequences import keep_last
    code = F.coalesce(event_code(F.lower("event_type")), F.lit(1))
    rows = events.filter(F.col(session_col).isNotNull()).join(item_vocab, "product_id", "left").select(
        session_col, "event_time", "item_idx", code.alias("event_idx"))
    counts = rows.groupBy(session_col).agg(F.count(F.lit(1)).alias("session_length"), F.count("item_idx").alias("known_items"))
    order = [F.desc("event_time"), F.desc("item_idx"), F.desc("event_idx")]
    last = top_k_per_group(rows.filter(F.col("item_idx").isNotNull()), session_col, order, max_len, rank_col=None)
    seq = last.groupBy(session_col).agg(F.array_sort(F.collect_list(F.struct("event_time", "item_idx", "event_idx"))).alias("s"))
    return seq.join(counts, session_col).select(
        session_col, "session_length", "known_items", keep_last(F.transform("s", lambda x: x["item_idx"]), max_len).alias("item_seq"),
        keep_last(F.transform("s", lambda x: x["event_idx"]), max_len).alias("event_seq"))


def session_recommendations(requests: DataFrame, item_vectors: DataFrame, item_vocab: DataFrame, k: int = 20,
                            session_col: str = "user_session") -> DataFrame:
    """Per session the ``k`` items nearest (cosine) to the mean vector of its
    items, under their original ids: ``user_session, rank, product_id,
    session_length, known_items``. ``item_vectors``: (item_idx, vec)."""
    numbered = requests.select(session_col, "session_length", "known_items", "item_seq", F.xxhash64(session_col).alias("query_id"))
    means = mean_vectors(numbered.select("query_id", F.explode("item_seq").alias("item_idx")), item_vectors, "query_id", "item_idx", 0)
    found = exact_topk(means, item_vectors, k, metric="cosine", item_col="item_idx")
    return (found.join(item_vocab, "item_idx").join(numbered.drop("item_seq"), "query_id")
            .select(session_col, "rank", "product_id", "session_length", "known_items"))
