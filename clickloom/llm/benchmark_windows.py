"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

A benchmark item gives its windows of ``WINDOW`` consecutive words (one shorter
window if it has fewer). Document words are scanned in place: a window can
only begin where each of its neighbouring word pairs occurs in some benchmark
window, which a bit set of hashed pairs tells (a scalar subquery, at most
``MAX_BITS``; its size follows the counted pairs). Places that pass are looked
up in the hash set of the windows themselves and so verified word by word. The
set is broadcast where its counted size is within ``BROADCAST_CHARS`` and
shuffled beyond. Only DataFrame functions are used; one row a document and the
places that passed leave the scan.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.functions.columns import attach
from clickloom.llm.textops import fresh
from clickloom.session import cut_lineage

WINDOW = 10
#: bits of the pair set at most (8 MB as longs); fuller sets only pass more places on
MAX_BITS = 1 << 26
#: characters of all windows up to which their hash set is broadcast
BROADCAST_CHARS = 32 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: between words: ASCII other than letters and digits
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def words(text: Column) -> Column:
    """The words, A-Z lower-cased; none for null."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP + "+"), "")


def _pairs(size: int) -> list[tuple[int, int]]:
    """The word offsets whose pairs cover a window of ``size`` words."""
    return [(0, 0)] if size == 1 else [(i, i + 1) for i in (*range(0, size - 2, 2), size - 2)]


def _hash(said: Column, at: Column, pair: tuple[int, int]) -> Column:
    return F.xxhash64(F.get(said, at + pair[0]), F.get(said, at + pair[1]))


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id string, size, gram`` of every window (words joined by a blank),
    distinct; a null item_id counts as the empty one."""
    items = cut_lineage(benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words(F.col("text")).alias("w"))
                        .where(F.size("w") > 0))
    size = F.least(F.size("w"), F.lit(window))
    at = F.explode(F.sequence(F.lit(1), F.size("w") - size + 1))
    return (items.select("item_id", "w", size.alias("size"), at.alias("at"))
            .select("item_id", "size", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("gram")).distinct())


class TestSet:
    """The windows of a benchmark and their pair bits, both counted."""

    __test__ = False

    def __init__(self, benchmark: DataFrame, window: int = WINDOW, max_bits: int = MAX_BITS, broadcast_chars: int = BROADCAST_CHARS):
        self.windows = cut_lineage(windows(benchmark, window))
        self.sizes = sorted(r["size"] for r in self.windows.select("size").distinct().collect())  # at most ``window`` numbers
        grams = self.windows.select("size", "gram").distinct()
        found = grams.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("gram")).alias("chars")).first()
        self.grams = F.broadcast(grams) if (found["chars"] or 0) <= broadcast_chars else grams
        # about one bit in 32 set: a place outside every window seldom passes its first pair, hardly ever all
        self.bits = min(max_bits, 1 << max(6, ceil(log2(32 * max(1, found["n"])))))
        said = F.split("gram", " ")
        hashed = F.array()
        for s in self.sizes:
            hashed = F.when(F.col("size") == s, F.array(*[_hash(said, F.lit(0), p) for p in _pairs(s)])).otherwise(hashed)
        at = grams.select(F.explode(hashed).alias("h")).select(F.col("h").bitwiseAND(self.bits - 1).alias("at"))
        one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(63).cast("int"))
        none = grams.sparkSession.range(self.bits // 64).select(F.col("id").alias("i"), F.lit(0).cast("long").alias("b"))
        by_word = (at.select(F.shiftrightunsigned("at", 6).alias("i"), one.alias("b")).unionByName(none)
                   .groupBy("i").agg(F.bit_or("b").alias("b")))
        # bits / 64 rows, bounded by MAX_BITS, become one array
        self.bit_words = cut_lineage(by_word.agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "b"))), lambda s: s["b"]).alias("_bits")))

    def _set(self, h: Column) -> Column:
        at = h.bitwiseAND(self.bits - 1)
        return F.getbit(F.element_at("_bits", (F.shiftrightunsigned(at, 6) + 1).cast("int")), at.bitwiseAND(63).cast("int")) == 1

    def _places(self, said: Column, size: int) -> Column:
        def may(i: Column) -> Column:
            fits = F.lit(True)
            for p in _pairs(size):
                fits = fits & self._set(_hash(said, i, p))
            return fits

        def place(i: Column) -> Column:
            return F.struct(i.alias("at"), F.lit(size).alias("size"), F.array_join(F.slice(said, i + 1, F.lit(size)), " ").alias("gram"))

        none = F.array().cast("array<int>")
        begin = F.when(F.size(said) >= size, F.sequence(F.lit(0), F.size(said) - size)).otherwise(none)
        return F.transform(F.filter(begin, may), place)

    def places(self, said: Column) -> Column:
        """array<struct<at, size, gram>>: where a window may begin."""
        none = F.array().cast("array<struct<at:int,size:int,gram:string>>")
        return F.concat(none, *[self._places(said, s) for s in self.sizes])

    def scan(self, docs: DataFrame, keep: list[str]) -> DataFrame:
        """The columns ``keep`` of every row with ``_row`` (its number), ``_n``
        (words) and ``_places``; written, so that ``_row`` is the same in all reads."""
        # words() is bound as a lambda's variable: it is evaluated once a row, whatever the optimiser inlines
        seen = F.transform(F.array(words(F.col("text"))), lambda w: F.struct(F.size(w).alias("n"), self.places(w).alias("places")))[0]
        rows = attach(docs.select(*keep, *([] if "text" in keep else ["text"])), self.bit_words).select(*keep, seen.alias("_seen"))
        return cut_lineage(rows.select(*keep, F.monotonically_increasing_id().alias("_row"), F.col("_seen.n").alias("_n"), F.col("_seen.places").alias("_places")))

    def hits(self, scanned: DataFrame) -> DataFrame:
        """``_row, at, size, gram`` of every verified occurrence of a window."""
        return scanned.select("_row", F.explode("_places").alias("p")).select("_row", "p.*").join(self.grams, ["size", "gram"], "left_semi")


def _spans(hits: DataFrame) -> DataFrame:
    """``_row, lo, hi, new``: occurrences by place; ``new`` of its words were not in an earlier one."""
    before = Window.partitionBy("_row").orderBy("at", "size").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("at") + F.col("size")
    rows = hits.select("_row", "at", "size").withColumn("past", F.max(end).over(before))
    lo = F.greatest("at", F.coalesce("past", F.lit(0)))
    return rows.select("_row", lo.alias("lo"), end.alias("hi")).where(F.col("hi") > F.col("lo"))


def mark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_bits: int = MAX_BITS,
         broadcast_chars: int = BROADCAST_CHARS) -> DataFrame:
    """One row a document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit when it lies in an occurrence of a benchmark window; items are
    those with an occurring window, written as strings, distinct, in string
    order. Null and empty texts have no words, nor windows where they are
    items. Repeated rows are marked one by one; an empty benchmark hits
    nothing, an empty table gives no rows. Only doc_id, text and item_id are read."""
    tests = TestSet(benchmark, window, max_bits, broadcast_chars)
    scanned = tests.scan(docs, ["doc_id"])
    hits = cut_lineage(tests.hits(scanned))
    n_hit = _spans(hits).groupBy("_row").agg(F.sum(F.col("hi") - F.col("lo")).alias("n_hit"))
    # a passage that occurs often in one text counts once from here on
    of_items = hits.select("_row", "size", "gram").distinct().join(tests.windows, ["size", "gram"]).select("_row", "item_id").distinct()
    items = of_items.groupBy("_row").agg(F.count(F.lit(1)).alias("n_items"), F.array_join(F.sort_array(F.collect_list("item_id")), ",").alias("items"))
    rows = scanned.select("doc_id", "_row", "_n").join(n_hit.join(items, "_row"), "_row", "left")
    return rows.select("doc_id", F.col("_n").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                       F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                       F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", window: int = WINDOW) -> DataFrame:
    """``docs`` without benchmark passages, all columns.

    ``remove='documents'`` leaves out every document with a hit word;
    ``'spans'`` keeps the row and takes the hit words, each with what stands
    before it up to the word before, out of its text. Other rows stay as they
    are, null texts included."""
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove {remove!r}")
    names = fresh(docs, "_row", "_n", "_places", "_bits", "_seen")
    if names != ["_row", "_n", "_places", "_bits", "_seen"]:
        clash = {c: f"{c}{i}__own" for i, c in enumerate(docs.columns) if c.lower() in ("_row", "_n", "_places", "_bits", "_seen")}
        out = decontaminate(docs.withColumnsRenamed(clash), benchmark, remove, window)
        return out.withColumnsRenamed({v: k for k, v in clash.items()})
    tests = TestSet(benchmark, window)
    scanned = tests.scan(docs, docs.columns)
    spans = _spans(tests.hits(scanned))
    if remove == "documents":
        return scanned.join(spans.select("_row").distinct(), "_row", "left_anti").select(*docs.columns)
    cut = spans.groupBy("_row").agg(F.collect_list(F.struct("lo", "hi")).alias("_places"))
    words_with_gap = F.regexp_extract_all("text", F.lit(f"{GAP}*+{GAP.replace('[', '[^', 1)}++"), F.lit(0))
    # a text's words are numbered from 0 like the places; what follows the last word stays
    left = F.filter(words_with_gap, lambda w, i: ~F.exists("_places", lambda s: (i >= s["lo"]) & (i < s["hi"])))
    tail = F.regexp_extract("text", f"{GAP}*+$", 0)
    text = F.when(F.col("_places").isNull(), F.col("text")).otherwise(F.concat(F.array_join(left, ""), tail))
    return scanned.drop("_places").join(cut, "_row", "left").withColumn("text", text).select(*docs.columns)
