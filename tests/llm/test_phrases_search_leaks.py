import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import awkward, rows
from clickloom.llm import benchmark_windows, best_position, fm_phrases

PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas", "FlatMapGroups", "PythonUDF")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
VOCAB = ["the", "of", "é", "日本", "a-b", "Tea", "cup", "x1", " ", "big"]


def prose(draw, n):
    return "".join(draw.choice(VOCAB) + draw.choice([" ", "  ", "\t", ". ", ", ", "\n", " ", " "]) for _ in range(n))


# phrases

def phrases_by_hand(docs, least, covered, first):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in docs:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= covered * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, _, left, right = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (s, a, p, left, right) in enumerate(sorted(kept)[:first]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("shard_bytes", [1 << 20, 2000])
def test_phrases_equal_plain_counting(spark, shard_bytes, monkeypatch):
    if shard_bytes == 2000:
        monkeypatch.setattr(fm_phrases, "BUCKET_BYTES", 3000)
        monkeypatch.setattr(fm_phrases, "PHRASES_A_KEY", 5)
    draw = random.Random(3)
    docs = [(draw.choice(["en", "de", None]), prose(draw, draw.randrange(120))) for _ in range(60)] + [("en", None), ("en", ""), ("en", "only")]
    docs += [("en", "kept together always. ")] * 7
    table = spark.createDataFrame([(i, lang, t, 1, "x") for i, (lang, t) in enumerate(docs)], "doc_id long, lang string, text string, n int, phrase string")
    for least, covered, first in ((5, 50, 40), (2, 30, 2000)):
        got = sorted(tuple(r) for r in fm_phrases.mine(table, least, covered, first, shard_bytes).collect())
        assert got == phrases_by_hand(docs, least, covered, first)


def test_phrase_arithmetic_is_exact_beyond_64_bits(spark):
    counts = spark.createDataFrame([(3_000_000_019, 3_000_000_037, 3_000_000_041), (10**9, 10**14, 10**14)], "a long, l long, r long")
    score = F.expr(f"(cast({fm_phrases.SCALE} AS decimal(7,0)) * cast(a AS decimal(15,0)) * cast(a AS decimal(15,0))) div (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))")
    for r in counts.select("a", "l", "r", score.alias("s")).collect():
        assert r["s"] == 10**6 * r["a"] ** 2 // (r["l"] * r["r"])


def test_index_intervals_hold_both_directions():
    draw = np.random.default_rng(2)
    ids = np.append(draw.integers(0, 5, 400), 0)
    index = fm_phrases.BidirectionalIndex(ids, 4, 3)
    pairs = index.right(index.words())
    for made in (index.left(pairs), index.right(pairs), index.left(index.left(index.words())), index.right(index.left(index.words()))):
        want = collections.Counter(tuple(w) for w in zip(ids, ids[1:], ids[2:]) if 0 not in w)
        assert {tuple(w): n for w, n in zip(made.words.tolist(), made.count.tolist(), strict=True)} == want


def test_phrases_of_awkward_tables(spark):
    assert fm_phrases.mine(awkward(spark).limit(0)).count() == 0
    got = rows(fm_phrases.mine(awkward(spark)))
    assert [r[:4] for r in got] == [("en", 1, "word word word", 59_998)]


# ranked search

def search_by_hand(docs, items, k):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    bags = [(i, collections.Counter(term.findall((t or "").translate(LOWER)))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for (i, b), size in zip(bags, sizes, strict=True):
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * (75 + 25 * size * n // total)))
                        for t in term.findall((text or "").translate(LOWER)) if b[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard_docs", [1 << 15, 512])
def test_search_equals_scoring_every_document(spark, shard_docs):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(60)] + VOCAB
    docs = [(i, " ".join(draw.choice(words[:draw.randrange(1, len(words))]) for _ in range(draw.randrange(1, 40)))) for i in range(900)]
    docs += [(i, "w1 w2 W1") for i in range(2000, 2100)] + [(7, "w1 w2 w1"), (None, "w1 w2 w1"), (9000, None), (9001, ""), (9002, "?!")]
    items = [(i, " ".join(draw.choice(words) for _ in range(draw.randrange(1, 15)))) for i in range(25)] + [(90, None), (91, "zzz"), (92, "w1 w1 W1 w2"), (93, "")]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("score", F.lit(1))
    queries = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = best_position.search(table, queries, 20, shard_docs=shard_docs, block_terms=60)
    assert sorted(rows(got), key=repr) == search_by_hand(docs, items, 20)


def test_search_stops_before_the_end_of_its_lists():
    draw = np.random.default_rng(1)
    n, terms = 20_000, 4
    doc = np.concatenate([np.arange(n)] * terms)
    impact = np.concatenate([np.sort(draw.pareto(1.0, n) * 1000).astype(np.int64)[::-1]] * terms)
    made = best_position.Lists(np.arange(n), np.zeros(n, bool), impact, doc, np.repeat(np.arange(terms), n), terms)
    found, score, read = made.best(np.arange(terms), np.ones(terms, np.int64), 10, None)
    whole = np.bincount(doc, impact, n).astype(np.int64)
    assert score.tolist() == np.sort(whole)[::-1][:10].tolist() and read < n * terms // 10
    # ties at the k-th score are all met: the smaller ids win
    flat = best_position.Lists(np.arange(n)[::-1], np.zeros(n, bool), np.full(n, 5), np.arange(n), np.zeros(n, np.int64), 1)
    assert flat.doc_ids[flat.best(np.array([0]), np.array([1]), 3, None)[0]].tolist() == [0, 1, 2]


def test_search_of_awkward_tables(spark):
    docs, queries = awkward(spark), spark.createDataFrame([(1, "ONE"), (2, "über"), (3, None)], "item_id long, text string")
    got = [(r["item_id"], r["rank"], r["doc_id"]) for r in best_position.search(docs, queries).orderBy("item_id", "rank").collect()]
    assert got == [(1, 1, 4), (1, 2, 5), (1, 3, 5), (1, 4, 6), (2, 1, 8)]
    assert best_position.search(docs.limit(0), queries).count() == 0 and best_position.search(docs, queries.limit(0)).count() == 0


# benchmark windows

def leaks_by_hand(docs, items, window):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    out = []
    for i, text in docs:
        w = word.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for item, said in items:
            b = word.findall((said or "").translate(LOWER))
            size = min(window, len(b))
            grams = {tuple(b[j:j + size]) for j in range(len(b) - size + 1)} if b else set()
            for j in range(len(w) - size + 1):
                if tuple(w[j:j + size]) in grams:
                    hit |= set(range(j, j + size))
                    found.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def leaky(draw):
    words = ["aa", "b", "C", "é", "日", "d9", "e", "f"]
    say = lambda n: "".join(draw.choice(words) + draw.choice([" ", ", ", "\n", "--", "_"]) for _ in range(n))
    items = [(i, say(draw.randrange(1, 20))) for i in range(12)] + [(100, "only"), (2, "b aa"), (None, "é é é"), (7, None), (8, "?"), (9, "x y z")]
    docs = [(i, say(draw.randrange(0, 80))) for i in range(60)] + [(70, items[3][1].upper() * 3), (70, items[3][1].upper() * 3), (71, None), (72, "ONLY."), (None, "x. Y z")]
    docs += [(80 + i, say(4) + items[i][1] + say(3) + items[i + 1][1]) for i in range(11)]
    return docs, items


@pytest.mark.parametrize("options", [{}, {"max_bits": 64, "broadcast_chars": 0}])
@pytest.mark.parametrize("window", [10, 3])
def test_leaks_equal_plain_matching(spark, window, options):
    docs, items = leaky(random.Random(window))
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("w", F.lit(1)).withColumn("item_id", F.lit(2))
    tests = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = benchmark_windows.mark(table, tests, window, **options)
    assert sorted(rows(got), key=repr) == leaks_by_hand(docs, items, window)
    assert not any(p in got._jdf.queryExecution().executedPlan().toString() for p in PYTHON)


def test_decontamination_takes_out_spans_or_documents(spark):
    docs = spark.createDataFrame([(1, "Before it, one TWO\tthree four; after.", 5), (2, "one two three", 5), (3, None, 5), (4, "one two three four", 5),
                                  (5, "one two three four one two three four five!", 5)], "doc_id long, text string, _row long")
    tests = spark.createDataFrame([("a", "One two three four")], "item_id string, text string")
    left = {r["doc_id"]: r["text"] for r in benchmark_windows.decontaminate(docs, tests).collect()}
    assert left == {1: "Before it; after.", 2: "one two three", 3: None, 4: "", 5: " five!"}
    kept = benchmark_windows.decontaminate(docs, tests, "documents")
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {2, 3}
    with pytest.raises(ValueError):
        benchmark_windows.decontaminate(docs, tests, "lines")


def test_leaks_of_awkward_tables(spark):
    docs, tests = awkward(spark), spark.createDataFrame([(1, "word " * 12), (2, "One")], "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"]) for r in benchmark_windows.mark(docs, tests).collect()}
    assert got == {1: (0, 0, 0), 2: (0, 0, 0), 3: (0, 0, 0), 4: (1, 1, 1), 5: (1, 1, 1), 6: (1, 1, 1), 7: (60_002, 60_000, 1), 8: (8, 0, 0), None: (5, 0, 0)}
    assert benchmark_windows.mark(docs, tests.limit(0)).where("contaminated").count() == 0
    assert benchmark_windows.mark(docs.limit(0), tests).count() == 0
