import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from cases import awkward, documents, rows
from clickloom.llm import grace, probminhash
from clickloom.llm.components import components
from clickloom.llm.textops import SPACES, U64, Words

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def exact(pairs):
    """doc_id, keep_id, group_size, kept, digest by a dictionary."""
    groups = defaultdict(list)
    for doc, text in pairs:
        groups[(text or "").translate(ASCII_LOWER)].append(doc)
    out = []
    for norm, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else -(1 << 63)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(norm.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def test_grace_equals_dictionary(spark):
    draw = random.Random(1)
    texts = [draw.choice(["A b", "a B", "c", "É", "é", "", None, "x" * 50, f"own {i}"]) for i in range(400)]
    docs = documents(spark, texts).repartition(5)
    assert sorted(rows(grace.dedup(docs)), key=repr) == exact(enumerate(texts))
    assert sorted(rows(grace.dedup(docs, table_bytes=300)), key=repr) == exact(enumerate(texts))
    assert rows(grace.dedup(documents(spark, []))) == []


def test_grace_awkward_rows(spark):
    docs = awkward(spark)
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(rows(grace.dedup(docs)), key=repr) == exact(pairs)
    kept = grace.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([2, 3, 6, 7, 8, None], key=repr)


def test_grace_many_salts(spark, monkeypatch):
    monkeypatch.setattr(grace, "ROWS_PER_SALT", 10)
    texts = ["same"] * 150 + [f"t{i}" for i in range(50)]
    assert sorted(rows(grace.dedup(documents(spark, texts).repartition(4))), key=repr) == exact(enumerate(texts))


def test_grace_recursion_spills_and_keeps_everything():
    draw = random.Random(2)
    records = [(grace._hash(c), c, i, 1, frozenset((i % 3,))) for i, c in enumerate(str(draw.randrange(3000)).encode() * 20 for _ in range(8000))]
    whole = sorted(grace.grace(records))
    assert sorted(grace.grace(records, table_bytes=5000)) == whole
    assert sum(r[3] for r in whole) == len(records) and len({r[1] for r in whole}) == len(whole)


def test_open_table_compares_content_under_equal_hashes():
    got = sorted(grace.grace([(5, c, i, 1, frozenset((0,))) for i, c in enumerate([b"a", b"b", b"a"])], table_bytes=1))
    assert [(r[1], r[2], r[3]) for r in got] == [(b"a", 2, 2), (b"b", 1, 1)]


def sets(texts):
    out = []
    for t in texts:
        w = Words([t or ""], SPACES).hash.tolist()
        out.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    return out


def brute(texts):
    """Least index of each text's class by comparing all pairs."""
    s = sets(texts)
    label = list(range(len(s)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(s)):
        for j in range(i):
            if (not s[i] and not s[j]) or (s[i] and s[j] and len(s[i] & s[j]) >= 0.8 * len(s[i] | s[j])):
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return [find(i) for i in range(len(s))]


def edited(words, draw, n):
    out = list(words)
    for at in draw.sample(range(len(out)), n):
        out[at] = f"z{draw.randrange(10**9)}"
    return " ".join(out)


def test_near_classes_equal_brute_force(spark):
    draw = random.Random(11)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(30):
        words = [draw.choice(vocabulary) for _ in range(draw.randint(40, 200))]
        texts += [edited(words, draw, draw.randint(0, 2)) for _ in range(draw.randint(1, 5))]
    passage = " ".join(draw.choice(vocabulary) for _ in range(60))
    texts += [passage + " " + " ".join(draw.choice(vocabulary) for _ in range(90)) for _ in range(25)]
    texts += ["a b", "A  b", "a b c d e", "", None, "  "]
    want = brute(texts)
    got = {r[0]: r[1] for r in rows(probminhash.classes(documents(spark, texts).repartition(3)))}
    assert [got[i] for i in range(len(texts))] == want


def test_near_kept_rows_stand_once(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "g h i j k"), (None, "l m n"), (None, "l m n")], "doc_id long, text string")
    assert sorted(rows(probminhash.keep_one(docs)), key=repr) == sorted([(1, "a b c d e f"), (2, "g h i j k"), (None, "l m n")], key=repr)
    assert probminhash.keep_one(docs.where("doc_id = 2")).count() == 1


@pytest.mark.parametrize("block, columns", [(512, 8192), (16, 100)])
def test_near_large_bucket_of_unlike_texts(spark, monkeypatch, block, columns):
    """One band key for all: every pair in the bucket must still be compared."""
    monkeypatch.setattr(probminhash, "BLOCK", block)
    monkeypatch.setattr(probminhash, "COLUMNS", columns)
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    families = [[draw.choice(vocabulary) for _ in range(80)] for _ in range(12)]
    texts = [edited(draw.choice(families), draw, 1) for _ in range(80)]
    docs = documents(spark, texts)
    n = [len(s) for s in sets(texts)]
    members = spark.createDataFrame([(7, i, n[i]) for i in range(len(texts))], "key long, doc long, n long")
    labels = {r["id"]: r["label"] for r in probminhash._label(docs, members).collect()}
    assert [labels.get(i, i) for i in range(len(texts))] == brute(texts)


def test_near_finds_texts_that_repeat_a_passage(spark):
    """Set similarity above 0.8, weighted similarity far below it."""
    draw = random.Random(29)
    texts = []
    for _ in range(12):
        plain = [f"w{draw.randrange(10**9)}" for _ in range(109)]
        passage = [f"w{draw.randrange(10**9)}" for _ in range(18)]
        texts += [" ".join(plain), " ".join(plain + passage * 500)]
    s = sets(texts)
    assert all(len(s[i] & s[i + 1]) >= 0.8 * len(s[i] | s[i + 1]) for i in range(0, len(s), 2))
    got = {r[0]: r[1] for r in rows(probminhash.classes(documents(spark, texts)))}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_near_awkward_rows(spark):
    docs = awkward(spark)
    got = {r[0]: r[1] for r in rows(probminhash.classes(docs))}
    assert got[1] == got[2] == got[3] == 1 and got[4] == got[5] == got[6] == 4 and got[7] == 7 and got[8] == 8 and got[None] is None
    kept = probminhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 4, 7, 8, None], key=repr)
    assert rows(probminhash.classes(awkward(spark, []))) == [] and probminhash.keep_one(awkward(spark, [])).count() == 0


def test_probminhash_estimates_probability_jaccard():
    draw = np.random.default_rng(4)
    ids = draw.integers(1, 1 << 63, 300).astype(U64)
    a, b = np.arange(0, 220), np.arange(60, 300)
    wa, wb = draw.uniform(0.5, 4, 300), draw.uniform(0.5, 4, 300)
    hits, rounds = 0, 40
    for r in range(rounds):
        shift = U64(r * 7919)
        s = probminhash.signatures(np.concatenate((ids[a], ids[b])) ^ shift, np.repeat([0, 1], (len(a), len(b))),
                                   np.concatenate((wa[a], wb[b])), 2)
        hits += (s[0] == s[1]).sum()
    pa, pb = np.zeros(300), np.zeros(300)
    pa[a], pb[b] = wa[a], wb[b]
    want = sum(1 / np.maximum(pa / pa[d], pb / pb[d]).sum() for d in range(60, 220))
    assert abs(hits / (rounds * probminhash.SLOTS) - want) < 0.03


def test_components_of_chains_stars_and_rings(spark):
    links = [(i + 1, i) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200)]
    got = {r["id"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 160)) and got[202] == 200
