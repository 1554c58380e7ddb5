import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cases import awkward, documents, rows
from clickloom.llm import gbt_quality, kn_toxicity, packing
from clickloom.llm.textops import SPACES, Words

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered)]


def test_words_and_shingles():
    texts = ["A b", "", "a\tB\x0bc é", None, "x" * 1000]
    w = Words(texts, SPACES, True)
    assert w.counts().tolist() == [2, 0, 4, 0, 1]
    assert w.hash[0] == w.hash[2] and w.hash[1] == w.hash[3]
    _, doc = w.shingles(3)
    assert doc.tolist() == [0, 2, 2, 4]


def test_quality_base_counts():
    draw = random.Random(3)
    texts = ["", "a b c d e f g h i j a b c d e", "x\n\n \n x\nx\nx", "é|<>", " ".join("ab" for _ in range(30)), "a" * 300]
    texts += [" ".join(draw.choice(["a", "b", "#c", "d\n", "é", "日"]) for _ in range(draw.randint(0, 40))) for _ in range(300)]
    counts, features = gbt_quality.statistics(texts)
    assert counts.tolist() == [base(t) for t in texts]
    assert features.shape == (len(texts), len(gbt_quality.FEATURES)) and np.isfinite(features).all()


def test_forest_is_monotone_and_learns():
    draw = np.random.default_rng(1)
    x = draw.uniform(0, 1, (1500, 3))
    y = ((x[:, 0] + 0.2 * np.sin(20 * x[:, 0]) < 0.5) & (x[:, 1] > 0.3)).astype(float)
    signs = np.array([-1, 1, 0])
    free = gbt_quality.grow(x, y, np.ones(len(x)), 0 * signs)
    assert ((free.scores(x) >= 0.5) == (y == 1)).mean() > 0.97
    # the wave in feature 0 is out of reach of a monotone forest; the rest is not
    forest = gbt_quality.grow(x, y, np.ones(len(x)), signs)
    assert ((forest.scores(x) >= 0.5) == (y == 1)).mean() > 0.9
    for _ in range(50):
        point = np.tile(draw.uniform(0, 1, 3), (40, 1))
        for f, sign in ((0, -1), (1, 1)):
            line = point.copy()
            line[:, f] = np.linspace(0, 1, 40)
            assert (sign * np.diff(forest.scores(line)) >= -1e-12).all()


def test_flat_nodes_equal_recursive_walk():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(300, 4))
    f = gbt_quality.grow(x, (x[:, 0] * x[:, 1] > 0).astype(float), np.ones(300), np.zeros(4, int), trees=7)

    def walk(row, at):
        while f.left[at] != at:
            at = f.left[at] if row[f.feature[at]] <= f.threshold[at] else f.right[at]
        return f.value[at]

    want = [1 / (1 + np.exp(-(f.bias + sum(walk(r, t) for t in f.roots)))) for r in x]
    assert np.allclose(f.scores(x), want)


def _quality_tables(spark):
    draw = random.Random(9)
    word = lambda: "".join(draw.choice("aeioustnr") for _ in range(draw.randint(2, 8)))
    good = [" ".join(word() for _ in range(draw.randint(20, 60))) + "." for _ in range(120)]
    bad = [" ".join(word() + draw.choice(["%%%", "###"]) for _ in range(draw.randint(20, 60))) for _ in range(60)]
    texts = good + bad
    labels = [(i, int(i < 120), 0) for i in range(len(texts)) if i % 3]
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_held_out_accuracy(spark):
    docs, labels = _quality_tables(spark)
    got = {r["doc_id"]: r for r in gbt_quality.judge(docs, gbt_quality.fit(docs, labels)).collect()}
    assert np.mean([got[i]["kept"] == (i < 120) for i in range(0, 180, 3)]) > 0.95


def test_quality_awkward_rows(spark):
    docs, labels = _quality_tables(spark)
    forest = gbt_quality.fit(docs, labels)
    table = awkward(spark)
    want = Counter((r["doc_id"], *base(r["text"] or "")) for r in table.collect())
    got = gbt_quality.judge(table, forest).collect()
    assert Counter(tuple(r)[:6] for r in got) == want
    assert all(r["base_failed"] and not r["kept"] for r in got if r["n_words"] < 10)
    assert gbt_quality.judge(awkward(spark, []), forest).count() == 0
    # labels of one class, nulls, unknown rows: no trees, the base rules decide
    odd = spark.createDataFrame([(None, 1, 1), (0, None, None), (0, 1, 1), (10**9, 1, 1)], "doc_id long, quality int, toxic int")
    none = gbt_quality.fit(docs, odd)
    assert not len(none.roots)
    assert all(r["kept"] != r["base_failed"] for r in gbt_quality.judge(docs, none).collect())
    assert not len(gbt_quality.fit(awkward(spark, []), odd).roots)


def _toxic_tables(spark, n=400):
    draw = random.Random(13)
    word = lambda: "".join(draw.choice(["th", "er", "on", "an", "re"]) for _ in range(draw.randint(1, 4)))
    texts, truth = [], []
    for i in range(n):
        words = [word() for _ in range(draw.randint(20, 200))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(max(2, len(words) // 40)):
                words[draw.randrange(len(words))] = draw.choice(["idiot", "scum", "Moron,", "TRASH"])
        texts.append(" ".join(words))
        truth.append(int(toxic))
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(truth)], "doc_id long, quality int, toxic int")
    return documents(spark, texts), labels, truth


def _held(doc):
    return zlib.crc32(str(doc).encode()) % 3 == 1


def test_toxicity_held_out_accuracy(spark):
    docs, labels, truth = _toxic_tables(spark)
    got = {r["doc_id"]: r for r in kn_toxicity.score(docs, kn_toxicity.fit(docs, labels)).collect()}
    assert all(r["held_out"] == _held(d) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for d, r in got.items())
    held = [d for d in got if _held(d)]
    assert np.mean([got[d]["predicted"] == truth[d] for d in held]) > 0.95


def test_toxicity_never_reads_held_out_labels(spark):
    docs, labels, truth = _toxic_tables(spark, 240)
    lied = spark.createDataFrame([(i, 1, 1 - t if _held(i) else t) for i, t in enumerate(truth)], "doc_id long, quality int, toxic int")
    a, b = kn_toxicity.fit(docs, labels), kn_toxicity.fit(docs, lied)
    assert np.array_equal(a.word, b.word) and np.array_equal(a.word_ratio, b.word_ratio) and np.allclose(a.weights, b.weights)


def test_toxicity_awkward_rows(spark):
    docs, labels, _ = _toxic_tables(spark, 240)
    model = kn_toxicity.fit(docs, labels)
    table = awkward(spark)
    got = kn_toxicity.score(table, model).collect()
    assert len(got) == table.count() and all(r["predicted"] == 0 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2, 3)}) == 1
    kept = kn_toxicity.keep_ordinary(table, model)
    assert kept.columns == table.columns and kept.count() == table.count()
    bad = documents(spark, ["you idiot scum moron trash " * 5, "fine words"])
    assert [r["doc_id"] for r in kn_toxicity.keep_ordinary(bad, model).collect()] == [1]
    assert kn_toxicity.score(awkward(spark, []), model).count() == 0
    # no labels at all, or of one class
    for odd in ([], [(1, 1, 1)], [(None, 1, 1), (1, 1, None)]):
        odd = spark.createDataFrame(odd, "doc_id long, quality int, toxic int")
        assert kn_toxicity.score(table, kn_toxicity.fit(table, odd)).count() == table.count()


def test_toxicity_finds_expressions_rare_in_their_class(spark):
    """Every toxic expression is in about 4 % of the toxic texts only."""
    draw = random.Random(17)
    word = lambda: "".join(draw.choice(["th", "er", "on", "an", "re"]) for _ in range(draw.randint(1, 4)))
    texts = []
    for i in range(1200):
        words = [word() for _ in range(draw.randint(20, 60))]
        if i % 2:
            for _ in range(2):
                words[draw.randrange(len(words))] = f"slur{draw.randrange(50)}"
        texts.append(" ".join(words))
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(1200)], "doc_id long, quality int, toxic int")
    docs = documents(spark, texts)
    got = {r["doc_id"]: r["predicted"] for r in kn_toxicity.score(docs, kn_toxicity.fit(docs, labels)).collect()}
    held = [d for d in got if _held(d)]
    assert np.mean([got[d] for d in held if d % 2]) > 0.9
    assert np.mean([got[d] for d in held if not d % 2]) < 0.05


def test_toxicity_counts_near_copies_once(spark):
    draw = random.Random(19)
    passage = [f"w{draw.randrange(10**6)}" for _ in range(60)]
    texts = [" ".join([*passage, f"end{i}"]) for i in range(90)] + [f"own words number {i} of a text" for i in range(90)]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, 1, int(i < 90)) for i in range(180)], "doc_id long, quality int, toxic int")
    sample = kn_toxicity.sample(docs, labels)
    parts = {(r["family"], r["curve"]) for r in sample.where("toxic = 1").collect()}
    assert len(parts) == 1 and sample.where("toxic = 1").count() > 40
    assert kn_toxicity.count(sample).agg({"t": "max"}).first()[0] == 1


def _counts(draw, n_words, n_pairs, dim=2):
    words = np.sort(draw.choice(1 << 50, n_words, replace=False).astype(np.uint64))
    i, j = draw.integers(0, n_words, n_pairs), draw.integers(0, n_words, n_pairs)
    pairs, first = np.unique(kn_toxicity._pair(words[i], words[j]), return_index=True)
    i, j = i[first], j[first]
    uni = draw.integers(0, 30, (n_words, dim)).astype(float) + np.eye(2)[draw.integers(0, 2, n_words)]
    bi = np.where(draw.random((len(pairs), dim)) < 0.4, 0, draw.integers(1, 25, (len(pairs), dim))).astype(float)
    bi += np.eye(2)[draw.integers(0, 2, len(pairs))]
    return words, uni, draw.integers(0, 9, n_words).astype(float), pairs, words[i], words[j], bi, i, j


@pytest.mark.parametrize("evidence", [0.0, 6.0, 1e9])
@pytest.mark.parametrize("others", [0, 7])
def test_toxicity_is_kneser_ney(evidence, others):
    """Probabilities in plain Python: they sum to one, and the tables hold their ratios."""
    words, uni, cont, pairs, left, right, bi, i, j = _counts(np.random.default_rng(4), 25, 130)
    rare = np.random.default_rng(others).integers(0, others + 1, 25).astype(float)
    model = kn_toxicity.build(words, uni, cont, pairs, left, right, bi, rare, evidence)
    d, log = kn_toxicity.DISCOUNT, {}

    def own(t, o):
        return (t, o) if (t - o) ** 2 / max(t + o, 1) >= evidence else ((t + o) / 2, (t + o) / 2)
    one = [own(*x) for x in uni]
    shared = [max(c, 1) / sum(max(x, 1) for x in cont) for c in cont]
    every = [t + o for t, o in uni]
    low_back = sum(min(x, d) for x in every) / sum(every)
    assert low_back == pytest.approx(d * len(every) / sum(every))  # all are above D here
    lows = []
    for c in (0, 1):
        n = sum(max(x[c] - d, 0) for x in one)
        lows.append([(1 - low_back) * max(x[c] - d, 0) / n + low_back * s for x, s in zip(one, shared, strict=True)])
        assert sum(lows[c]) == pytest.approx(1)

    def own_pair(t, o, w):
        chance = [(t + o) * lows[c][w] / (lows[0][w] + lows[1][w]) for c in (0, 1)]
        surprise = 2 * sum(x * np.log(x / e) for x, e in zip((t, o), chance, strict=True) if x)
        return (t, o) if surprise >= evidence else chance
    two = [own_pair(*x, w) for x, w in zip(bi, j, strict=True)]
    for c in (0, 1):
        low = lows[c]
        for v in range(25):
            met = {j[k]: (two[k][c], sum(bi[k])) for k in range(len(two)) if i[k] == v}
            context = sum(x for _, x in met.values()) + rare[v]
            back = (d * len(met) + rare[v]) / context if met else 1.0  # D N1+(v .) / c(v .), and the pairs without an entry
            kept = sum(max(x - d, 0) for x, _ in met.values())
            if not kept:
                back = 1.0
            p = [((1 - back) * max(met[w][0] - d, 0) / kept if kept and w in met else 0) + back * low[w] for w in range(25)]
            assert sum(p) == pytest.approx(1) and 0 < back <= 1
            for w in range(25):
                log[c, v, w] = np.log(p[w])
        log[c, None] = np.log(low)

    class Said:
        hash = np.concatenate([words[[v, w]] for v in range(25) for w in range(25)])
        doc = np.repeat(np.arange(625), 2)
    got = model.ratios(Said).reshape(25, 25, 2)
    for v in range(25):
        assert np.allclose(got[v, :, 0], log[0, None][v] - log[1, None][v])
        assert np.allclose(got[v, :, 1], [log[0, v, w] - log[1, v, w] for w in range(25)])


def test_toxicity_of_few_large_families_keeps_its_words():
    """Words met twice in a thousand ordinary families, three toxic families."""
    draw = np.random.default_rng(5)
    words = np.sort(draw.choice(1 << 50, 30_000, replace=False).astype(np.uint64))
    uni = np.zeros((30_000, 2))
    uni[:, 1] = 2
    uni[:400] = (3, 0)
    scale = np.array([1003 / 6, 1003 / 2000])
    none = np.zeros(0, np.uint64)
    for evidence in kn_toxicity.EVIDENCE:
        model = kn_toxicity.build(words, uni * scale, np.ones(30_000), none, none, none, np.zeros((0, 2)), np.zeros(30_000), evidence)
        assert len(model.word) == 30_000 and np.isfinite(model.word_ratio).all()
        assert model.word_ratio[:400].min() > 3 and model.word_ratio[400:].max() < 0.1


def test_toxicity_continuations_of_all_documents(spark, monkeypatch):
    monkeypatch.setattr(kn_toxicity, "PAIRS_HELD", 3)
    texts = ["a x b x", "c x", None, "x", "c X. d y", "a x y"] * 2
    words = np.sort([Words([w], SPACES).hash[0] for w in "xy"])
    got = kn_toxicity.continuations(documents(spark, texts).repartition(3), words).collect()
    assert {words[r["w"]]: r["cont"] for r in got} == {Words(["x"], SPACES).hash[0]: 3, Words(["y"], SPACES).hash[0]: 2}


def sequences(pieces):
    out = {}
    for r in pieces:
        out.setdefault(r["sequence_id"], []).append((r["offset"], r["doc_id"], r["start"], r["length"]))
    return {k: sorted(v, key=lambda p: p[0]) for k, v in out.items()}


def test_packing_tables(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    draw = random.Random(21)
    texts = [" ".join(draw.choice(["alpha", "Übung", "été", "1234", "x"]) for _ in range(int(draw.paretovariate(0.6)) % 6000)) for _ in range(300)]
    texts += ["", None, "a" * 9000]
    docs = documents(spark, texts).repartition(3)
    pieces = packing.pack_documents(docs, VOCABULARY, public_tokenizers.PATTERN, with_ids=True).collect()
    ids = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for t in texts]
    by_doc = {}
    for r in pieces:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids"] == part.tolist() and r["ids_crc32"] == zlib.crc32(part.tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    for doc, parts in by_doc.items():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == len(ids[doc])
    assert set(by_doc) == set(range(len(texts)))
    padding = total = 0
    for parts in sequences(pieces).values():
        at = 0
        for offset, _, _, n in parts:
            assert offset == at
            at += n
        assert at <= 2048 and len(parts) <= packing.MAX_SEGMENTS
        padding += 0 if at & (at - 1) == 0 else 2048 - at
        total += at
    assert padding <= 0.02 * total


def test_packing_ids_of_added_tokens(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"hello {end} world", end, f"{end}{end}", f"a  {end}\n\n b", f"  {end}  ", f"x{end}y", "<|endoftext|", f"<|{end}|>", f"é{end} 's"]
    draw = random.Random(23)
    texts += ["".join(draw.choice([end, " ", "  ", "\n", "a", "don't", "é", "<|", "|>", "12"]) for _ in range(draw.randint(1, 12))) for _ in range(300)]
    got = {}
    for r in packing.pack_documents(documents(spark, texts), VOCABULARY, public_tokenizers.PATTERN, with_ids=True).collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["ids"]))
    for i, text in enumerate(texts):
        assert [x for _, ids in sorted(got[i]) for x in ids] == [*tokenizer.encode(text, add_special_tokens=False).ids, 1], text


@pytest.mark.parametrize("words", [8, 18])
def test_many_short_documents_leave_little_padding(spark, words):
    docs = documents(spark, ["the of " * (words // 2) for _ in range(3000)])
    pieces = packing.pack_documents(docs, VOCABULARY, public_tokenizers.PATTERN).collect()
    used = padded = 0
    for parts in sequences(pieces).values():
        n = sum(p[3] for p in parts)
        assert n <= packing.MAX_TOKENS and len(parts) <= packing.MAX_SEGMENTS
        used, padded = used + n, padded + (n if n & (n - 1) == 0 else packing.MAX_TOKENS)
    assert used == sum({r["doc_id"]: r["doc_tokens"] for r in pieces}.values()) and (padded - used) / padded < 0.02


def test_packing_awkward_rows(spark):
    table = awkward(spark)
    pieces = packing.pack_documents(table, VOCABULARY, public_tokenizers.PATTERN).collect()
    assert Counter(r["doc_id"] for r in pieces if r["start"] == 0) == Counter(r["doc_id"] for r in table.collect())
    assert [r["doc_tokens"] for r in pieces if r["doc_id"] == 1] == [1]
    assert packing.pack_documents(awkward(spark, []), VOCABULARY, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("limits", [(64, 4, 64), (64, 64, 10), (32, 3, 8), (64, 1, 64)])
def test_packer_keeps_every_limit(limits):
    draw = np.random.default_rng(6)
    packer = packing.Packer(*limits)
    examples = [packing.example(i, np.arange(n), draw.random(n) < 0.4) for i, n in enumerate(draw.integers(1, 150, 200))]
    sizes = [len(e.ids) for e in examples]
    out = [s for e in examples for s in packer.add(e)] + list(packer.finish())
    seen = np.zeros(len(sizes), int)
    for pieces in out:
        assert sum(n for _, _, n in pieces) <= limits[0] and len(pieces) <= limits[1]
        assert sum(int(e.loss[s + n] - e.loss[s]) for e, s, n in pieces) <= limits[2]
        for e, s, n in pieces:
            assert s == seen[e.doc_id]
            seen[e.doc_id] += n
    assert seen.tolist() == sizes
