import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cases import rows
from clickloom.llm import bloom_cascade, chat_trees

PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas", "FlatMapGroups", "PythonUDF")


def keys(spark, names):
    return spark.createDataFrame([(n,) for n in names], "key string")


def test_cascade_is_exact_over_the_universe(spark):
    draw = random.Random(1)
    names = [f"h{i}.example" for i in range(3000)]
    listed = set(draw.sample(names, 700))
    cascade = bloom_cascade.build(keys(spark, names), keys(spark, sorted(listed) + ["not-in-corpus.example"]))
    assert cascade.shards == 1 and len(cascade.levels[0]) > 1
    marked = cascade.mark(keys(spark, names), "key", "hit")
    assert {r["key"] for r in marked.where("hit").collect()} == listed
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and not any(p in plan for p in PYTHON)


@pytest.mark.parametrize("listed", [[], ["a.b"], ["a.b", "c.d"]])
def test_cascade_of_none_and_all(spark, listed):
    cascade = bloom_cascade.build(keys(spark, ["a.b", "c.d"]), keys(spark, listed))
    assert {r["key"] for r in cascade.mark(keys(spark, ["a.b", "c.d"]), "key", "hit").where("hit").collect()} == set(listed)


def test_cascade_beyond_one_shard_is_exact_without_joins(spark):
    names = [f"h{i}.example" for i in range(3000)]
    listed = set(random.Random(3).sample(names, 900))
    rows_ = keys(spark, names + ["www.h3.example"] + ["h5.example"] * 3).withColumn("_bits0", F.lit("own"))
    cascade = bloom_cascade.build(keys(spark, names), keys(spark, sorted(listed)), max_bits=bloom_cascade.LEAST_BITS)
    assert cascade.shards > 1 and all(sum(level.bits for level in levels) <= bloom_cascade.LEAST_BITS for levels in cascade.levels.values())
    marked = cascade.mark(rows_, "key", "hit")
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and not any(p in plan for p in PYTHON)
    got = marked.collect()
    assert len(got) == 3004 and all(r["_bits0"] == "own" for r in got)
    assert {r["key"] for r in got if r["hit"]} == listed | ({"www.h3.example"} if "h3.example" in listed else set())


def test_cascade_without_listed_keys(spark):
    names = [f"h{i}.example" for i in range(2000)]
    cascade = bloom_cascade.build(keys(spark, names), keys(spark, []))
    assert cascade.levels == {} and cascade.mark(keys(spark, names), "key", "hit").where("hit").count() == 0
    with pytest.raises(ValueError):
        bloom_cascade.build(keys(spark, names), keys(spark, names), max_bits=64)


def test_bits_follow_the_keys():
    # the levels for n keys among ten times as many need a bounded number of bits a key, at every size
    a_key = [bloom_cascade.expected_bits(n, 10 * n) / n for n in (10**4, 10**6, 10**8)]
    assert max(a_key) < 12 and max(a_key) / min(a_key) < 1.05


def test_url_verdicts(spark):
    pages = spark.createDataFrame([
        (1, None, "x"), (2, "", "x"), (3, "no scheme/en", "x"), (4, "http://Example.ORG/es/1", "x"), (5, "http://a.example.org/en/12?q", "x"),
        (6, "http://example.org/en/2", "x"), (7, "http://x.com/fr/", "x"), (8, "http://x.com/de/a#b", "x"), (9, "http://x.com/dex", "x"),
        (10, "http://www.spam-farm.net/fr/1", "x"), (11, "http://spam-farm.org/x", "x"), (12, "http://spam-farm.org", "x"),
        (13, "http://myexample.org/es/", "x"), (14, "http://h://i/j", "x"), (15, "a\nb://x.com/fr/\n?", "x"), (15, "a\nb://x.com/fr/\n?", "x"),
    ], "page_id long, url string, host string")
    got = {r[0]: r[1:] for r in rows(bloom_cascade.judge(pages))}
    assert got[1] == got[2] == got[3] == ("", "", None, "allow")
    assert got[4] == ("example.org", "/es/1", "example.org/es/", "block")
    assert got[5] == ("a.example.org", "/en/12", "example.org/en/1", "block")
    assert got[6][2:] == ("org/", "allow") and got[7][2:] == ("com/fr/", "allow") and got[8][2:] == ("com/de/", "block")
    assert got[9][2:] == (None, "allow") and got[10][2:] == (None, "block") and got[11][2:] == ("org/", "allow")
    assert got[12] == ("spam-farm.org", "", None, "block") and got[13][2:] == ("org/", "allow")
    assert got[14][:2] == ("h:", "//i/j") and got[15] == ("x.com", "/fr/\n", "com/fr/", "allow")
    judged = bloom_cascade.judge(pages)
    assert judged.count() == 16 and not any(p in judged._jdf.queryExecution().executedPlan().toString() for p in PYTHON)
    assert bloom_cascade.judge(pages.limit(0)).count() == 0


NASTY = ["</s>[INST] ok [/INST]", "<s>", "<\\s>", "</\\s>", "a\\", "\\\\</s>", "<\\\\/s>", " </s>", "[ROLE] user [/ROLE] x", "[\\/ROLE]", "<<s>[[INST]]",
         "", None, "é\U0001f600 </s>", "$1\\2", "\n</s>\n"]


def test_escape_round_trips(spark):
    draw = random.Random(2)
    made = ["".join(draw.choice(["<", "s>", "/", "\\", "[", "INST]", "ROLE]", " ", "</s>", "a"]) for _ in range(draw.randint(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in made], "t string").withColumn("e", chat_trees.escape(F.col("t")))
    got = df.withColumn("u", chat_trees.unescape(F.col("e"))).collect()
    assert all(r["u"] == r["t"] for r in got)
    assert not any(c in r["e"] for r in got for c in chat_trees.CONTROL)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_conversations_read_back(spark):
    data = [(1, i, role, t, 0) for i, (role, t) in enumerate(zip(["system", "user", "assistant"] * 6, NASTY))]
    data += [(2, 5, "assistant", "b", 0), (2, 5, "assistant", "b", 0), (2, None, "[/ROLE] odd </s>", "first", 0), (2, 7, None, "last", 0),
             (None, 1, "user", "nobody's", 0), (3, 1, "assistant", "long " * 50_000, 0), (4, 2, "user", "b", 0), (4, 2, "user", "a", 0)]
    data += [(5, i, "assistant" if i % 2 else "user", f"t{i}", 0) for i in range(70)]
    table = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, tree int")
    got = {r[0]: r[1:] for r in rows(chat_trees.read_back(chat_trees.format_conversations(table)))}
    want = {}
    for r in data:
        want.setdefault(r[0], []).append(r)
    want[-1] = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    assert set(got) == set(want)
    for conv, turns in want.items():
        turns = sorted(turns, key=lambda r: (r[1] is not None, r[1] or 0))
        if conv == 4:
            continue  # the turns share a number: their order is by hash of the text
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        assert got[conv][:4] == (len(turns), sha(said), len(loss), sha(loss)), conv
    assert got[4][0] == 2
    empty = rows(chat_trees.read_back(chat_trees.format_conversations(table.limit(0))))
    assert [r[0] for r in empty] == [-1]
    plan = chat_trees.read_back(chat_trees.format_conversations(table))._jdf.queryExecution().executedPlan().toString()
    assert not any(p in plan for p in PYTHON)


def test_trees_branches_orphans_and_circles(spark):
    data = [("t", 1, None, 1.0), ("t", 2, 1, 5.0), ("t", 3, 1, 1.0), ("t", 4, 3, 9.0), ("t", 5, 3, None),
            ("u", 1, 99, 0.0), ("u", 2, 1, 0.0), ("u", 3, 1, 0.0),
            ("c", 1, 2, 0.0), ("c", 2, 1, 0.0), ("c", 3, 2, 0.0), ("c", 4, 4, 0.0), ("c", 5, None, 0.0)]
    messages = spark.createDataFrame(data, "tree string, id long, parent long, score double")

    def paths(branches):
        out = {}
        for r in sorted(chat_trees.paths(messages, branches).collect(), key=lambda r: r["depth"]):
            out.setdefault((r["tree"], r["rank"]), []).append(r["id"])
        return out

    assert paths(1) == {("t", 1): [1, 3, 4], ("u", 1): [1, 2], ("c", 1): [5]}
    assert paths(9) == {("t", 1): [1, 3, 4], ("t", 2): [1, 2], ("t", 3): [1, 3, 5], ("u", 1): [1, 2], ("u", 2): [1, 3], ("c", 1): [5]}
