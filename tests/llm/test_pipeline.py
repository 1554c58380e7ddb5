import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from cases import awkward, documents
from clickloom.llm import kn_toxicity, pii
from test_dedup import ASCII_LOWER, brute

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_run_equals_brute_force(spark):
    """The whole pipeline against plain Python over the documents at sf0.001."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = kn_toxicity.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    kept = [d for d in sorted(rows) if model.scores([rows[d]])[0] < 0.7]
    last = {rows[d].translate(ASCII_LOWER): d for d in kept}
    kept = sorted(last.values())
    classes = brute([rows[d] for d in kept])
    kept = [d for i, d in enumerate(kept) if classes[i] == i]
    tokenizer, find = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), pii.Finder().spans
    ids = {d: tokenizer.encode(pii.redacted(rows[d], sum(find(rows[d]), [])), add_special_tokens=False).ids + [1] for d in kept}
    got = defaultdict(list)
    for r in corpus_pipeline.run(spark, SMALL).collect():
        got[r["doc_id"]].append((r["start"], r["ids"], r["ids_crc32"]))
    assert sorted(got) == kept
    for d, parts in got.items():
        assert sum((p[1] for p in sorted(parts)), []) == ids[d]
        assert all(zlib.crc32(np.array(p[1], "<u4").tobytes()) == p[2] for p in parts)


def test_stage_order_and_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "pii", "packing"]
    for table in (documents(spark, ["a b c", "A b C", "", None, "mail x@y.zz"]), documents(spark, [])):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, table, SMALL).columns == COLUMNS


def test_stages_take_awkward_rows(spark):
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    assert sorted((r["doc_id"] for r in docs.collect()), key=repr) == sorted([2, 6, 7, 8, None], key=repr)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() > 5
