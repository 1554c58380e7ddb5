"""The thin registered queries: an operator over its whole table, with
production parameters, returning the contract's columns."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import (
    benchmark_windows, best_position, bloom_cascade, bpe, chat_trees, fm_phrases, gbt_quality, grace, html_text, kn_toxicity, packing, pii,
    probminhash,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


@query()
def op1_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


@query()
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN)


@query("""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
           FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm)
""")
def op6_grace_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grace.dedup(table(spark, sf_dir, "documents"))


@query()
def op4_html_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query()
def op8_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return kn_toxicity.score(docs, kn_toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query()
def op7_gbt_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return gbt_quality.judge(docs, gbt_quality.fit(docs, table(spark, sf_dir, "labels")))


@query(r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS u FROM pages
), h AS (
  SELECT page_id,
         translate(regexp_extract(u, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(u, '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
  FROM p
), rules(verdict, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fit AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM h JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id
), hosts AS (
  SELECT DISTINCT host FROM h
), keys AS (
  SELECT host, array_to_string(string_split(host, '.')[i:], '.') AS key
  FROM hosts, LATERAL (SELECT unnest(range(1, len(string_split(host, '.')) + 1)) AS i)
), blocked AS (
  SELECT DISTINCT host FROM keys
  WHERE contains(key, '.') AND list_has_any(string_split(string_split(key, '.')[1], '-'),
                                           ['adult', 'ads', 'bets', 'casino', 'farm', 'pills', 'spam'])
)
SELECT h.page_id, h.host, h.path, fit.rule,
       coalesce(fit.verdict, CASE WHEN blocked.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN fit USING (page_id) LEFT JOIN blocked ON h.host = blocked.host
""")
def op9_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_cascade.judge(table(spark, sf_dir, "pages"))


@query(r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), e AS (
  SELECT *, length('<s>[ROLE]  [/ROLE]  </s>')
            + length(regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]|ROLE\]))', '\1\\\2\3', 'g'))
            + length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]|ROLE\]))', '\1\\\2\3', 'g')) AS n
  FROM c
), g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS said,
         coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS loss, CAST(sum(n) AS BIGINT) AS formatted_chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g
""")
def op10_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_trees.read_back(chat_trees.format_conversations(table(spark, sf_dir, "conversations")))


@query()
def op5_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                  public_tokenizers.PATTERN)


@query()
def op2_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.classes(table(spark, sf_dir, "documents"))


@query(r"""
WITH w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)
), f AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM w, range(1, 4) s(size))
  GROUP BY ALL HAVING count(*) >= 10
), cuts AS (
  SELECT c.lang, c.size, c.phrase, c.f AS a, k, l.f AS l, r.f AS r,
         CAST(CAST(1000000 AS HUGEINT) * c.f * c.f // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM f WHERE size > 1) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
), least AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, f
  FROM (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size = 3)
), kept AS (
  SELECT * FROM least c
  WHERE size = 3 OR NOT EXISTS (SELECT 1 FROM longer WHERE longer.lang = c.lang AND longer.phrase = c.phrase AND 100 * longer.f >= 50 * c.a)
), n AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
""")
def op11_fm_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_phrases.mine(table(spark, sf_dir, "documents"))


@query(r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), q AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL
), s AS (
  SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM t WHERE len(w) > 0
), p AS (
  SELECT doc_id, term, count(*) AS tf, any_value(n) AS n
  FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM t) WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term
), i AS (
  SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)) AS impact,
         CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) OVER (PARTITION BY term) + 1))) AS BIGINT) AS weight
  FROM p, s
), f AS (
  SELECT item_id, doc_id, CAST(sum(times * weight * impact) AS BIGINT) AS score FROM q JOIN i USING (term) GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM f WHERE score > 0 QUALIFY rank <= 20
""")
def op12_best_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_position.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, least(len(w), 10) AS size, w
  FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0
), g AS (
  SELECT DISTINCT item_id, size, array_to_string(w[pos:pos + size - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS pos FROM b)
), o AS (
  SELECT row, pos, size, array_to_string(w[pos:pos + size - 1], ' ') AS gram
  FROM (SELECT row, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM d, (SELECT DISTINCT size FROM g))
), h AS (
  SELECT row, pos, item_id, size FROM o JOIN g USING (size, gram)
), n AS (
  SELECT row, count(DISTINCT word) AS n_hit FROM (SELECT row, unnest(range(pos, pos + size)) AS word FROM h) GROUP BY row
), i AS (
  SELECT row, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT row, item_id FROM h) GROUP BY row
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (row) LEFT JOIN i USING (row)
""")
def op13_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_windows.mark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
