"""Tables with the awkward rows every operator must take."""

LONG = "long " + "word " * 60_000 + "end"

#: doc_id, text, lang, source, n_chars; then columns whose names operators use inside
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, sha string, keep_id long, `_id` long, "
          "label int, toxic int, key long, doc long")

AWKWARD = [
    (1, None, None, None, None),
    (2, "", "en", "s", 0),
    (3, " \t\n", "en", "s", 3),
    (4, "one", "en", "s", 3),
    (5, "one", "en", "s", 3),
    (5, "one", "en", "s", 3),
    (6, "ONE", None, "s", 3),
    (7, LONG, "en", None, None),
    (8, "é ß 日本 \U0001f600 naïve café über alles", "de", "s", 1),
    (None, "a row without an id", "en", "s", 19),
]


def awkward(spark, rows=AWKWARD):
    return spark.createDataFrame([(*r, "x", 9, 9, 1, 1, 1, 1) for r in rows], SCHEMA)


def documents(spark, texts):
    """doc_id from 0, in the columns of the documents table."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def rows(df):
    return [tuple(r) for r in df.collect()]
