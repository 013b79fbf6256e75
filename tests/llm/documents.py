from __future__ import annotations

from pyspark.sql import types as T

#: Columns whose names the operators use themselves.
CLASHES = ["ids", "keys", "lines", "row", "host", "text_key", "gram", "kept", "leaks", "n", "at", "decoded", "bucket"]
LONG = "word " * 30_000 + "€ end"


def documents_schema(clashes: bool = True) -> T.StructType:
    fields = [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
    return T.StructType(fields + [T.StructField(c, T.StringType()) for c in CLASHES if clashes])


def make_documents(spark, rows, clashes: bool = False):
    """Documents from (doc_id, text[, lang[, source]])."""
    full = []
    for doc_id, text, *rest in rows:
        lang, source = (*rest, *("en", "src")[len(rest) :])
        full.append((doc_id, text, lang, source, None if text is None else len(text), *(["x"] * len(CLASHES) * clashes)))
    return spark.createDataFrame(full, documents_schema(clashes))


ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, LONG),
    (None, "a text without an id, which is long enough to be compared with any other text in here " * 3),
    (5, "the same text twice, row for row, and long enough to be found as a repeated string of bytes, yes"),
    (5, "the same text twice, row for row, and long enough to be found as a repeated string of bytes, yes"),
    (6, "one id with two texts, the first", None, None),
    (6, "one id with two texts, the second", "de", None),
    (7, "é€\U0001f600 \x00 ▁ <|endoftext|> <s>", "fr", "other"),
    (8, "12345 67890 !!!", None, "other"),
]
