"""A documents table with every awkward case, and helpers."""

from pyspark.sql import types as T

LONG = "Anblewh sttible athawh " * 4000
DOCS = [
    (1, "a b c d e f g", "en", "s", 13), (1, "a b c d e f g", "en", "s", 13), (2, "a  b\tc d e f g", None, None, None), (3, None, "en", "s", 0),
    (4, "", "en", "s", 0), (5, " ", "en", "s", 1), (6, LONG, "de", "s", len(LONG)), (7, LONG, "de", "s", len(LONG)), (None, "orphan text of nobody", "en", "s", 3),
    (None, None, None, None, None), (8, "naïve 😀 漢字 mail: jo@mail.example.com, +1 (487) 555-7209", "fr", "s", 9), (9, "x" * 50_000, "en", "s", 50_000),
]
SCHEMA = T.StructType([
    T.StructField(n, t) for n, t in
    [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType())]
])
CLASHING = ["kept", "keep_id", "node", "name", "words", "fp", "sha", "norm", "spans", "terms", "_terms", "_clean", "_id", "_print", "entry", "since", "n_active",
            "host", "tree", "html", "length", "piece", "slot", "component", "size", "class_id", "_gone", "word", "print", "contexts", "label", "_text"]


def awkward(spark):
    """The rows above with extra columns named like anything the operators use inside."""
    docs = spark.createDataFrame(DOCS, SCHEMA)
    return docs.selectExpr("*", *(f"'{c}' as {c}" for c in CLASHING))


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def many(rows):
    """Rows as a sorted list, nulls first."""
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, str(x)) for x in r))
