"""Token features over the documents table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shelfwise.functions.scalars import r6
from shelfwise.operators import features as feat
from shelfwise.operators import text as tx
from shelfwise.plans.registry import query
from shelfwise.session import durable, scratch_root
from shelfwise.sources import text

TOKENS = r"tok AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\s')) AS term FROM documents)"
MIN_DOCUMENTS = 5


_COMMON = f"""
    WITH {TOKENS} SELECT term, n FROM (
      SELECT term, n, row_number() OVER (ORDER BY n DESC, term) AS k FROM (SELECT term, count(*) AS n FROM tok GROUP BY term)) WHERE k > 20
    """


def _tokens(t):
    return tx.tokenize(t.documents.select("doc_id", "text")).drop("text")


def _counts(t):
    return tx.document_terms(_tokens(t), "doc_id")


@query("token_count", rf"SELECT doc_id, CAST(len(regexp_split_to_array(lower(text), '\s')) AS bigint) AS n FROM documents")
def token_count(t):
    return tx.token_count(_tokens(t)).select("doc_id", "n")


@query("tokenize", f"WITH {TOKENS} SELECT term, count(*) AS n FROM tok GROUP BY term")
def tokenize(t):
    return tx.term_counts(tx.terms(_tokens(t)))


@query(
    "regex_tokenize",
    r"""
    SELECT term, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-zA-Z0-9_]')) AS term FROM documents)
    WHERE term <> '' GROUP BY term
    """,
)
def regex_tokenize(t):
    return tx.term_counts(tx.terms(tx.tokenize_regex(t.documents.select("text"))))


@query(
    "stopwords",
    _COMMON,
)
def stopwords(t):
    counts = durable(tx.term_counts(tx.terms(_tokens(t))))
    return counts.join(tx.most_frequent(counts, 20).select("term"), "term", "left_anti")


@query("stopwords_file", _COMMON)
def stopwords_file(t):
    """As ``stopwords``, with the words kept in a text file, a word a line."""
    counts = durable(tx.term_counts(tx.terms(_tokens(t))))
    path = f"{scratch_root(t.spark)}/stopwords-{uuid.uuid4().hex}"
    tx.most_frequent(counts, 20).select("term").coalesce(1).write.text(path)
    return counts.join(text.read_words(t.spark, path), "term", "left_anti")


@query(
    "ngrams",
    r"""
    WITH d AS (SELECT regexp_split_to_array(lower(text), '\s') w FROM documents)
    SELECT term, count(*) AS n FROM (
      SELECT unnest([w[k] || ' ' || w[k + 1] for k in range(1, len(w))]) AS term FROM d) GROUP BY term
    """,
)
def ngrams(t):
    return tx.term_counts(tx.terms(tx.ngrams(_tokens(t)), "grams"))


@query(
    "count_vectorizer",
    f"""
    WITH {TOKENS}, c AS (SELECT doc_id, term, count(*) AS n FROM tok GROUP BY 1, 2),
    v AS (SELECT term FROM c GROUP BY term HAVING count(*) >= {MIN_DOCUMENTS})
    SELECT doc_id, term, n FROM c JOIN v USING (term)
    """,
)
def count_vectorizer(t):
    return tx.count_terms(_counts(t), "doc_id", MIN_DOCUMENTS).select("doc_id", "term", "n")


@query(
    "tfidf",
    f"""
    WITH {TOKENS}, c AS (SELECT doc_id, term, count(*) AS n FROM tok GROUP BY 1, 2),
    v AS (SELECT term, count(*) AS df FROM c GROUP BY term HAVING count(*) >= {MIN_DOCUMENTS})
    SELECT doc_id, term, round(n * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS w FROM c JOIN v USING (term)
    """,
)
def tfidf(t):
    return tx.tfidf(_counts(t), t.documents, "doc_id", MIN_DOCUMENTS).withColumn("w", r6(F.col("w")))


@query("hashing_tf")
def hashing_tf(t):
    return feat.nonzero_form(tx.hash_terms(_tokens(t), 20), "doc_id", "tf")


@query("word2vec")
def word2vec(t):
    """Every term has a vector, however rare it is."""
    return tx.embed_documents(_tokens(t), "doc_id").withColumn("value", r6(F.col("value")))


@query("feature_hasher")
def feature_hasher(t):
    hashed = tx.hash_columns(t.part, ["p_size", "p_retailprice", "p_brand", "p_type"])
    return feat.nonzero_form(hashed, "p_partkey", "hashed")
