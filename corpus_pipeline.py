"""From raw documents to packed training sequences, a stage at a time.

Each stage takes every row its predecessor kept and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import exact_dedup, near_join, packing, pii, quality
from shelfwise.session import durable


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; the model is fitted on labelled rows of ``docs``.

    Null and empty texts fail on their words, long ones are judged whole, repeated rows each time; without labels of both
    kinds the counted rules decide alone. An empty table stays empty; other columns are kept as they are.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit(docs, labels))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id.

    Null counts as empty, and empty texts as one text. Of an id with several texts only the copies go; rows that repeat id and
    text share one verdict, and so do rows without an id. An empty table stays empty; other columns are kept.
    """
    return exact_dedup.drop_duplicates(docs)


def unlike_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the document with the smallest id.

    Of an id with several texts only the copies go; a row without an id stays, as do rows that repeat id and words. Null and
    empty texts are one class. An empty table stays empty; other columns are kept.
    """
    return near_join.drop_near_duplicates(docs)


def sanitised_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and what gives it away as labels.

    Null texts stay null or empty, every row is kept, repeated ones too; texts of any length are treated whole.
    """
    return pii.sanitise(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document: its place in a sequence of at most 2048 tokens.

    A null or empty text is one closing token. Longer documents are cut; repeated rows are packed each time; an empty table
    gives no rows.
    """
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality rules", good_documents),
    ("exact dedup", distinct_documents),
    ("n-gram Jaccard join", unlike_documents),
    ("PII", sanitised_documents),
    ("best-fit packing", packed_sequences),
]

#: The quality verdict, the similarity classes and the tokenizer have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
