"""Token features of documents.

Long-form operators (one row per document and term) scale with the corpus: counts are combined
before each shuffle and no vocabulary passes through the driver. The vector operators use the
Spark ML stages, whose vocabularies are bounded by a parameter.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.feature import (
    CountVectorizer,
    CountVectorizerModel,
    FeatureHasher,
    HashingTF,
    IDF,
    NGram,
    RegexTokenizer,
    StopWordsRemover,
    Tokenizer,
)
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from shelfwise.operators.ids import dense_index
from shelfwise.operators.krylov import table_svd
from shelfwise.operators.relational import top_k
from shelfwise.session import durable, release

PART = 1 << 19  # tokens whose neighbours are counted at once
CHUNK = 1 << 19  # tokens that share a list of terms


def tokenize(df: DataFrame, text: str = "text", out: str = "tokens") -> DataFrame:
    """Lower-case and split at every whitespace character."""
    return Tokenizer(inputCol=text, outputCol=out).transform(df)


def tokenize_regex(
    df: DataFrame, text: str = "text", out: str = "tokens", pattern: str = r"\W", gaps: bool = True, shortest: int = 1
) -> DataFrame:
    """Lower-case and split at (or collect, without ``gaps``) matches of an ASCII pattern."""
    stage = RegexTokenizer(inputCol=text, outputCol=out, pattern=pattern, gaps=gaps, minTokenLength=shortest)
    return stage.transform(df)


def token_count(df: DataFrame, tokens: str = "tokens", out: str = "n") -> DataFrame:
    return df.withColumn(out, F.size(tokens).cast("long"))


def remove_words(df: DataFrame, words: Sequence[str], tokens: str = "tokens", out: str = "kept") -> DataFrame:
    """Drop a given short list of words from token arrays, ignoring case."""
    return StopWordsRemover(inputCol=tokens, outputCol=out, stopWords=list(words)).transform(df)


def ngrams(df: DataFrame, n: int = 2, tokens: str = "tokens", out: str = "grams") -> DataFrame:
    return NGram(n=n, inputCol=tokens, outputCol=out).transform(df)


def terms(df: DataFrame, tokens: str = "tokens", key: str | None = None) -> DataFrame:
    """One row per token occurrence.

    The outer form keeps Spark from adding an emptiness filter that would tokenize every text
    again; the null row of an empty text is dropped right after.
    """
    rows = df.select(*([key] if key else []), F.explode_outer(tokens).alias("term"))
    return rows.where(F.col("term").isNotNull())


def term_counts(occurrences: DataFrame) -> DataFrame:
    """``(term, n)`` over the whole corpus; each task ships one partial count per term."""
    return occurrences.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def most_frequent(counts: DataFrame, k: int) -> DataFrame:
    return top_k(counts, k, F.desc("n"), F.asc("term"))


def document_terms(df: DataFrame, key: str, tokens: str = "tokens") -> DataFrame:
    """``(key, term, n)``: how often each document holds each term."""
    return terms(df, tokens, key).groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))


def vocabulary(counts: DataFrame, min_documents: int = 1) -> DataFrame:
    """``(term, df, cf)``: documents and occurrences per term, rare terms left out.

    ``counts`` are document terms, so a term's rows are added up on the map side first. Testing
    ``n`` keeps the column alive, and with it the same shuffle as the counts themselves: Spark
    reuses that one instead of tokenizing the corpus twice.
    """
    totals = counts.groupBy("term").agg(F.count_if(F.col("n") > 0).alias("df"), F.sum("n").alias("cf"))
    return totals.where(F.col("df") >= min_documents)


def count_terms(counts: DataFrame, key: str, min_documents: int) -> DataFrame:
    """Document terms limited to the vocabulary, a part of which each task holds, so that the document terms are not sorted."""
    known = vocabulary(counts, min_documents).select("term", "df", "cf")
    return counts.join(known.hint("shuffle_hash"), "term").select(key, "term", "n", "df")


def tfidf(counts: DataFrame, documents: DataFrame, key: str, min_documents: int = 1) -> DataFrame:
    """``(key, term, w)`` with ``w = n * ln((m + 1) / (df + 1))`` over ``m`` documents."""
    m = documents.agg(F.count(F.lit(1))).scalar()
    weighted = count_terms(counts, key, min_documents)
    return weighted.select(key, "term", (F.col("n") * F.log((m + 1) / (F.col("df") + 1))).alias("w"))


def hash_terms(df: DataFrame, buckets: int = 20, tokens: str = "tokens", out: str = "tf") -> DataFrame:
    return HashingTF(numFeatures=buckets, inputCol=tokens, outputCol=out).transform(df)


def weigh(df: DataFrame, counts: str = "tf", out: str = "tfidf", min_documents: int = 0) -> DataFrame:
    """Inverse-document-frequency weights on term-frequency vectors."""
    return IDF(inputCol=counts, outputCol=out, minDocFreq=min_documents).fit(df).transform(df)


def fit_counts(
    df: DataFrame, size: int = 1 << 18, min_documents: float = 1.0, tokens: str = "tokens", out: str = "counts", whole: bool = False
) -> CountVectorizerModel:
    """Vocabulary of at most ``size`` terms, most frequent first.

    With ``whole`` more terms than ``size`` are an error instead of being left out.
    """
    if whole:
        model = CountVectorizer(inputCol=tokens, outputCol=out, vocabSize=size + 1, minDF=min_documents).fit(df)
        if len(model.vocabulary) > size:
            raise ValueError(f"more than {size} terms")
        return model
    return CountVectorizer(inputCol=tokens, outputCol=out, vocabSize=size, minDF=min_documents).fit(df)


def weighted_vectors(df: DataFrame, key: str, common: int = 20, min_documents: int = 1, tokens: str = "tokens", out: str = "features") -> tuple[DataFrame, DataFrame]:
    """``(key, out)``, a row for each row of ``df`` with its sparse tf-idf vector, and ``(term, ix)``, the vector's places.

    The ``common`` most frequent terms and those of fewer than ``min_documents`` rows are left out. The vocabulary is a
    table throughout and has no bound. Vectors are written as the fields that Spark ML stores them in, and read back as vectors.
    """
    rows = durable(df.select(key, tokens, F.monotonically_increasing_id().alias("_row")))
    counts = durable(document_terms(rows, "_row", tokens))
    frequent = most_frequent(counts.groupBy("term").agg(F.sum("n").alias("n")), common).select("term")
    known = durable(vocabulary(counts.join(frequent, "term", "left_anti"), min_documents))
    places = dense_index(known, "term", "ix")
    m, size = rows.count(), known.count()
    weights = known.join(places, "term").select("term", F.col("ix").cast("int").alias("ix"), F.log((F.lit(m) + 1) / (F.col("df") + 1)).alias("idf"))
    cells = counts.join(weights, "term").groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("ix", (F.col("n") * F.col("idf")).alias("w")))).alias("c"))
    held = F.coalesce("c", F.array().cast("array<struct<ix:int,w:double>>"))
    vector = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"), held["ix"].alias("indices"), held["w"].alias("values"))
    written = durable(rows.select(key, "_row").join(cells, "_row", "left").select(key, vector.alias(out)))
    release(rows, counts)
    return df.sparkSession.read.schema(StructType([written.schema[key], StructField(out, VectorUDT())])).parquet(written.scratch_path), places


def _counted_near(window: int, part: int):
    """Function counting the neighbours of batches of token arrays, ``part`` places at a time, once whatever their order."""

    def count(batches):
        for batch in batches:
            lists = batch.column(0)
            kind, text = lists.type.value_type, np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            coded = lists.flatten().dictionary_encode()
            known, codes = coded.dictionary, pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo in range(0, len(codes), part):
                keys = [np.zeros(0, np.int64)]
                for d in range(1, window + 1):
                    b = codes[lo + d : lo + d + part]
                    a = codes[lo : lo + len(b)]
                    both = (a >= 0) & (b >= 0) & (text[lo : lo + len(b)] == text[lo + d : lo + d + len(b)])
                    keys.append(np.minimum(a, b)[both] * len(known) + np.maximum(a, b)[both])
                found, n = np.unique(np.concatenate(keys), return_counts=True)
                for at in range(0, len(found), 1 << 16):
                    pair = found[at : at + (1 << 16)]
                    columns = [known.take(pa.array(c)).cast(kind) for c in (pair // len(known), pair % len(known))]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(n[at : at + (1 << 16)])], ["a", "b", "n"])

    return count


def _near_once(df: DataFrame, window: int, tokens: str) -> DataFrame:
    """``(a, b, n)`` with ``a <= b``: how often two terms stand at most ``window`` places apart."""
    kind = df.schema[tokens].dataType.elementType.simpleString()
    pairs = df.select(tokens).mapInArrow(_counted_near(window, PART), f"a {kind}, b {kind}, n long")
    return pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("n").alias("n"))


def neighbouring_terms(df: DataFrame, window: int = 5, tokens: str = "tokens") -> DataFrame:
    """``(a, b, n)``: how often two terms stand at most ``window`` places apart, in both directions.

    Pairs are counted in the tasks, and once whatever their order; they are turned around after the only shuffle. Null tokens
    keep their places and have no neighbours.
    """
    return _near_once(df, window, tokens).select(F.inline(F.expr(
        "if(a = b, array(struct(a, b, 2 * n AS n)), array(struct(a, b, n), struct(b AS a, a AS b, n)))"
    )))


def _in_chunks(size: int):
    """Function packing batches of token arrays into rows of about ``size`` tokens: the different terms, and the texts by their places among these."""

    def pack(batches):
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            lists = batch.column(0)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            lo = 0
            while lo < len(lists):
                before = ends[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, before + size, "right")))
                coded = lists.slice(lo, hi - lo).flatten().dictionary_encode()
                codes = pc.fill_null(coded.indices, len(coded.dictionary)).to_numpy(zero_copy_only=False).astype(np.int32)
                held = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary.cast(pa.string()))
                rest = [pa.array([x.tobytes()], pa.binary()) for x in (codes, (ends[lo:hi] - before).astype(np.int64))]
                yield pa.RecordBatch.from_arrays([pa.array([number]), held, *rest], ["chunk", "terms", "codes", "ends"])
                lo, number = hi, number + 1

    return pack


def _translated(chunk: pa.Table, numbers: pa.Table) -> pa.Table:
    if not chunk.num_rows:
        return pa.table({"ids": pa.array([], pa.list_(pa.int64()))})
    row = chunk.select(["codes", "ends"]).to_pylist()[0]
    codes, ends = np.frombuffer(row["codes"], np.int32), np.frombuffer(row["ends"], np.int64)
    ids = np.full(int(codes.max(initial=0)) + 1, -1)
    places = numbers["pos"].to_numpy()
    good = places < len(ids)
    ids[places[good]] = numbers["ix"].to_numpy()[good]
    ids = ids[codes]
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids, mask=ids < 0))
    return pa.table({"ids": lists})


def number_tokens(df: DataFrame, numbers: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``(ids)``: a row for each text with its terms' numbers from ``(term, ix)``, nulls where a term has none.

    What is shuffled is the different terms of each chunk of texts, and the chunks themselves, not the tokens as text.
    """
    chunks = durable(df.select(tokens).where(F.size(tokens) > 0).mapInArrow(_in_chunks(CHUNK), "chunk long, terms array<string>, codes binary, ends binary"))
    known = chunks.select(F.col("chunk").alias("of"), F.posexplode("terms").alias("pos", "term")).join(numbers, "term").select("of", "pos", "ix")
    return chunks.select("chunk", "codes", "ends").groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(_translated, "ids array<long>")


def term_vectors(df: DataFrame, size: int = 3, least: int = 1, window: int = 5, negatives: float = 1.0, tokens: str = "tokens") -> DataFrame:
    """``(term, v)``: term vectors from the positive pointwise mutual information of terms that stand near each other, less the
    log of ``negatives``, by the SVD of that table: what word2vec with negative sampling factors implicitly.

    Terms met fewer than ``least`` times have none. The vocabulary is a table throughout; terms meet as numbers.
    """
    common = term_counts(terms(df, tokens)).where(F.col("n") >= least).select("term")
    numbers = dense_index(common, "term", "ix")
    near = durable(_near_once(number_tokens(df, numbers, tokens), window, "ids"))
    both = F.inline(F.expr("if(a = b, array(struct(a AS ix, 2 * n AS n)), array(struct(a AS ix, n), struct(b AS ix, n)))"))
    sums = durable(near.select(both).groupBy("ix").agg(F.sum("n").alias("n")))
    total = sums.agg(F.sum("n")).scalar()
    left, right = sums.toDF("a", "na"), sums.toDF("b", "nb")
    n = F.when(F.col("a") == F.col("b"), 2 * F.col("n")).otherwise(F.col("n"))
    gain = F.log(n * total / (F.col("na").cast("double") * F.col("nb"))) - F.log(F.lit(float(negatives)))
    entries = near.join(left, "a").join(right, "b").select("a", "b", gain.alias("w")).where("w > 0")
    entries = entries.select(F.inline(F.expr(
        "if(a = b, array(struct(a AS row, b AS col, w)), array(struct(a AS row, b AS col, w), struct(b AS row, a AS col, w)))"
    )))
    found = table_svd(entries, size, tolerance=1e-5, once=True)
    roots = F.lit([float(x) ** 0.5 for x in found.s])
    vectors = found.rows.select(F.col("row").alias("ix"), F.zip_with("v", roots, lambda x, r: x / r).alias("v"))
    return numbers.join(vectors, "ix").select("term", "v")


def embed_documents(df: DataFrame, key: str, size: int = 3, tokens: str = "tokens", **options) -> DataFrame:
    """``(key, pos, value)``: the mean term vector of each document over all its tokens; terms without a vector count as zeros."""
    vectors = durable(term_vectors(df, size, tokens=tokens, **options))
    counts = df.select(key, F.explode(tokens).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))
    parts = counts.join(vectors, "term").select(key, "n", F.posexplode("v").alias("pos", "x")).groupBy(key, "pos").agg(F.sum(F.col("n") * F.col("x")).alias("x"))
    every = df.select(key, F.size(tokens).alias("length"), F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("pos"))
    value = F.coalesce(F.try_divide(F.col("x"), F.col("length")), F.lit(0.0))
    return every.join(parts, [key, "pos"], "left").select(key, F.col("pos").cast("long").alias("pos"), value.alias("value"))


def hash_columns(df: DataFrame, columns: Sequence[str], buckets: int = 300, out: str = "hashed") -> DataFrame:
    """Hash mixed columns: numbers under their name, text and flags under ``name=value``."""
    return FeatureHasher(inputCols=list(columns), outputCol=out, numFeatures=buckets).transform(df)
