"""Numeric and categorical features on Spark ML, with long-form views for tables and reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    DCT,
    MaxAbsScaler,
    MinMaxScaler,
    Normalizer,
    OneHotEncoder,
    PolynomialExpansion,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
    VectorIndexer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.arrays import doubles
from shelfwise.operators.ids import dense_index
from shelfwise.operators.relational import among
from shelfwise.session import durable

SCALERS = {"standard": StandardScaler, "minmax": MinMaxScaler, "maxabs": MaxAbsScaler}


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features", invalid: str = "error") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid=invalid).transform(df)


def as_vector(df: DataFrame, array: str, out: str = "features") -> DataFrame:
    """Turn an array column into a dense vector column."""
    return df.withColumn(out, array_to_vector(doubles(F.col(array))))


def long_form(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``(key, pos, value)`` for every position of a short dense vector."""
    return df.select(key, F.posexplode(vector_to_array(vector)).alias("pos", "value")).withColumn(
        "pos", F.col("pos").cast("long")
    )


def nonzero_form(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``(key, pos, value)`` for the stored entries of a sparse vector; wide vectors stay sparse."""
    raw = F.unwrap_udt(vector)
    entries = F.arrays_zip(raw.getField("indices").alias("pos"), raw.getField("values").alias("value"))
    return df.select(key, F.inline(entries).alias("pos", "value")).withColumn("pos", F.col("pos").cast("long"))


def element(vector: Column, position: int) -> Column:
    return F.get(vector_to_array(vector), position)


def head(vector: Column, n: int) -> Column:
    return F.slice(vector_to_array(vector), 1, n)


def scale(df: DataFrame, columns: Sequence[str], kind: str, out: str = "scaled") -> DataFrame:
    """Assemble numeric columns and scale them: ``standard`` (no centring), ``minmax`` or ``maxabs``."""
    whole = assemble(df, columns, "_raw")
    return SCALERS[kind](inputCol="_raw", outputCol=out).fit(whole).transform(whole).drop("_raw")


def normalize(df: DataFrame, vector: str, p: float, out: str = "normalized") -> DataFrame:
    return Normalizer(inputCol=vector, outputCol=out, p=p).transform(df)


def expand(df: DataFrame, vector: str, degree: int = 3, out: str = "expanded") -> DataFrame:
    return PolynomialExpansion(inputCol=vector, outputCol=out, degree=degree).transform(df)


def cosine_transform(df: DataFrame, vector: str, inverse: bool = False, out: str = "transformed") -> DataFrame:
    return DCT(inputCol=vector, outputCol=out, inverse=inverse).transform(df)


def label_table(df: DataFrame, column: str, order: str = "frequencyDesc") -> DataFrame:
    """``(column, ix)``: the labels numbered by frequency, equal ones alphabetically, or by the alphabet alone.

    The numbers come from a range sort and one count for each partition, so a column may have any number of labels. Null is
    no label.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    keys = {"frequencyDesc": [-F.col("_n"), F.col(column)], "frequencyAsc": [F.col("_n"), F.col(column)], "alphabetAsc": [F.col(column)]}
    fields = [c.alias(f"k{n}") for n, c in enumerate(keys[order])]
    numbered = dense_index(counts.select(F.struct(*fields).alias("_key")), "_key", "_ix")
    return numbered.select(F.col(f"_key.k{len(fields) - 1}").alias(column), F.col("_ix").cast("double").alias("_ix"))


def index_labels(df: DataFrame, column: str, out: str, labels: DataFrame | None = None, order: str = "frequencyDesc", invalid: str = "error") -> DataFrame:
    """Label index column from a table of labels, by default the column's own.

    A value that is no label is an error, leaves its row out (``skip``), or gets the number of labels as its index (``keep``).
    """
    labels = label_table(df, column, order) if labels is None else labels
    if invalid == "skip":
        return df.join(labels.withColumnRenamed("_ix", out), column)
    other = labels.agg(F.count(F.lit(1)).cast("double")).scalar() if invalid == "keep" else F.raise_error(
        F.concat(F.lit(f"value of {column} without a label: "), F.coalesce(F.col(column).cast("string"), F.lit("null")))
    )
    return df.join(labels, column, "left").withColumn(out, F.when(F.col("_ix").isNotNull(), F.col("_ix")).otherwise(other)).drop("_ix")


def labels_back(df: DataFrame, column: str, out: str, labels: DataFrame) -> DataFrame:
    """Names of label indices from a table of labels, a join."""
    name = next(c for c in labels.columns if c != "_ix")
    return df.join(labels.select(F.col(name).alias(out), F.col("_ix").alias(column)), column, "left")


def product_rows(part: DataFrame) -> DataFrame:
    """``(p_partkey, pos, value)``: the entries other than 0 of what ``product_features`` gives, as rows from label tables."""
    numeric = ["p_retailprice", "p_size"]
    spreads = {c: part.agg(F.stddev_samp(c)).scalar() for c in numeric}
    start, found = len(numeric), []
    for pos, c in enumerate(numeric):
        found.append(part.select("p_partkey", F.lit(pos).cast("long").alias("pos"), F.coalesce(F.try_divide(F.col(c), spreads[c]), F.lit(0.0)).alias("value")))
    for c in ("p_brand", "p_type"):
        labels = durable(label_table(part, c))
        hot = index_labels(part.select("p_partkey", c), c, "ix", labels, invalid="skip")
        found.append(hot.select("p_partkey", (F.col("ix").cast("long") + start).alias("pos"), F.lit(1.0).alias("value")))
        start += labels.count()
    return reduce(DataFrame.unionByName, found).where("value <> 0")


def one_hot(df: DataFrame, columns: Sequence[str], outs: Sequence[str], drop_last: bool = True) -> DataFrame:
    encoder = OneHotEncoder(inputCols=list(columns), outputCols=list(outs), dropLast=drop_last)
    return encoder.fit(df).transform(df)


def dummies(df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], strict: bool = False) -> DataFrame:
    """One 0/1 column per value of a closed list; any other value is all zeros, or an error where ``strict``."""
    value = among(F.col(column), values) if strict else F.col(column)
    return df.select(*keys, *(F.when(value == v, 1.0).otherwise(0.0).alias(v) for v in values))


def index_categories(df: DataFrame, vector: str, most: int, out: str = "indexed", expected: Sequence[int] = ()) -> DataFrame:
    """Index vector positions with at most ``most`` distinct values; leave the others as they are.

    An ``expected`` position with more values is an error.
    """
    model = VectorIndexer(inputCol=vector, outputCol=out, maxCategories=most).fit(df)
    wide = set(expected) - set(model.categoryMaps)
    if wide:
        raise ValueError(f"positions {sorted(wide)} have more than {most} values")
    return model.transform(df)


def product_pipeline(numeric: Sequence[str], categorical: Sequence[str], out: str = "features") -> Pipeline:
    """Scaled numeric columns followed by one-hot categories in one vector; ids stay outside."""
    indexed, encoded = [f"{c}_ix" for c in categorical], [f"{c}_hot" for c in categorical]
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(numeric), outputCol="_numeric"),
            StandardScaler(inputCol="_numeric", outputCol="_scaled", withMean=False, withStd=True),
            StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
            VectorAssembler(inputCols=["_scaled", *encoded], outputCol=out),
        ]
    )


def product_features(part: DataFrame) -> tuple[DataFrame, PipelineModel]:
    """``(p_partkey, features)`` over price, size, brand and type, and the fitted pipeline."""
    model = product_pipeline(["p_retailprice", "p_size"], ["p_brand", "p_type"]).fit(part)
    return model.transform(part).select("p_partkey", "features"), model


def first_values(features: DataFrame, key: str, vector: str, n: int = 10) -> DataFrame:
    """The first row by key, its first ``n`` vector values as columns ``v1 .. vn``."""
    row = features.orderBy(key).limit(1).select(head(F.col(vector), n).alias("h"))
    return row.select(*(F.get("h", k).alias(f"v{k + 1}") for k in range(n)))
