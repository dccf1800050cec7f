"""Matrix factors of tables of any width: SVD and PCA by block Krylov steps (see ``krylov``)."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.krylov import TableSvd, table_svd
from shelfwise.session import durable


def energy(s: np.ndarray, total: float) -> np.ndarray:
    """Share of the squared weight kept by the first 1, 2, .. singular values."""
    return np.cumsum(np.asarray(s) ** 2) / total


def rank_for(s: np.ndarray, total: float, share: float = 0.95) -> int | None:
    """Least number of singular values keeping ``share`` of the squared weight; None if too few."""
    reached = np.flatnonzero(energy(s, total) >= share - 1e-12)
    return int(reached[0]) + 1 if reached.size else None


def vector_entries(df: DataFrame, key: str, vector: str) -> DataFrame:
    """The ``(row, col, w)`` entries of a vector column; zeros are left out."""
    cells = df.select(F.col(key).cast("long").alias("row"), F.posexplode(vector_to_array(F.col(vector))).alias("col", "w"))
    return cells.where("w <> 0").withColumn("col", F.col("col").cast("long"))


def pair_svd(pairs: DataFrame, k: int, **options) -> TableSvd:
    """SVD of the 0/1 matrix of distinct ``(row, col)`` pairs."""
    return table_svd(pairs.distinct().withColumn("w", F.lit(1.0)), k, once=True, **options)


def vector_svd(df: DataFrame, key: str, vector: str, k: int, **options) -> TableSvd:
    """SVD of the matrix whose rows are ``(key, vector)``."""
    return table_svd(vector_entries(df, key, vector), k, **options)


def pca(df: DataFrame, key: str, vector: str, k: int, out: str = "components") -> tuple[DataFrame, np.ndarray]:
    """``df`` projected onto its first ``k`` principal directions, and each direction's share of the variance.

    Columns are centred in the products only, so a sparse table stays sparse; the projected rows are not centred, as in
    Spark ML. Directions without variance are zeros.
    """
    entries = durable(vector_entries(df, key, vector))
    n = df.count()
    found = table_svd(entries, k, centre_rows=n)
    means = entries.groupBy("col").agg((F.sum("w") / n).alias("m"), F.sum(F.col("w") * F.col("w")).alias("q"))
    total = means.agg(F.sum(F.col("q") - n * F.col("m") * F.col("m"))).first()[0] or 0.0
    shares = np.zeros(k)
    if total > 0:
        shares[: len(found.s)] = found.s**2 / total
    blank = F.array_repeat(F.lit(0.0), k)
    scores = found.rows.toDF("_row", "_scores")
    filled = F.slice(F.concat(F.coalesce("_scores", F.array().cast("array<double>")), blank), 1, k)
    projected = df.join(scores, F.col(key).cast("long") == F.col("_row"), "left").withColumn(out, array_to_vector(filled)).drop("_row", "_scores")
    return projected, shares
