"""Recommendation jobs over user-item interactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.scalars import r6
from shelfwise.operators.relational import drop_keys, few, items_of, keep_keys, ranked, top_k
from shelfwise.operators.similarity import corated_cosine, cosine_from_counts, mean_cosine, mean_cosine_rows, shared_with_target


def copurchase_users(pairs: DataFrame, target: int, k: int = 10) -> DataFrame:
    """``(user_id, n_shared)``: the ``k`` users who share most distinct items with the target."""
    shared = keep_keys(pairs.where(F.col("u") != target), items_of(pairs, target), "i")
    counts = shared.groupBy(F.col("u").alias("user_id")).agg(F.count(F.lit(1)).alias("n_shared"))
    return top_k(counts, k, F.desc("n_shared"), F.asc("user_id"))


def _best(scored: DataFrame, key: str, name: str, k: int) -> DataFrame:
    """``(rank, name, score)``; scores are rounded before ranking so that ties go by id."""
    rows = scored.select(F.col(key).alias(name), r6(F.col("score")).alias("score"))
    return ranked(rows, k, F.desc("score"), F.asc(name)).select("rank", name, "score")


def content_top(
    pairs: DataFrame, features: DataFrame, target: int, peers: int = 10, k: int = 5
) -> DataFrame:
    """Items the target's nearest users bought and the target did not, by mean feature cosine.

    ``features`` is ``(i, pos, value)``, a row for each entry other than 0.
    """
    mine = items_of(pairs, target)
    near = few(copurchase_users(pairs, target, peers).select(F.col("user_id").alias("u")))
    candidates = drop_keys(keep_keys(pairs, near, "u").select("i").distinct(), mine, "i")
    scored = mean_cosine_rows(keep_keys(features, candidates, "i"), keep_keys(features, mine, "i"))
    return _best(scored, "i", "item_id", k)


def similar_users(pairs: DataFrame, target: int, k: int = 5) -> DataFrame:
    """Users closest to the target by cosine of their 0/1 item rows."""
    table = shared_with_target(pairs, target).where(F.col("u") != target)
    scored = table.withColumn("score", cosine_from_counts(table)).where(F.col("score").isNotNull())
    return _best(scored, "u", "user_id", k)


def neighbourhood_scores(weighted: DataFrame, target: int, factor: float = 0.5) -> DataFrame:
    """``(item_id, score)``: each unseen item's mean co-rated similarity to the target's items."""
    mine = items_of(weighted, target)
    unseen = drop_keys(corated_cosine(weighted, mine, factor).withColumnRenamed("b", "i"), mine, "i")
    return unseen.groupBy(F.col("i").alias("item_id")).agg(r6(F.avg("score")).alias("score"))


def factor_top(items: DataFrame, pairs: DataFrame, target: int, k: int = 5) -> DataFrame:
    """Items not bought by the target, by mean cosine to the bought ones in factor space.

    ``items`` is ``(i, v)`` with item rows scaled by the singular values. Cosines of those rows
    equal cosines of the low-rank reconstruction, which is never built.
    """
    mine = items_of(pairs, target)
    scored = mean_cosine(drop_keys(items, mine, "i"), keep_keys(items, mine, "i"), "v")
    return _best(scored, "i", "item_id", k)
