"""Similarity of items and users: dense vectors as expressions, sparse ones as long-form joins.

Nothing here builds a product of two tables. Comparing rows with one target uses the target as a
scalar subquery; averaging cosines over many targets uses the mean of their unit vectors, because

    mean_j cos(x, t_j) = x/|x| . mean_j(t_j/|t_j|)

so each candidate costs one dot product however many targets there are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.arrays import dot, unit
from shelfwise.operators.relational import few, items_of, keep_keys

ROWS_PER_SLICE = 100_000  # purchases of one user that may meet the target items in one task


def against_target(
    vectors: DataFrame, key: str, vector: str, target: int, measure: Callable[[Column, Column], Column]
) -> DataFrame:
    """``(a, b, score)`` of the target row ``a`` with every other row ``b``."""
    reference = vectors.where(F.col(key) == target).select(vector).scalar()
    others = vectors.where(F.col(key) != target).select(F.col(key).alias("b"), vector, reference.alias("_reference"))
    return others.select(
        F.lit(target).cast("long").alias("a"), "b", measure(F.col("_reference"), F.col(vector)).alias("score")
    ).where(F.col("score").isNotNull())


def mean_unit(vectors: DataFrame, vector: str) -> Column:
    """Mean of the unit vectors of a table as one scalar; zero vectors are left out."""
    units = vectors.select(unit(F.col(vector)).alias("v")).where(F.col("v").isNotNull())
    mean = Summarizer.mean(array_to_vector(F.col("v")))
    return units.agg(vector_to_array(mean).alias("v")).scalar()


def mean_cosine(candidates: DataFrame, targets: DataFrame, vector: str, score: str = "score") -> DataFrame:
    """Add the mean cosine of each candidate to all target vectors; zero candidates are dropped."""
    beside = candidates.withColumn("_mean", mean_unit(targets, vector))
    scored = beside.withColumn(score, dot(unit(F.col(vector)), F.col("_mean"))).drop("_mean")
    return scored.where(F.col(score).isNotNull())


def mean_cosine_rows(candidates: DataFrame, targets: DataFrame) -> DataFrame:
    """``(i, score)``: as ``mean_cosine`` for sparse vectors in rows ``(i, pos, value)``; the width of a vector is no matter."""

    def units(rows: DataFrame) -> DataFrame:
        lengths = rows.groupBy("i").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("length")).where("length > 0")
        return rows.join(lengths, "i").select("i", "pos", (F.col("value") / F.col("length")).alias("value"))

    held = units(targets)
    n = held.agg(F.countDistinct("i")).scalar()
    mean = held.groupBy("pos").agg((F.sum("value") / n).alias("m"))
    products = units(candidates).join(mean, "pos", "left")
    return products.groupBy("i").agg(F.sum(F.col("value") * F.coalesce("m", F.lit(0.0))).alias("score"))


def mean_item_cosine(pairs: DataFrame, target: int) -> DataFrame:
    """``(i, n_target, score)``: mean cosine of each item to the target user's items.

    Item vectors are the 0/1 columns of the user-item table. The target's unit item vectors are
    summed into one weight per user, so two grouped sums replace the candidate-by-target table.
    """
    mine = items_of(pairs, target)
    n_target = mine.agg(F.count(F.lit(1))).scalar()
    sizes = _sizes(keep_keys(pairs, mine, "i"), "i", "n")
    held = few(sizes.select("i", (1.0 / F.sqrt("n")).alias("share")))
    weights = pairs.join(held, "i").groupBy("u").agg(F.sum("share").alias("p"))
    scores = pairs.join(weights, "u", "left").groupBy("i").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("p", F.lit(0.0))).alias("s")
    )
    return scores.join(mine, "i", "left_anti").select(
        "i", n_target.alias("n_target"), F.try_divide(F.col("s"), F.sqrt("n") * n_target).alias("score")
    )


def shared_with_target(pairs: DataFrame, target: int) -> DataFrame:
    """``(u, n_items, n_shared, n_target)`` for every user: set sizes against the target's set."""
    mine = items_of(pairs, target)
    n_target = mine.agg(F.count(F.lit(1))).scalar()
    marked = pairs.join(mine.withColumn("hit", F.lit(1)), "i", "left")
    return marked.groupBy("u").agg(
        F.count(F.lit(1)).alias("n_items"), F.count("hit").alias("n_shared"), n_target.alias("n_target")
    )


def multiset_overlap(lines: DataFrame, target: int) -> DataFrame:
    """``(u, n_lines, n_shared, n_target)`` with repeats counted: shared = sum of lesser counts."""
    counted = lines.groupBy("u", "i").agg(F.count(F.lit(1)).alias("n"))
    mine = few(counted.where(F.col("u") == target).select("i", F.col("n").alias("m")))
    n_target = mine.agg(F.sum("m")).scalar()
    return counted.join(mine, "i", "left").groupBy("u").agg(
        F.sum("n").alias("n_lines"),
        F.sum(F.when(F.col("m").isNotNull(), F.least("n", "m")).otherwise(0)).alias("n_shared"),
        n_target.alias("n_target"),
    )


def cosine_from_counts(table: DataFrame) -> Column:
    """Cosine of 0/1 rows from ``n_shared``, ``n_items`` and ``n_target``."""
    return F.try_divide(table["n_shared"], F.sqrt(table["n_items"] * table["n_target"]))


def _beside_target_items(weighted: DataFrame, items: DataFrame, per_slice: int) -> DataFrame:
    """``(a, b, wa, wb)``: purchases of target items beside each other purchase of the same user.

    Only rows on target items stand on the left. A user with more than ``per_slice`` purchases is cut by item into as
    many slices as the count asks for, and that user's left rows are repeated for each; all others stay as they are.
    """
    counts = weighted.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / per_slice).cast("int").alias("slices"))
    heavy = few(counts.where("slices > 1"))
    slices = F.coalesce("slices", F.lit(1))
    left = keep_keys(weighted, items, "i").join(heavy, "u", "left").select(
        "u", F.col("i").alias("a"), F.col("w").alias("wa"), F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice")
    )
    right = weighted.join(heavy, "u", "left").select(
        "u", F.col("i").alias("b"), F.col("w").alias("wb"), F.pmod(F.xxhash64("i"), slices).cast("int").alias("slice")
    )
    return left.join(right, ["u", "slice"]).where(F.col("a") != F.col("b"))


def _sizes(pairs: DataFrame, item: str, size: str) -> DataFrame:
    return pairs.groupBy(F.col("i").alias(item)).agg(F.count(F.lit(1)).alias(size))


def item_cosine(pairs: DataFrame, items: DataFrame, per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """``(a, b, score)``: cosine of 0/1 user columns of each given item ``a`` with each item ``b``.

    Pairs without a common user have cosine 0 and are not listed.
    """
    own = few(_sizes(keep_keys(pairs, items, "i"), "a", "na"))
    both = _beside_target_items(pairs.withColumn("w", F.lit(1.0)), items, per_slice)
    shared = both.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_shared"))
    return (
        shared.join(own, "a").join(_sizes(pairs, "b", "nb"), "b")
        .select("a", "b", (F.col("n_shared") / F.sqrt(F.col("na") * F.col("nb"))).alias("score"))
    )


def corated_cosine(weighted: DataFrame, items: DataFrame, factor: float = 0.5, per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """``(a, b, score)``: ``factor`` times the cosine over the users who rated both items."""
    both = _beside_target_items(weighted, items, per_slice)
    sums = both.groupBy("a", "b").agg(
        F.sum(F.col("wa") * F.col("wb")).alias("ab"),
        F.sum(F.col("wa") * F.col("wa")).alias("aa"),
        F.sum(F.col("wb") * F.col("wb")).alias("bb"),
    )
    return sums.select("a", "b", F.try_divide(factor * F.col("ab"), F.sqrt(F.col("aa") * F.col("bb"))).alias("score")).where(
        F.col("score").isNotNull()
    )


def pearson(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(x, y, r)`` for every ordered pair of columns, from one aggregation pass.

    The diagonal is 1 by definition for a column that varies.
    """
    pairs = [(x, y) for n, x in enumerate(columns) for y in columns[n:]]
    stats = df.agg(*(F.corr(x, y).alias(f"{x}|{y}") for x, y in pairs))
    cells = [
        F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"`{a}|{b}`").alias("r"))
        for a, b in pairs
        for x, y in dict.fromkeys(((a, b), (b, a)))
    ]
    return stats.select(F.inline(F.array(*cells)))
