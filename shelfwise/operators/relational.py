"""Relational preparation of order data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import durable

CHUNK = 1024
FEW = 100_000
MOST_COLUMNS = 15_000


def _chunk_of(size: int) -> Column:
    """Number of the ``size``-wide id range an item lies in (integer division, no doubles)."""
    return F.expr(f"i div {int(size)}").alias("chunk")


def purchases(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One row ``(u, i, q)`` per order line: user, item, quantity."""
    return orders.join(lineitem, orders["o_orderkey"] == lineitem["l_orderkey"]).select(
        F.col("o_custkey").alias("u"), F.col("l_partkey").alias("i"), F.col("l_quantity").alias("q")
    )


def order_pairs(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Distinct ``(u, i)`` straight from orders and lines."""
    return purchases(orders, lineitem).select("u", "i").distinct()


def interactions(
    orders: DataFrame, lineitem: DataFrame, part: DataFrame, customer: DataFrame
) -> DataFrame:
    """Distinct ``(u, i)`` of known users and known items.

    The pairs are reduced before they meet the two dimensions, which are joined on their keys as
    existence tests: no dimension column is needed afterwards.
    """
    pairs = order_pairs(orders, lineitem)
    items = part.select(F.col("p_partkey").alias("i"))
    users = customer.select(F.col("c_custkey").alias("u"))
    return pairs.join(items, "i", "left_semi").join(users, "u", "left_semi").select("u", "i")


def ratings(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """``(u, i, w)`` with the total quantity a user bought of an item."""
    return purchases(orders, lineitem).groupBy("u", "i").agg(F.sum("q").alias("w"))


def few(rows: DataFrame, bound: int | None = None) -> DataFrame:
    """Compute a side input once, and let Spark know when it is small.

    Up to ``bound`` rows come back as a local table of known size. Spark then broadcasts it and
    pushes existence tests on it below the distinct and the order join, down to the scans. More
    rows than that stay distributed in the checkpoint folder and are joined by shuffle.
    """
    bound = FEW if bound is None else bound
    table = rows.limit(bound + 1).toArrow()
    if table.num_rows <= bound:
        return rows.sparkSession.createDataFrame(table, rows.schema)
    return durable(rows)


def items_of(pairs: DataFrame, user: int) -> DataFrame:
    """Distinct items of one user."""
    return few(pairs.where(F.col("u") == user).select("i").distinct())


def keep_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    return df.join(keys.select(on), on, "left_semi")


def drop_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is not among ``keys``; keys must not be null."""
    return df.join(keys.select(on), on, "left_anti")


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)


def ranked(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows with a 1-based ``rank``; only those ``k`` rows meet in one task."""
    window = Window.orderBy(*order)
    return top_k(df, k, *order).withColumn("rank", F.row_number().over(window).cast("long"))


def top_k_per_group(df: DataFrame, group: str, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows of each group with their ``rank``.

    Spark cuts every partition to ``k`` rows per group before the shuffle, so a hot group
    arrives as at most ``k`` rows per map task.
    """
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window).cast("long")).where(F.col("rank") <= k)


def item_sets(pairs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Sorted item sets ``(u, chunk, items)``.

    A user's set is laid out in id ranges of ``chunk`` items, so no array exceeds ``chunk``
    entries however much one user bought; small catalogues give one row per user.
    """
    return (
        pairs.groupBy("u", _chunk_of(chunk))
        .agg(F.sort_array(F.collect_set("i")).alias("items"))
    )


def item_lists(lines: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Item lists with repeats, ``(u, chunk, items)`` of ``struct(i, n)`` sorted by item.

    Repeats are counted before collecting: an item bought a million times is one entry.
    """
    counted = lines.groupBy("u", "i").agg(F.count(F.lit(1)).alias("n"))
    return (
        counted.groupBy("u", _chunk_of(chunk))
        .agg(F.sort_array(F.collect_list(F.struct("i", "n"))).alias("items"))
    )


def explode_items(sets: DataFrame) -> DataFrame:
    return sets.select("u", F.explode("items").alias("i"))


def among(value: Column, values: Sequence) -> Column:
    """``value``, which must be null or one of ``values``."""
    unknown = F.raise_error(F.concat(F.lit("value outside the list: "), value.cast("string")))
    return F.when(value.isNull() | value.isin(list(values)), value).otherwise(unknown)


def values_of(df: DataFrame, column: str, most: int = MOST_COLUMNS) -> list | None:
    """The distinct values of a column in their own order (numbers as numbers), or None beyond ``most``; null is no value."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()
    return sorted(r[0] for r in found) if len(found) <= most else None


def indicator_pivot(pairs: DataFrame, row: str, column: str, prefix: str, most: int = MOST_COLUMNS) -> DataFrame:
    """0/1 matrix with one column for each value that occurs, in the values' order.

    The values come from a grouped pass of their own. Where there are more than ``most`` no table is wide enough: the result
    is then the same matrix in long form, ``(row, column, 1.0)`` for the cells that are not 0.
    """
    cells = pairs.select(row, column)
    values = values_of(cells, column, most)
    if values is None:
        return cells.where(F.col(column).isNotNull()).distinct().withColumn("value", F.lit(1.0))
    wide = cells.groupBy(row).pivot(column, values).agg(F.max(F.lit(1.0))) if values else cells.select(row).distinct()
    renamed = wide.select(row, *(F.col(f"`{v}`").alias(f"{prefix}{v}") for v in values))
    return renamed.na.fill(0.0)


def best_average(lines: DataFrame) -> DataFrame:
    """Mean quantity per (user, item), then the best of those means per item."""
    means = lines.groupBy("u", "i").agg(F.avg("q").alias("m"))
    return means.groupBy("i").agg(F.max("m").alias("best_avg"))
