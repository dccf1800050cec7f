"""Dense 0-based numbering of sparse ids."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import durable

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def dense_index(df: DataFrame, column: str, index: str) -> DataFrame:
    """``(column, index)`` with the same numbers as ``dense_rank() - 1``, without one big task.

    The distinct ids are range-partitioned, sorted inside each partition and written to the
    checkpoint folder, which freezes the partition bounds. Each id's number is then its place in
    its partition plus the rows of the partitions before it: one small count per partition.
    """
    ids = df.select(column).where(F.col(column).isNotNull()).distinct()
    ordered = durable(
        ids.repartitionByRange(F.col(column))
        .sortWithinPartitions(column)
        .select(column, F.monotonically_increasing_id().alias("_slot"))
    )
    part = F.shiftright("_slot", _ROW_BITS).cast("int")
    sizes = {r["p"]: r["n"] for r in ordered.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = [sizes.get(p, 0) for p in range(max(sizes, default=-1) + 1)]
    starts = [0, *accumulate(counts)][: max(len(counts), 1)]
    offset = F.array(*(F.lit(s).cast("long") for s in starts))[part]
    place = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return ordered.select(column, (offset + place).cast("long").alias(index))


def index_pairs(pairs: DataFrame) -> DataFrame:
    """``(u, i, u_ix, i_ix, label)`` with the label ``u_ix:i_ix``.

    The pairs are read three times, so they are computed once and kept in the checkpoint folder.
    """
    pairs = durable(pairs)
    users = dense_index(pairs, "u", "u_ix")
    items = dense_index(pairs, "i", "i_ix")
    return (
        pairs.join(users, "u").join(items, "i")
        .select("u", "i", "u_ix", "i_ix", F.concat_ws(":", "u_ix", "i_ix").alias("label"))
    )
