"""Database tables over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    """A JDBC address with its connection properties (user, password, driver)."""

    url: str
    properties: dict[str, str] = field(default_factory=dict, repr=False)  # holds the password
    fetch_size: int = 10_000
    batch_size: int = 10_000


def read_options(
    database: Database,
    table: str,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> dict[str, str]:
    """Reader options; with ``split_column`` and ``bounds`` the read is cut into parallel ranges.

    The bounds only place the cuts: rows outside them are still read.
    """
    if (split_column is None) != (bounds is None):
        raise ValueError("a parallel read needs both split_column and bounds")
    options = {**database.properties, "url": database.url, "dbtable": table, "fetchsize": str(database.fetch_size)}
    if split_column is not None:
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def key_bounds(spark: SparkSession, database: Database, table: str, column: str) -> tuple[int, int]:
    """Least and greatest key, computed by the database."""
    probe = f"(SELECT min({column}) AS lo, max({column}) AS hi FROM {table}) AS bounds"
    row = spark.read.format("jdbc").options(**read_options(database, probe)).load().first()
    return (int(row[0] or 0), int(row[1] or 0) + 1)


def read_table(
    spark: SparkSession,
    database: Database,
    table: str,
    split_column: str | None = None,
    partitions: int = 1,
    bounds: tuple[int, int] | None = None,
) -> DataFrame:
    if split_column is not None and bounds is None:
        bounds = key_bounds(spark, database, table, split_column)
    return spark.read.format("jdbc").options(**read_options(database, table, split_column, bounds, partitions)).load()


def write_table(df: DataFrame, database: Database, table: str, mode: str = "overwrite", connections: int = 8) -> None:
    """Write with at most ``connections`` open connections; ``mode`` is overwrite or append."""
    if mode not in {"overwrite", "append"}:
        raise ValueError("mode must be overwrite or append")
    (
        df.write.format("jdbc")
        .options(**database.properties)
        .option("url", database.url)
        .option("dbtable", table)
        .option("batchsize", database.batch_size)
        .option("numPartitions", connections)
        .option("truncate", mode == "overwrite")
        .mode(mode)
        .save()
    )
