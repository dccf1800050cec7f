"""Catalog tables and daily partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "etldate"


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).saveAsTable(name)


def load_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def write_daily(df: DataFrame, path: str, day: Column | str | None = None) -> None:
    """Write by ``etldate``, replacing only the days present in ``df``.

    Every task writes the days it holds; there is no shuffle that would put one day in one task.
    """
    if day is not None:
        df = df.withColumn(DAY, F.lit(day) if isinstance(day, str) else day)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )


def latest(df: DataFrame, day: str = DAY) -> DataFrame:
    """Rows of the greatest day.

    The day is a scalar subquery, so on a day-partitioned table Spark resolves it first and
    lists the files of that one partition only.
    """
    newest = df.agg(F.max(day)).scalar()
    return df.where(F.col(day) == newest)


def latest_by_time(df: DataFrame, ts: str) -> DataFrame:
    """Rows of the greatest day of a time column.

    The bound is the start of that day, compared with the bare column, so the scan skips what lies before it.
    """
    start = df.agg(F.date_trunc("day", F.max(ts))).scalar()
    return df.where(F.col(ts) >= start)


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    return latest(spark.read.parquet(path))
