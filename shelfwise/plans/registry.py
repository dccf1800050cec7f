"""Named queries over the given tables, each with its SQL counterpart where one exists."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

TARGET = 42


class Tables:
    """The parquet tables of one folder, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    orders = cached_property(lambda self: self._read("orders"))
    lineitem = cached_property(lambda self: self._read("lineitem"))
    part = cached_property(lambda self: self._read("part"))
    customer = cached_property(lambda self: self._read("customer"))
    events = cached_property(lambda self: self._read("events"))
    documents = cached_property(lambda self: self._read("documents"))
    labels = cached_property(lambda self: self._read("labels"))
    embeddings = cached_property(lambda self: self._read("embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register
