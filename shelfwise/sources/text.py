"""Text-shaped inputs: CSV, libsvm, delimited lines, JSON strings, word lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Charset names Spark accepts as they are.
_PLAIN_CHARSETS = {"utf-8", "utf-16", "utf-16be", "utf-16le", "utf-32", "iso-8859-1", "us-ascii"}


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str, charset: str = "UTF-8", header: bool = True
) -> DataFrame:
    """CSV with a given schema, so no pass over the data is spent on inference.

    For another charset, such as ``gbk``, Spark wants ``spark.sql.legacy.javaCharsets``. Spark looks at it again when
    the query runs, so it belongs in the session's configuration; without it this raises.
    """
    if charset.lower() not in _PLAIN_CHARSETS and spark.conf.get("spark.sql.legacy.javaCharsets", "false") != "true":
        raise ValueError(f"reading {charset} needs spark.sql.legacy.javaCharsets=true in the session's configuration")
    return spark.read.schema(schema).option("header", header).option("encoding", charset).csv(path)


def read_libsvm(spark: SparkSession, path: str, features: int) -> DataFrame:
    """``(label, features)``; stating the width saves a pass over the file."""
    return spark.read.format("libsvm").option("numFeatures", features).load(path)


def read_words(spark: SparkSession, path: str, column: str = "term") -> DataFrame:
    """One word per line, blank lines dropped."""
    return spark.read.text(path).select(F.trim("value").alias(column)).where(F.length(column) > 0).distinct()


def parse_delimited(
    lines: DataFrame, fields: dict[str, str], separator: str = "::", column: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Split text lines into typed columns ``{name: type}``.

    Returns the rows with exactly the expected fields, all of them parsable, and the raw lines
    of all others.
    """
    parts = F.split(F.col(column), f"\\Q{separator}\\E", -1)
    typed = F.struct(*(F.get(parts, i).try_cast(t).alias(n) for i, (n, t) in enumerate(fields.items())))
    whole = F.size(parts) == len(fields)
    for name in fields:
        whole = whole & F.col(f"_row.{name}").isNotNull()
    parsed = lines.withColumn("_row", typed)
    good = F.coalesce(whole, F.lit(False))
    return parsed.where(good).select("_row.*"), parsed.where(~good).select(column)


def parse_json(df: DataFrame, column: str, schema: StructType | str, into: str = "parsed") -> DataFrame:
    """Add a struct parsed from JSON text with a given schema; bad text gives null fields."""
    return df.withColumn(into, F.from_json(F.col(column), schema))


def as_json(*columns: str | Column) -> Column:
    """The given columns as one JSON object text."""
    return F.to_json(F.struct(*columns))
