"""Scalar column expressions: tolerant casts, flags and repeatable splits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_or(text: Column, default: float = 0.0) -> Column:
    """Parse text as double; missing or unparsable text becomes ``default``."""
    return F.coalesce(F.trim(text).try_cast("double"), F.lit(default))


def flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def day(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def in_sample(key: Column, share: float = 0.7) -> Column:
    """True for a fixed ``share`` of keys.

    It compares the key's MD5 with a threshold, so a row falls on the same side whatever the
    partitioning; ``randomSplit`` gives no such promise.
    """
    if not 0.0 < share < 1.0:
        raise ValueError("share must lie between 0 and 1")
    threshold = format(int(share * 16**4), "04x")
    return F.md5(key.cast("string")) < F.lit(threshold)


def fold_of(key: Column, folds: int) -> Column:
    """Stable fold number of a key, for cross-validation."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long"), F.lit(folds)).cast("int")


def r6(value: Column) -> Column:
    return F.round(value.cast("double"), 6)
