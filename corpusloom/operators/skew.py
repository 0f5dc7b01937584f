"""Joins on keys of which one may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one key that a task may get, and the most keys that are split (so their table stays small enough to broadcast).
ROWS, MOST_KEYS = 50_000, 100_000


def hot_keys(counted: DataFrame, key: str, total: int, rows: int | None = None) -> DataFrame:
    """Of (``key``, count), the keys of more than ``rows`` rows (ROWS if none is given), each with the number of parts it takes so that no part has more.

    Of ``total`` rows at most total / rows keys can be that frequent; where this would be over MOST_KEYS, ``rows`` is raised until it
    is not.  So at most MOST_KEYS short rows are broadcast, whatever the data."""
    most = max(rows or ROWS, -(-total // MOST_KEYS))
    parts = F.ceil(F.col("count") / most).cast("int").alias("parts")
    return F.broadcast(counted.filter(F.col("count") > most).select(key, parts))


def split_rows(rows: DataFrame, hot: DataFrame, key: str, *spread: str) -> DataFrame:
    """``rows`` with a column ``part``: for a hot key by the hash of the columns ``spread``, else 0."""
    part = F.pmod(F.xxhash64(*spread), F.coalesce("parts", F.lit(1))).cast("int")
    return rows.join(hot, key, "left").withColumn("part", part).drop("parts")


def repeat_rows(rows: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """``rows`` once for each part of their key, numbered in ``part``."""
    part = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    return rows.join(hot, key, "left").withColumn("part", part).drop("parts")
