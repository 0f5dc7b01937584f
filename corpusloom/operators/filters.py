"""Metadata filters written as dictionaries."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_COMPARE = {
    "$eq": lambda c, v: c == v, "$ne": lambda c, v: c != v, "$gt": lambda c, v: c > v, "$gte": lambda c, v: c >= v,
    "$lt": lambda c, v: c < v, "$lte": lambda c, v: c <= v, "$in": lambda c, v: c.isin(*v), "$nin": lambda c, v: ~c.isin(*v),
    "$contains": lambda c, v: F.contains(c.cast("string"), F.lit(v)),
}


def compiled(condition: dict[str, Any], df: DataFrame) -> Column:
    """``condition`` as one boolean column that is never null.

    Keys are columns, with dots into structs, or ``$and`` and ``$or`` over lists of conditions; a bare
    value means ``$eq``; several operators of a key all have to hold.  A column that is missing or null
    makes its comparison false, also for ``$ne`` and ``$nin``.  Unknown operators raise ValueError.  An empty condition is true.
    """
    parts = [_part(key, value, df) for key, value in condition.items()]
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def _part(key: str, value: Any, df: DataFrame) -> Column:
    if key in ("$and", "$or"):
        sides = [compiled(v, df) for v in value]
        return reduce((lambda a, b: a & b) if key == "$and" else (lambda a, b: a | b), sides, F.lit(key == "$and"))
    if key.startswith("$"):
        raise ValueError(f"unknown operator {key!r}")
    tests = value if isinstance(value, dict) else {"$eq": value}
    unknown = [op for op in tests if op not in _COMPARE]
    if unknown:
        raise ValueError(f"unknown operator {unknown[0]!r}")
    if not _exists(key, df):
        return F.lit(False)
    return reduce(lambda a, b: a & b, [F.coalesce(_COMPARE[op](F.col(key), v), F.lit(False)) for op, v in tests.items()], F.lit(True))


def _exists(key: str, df: DataFrame) -> bool:
    kind = df.schema
    for name in key.split("."):
        if not hasattr(kind, "fieldNames") or name not in kind.fieldNames():
            return False
        kind = kind[name].dataType
    return True


def filtered(df: DataFrame, condition: dict[str, Any] | None) -> DataFrame:
    return df.filter(compiled(condition, df)) if condition else df
