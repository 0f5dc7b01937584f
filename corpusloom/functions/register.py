"""The vector functions for SQL, as temporary SQL functions: no Python runs when they are called."""

from __future__ import annotations

from pyspark.sql import SparkSession

_BODIES = {
    "vector_dot": ("a ARRAY<DOUBLE>, b ARRAY<DOUBLE>", "DOUBLE", "aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, x) -> s + x)"),
    "vector_norm": ("a ARRAY<DOUBLE>", "DOUBLE", "sqrt(aggregate(a, 0D, (s, x) -> s + x * x))"),
    "vector_cosine": (
        "a ARRAY<DOUBLE>, b ARRAY<DOUBLE>", "DOUBLE",
        "CASE WHEN aggregate(a, 0D, (s, x) -> s + x * x) = 0 OR aggregate(b, 0D, (s, x) -> s + x * x) = 0 THEN 0D "
        "ELSE aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, x) -> s + x) / sqrt(aggregate(a, 0D, (s, x) -> s + x * x)) / sqrt(aggregate(b, 0D, (s, x) -> s + x * x)) END",
    ),
    "vector_distance": ("a ARRAY<DOUBLE>, b ARRAY<DOUBLE>", "DOUBLE", "aggregate(zip_with(a, b, (x, y) -> (x - y) * (x - y)), 0D, (s, x) -> s + x)"),
    "window_count": ("n INT, width INT, shared INT", "INT", "CASE WHEN n > 0 THEN int(1 + greatest(0, ceil((n - width) / greatest(1, width - shared)))) ELSE 0 END"),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Makes the functions known to SQL in this session; gives their names."""
    for name, (arguments, result, body) in _BODIES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    return list(_BODIES)
