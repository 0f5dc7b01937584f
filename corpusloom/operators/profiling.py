"""Profiles of tables: rows, distinct values, duplicates, exact percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.skew import hot_keys, repeat_rows, split_rows
from corpusloom.session import written


def scan_profile(df: DataFrame, id_col: str) -> DataFrame:
    """One row: n_rows, n_ids (not null), n_null_ids, n_distinct, rows_per_id (null without ids)."""
    out = df.agg(F.count("*").alias("n_rows"), F.count(id_col).alias("n_ids"), F.count_if(F.col(id_col).isNull()).alias("n_null_ids"), F.count_distinct(id_col).alias("n_distinct"))
    return out.withColumn("rows_per_id", F.round(F.try_divide("n_rows", "n_distinct"), 6))


def id_uniqueness(df: DataFrame, id_col: str) -> DataFrame:
    """One row: all_unique (no null and no id twice), n_rows, unique_ids, duplicates (non-null rows beyond the
    first of their id), null_ids, uniqueness_rate (distinct ids in percent of all rows; null for an empty table)."""
    p = scan_profile(df, id_col)
    return p.select(
        ((F.col("n_distinct") == F.col("n_ids")) & (F.col("n_null_ids") == 0)).alias("all_unique"), "n_rows", F.col("n_distinct").alias("unique_ids"),
        (F.col("n_ids") - F.col("n_distinct")).alias("duplicates"), F.col("n_null_ids").alias("null_ids"),
        F.round(F.try_divide(F.col("n_distinct") * 100.0, F.col("n_rows")), 6).alias("uniqueness_rate"),
    )


def duplicate_rows(df: DataFrame, id_col: str, rows_per_part: int | None = None) -> DataFrame:
    """All rows whose id occurs more than once; nulls count as equal.

    Ids are counted with partial aggregation and joined back; the rows of an id with over ``rows_per_part`` of them are
    spread over several tasks by the hash of the whole row, and null ids need no join at all."""
    counts = df.groupBy(F.col(id_col).alias("_id")).count()
    state = counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.coalesce(F.max(F.when(F.col("_id").isNull(), F.col("count"))), F.lit(0)).alias("nulls")).first()
    hot = hot_keys(counts.filter("_id is not null"), "_id", state.n, rows_per_part)
    spread = F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind])
    # The row goes as one struct, so names in it do not matter.
    keyed = df.select(F.col(id_col).alias("_id"), spread.alias("_spread"), F.struct(*[f"`{c}`" for c in df.columns]).alias("_row")).filter("_id is not null")
    several = repeat_rows(counts.filter("_id is not null and count > 1").select("_id"), hot, "_id")
    found = split_rows(keyed, hot, "_id", "_spread").join(several, ["_id", "part"], "left_semi").select("_row.*")
    return found.unionByName(df.filter(F.col(id_col).isNull())) if state.nulls > 1 else found


def value_counts(df: DataFrame, col: str, limit: int | None = None, least: int = 1) -> DataFrame:
    """(col, n) of non-null values that occur at least ``least`` times, by count, ties by value; the first ``limit``."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n")).filter(F.col("n") >= least).orderBy(F.desc("n"), col)
    return counts if limit is None else counts.limit(limit)


def duplicate_samples(df: DataFrame, id_col: str, groups: int = 5) -> DataFrame:
    """The rows of the ``groups`` most frequent repeated ids."""
    top = value_counts(df, id_col, groups, least=2).select(F.col(id_col).alias("_id"))
    return df.join(F.broadcast(top), F.col(id_col) == F.col("_id"), "left_semi")


def totals(profiles: DataFrame) -> DataFrame:
    """Sums of scan profiles of several tables; distinct counts are added, not merged."""
    return profiles.agg(F.count("*").alias("n_tables"), F.sum("n_rows").alias("n_rows"), F.sum("n_distinct").alias("n_distinct"))


def length_statistics(df: DataFrame, col: str, points: tuple[int, ...] = (50, 90, 95, 99)) -> DataFrame:
    """One row: n, least, most, mean and exact percentiles with linear interpolation (p50, ...) of a numeric
    column; zeros for an empty table, nulls left out.

    Distinct values are counted, spread over ranges and written; the ranges' totals (a row for each task) tell in which range
    each wanted position lies, and running totals within the ranges give the values there, so no task holds more than a range."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    out = df.agg(F.count(col).alias("n"), zero(F.min(col)).alias("least"), zero(F.max(col)).alias("most"), F.round(F.coalesce(F.avg(col), F.lit(0.0)), 6).alias("mean"))
    counted = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("v")).count()
    ranges = written(counted.repartitionByRange("v").select(F.spark_partition_id().alias("range"), "v", "count"), "ranges")
    before = {}
    n = 0
    for r in ranges.groupBy("range").agg(F.min("v").alias("v"), F.sum("count").alias("count")).orderBy("v").collect():
        before[r["range"]] = n
        n += r["count"]
    if not n:
        return out.select("*", *[F.lit(0.0).alias(f"p{p}") for p in points])
    exact = {p: (n - 1) * p / 100 for p in points}
    wanted = sorted({int(x) for x in exact.values()} | {min(int(x) + 1, n - 1) for x in exact.values()})
    offset = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col("range"))
    running = F.sum("count").over(Window.partitionBy("range").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    spans = ranges.withColumn("until", offset + running).withColumn("from", F.col("until") - F.col("count"))
    hit = F.filter(F.lit(wanted), lambda i: (i >= F.col("from")) & (i < F.col("until")))
    value = {r.i: r.v for r in spans.select("v", F.explode(hit).alias("i")).collect()}
    found = []
    for p, x in exact.items():
        low, high = value[int(x)], value[min(int(x) + 1, n - 1)]
        found.append(F.round(F.lit(low + (high - low) * (x - int(x))), 6).alias(f"p{p}"))
    return out.select("*", *found)


def sample_exact(df: DataFrame, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer) chosen by the digest of seed and id; the same rows on every run."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))), id_col).limit(n)


def index_rows(df: DataFrame, name: str = "row_index") -> DataFrame:
    """``df``, read from Parquet, with the 0-based position of each row in its file."""
    return df.select(F.col("_metadata.row_index").alias(name), *df.columns)


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row for each key: the first in ``order``."""
    return df.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_at = 1").drop("_at")
