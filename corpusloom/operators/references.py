"""References to rows that do not exist, or not at the time of the reference."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.casts import integer_key, stripped
from corpusloom.operators.skew import hot_keys, repeat_rows, split_rows


@dataclass(frozen=True)
class Reference:
    """A referring table: its name in the report, and its columns."""

    table: str
    rows: DataFrame
    key: str
    time: str
    id: str


def _referring(references: list[Reference]) -> DataFrame:
    out = None
    for r in references:
        part = r.rows.select(
            F.lit(r.table).alias("ref_table"),
            F.col(r.id).cast("string").alias("id"),
            F.col(r.key).cast("string").alias("ref_text"),
            F.col(r.time).alias("at"),
        )
        out = part if out is None else out.unionByName(part)
    return out.filter(stripped(F.col("ref_text")) != "").withColumn("key", integer_key(F.col("ref_text")))


def orphan_references(references: list[Reference], parents: DataFrame, parent_key: str, loaded: str, deleted: str, rows_per_part: int | None = None) -> DataFrame:
    """Rows of ``references`` whose key leads to no parent row in force at their time.

    A parent row is in force from ``loaded`` (included) to ``deleted`` (excluded; null: for ever).
    Result: ref_table, id, ref_text, at, reason, one row for each such referring row, where reason is
    ``not_a_key`` (a text that is no whole number), ``absent`` (no parent row has the key) or
    ``not_in_force`` (withdrawn, or loaded later).

    Distinct keys are anti-joined against the parents' keys and joined back for the absent ones.  The
    others are held against the parents' times in one ordered pass: per key, the latest end among rows
    loaded so far.  Keys of over ``rows_per_part`` references (see ``skew.hot_keys``) are spread over as many
    parts as it takes, for which the key's parent rows are repeated.

    Null or blank keys are no references.  A row without a time is ``not_in_force``, since nothing is in
    force then.  Parent rows with a null key or load time count as missing.  Empty tables on either side
    give an empty result, or all rows as absent.  Other columns are ignored, whatever their names.
    """
    refs = _referring(references)
    owners = parents.select(F.col(parent_key).cast("bigint").alias("key"), F.col(loaded).alias("from"), F.col(deleted).alias("to")).filter("key is not null and `from` is not null")

    counted = refs.filter("key is not null").groupBy("key").count()
    total = sum(r.rows.count() for r in references)
    hot = hot_keys(counted, "key", total, rows_per_part)
    keyed = split_rows(refs.filter("key is not null"), hot, "key", "id", "at")

    absent = counted.select("key").join(owners.select("key").distinct(), "key", "left_anti")
    lost = keyed.join(repeat_rows(absent, hot, "key"), ["key", "part"], "left_semi").select("ref_table", "id", "ref_text", "at", F.lit("absent").alias("reason"))

    # Rows of one load time count as the one that ends last.
    forever = F.lit("9999-12-31 00:00:00").cast(dict(owners.dtypes)["from"])
    spans = owners.groupBy("key", F.col("from").alias("at")).agg(F.max(F.coalesce("to", forever)).alias("end"))
    spans = repeat_rows(spans, hot, "key").withColumn("kind", F.lit(0))
    known = keyed.join(spans.select("key", "part").distinct(), ["key", "part"], "left_semi").withColumn("kind", F.lit(1))
    swept = known.unionByName(spans, allowMissingColumns=True)
    so_far = Window.partitionBy("key", "part").orderBy(F.col("at").asc_nulls_first(), "kind").rowsBetween(Window.unboundedPreceding, 0)
    late = (
        swept.withColumn("last_end", F.max("end").over(so_far))
        .filter((F.col("kind") == 1) & ~F.coalesce(F.col("last_end") > F.col("at"), F.lit(False)))
        .select("ref_table", "id", "ref_text", "at", F.lit("not_in_force").alias("reason"))
    )
    texts = refs.filter("key is null").select("ref_table", "id", "ref_text", "at", F.lit("not_a_key").alias("reason"))
    return texts.unionByName(lost).unionByName(late)


def month(at: Column) -> Column:
    """``yyyy-MM``; null for no time."""
    return F.date_format(at, "yyyy-MM")


def orphan_counts(orphans: DataFrame) -> DataFrame:
    """Orphans per table, month and reason: rows and distinct key texts."""
    return orphans.groupBy("ref_table", month(F.col("at")).alias("ref_month"), "reason").agg(
        F.count("*").alias("n_rows"), F.count_distinct("ref_text").alias("n_keys")
    )
