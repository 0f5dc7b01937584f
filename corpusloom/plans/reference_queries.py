"""Queries over broken references, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.references import Reference, month, orphan_counts, orphan_references
from corpusloom.plans.tables import table


def _orphans(spark: SparkSession, folder: str) -> DataFrame:
    chunks, vectors, documents = (table(spark, folder, t) for t in ("chunks", "chunk_embeddings", "merged_unique_documents"))
    references = [Reference("chunks", chunks, "doc_id", "ingested_at", "id"), Reference("chunk_embeddings", vectors, "doc_id", "embedded_at", "id")]
    return orphan_references(references, documents, "documentid", "loaded_at", "deleted_at")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return _orphans(spark, folder).select("ref_table", month(F.col("at")).alias("ref_month"), "id").distinct()


def p3_orphan_counts(spark: SparkSession, folder: str) -> DataFrame:
    return orphan_counts(_orphans(spark, folder))


_SQL = r"""
with refs as (
  select 'chunks' as ref_table, id, doc_id, ingested_at as t from chunks
  union all select 'chunk_embeddings', id, doc_id, embedded_at from chunk_embeddings
), keyed as (
  select *, try_cast(regexp_extract(doc_id, '^\s*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)\s*$', 1) as decimal(38,18)) as num
  from refs where regexp_replace(doc_id, '\s', '', 'g') <> ''
), orphans as (
  select *, case when num is null or num <> floor(num) then 'not_a_key'
                 when not exists (select 1 from merged_unique_documents m where m.documentid = num) then 'absent'
                 else 'not_in_force' end as reason
  from keyed k
  where not exists (select 1 from merged_unique_documents m
                    where m.documentid = k.num and m.loaded_at <= k.t and (m.deleted_at is null or m.deleted_at > k.t))
)
"""

QUERIES = {
    "p3_found": (p3_found, _SQL + "select distinct ref_table, strftime(t, '%Y-%m') as ref_month, id from orphans"),
    "p3_orphan_counts": (
        p3_orphan_counts,
        _SQL + "select ref_table, strftime(t, '%Y-%m') as ref_month, reason, count(*) as n_rows, count(distinct doc_id) as n_keys from orphans group by all",
    ),
}
