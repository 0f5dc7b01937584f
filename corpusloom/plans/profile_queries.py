"""Queries that profile and validate tables, with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.chunking import token_count
from corpusloom.operators.profiling import duplicate_rows, duplicate_samples, id_uniqueness, length_statistics, sample_exact, scan_profile, totals, value_counts
from corpusloom.operators.validation import alignment, corpus_status, dimensions, pair_status, status_counts
from corpusloom.plans.tables import table
from corpusloom.sources.files import file_statistics, shard_order

#: Tables and the columns that identify their rows.
PROFILED = {"documents": "doc_id", "merged_unique_documents": "documentid", "chunks": "doc_id", "chunk_embeddings": "doc_id", "events": "user_id", "lineitem": "l_orderkey"}


def _profiles(spark: SparkSession, folder: str) -> DataFrame:
    parts = [scan_profile(table(spark, folder, t), c).withColumn("name", F.lit(t)) for t, c in PROFILED.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def profile_totals(spark: SparkSession, folder: str) -> DataFrame:
    return totals(_profiles(spark, folder))


def uniqueness_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return id_uniqueness(table(spark, folder, "chunks"), "id")


def uniqueness_documents(spark: SparkSession, folder: str) -> DataFrame:
    return id_uniqueness(table(spark, folder, "merged_unique_documents"), "documentid")


def duplicate_document_rows(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_rows(table(spark, folder, "merged_unique_documents"), "documentid").select("documentid", "loaded_at", "birimadi")


def duplicate_top10(spark: SparkSession, folder: str) -> DataFrame:
    return value_counts(table(spark, folder, "chunks"), "doc_id", 10, least=2)


def duplicate_groups(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_samples(table(spark, folder, "events"), "user_id").select("user_id", "event_id", "event_type")


def token_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return length_statistics(table(spark, folder, "documents").select(token_count(F.coalesce("text", F.lit(""))).alias("n")), "n")


def character_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return length_statistics(table(spark, folder, "documents"), "n_chars")


def price_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return length_statistics(table(spark, folder, "lineitem"), "l_extendedprice")


def sample_rows(spark: SparkSession, folder: str) -> DataFrame:
    return sample_exact(table(spark, folder, "documents"), 100, "doc_id").select("doc_id", "source")


def vector_dimensions(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions(table(spark, folder, "chunk_embeddings"))


def shard_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks get the shard of their vector; what has none is a shard without a name."""
    vectors = table(spark, folder, "chunk_embeddings")
    own = vectors.filter("id is not null").groupBy("id").agg(F.min("shard").alias("shard"))
    return pair_status(table(spark, folder, "chunks").join(own, "id", "left"), vectors)


def shard_status(spark: SparkSession, folder: str) -> DataFrame:
    out = corpus_status(table(spark, folder, "chunk_embeddings"), table(spark, folder, "embedding_meta"))
    return out.select("shard", "n_rows", "n_empty", "dim", "stated_dim", "stated_rows", "stated_unit", "unit", "status")


def shard_status_counts(spark: SparkSession, folder: str) -> DataFrame:
    return status_counts(corpus_status(table(spark, folder, "chunk_embeddings"), table(spark, folder, "embedding_meta")))


def shard_sequence(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunk_embeddings").groupBy("shard").agg(F.count("*").alias("n")).select("shard", "n", shard_order(F.col("shard")).alias("first"))


def vector_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """The first and the last delivery of every id that was delivered with a usable vector more than once."""
    rows = table(spark, folder, "chunk_embeddings").filter("id is not null and size(embedding) = 128")
    ends = rows.groupBy("id").agg(F.count("*").alias("n"), F.min_by("embedding", "embedded_at").alias("first"), F.max_by("embedding", "embedded_at").alias("last")).filter("n > 1")
    return alignment(ends.select("id", F.col("first").alias("embedding")), ends.select("id", F.col("last").alias("embedding")))


def file_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and columns of the tables from their files' footers."""
    parts = [file_statistics(spark, f"{folder}/{t}.parquet").agg(F.sum("n_rows").alias("n_rows"), F.max("n_columns").alias("n_columns")).select(F.lit(t).alias("name"), "n_rows", "n_columns") for t in PROFILED]
    return reduce(DataFrame.unionByName, parts)


def _one(t: str, c: str) -> str:
    return f"select '{t}' as name, count(*) as n_rows, count({c}) as n_ids, count(*) - count({c}) as n_null_ids, count(distinct {c}) as n_distinct, round(count(*) / nullif(count(distinct {c}), 0), 6) as rows_per_id from {t}"


_PROFILES = " union all ".join(_one(t, c) for t, c in PROFILED.items())


def _unique(t: str, c: str) -> str:
    return f"""select count(distinct {c}) = count(*) as all_unique, count(*) as n_rows, count(distinct {c}) as unique_ids, count({c}) - count(distinct {c}) as duplicates,
               count(*) - count({c}) as null_ids, round(count(distinct {c}) * 100.0 / count(*), 6) as uniqueness_rate from {t}"""


def _lengths(values: str) -> str:
    points = ", ".join(f"round(quantile_cont(v, {p / 100}), 6) as p{p}" for p in (50, 90, 95, 99))
    return f"select count(v) as n, min(v) as least, max(v) as most, round(avg(v), 6) as mean, {points} from ({values})"


_UNIT = "abs(sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))) - 1) <= 1e-3"
_STATUS = f"""
with seen as (
  select shard, count(*) as n_rows, count(*) filter (embedding is null or len(embedding) = 0) as n_empty, count(distinct len(embedding)) filter (len(embedding) > 0) as n_dims,
         cast(max(len(embedding)) filter (len(embedding) > 0) as int) as dim, coalesce(bool_and(coalesce({_UNIT} and not isnan(list_sum(embedding)), false)) filter (len(embedding) > 0), false) as unit
  from chunk_embeddings group by shard
), both_sides as (
  select coalesce(s.shard, m.shard) as shard, n_rows, n_empty, s.dim, m.dim as stated_dim, n_vectors as stated_rows, normalized as stated_unit, unit,
    case when n_rows is null then 'SKIP' when m.dim is null then 'WARN'
         when coalesce(n_dims <> 1 or s.dim <> m.dim or n_rows <> n_vectors or (normalized and not unit), false) then 'FAIL'
         when n_vectors is null or normalized is null then 'WARN' else 'PASS' end as status
  from seen s full join embedding_meta m on m.shard = s.shard
)
"""

QUERIES = {
    "scan_profile": (_profiles, _PROFILES),
    "profile_totals": (profile_totals, f"select count(*) as n_tables, cast(sum(n_rows) as bigint) as n_rows, cast(sum(n_distinct) as bigint) as n_distinct from ({_PROFILES})"),
    "uniqueness_chunks": (uniqueness_chunks, _unique("chunks", "id")),
    "uniqueness_documents": (uniqueness_documents, _unique("merged_unique_documents", "documentid")),
    "duplicate_document_rows": (duplicate_document_rows, "select documentid, loaded_at, birimadi from (select *, count(*) over (partition by documentid) as n from merged_unique_documents) where n > 1"),
    "duplicate_top10": (duplicate_top10, "select doc_id, count(*) as n from chunks where doc_id is not null group by doc_id having count(*) >= 2 order by n desc, doc_id limit 10"),
    "duplicate_groups": (duplicate_groups, "select user_id, event_id, event_type from events where user_id in (select user_id from events group by user_id having count(*) > 1 order by count(*) desc, user_id limit 5)"),
    "token_statistics": (token_statistics, _lengths(r"select cast(len(regexp_extract_all(coalesce(text, ''), E'[^ \t\n\r\f]+')) as int) as v from documents")),
    "character_statistics": (character_statistics, _lengths("select n_chars as v from documents")),
    "price_statistics": (price_statistics, _lengths("select l_extendedprice as v from lineitem")),
    "sample_rows": (sample_rows, "select doc_id, source from documents order by md5('42:' || doc_id), doc_id limit 100"),
    "vector_dimensions": (vector_dimensions, "select cast(len(embedding) as int) as dim, count(*) as n from chunk_embeddings group by 1"),
    "shard_pairs": (
        shard_pairs,
        """with own as (select id, min(shard) as shard from chunk_embeddings where id is not null group by id), a as (select o.shard, count(*) as c from chunks left join own o using (id) group by 1),
           b as (select shard, count(*) as e from chunk_embeddings group by 1)
           select coalesce(a.shard, b.shard) as shard, coalesce(c, 0) as chunk_rows, coalesce(e, 0) as embedding_rows, coalesce(c = e, false) as match,
             case when e is null then 'missing_embedding' when c is null then 'missing_chunks' when c = e then 'valid' else 'mismatch' end as status from a full join b on a.shard is not distinct from b.shard""",
    ),
    "shard_status": (shard_status, _STATUS + "select * from both_sides"),
    "shard_status_counts": (shard_status_counts, _STATUS + "select status, count(*) as n from both_sides group by status"),
    "shard_sequence": (shard_sequence, r"select shard, count(*) as n, coalesce(try_cast(regexp_extract(shard, '^docs_(\d+(?:\.\d+)?)m_', 1) as double), 0.0) as first from chunk_embeddings group by shard"),
    "vector_alignment": (
        vector_alignment,
        """select count(*) as n, round(min(c), 6) as least, round(avg(c), 6) as mean, case when count(*) = 0 then 'WARN' when min(c) >= 0.995 then 'PASS' else 'FAIL' end as status
           from (select list_cosine_similarity(arg_min(embedding, embedded_at)::double[], arg_max(embedding, embedded_at)::double[]) as c from chunk_embeddings where id is not null and len(embedding) = 128 group by id having count(*) > 1)""",
    ),
    "file_rows": (file_rows, " union all ".join(f"select '{t}' as name, count(*) as n_rows, cast((select count(*) from (describe select * from {t})) as int) as n_columns from {t}" for t in PROFILED)),
}
