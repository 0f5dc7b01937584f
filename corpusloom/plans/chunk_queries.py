"""Queries over chunks and their documents, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.casts import safe_int, safe_string
from corpusloom.functions.text import millions_label, not_blank, preview, shortened, with_role
from corpusloom.operators.chunking import chunk_documents, token_count, window_count
from corpusloom.operators.enrichment import carried_defaults, current_documents, enriched, missing_documents, record_id, vector_records
from corpusloom.operators.profiling import index_rows
from corpusloom.plans.tables import table
from corpusloom.session import shared_folder
from corpusloom.sources.files import read_json_lines, read_rows, write_json_lines

_GAP = r"[ \t\n\r\f]"
_TOKEN = r"[^ \t\n\r\f]+"


def _chunk_sql(source: str, window: int, overlap: int, columns: str) -> str:
    step = max(1, window - overlap)
    return rf"""
with pieces as (
  select cast(doc_id as varchar) as doc_id, text, regexp_extract_all(text, E'[ \t\n\r\f]*[^ \t\n\r\f]+') as p from {source} where text is not null and doc_id is not null
), numbered as (
  select *, unnest(generate_series(0, cast(greatest(0, ceil((len(p) - {window}) / {step}.0)) as bigint))) as i from pieces where len(p) > 0
), spans as (
  select *, i * {step} as s, least(i * {step} + {window}, len(p)) as e from numbered
), cut as (
  select doc_id, text, i, e - s as n,
         length(array_to_string(p[1:s], '')) + length(p[s + 1]) - length(ltrim(p[s + 1], E' \t\n\r\f')) as a, length(array_to_string(p[1:e], '')) as b
  from spans
)
select {columns} from cut
"""


_CHUNK_COLUMNS = """sha1(doc_id || ':' || i || '@' || a || '-' || b) as id, doc_id, cast(i as int) as chunk_id, cast(a as int) as start_char, cast(b as int) as end_char,
  substring(text, cast(a + 1 as bigint), cast(b - a as bigint)) as mdtext, cast(n as int) as num_tokens, 'documents' as source_path, sha1(text) as doc_checksum"""


def chunk_512(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_documents(table(spark, folder, "documents"), source="documents")


def chunk_64(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_documents(table(spark, folder, "documents"), window=64, overlap=8, source="documents")


def chunk_numbers(spark: SparkSession, folder: str) -> DataFrame:
    n = token_count(F.coalesce("text", F.lit("")))
    return table(spark, folder, "documents").select("doc_id", n.cast("bigint").alias("n_tokens"), window_count(n, 96, 12).alias("n_chunks"))


def chunk_row_window(spark: SparkSession, folder: str) -> DataFrame:
    """The rows 100 to 299 of the file."""
    rows = read_rows(spark, f"{folder}/embeddings.parquet", "vec_id", "label", start=100, end=300)
    return rows.select("row_index", "vec_id", "label")


def chunk_shard_labels(spark: SparkSession, folder: str) -> DataFrame:
    first = F.floor(F.col("o_orderkey") / 7) * 100_000
    return table(spark, folder, "orders").select("o_orderkey", millions_label(first).alias("label"))


_CURRENT = """
current as (
  select * exclude (pos) from (
    select *, row_number() over (partition by documentid order by loaded_at desc nulls last, mdtext asc nulls first) as pos
    from merged_unique_documents where documentid is not null) where pos = 1
)"""
_KEYED = r"""
keyed as (
  select *, case when num = floor(num) then cast(num as bigint) end as key from (
    select *, try_cast(regexp_extract(doc_id, '^\s*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)\s*$', 1) as decimal(38,18)) as num from chunks)
)"""


def _number(c: str) -> str:
    return f"coalesce(try_cast(trunc(try_cast({c} as double)) as bigint), 0)"


_ENRICHED = f"""
with {_CURRENT.strip()}, {_KEYED.strip()}, joined as (
select k.id, k.doc_id, coalesce(cast(d.documentid as varchar), k.doc_id, '') as documentId, k.chunk_id, k.start_char, k.end_char, k.num_tokens,
  coalesce(k.doc_checksum, '') as doc_checksum, coalesce(k.mdtext, '') as mdtext,
  coalesce(d.itemtype_name, 'UNKNOWN') as itemTypeName, coalesce(d.itemtype_description, 'Unknown Document Type') as itemTypeDescription, coalesce(d.birimadi, 'Unknown') as birimAdi,
  coalesce(strftime(d.karartarihi, '%Y-%m-%d %H:%M:%S'), '') as kararTarihi, coalesce(d.karartarihistr, '') as kararTarihiStr, coalesce(d.kesinlesmedurumu, '') as kesinlesmeDurumu,
  coalesce(d.kararno, '') as kararNo, coalesce(d.esasno, '') as esasNo,
  {_number("d.esasnoyil")} as esasNoYil, {_number("d.esasnosira")} as esasNoSira, {_number("d.kararnoyil")} as kararNoYil, {_number("d.kararnosira")} as kararNoSira,
  d.documentid is not null as found
from keyed k left join current d on d.documentid = k.key)
"""


def enrich_left_join(spark: SparkSession, folder: str) -> DataFrame:
    return enriched(table(spark, folder, "chunks"), table(spark, folder, "merged_unique_documents"))


def enrich_records(spark: SparkSession, folder: str) -> DataFrame:
    """Vector records, their metadata as columns."""
    records = vector_records(enrich_left_join(spark, folder).dropDuplicates(["id"]), table(spark, folder, "chunk_embeddings"))
    return records.select("id", F.size("values").alias("dim"), "metadata.documentId", "metadata.chunkId", "metadata.itemTypeName", "metadata.birimAdi", "metadata.esasNoYil", "metadata.kararNo")


def missing_docs(spark: SparkSession, folder: str) -> DataFrame:
    return missing_documents(table(spark, folder, "chunks"), table(spark, folder, "merged_unique_documents"))


def record_ids(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").select("id", record_id(F.col("doc_id"), F.col("chunk_id")).alias("record_id"))


def text_previews(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id", preview(text).alias("preview"), preview(text, 300).alias("snippet"), shortened(text).alias("short"), with_role(F.substring(text, 1, 40), "passage").alias("passage"), with_role(F.substring(text, 1, 40)).alias("query")
    )


def role_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The whole texts as they are embedded in each role, by their digests."""
    roles = {role: with_role(F.col("text"), role) for role in ("passage", "query")}
    return table(spark, folder, "documents").select("doc_id", *[f(x).alias(f"{role}_{what}") for role, x in roles.items() for what, f in (("digest", F.sha1), ("length", F.length))])


def safe_casts(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("esasnoyil", "esasnosira", "kararnoyil", "kararnosira")
    numbers = [safe_int(F.col(c)).alias(f"{c}_n") for c in columns]
    return table(spark, folder, "merged_unique_documents").select("documentid", *[safe_string(F.col(c)).alias(c) for c in columns], *numbers)


def not_blank_texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").filter(not_blank(F.col("mdtext"))).groupBy("doc_checksum").agg(F.count("*").alias("n"), F.sum(F.length("mdtext")).alias("n_chars"))


def chunk_defaults(spark: SparkSession, folder: str) -> DataFrame:
    return carried_defaults(table(spark, folder, "chunks"))


def current_document_rows(spark: SparkSession, folder: str) -> DataFrame:
    return current_documents(table(spark, folder, "merged_unique_documents")).select("documentid", "birimadi", "loaded_at", F.sha1(F.coalesce("mdtext", F.lit(""))).alias("text_digest"))


def json_lines_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """All texts written as JSON lines and read again: how often each occurs, by its digest."""
    path = f"{shared_folder(spark).rstrip('/')}/corpusloom/lines-{uuid.uuid4().hex}"
    write_json_lines(table(spark, folder, "documents"), path, "text")
    return read_json_lines(spark, path).groupBy(F.sha1("content").alias("digest")).agg(F.count("*").alias("n"), F.max(F.length("content")).alias("length"))


def head_rows(spark: SparkSession, folder: str) -> DataFrame:
    return index_rows(table(spark, folder, "embeddings")).orderBy("row_index").limit(10).select("vec_id", "label")


QUERIES = {
    "chunk_512": (chunk_512, _chunk_sql("documents", 512, 64, _CHUNK_COLUMNS)),
    "chunk_64": (chunk_64, _chunk_sql("documents", 64, 8, _CHUNK_COLUMNS)),
    "chunk_numbers": (
        chunk_numbers,
        r"""select doc_id, cast(n as bigint) as n_tokens, cast(case when n = 0 then 0 else 1 + greatest(0, ceil((n - 96) / 84.0)) end as int) as n_chunks
            from (select doc_id, len(regexp_extract_all(coalesce(text, ''), E'[^ \t\n\r\f]+')) as n from documents)""",
    ),
    "chunk_row_window": (chunk_row_window, "select vec_id as row_index, vec_id, label from embeddings where vec_id >= 100 and vec_id < 300"),
    "chunk_shard_labels": (chunk_shard_labels, r"select o_orderkey, regexp_replace(printf('%.1f', floor(o_orderkey / 7) * 100000 / 1000000.0), '\.0$', '') || 'm' as label from orders"),
    "chunk_defaults": (
        chunk_defaults,
        "select coalesce(id, '') as id, coalesce(doc_id, '') as doc_id, coalesce(chunk_id, -1) as chunk_id, coalesce(start_char, -1) as start_char, coalesce(end_char, -1) as end_char, coalesce(num_tokens, 0) as num_tokens from chunks",
    ),
    "enrich_left_join": (enrich_left_join, _ENRICHED + "select * from joined"),
    "enrich_records": (
        enrich_records,
        _ENRICHED + """, one as (select * from (select *, row_number() over (partition by id) as pos from joined) where pos = 1),
          vectors as (select id, min(len(embedding)) as dim from (select id, embedding, row_number() over (partition by id order by embedding) as pos from chunk_embeddings where id is not null and embedding is not null) where pos = 1 group by id)
          select 'doc_' || coalesce(doc_id, '') || '_chunk_' || chunk_id as id, cast(v.dim as int) as dim, documentId, cast(chunk_id as varchar) as chunkId, itemTypeName, birimAdi, esasNoYil, kararNo from one join vectors v using (id)""",
    ),
    "missing_docs": (missing_docs, f"with {_KEYED.strip()} select distinct doc_id from keyed k where doc_id is not null and not exists (select 1 from merged_unique_documents m where m.documentid = k.key)"),
    "record_ids": (record_ids, "select id, 'doc_' || coalesce(doc_id, '') || '_chunk_' || coalesce(cast(chunk_id as varchar), '') as record_id from chunks"),
    "text_previews": (
        text_previews,
        """select doc_id, case when length(text) > 200 then substring(text, 1, 200) || '...' else text end as preview, case when length(text) > 300 then substring(text, 1, 300) || '...' else text end as snippet,
           case when length(text) > 50 then substring(text, 1, 47) || '...' else text end as short, 'passage: ' || coalesce(substring(text, 1, 40), '') as passage, 'query: ' || coalesce(substring(text, 1, 40), '') as query from documents""",
    ),
    "role_texts": (
        role_texts,
        "select doc_id, " + ", ".join(f"sha1({x}) as {r}_digest, cast(length({x}) as int) as {r}_length" for r in ("passage", "query") for x in [f"'{r}: ' || coalesce(text, '')"]) + " from documents",
    ),
    "safe_casts": (
        safe_casts,
        "select documentid, " + ", ".join(f"coalesce({c}, '') as {c}, {_number(c)} as {c}_n" for c in ("esasnoyil", "esasnosira", "kararnoyil", "kararnosira")) + " from merged_unique_documents",
    ),
    "not_blank_texts": (
        not_blank_texts,
        r"select doc_checksum, count(*) as n, cast(sum(length(mdtext)) as bigint) as n_chars from chunks where regexp_replace(mdtext, '[\s\p{Z}\x{200B}]', '', 'g') <> '' group by doc_checksum",
    ),
    "current_document_rows": (current_document_rows, f"with {_CURRENT.strip()} select documentid, birimadi, loaded_at, sha1(coalesce(mdtext, '')) as text_digest from current"),
    "json_lines_round_trip": (json_lines_round_trip, "select sha1(coalesce(text, '')) as digest, count(*) as n, cast(max(length(coalesce(text, ''))) as int) as length from documents group by 1"),
    "head_rows": (head_rows, "select vec_id, label from embeddings order by vec_id limit 10"),
}
