"""Chunks with the metadata of their documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.casts import integer_key, safe_int, safe_string
from corpusloom.operators.profiling import latest
from corpusloom.operators.skew import hot_keys, repeat_rows, split_rows

# Names of the metadata in a vector record and the document columns they come from, and what stands for a missing one.
TEXTS = {"kararTarihi": "karartarihi", "kararTarihiStr": "karartarihistr", "kesinlesmeDurumu": "kesinlesmedurumu", "kararNo": "kararno", "esasNo": "esasno"}
NUMBERS = {"esasNoYil": "esasnoyil", "esasNoSira": "esasnosira", "kararNoYil": "kararnoyil", "kararNoSira": "kararnosira"}
MISSING = {"itemTypeName": ("itemtype_name", "UNKNOWN"), "itemTypeDescription": ("itemtype_description", "Unknown Document Type"), "birimAdi": ("birimadi", "Unknown")}


def current_documents(documents: DataFrame) -> DataFrame:
    """One row for each id: the latest loaded, of equal ones the one with the smallest text."""
    return latest(documents.filter("documentid is not null"), ["documentid"], F.col("loaded_at").desc_nulls_last(), F.col("mdtext").asc_nulls_first())


def enriched(chunks: DataFrame, documents: DataFrame, rows_per_part: int | None = None) -> DataFrame:
    """Each chunk once, with the flat metadata of its document.

    Keys are compared as whole numbers however they are written; a document that was delivered
    several times counts with its latest row, so no chunk is multiplied.  Chunks without a document get the document's id from
    ``doc_id`` and the values of MISSING; ``found`` tells them apart.  The chunks of a document with over ``rows_per_part`` of them are split.
    """
    left = chunks.withColumn("_key", integer_key(F.col("doc_id")))
    counted = left.groupBy("_key").count().filter("_key is not null")
    hot = hot_keys(counted, "_key", chunks.count(), rows_per_part)
    columns = ["documentid", *[c for c, _ in MISSING.values()], *TEXTS.values(), *NUMBERS.values()]
    right = current_documents(documents).select(F.col("documentid").alias("_key"), *[F.col(c).alias(f"_{c}") for c in columns])
    joined = split_rows(left, hot, "_key", "id").join(repeat_rows(right, hot, "_key"), ["_key", "part"], "left")
    doc = lambda c: F.col(f"_{c}")
    return joined.select(
        "id", "doc_id", F.coalesce(doc("documentid").cast("string"), F.col("doc_id"), F.lit("")).alias("documentId"),
        F.col("chunk_id"), "start_char", "end_char", "num_tokens", safe_string(F.col("doc_checksum")).alias("doc_checksum"), safe_string(F.col("mdtext")).alias("mdtext"),
        *[safe_string(doc(c), default).alias(name) for name, (c, default) in MISSING.items()],
        *[safe_string(doc(c)).alias(name) for name, c in TEXTS.items()], *[safe_int(doc(c)).alias(name) for name, c in NUMBERS.items()],
        doc("documentid").isNotNull().alias("found"),
    )


def missing_documents(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """(doc_id): the distinct non-null keys of chunks that no document has, as written; keys that are no number included."""
    keys = chunks.select("doc_id").filter("doc_id is not null").distinct().withColumn("_key", integer_key(F.col("doc_id")))
    known = documents.select(F.col("documentid").alias("_key")).filter("_key is not null").distinct()
    return keys.join(known, "_key", "left_anti").select("doc_id")


def record_id(doc_id: Column, chunk: Column) -> Column:
    return F.concat(F.lit("doc_"), safe_string(doc_id), F.lit("_chunk_"), safe_string(chunk))


def vector_records(enriched_chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    """(id, values, metadata): chunks joined with their vectors by id, the metadata as one struct of 19 fields.

    Chunks without a vector are left out; of several vectors with an id one that is not null is taken."""
    own = vectors.filter("id is not null and embedding is not null").groupBy("id").agg(F.min("embedding").alias("values"))
    names = ["documentId", "chunkId", "start_char", "end_char", "num_tokens", "doc_checksum", *MISSING, *TEXTS, *NUMBERS, "mdtext"]
    rows = enriched_chunks.withColumn("chunkId", F.col("chunk_id").cast("string")).join(own, "id")
    return rows.select(record_id(F.col("doc_id"), F.col("chunk_id")).alias("id"), "values", F.struct(*names).alias("metadata"))


def carried_defaults(rows: DataFrame) -> DataFrame:
    """Columns carried beside a vector, nulls as empty text, -1 and 0."""
    return rows.select(
        safe_string(F.col("id")).alias("id"), safe_string(F.col("doc_id")).alias("doc_id"),
        *[F.coalesce(F.col(c).cast("int"), F.lit(d)).alias(c) for c, d in (("chunk_id", -1), ("start_char", -1), ("end_char", -1), ("num_tokens", 0))],
    )
