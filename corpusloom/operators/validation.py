"""Checks that chunks, vectors and their descriptions agree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.vectors import cosine, norm


def pair_status(chunks: DataFrame, vectors: DataFrame, shard_col: str = "shard") -> DataFrame:
    """(shard, chunk_rows, embedding_rows, match, status) by full outer join of the counts of each shard.

    status: valid, mismatch, missing_embedding (no vector rows) or missing_chunks (no chunk rows)."""
    a = chunks.groupBy(F.col(shard_col).alias("shard")).agg(F.count("*").alias("chunk_rows"))
    b = vectors.groupBy(F.col(shard_col).alias("shard")).agg(F.count("*").alias("embedding_rows"))
    status = F.when(F.col("embedding_rows").isNull(), "missing_embedding").when(F.col("chunk_rows").isNull(), "missing_chunks").when(F.col("chunk_rows") == F.col("embedding_rows"), "valid").otherwise("mismatch")
    both = a.join(b, a["shard"].eqNullSafe(b["shard"]), "full").select(F.coalesce(a["shard"], b["shard"]).alias("shard"), "chunk_rows", "embedding_rows").withColumn("status", status)
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return both.select("shard", zero("chunk_rows"), zero("embedding_rows"), (F.col("status") == "valid").alias("match"), "status")


def corpus_status(vectors: DataFrame, meta: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """For each shard of ``vectors`` or ``meta``: rows, stated and found dimensions and norms, and a status.

    FAIL: counts or dimensions differ from the stated ones, or a shard said to be normalised is not.
    SKIP: a shard without vectors.  WARN: a shard without a description, or one that does not state its count or flag.  Else PASS.
    Null vectors count as rows and are reported, but have no dimension.
    """
    usable = F.col("embedding").isNotNull() & (F.size("embedding") > 0)
    unit = F.abs(norm(F.col("embedding")) - 1) <= tolerance
    seen = vectors.groupBy("shard").agg(
        F.count("*").alias("n_rows"), F.count_if(~usable | F.col("embedding").isNull()).alias("n_empty"),
        F.count_distinct(F.when(usable, F.size("embedding"))).alias("n_dims"), F.max(F.when(usable, F.size("embedding"))).alias("dim"),
        F.coalesce(F.bool_and(F.when(usable, F.coalesce(unit, F.lit(False)))), F.lit(False)).alias("unit"),
    )
    stated = meta.select("shard", F.col("dim").alias("stated_dim"), F.col("n_vectors").alias("stated_rows"), F.col("normalized").alias("stated_unit"))
    both = seen.join(stated, "shard", "full")
    lacks = F.col("stated_dim").isNull()
    wrong = (F.col("n_dims") != 1) | (F.col("dim") != F.col("stated_dim")) | (F.col("n_rows") != F.col("stated_rows")) | (F.col("stated_unit") & ~F.col("unit"))
    vague = F.col("stated_rows").isNull() | F.col("stated_unit").isNull()
    status = F.when(F.col("n_rows").isNull(), "SKIP").when(lacks, "WARN").when(F.coalesce(wrong, F.lit(False)), "FAIL").when(vague, "WARN").otherwise("PASS")
    return both.withColumn("status", status)


def status_counts(statuses: DataFrame) -> DataFrame:
    return statuses.groupBy("status").agg(F.count("*").alias("n"))


def alignment(stored: DataFrame, recomputed: DataFrame, id_col: str = "id", vector_col: str = "embedding", threshold: float = 0.995) -> DataFrame:
    """One row: n, least and mean cosine between the vectors of equal ids, and the status PASS or FAIL.

    Ids of one side only and null vectors are left out; WARN where nothing can be compared."""
    a = stored.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_a"))
    b = recomputed.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_b"))
    scores = a.join(b, "_id").select(cosine(F.col("_a"), F.col("_b")).alias("c")).filter("c is not null")
    out = scores.agg(F.count("*").alias("n"), F.round(F.min("c"), 6).alias("least"), F.round(F.avg("c"), 6).alias("mean"))
    return out.withColumn("status", F.when(F.col("n") == 0, "WARN").when(F.col("least") >= threshold, "PASS").otherwise("FAIL"))


def dimensions(vectors: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """(dim, n): how many vectors have each number of elements; null vectors have a null one."""
    return vectors.groupBy(F.when(F.col(vector_col).isNotNull(), F.size(vector_col)).alias("dim")).agg(F.count("*").alias("n"))


def single_dimension(vectors: DataFrame, vector_col: str = "embedding") -> int:
    """The one number of elements of all non-null vectors; ValueError if there are several or none."""
    found = [r.dim for r in dimensions(vectors, vector_col).filter("dim is not null").orderBy("dim").limit(2).collect()]
    if len(found) != 1:
        raise ValueError(f"vectors of {'several sizes' if found else 'no size'}: {found}")
    return found[0]
