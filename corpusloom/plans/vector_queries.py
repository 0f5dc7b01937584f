"""Queries over vectors, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import vectors as V
from corpusloom.operators.embedding import embedded
from corpusloom.operators.filters import filtered
from corpusloom.functions.text import not_blank, preview
from corpusloom.operators.profiling import index_rows, sample_exact
from corpusloom.operators.search import batch_top_k, cell_centres, enough_probes, fetched, hydrated, index_stats, ivf_batch_top_k, top_k, upserted, vector_search
from corpusloom.operators.subset import assigned, kmeans_subset, label_centres, medoids, members
from corpusloom.plans.tables import table
from corpusloom.operators.validation import alignment
from corpusloom.session import written
from corpusloom.sources.files import read_rows, zipped
from corpusloom.streaming.index import windowed_counts

DIM = 64


def _index(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("values"), "label")


def _first(spark: SparkSession, folder: str) -> list[float]:
    """The vector of id 0, as a query."""
    row = table(spark, folder, "embeddings").filter("vec_id = 0").select("embedding").first()
    return list(row[0]) if row else [0.0] * DIM


def _nearest(metric: str, condition: dict | None = None):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return top_k(_index(spark, folder), _first(spark, folder), 10, metric, condition, keep=["label"])

    return run


def _batch(metric: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        """Every id divisible by 20 against all rows."""
        rows = _index(spark, folder)
        return batch_top_k(rows, rows.filter("id % 20 = 0"), DIM, 5, metric, skip_self=True)

    return run


def filter_and(spark: SparkSession, folder: str) -> DataFrame:
    condition = {"$and": [{"birimadi": {"$eq": "3. Hukuk Dairesi"}}, {"n_chars": {"$gte": 500, "$lt": 3000}}, {"text": {"$contains": "dava"}}]}
    return filtered(table(spark, folder, "documents"), condition).select("doc_id", "n_chars")


def filter_in_or(spark: SparkSession, folder: str) -> DataFrame:
    condition = {"$or": [{"lang": {"$in": ["en", "de"]}}, {"source": {"$nin": ["yuksek_mahkeme", "bolge_mahkemesi"]}, "n_chars": {"$gt": 2000}}, {"no_such_column": 1}]}
    return filtered(table(spark, folder, "documents"), condition).select("doc_id", "lang", "source")


def fetch_by_ids(spark: SparkSession, folder: str) -> DataFrame:
    return fetched(_index(spark, folder), [3, 77, 400, 10**9]).select("id", "label")


def namespace_stats(spark: SparkSession, folder: str) -> DataFrame:
    return index_stats(table(spark, folder, "chunk_embeddings").withColumn("namespace", F.col("shard")))


def upsert_last_wins(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors by id as they stand after all deliveries; a failed first try does not replace a vector."""
    rows = table(spark, folder, "chunk_embeddings").select("shard", "id", "embedded_at", F.size("embedding").alias("dim"))
    old, new = rows.filter("embedded_at < timestamp_ntz'2025-01-01'"), rows.filter("embedded_at >= timestamp_ntz'2025-01-01'")
    return upserted(old.distinct(), new.distinct(), ["shard", "id"], "embedded_at").groupBy("shard").agg(F.count("*").alias("n"), F.min("embedded_at").alias("first"), F.max("embedded_at").alias("last"))


def normalised_vectors(spark: SparkSession, folder: str) -> DataFrame:
    v = F.col("embedding")
    return table(spark, folder, "embeddings").select("vec_id", F.round(V.norm(v), 6).alias("norm"), F.round(F.get(V.normalised(v), F.lit(0)), 6).alias("first"), F.round(V.dot(v, v), 6).alias("square"))


def assign_nearest(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return assigned(rows, label_centres(rows), DIM)


def medoid_per_cluster(spark: SparkSession, folder: str) -> DataFrame:
    return medoids(assign_nearest(spark, folder))


def subset_members(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return members(rows, medoid_per_cluster(spark, folder)).select("vec_id", "label")


def subset_kmeans(spark: SparkSession, folder: str) -> DataFrame:
    return kmeans_subset(table(spark, folder, "embeddings"), 20, DIM, spherical=True).select("vec_id", "label")


def union_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Source documents and the corpus as one table of texts."""
    a = table(spark, folder, "documents").select(F.lit("documents").alias("origin"), F.col("doc_id").cast("string").alias("key"), F.length("text").alias("n"))
    b = table(spark, folder, "merged_unique_documents").select(F.lit("decisions").alias("origin"), F.col("documentid").cast("string").alias("key"), F.length("mdtext").alias("n"))
    return a.unionByName(b)


def distinct_units(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("birimadi", "lang").distinct()


def embed_documents(spark: SparkSession, folder: str) -> DataFrame:
    out = embedded(table(spark, folder, "documents"), id_col="doc_id", text_col="text")
    return out.select("id", F.size("embedding").alias("dim"), F.round(V.norm(F.col("embedding")), 4).alias("norm"), "error")


def search_pruned(spark: SparkSession, folder: str) -> DataFrame:
    """Every id divisible by 20: its top 10 of the rows in the trained cells nearest to it, as many cells as hold 95 % of a sample's true top 10."""
    rows = _index(spark, folder)
    centres = cell_centres(rows, DIM)
    queries = rows.filter("id % 20 = 0")
    if not len(centres):
        return batch_top_k(rows, queries, DIM, 10, skip_self=True)
    return ivf_batch_top_k(rows, queries, centres, enough_probes(rows, centres), 10, skip_self=True)


def hits_with_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest of every id divisible by 20, each with the text that stands at its position in the documents."""
    hits = batch_top_k(_index(spark, folder), _index(spark, folder).filter("id % 20 = 0"), DIM, 5, skip_self=True)
    rows = index_rows(table(spark, folder, "documents")).withColumn("snippet", preview(F.col("text")))
    return hydrated(hits, rows, "row_index", "doc_id", "snippet")


def zip_by_position(spark: SparkSession, folder: str) -> DataFrame:
    """Document i beside vector i, as far as both go."""
    left = read_rows(spark, f"{folder}/documents.parquet", "doc_id", "source")
    right = read_rows(spark, f"{folder}/embeddings.parquet", "vec_id", "label")
    return zipped(left, right, strict=False)


def recomputed_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """All texts embedded and stored; a sample of 100 embedded again and held against what was stored."""
    texts = table(spark, folder, "documents").filter(not_blank(F.col("text")))
    stored = written(embedded(texts, id_col="doc_id", text_col="text"), "stored")
    again = embedded(sample_exact(texts, 100, "doc_id"), id_col="doc_id", text_col="text")
    return alignment(stored, again)


def search_pruned_recall(spark: SparkSession, folder: str) -> DataFrame:
    """One row: the queries of ``search_pruned``, and whether it finds at least nine in ten of their true neighbours."""
    rows = _index(spark, folder)
    exact = batch_top_k(rows, rows.filter("id % 20 = 0"), DIM, 10, skip_self=True).select("query_id", "id")
    found = search_pruned(spark, folder).select("query_id", "id", F.lit(True).alias("found"))
    return exact.join(found, ["query_id", "id"], "left").agg(F.count_distinct("query_id").alias("n_queries"), (F.count("found") >= 0.9 * F.count("*")).alias("enough"))


def search_namespace(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest to vector 0 in the namespace of label 3 whose vector number is even."""
    rows = _index(spark, folder).select(F.col("label").cast("string").alias("namespace"), "id", "values", F.struct((F.col("id") % 2).alias("odd")).alias("metadata"))
    return vector_search(rows, _first(spark, folder), 10, "3", {"metadata.odd": 0}).select("rank", "id", "score", F.col("metadata.odd").alias("odd"))


def hourly_events(spark: SparkSession, folder: str) -> DataFrame:
    return windowed_counts(table(spark, folder, "events"))


_V = "embedding::double[]"
_PAIR = "from embeddings a, (select embedding::double[] as q from embeddings where vec_id = 0)"
_SCORES = {"cosine": "list_cosine_similarity(a.embedding::double[], q)", "dotproduct": "list_inner_product(a.embedding::double[], q)", "euclidean": "0 - pow(list_distance(a.embedding::double[], q), 2)"}


def _nearest_sql(metric: str, where: str = "true") -> str:
    return f"""select row_number() over (order by score desc, id) as rank, id, score, label from (select vec_id as id, round({_SCORES[metric]}, 6) as score, label {_PAIR} where {where} order by score desc, id limit 10)"""


def _batch_sql(metric: str) -> str:
    return f"""select query_id, rank, id, score from (select query_id, id, score, row_number() over (partition by query_id order by score desc, id) as rank from (
        select b.vec_id as query_id, a.vec_id as id, round({_SCORES[metric].replace("q)", "b.embedding::double[])")}, 6) as score from embeddings a join embeddings b on b.vec_id % 20 = 0 and a.vec_id <> b.vec_id)) where rank <= 5"""


_ASSIGNED = """
with means as (
  select label as cid, i, avg(x) as x from (select label, unnest(embedding::double[]) as x, generate_subscripts(embedding, 1) as i from embeddings) group by 1, 2
), centres as (
  select cid, list(x order by i) as centre from means group by cid
), near as (
  select vec_id, cast(cid as bigint) as cid, round(list_sum(list_transform(list_zip(embedding, centre), lambda p: pow(p[1]::double - p[2], 2))), 6) as distance from embeddings, centres
), assigned as (
  select * exclude (pos) from (select *, row_number() over (partition by vec_id order by distance, cid) as pos from near) where pos = 1
), medoids as (
  select * exclude (pos) from (select *, row_number() over (partition by cid order by distance, vec_id) as pos from assigned) where pos = 1
)
"""

QUERIES = {
    **{f"knn_{m}": (_nearest(m), _nearest_sql(m)) for m in V.METRICS},
    "knn_filtered": (_nearest("cosine", {"label": {"$in": [1, 2, 3]}, "id": {"$ne": 0}}), _nearest_sql("cosine", "label in (1, 2, 3) and vec_id <> 0")),
    **{f"knn_batch_{m}": (_batch(m), _batch_sql(m)) for m in V.METRICS},
    "filter_and": (filter_and, "select doc_id, n_chars from documents where birimadi = '3. Hukuk Dairesi' and n_chars >= 500 and n_chars < 3000 and text like '%dava%'"),
    "filter_in_or": (filter_in_or, "select doc_id, lang, source from documents where coalesce(lang in ('en', 'de'), false) or (coalesce(source not in ('yuksek_mahkeme', 'bolge_mahkemesi'), false) and n_chars > 2000)"),
    "fetch_by_ids": (fetch_by_ids, "select vec_id as id, label from embeddings where vec_id in (3, 77, 400, 1000000000)"),
    "namespace_stats": (namespace_stats, "select coalesce(shard, '') as namespace, count(*) as n_vectors from chunk_embeddings group by 1 union all select null, count(*) from chunk_embeddings"),
    "upsert_last_wins": (
        upsert_last_wins,
        """select shard, count(*) as n, min(pos) as first, max(pos) as last from (select shard, id, max(embedded_at) as pos from chunk_embeddings where embedded_at is not null group by 1, 2) group by shard""",
    ),
    "normalised_vectors": (
        normalised_vectors,
        f"select vec_id, round(n, 6) as norm, round(embedding[1]::double / n, 6) as first, round(n * n, 6) as square from (select *, sqrt(list_inner_product({_V}, {_V})) as n from embeddings)",
    ),
    "assign_nearest": (assign_nearest, _ASSIGNED + "select * from assigned"),
    "medoid_per_cluster": (medoid_per_cluster, _ASSIGNED + "select cid, vec_id, distance from medoids"),
    "subset_members": (subset_members, _ASSIGNED + "select vec_id, label from embeddings where vec_id in (select vec_id from medoids)"),
    "subset_kmeans": (subset_kmeans, None),
    "union_shards": (
        union_shards,
        "select 'documents' as origin, cast(doc_id as varchar) as key, cast(length(text) as int) as n from documents union all select 'decisions', cast(documentid as varchar), cast(length(mdtext) as int) from merged_unique_documents",
    ),
    "distinct_units": (distinct_units, "select distinct birimadi, lang from documents"),
    "embed_documents": (embed_documents, None),
    "search_pruned": (search_pruned, None),
    "hits_with_rows": (
        hits_with_rows,
        f"""with hits as ({_batch_sql("cosine")}), placed as (select row_number() over () - 1 as pos, doc_id, case when length(text) > 200 then substring(text, 1, 200) || '...' else text end as snippet from documents)
            select query_id, rank, id, score, doc_id, snippet from hits left join placed on pos = id""",
    ),
    "zip_by_position": (
        zip_by_position,
        """select * from (select row_number() over () - 1 as row_index, doc_id, source from documents) join (select row_number() over () - 1 as row_index, vec_id, label from embeddings) using (row_index)""",
    ),
    "recomputed_vectors": (
        recomputed_vectors,
        r"""select least(100, count(*)) as n, 1.0::double as least, 1.0::double as mean, 'PASS' as status from documents where regexp_replace(text, '[\s\p{Z}\x{200B}]', '', 'g') <> ''""",
    ),
    "search_pruned_recall": (search_pruned_recall, "select count(*) as n_queries, true as enough from embeddings where vec_id % 20 = 0"),
    "search_namespace": (search_namespace, _nearest_sql("cosine", "label = 3 and vec_id % 2 = 0").replace("score, label from (", "score, odd from (").replace("as score, label ", "as score, vec_id % 2 as odd ")),
    "hourly_events": (hourly_events, "select time_bucket(interval '1 hour', ts) as start, event_type, count(*) as n, round(avg(value), 6) as mean_value from events group by 1, 2"),
}
