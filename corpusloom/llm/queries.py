"""Queries of the operators for training data, with their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.clusters import cluster_profiles, mutual_clusters, similarity_clusters
from corpusloom.llm.mixture import mixture, source_name
from corpusloom.llm.neighbours import most_similar, similar_pairs
from corpusloom.llm.packing import fill_report, packed
from corpusloom.llm.records import record_classes, record_counts
from corpusloom.llm.residue import find_residue, residue_on_unseen_hosts, residue_on_unseen_kinds
from corpusloom.llm.subset import varied_subsets
from corpusloom.llm.tokens import token_counts
from corpusloom.llm.vectors import usable_vectors
from corpusloom.plans.tables import table
from corpusloom.session import written

DIM = 128


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return mutual_clusters(similarity_clusters(table(spark, folder, "chunk_embeddings"), DIM))


def p1_cluster_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return cluster_profiles(similarity_clusters(table(spark, folder, "chunk_embeddings"), DIM))


def p1_profile_checks(spark: SparkSession, folder: str) -> DataFrame:
    """One row: the mutual clusters and their members, and how many of them the profiles give another size or typical ids from outside."""
    clusters = similarity_clusters(table(spark, folder, "chunk_embeddings"), DIM)
    found = written(mutual_clusters(clusters), "mutual")
    sizes = found.groupBy("cluster_id").agg(F.count("*").alias("n"))
    profiles = written(cluster_profiles(clusters).join(sizes, "cluster_id"), "profiles")
    typical = profiles.select("cluster_id", F.explode("typical_ids").alias("id")).join(found, ["cluster_id", "id"], "left_anti")
    counts = profiles.agg(F.count("*").alias("n_clusters"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_members"), F.count_if((F.col("n_members") != F.col("n")) | (F.size("typical_ids") != 3)).alias("n_wrong"))
    return counts.withColumn("n_foreign", F.lit(typical.count()).cast("bigint"))


def p2_checks(spark: SparkSession, folder: str) -> DataFrame:
    """For each subset its number of different ids, and how many of them have no usable vector."""
    chosen = p2_varied_subsets(spark, folder)
    usable = usable_vectors(table(spark, folder, "chunk_embeddings"), DIM).select("id", F.lit(True).alias("usable"))
    return chosen.join(usable, "id", "left").groupBy("subset_name").agg(F.count_distinct("id").alias("n_ids"), F.count_if(F.col("usable").isNull()).alias("n_unusable"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return similar_pairs(most_similar(table(spark, folder, "chunk_embeddings"), DIM))


def p2_varied_subsets(spark: SparkSession, folder: str) -> DataFrame:
    return varied_subsets(table(spark, folder, "chunk_embeddings"), table(spark, folder, "subset_sizes"), DIM)


# Labels of the fields of a decision, and of its body.
LABELS, BODY = ("birim", "esas no", "karar no", "karar tarihi", "dava türü"), "metin"


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return record_classes(table(spark, folder, "merged_unique_documents"), "documentid", "mdtext", LABELS, BODY)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    copies = _records(spark, folder).filter("id <> keep")
    return copies.select(F.col("keep").alias("documentid_keep"), F.col("id").alias("documentid_copy")).distinct()


def p4_record_counts(spark: SparkSession, folder: str) -> DataFrame:
    return record_counts(_records(spark, folder)).withColumnRenamed("keep", "documentid_keep")


_P4 = r"""
with texts as (
  select documentid as id, ' ' || trim(regexp_replace(translate(regexp_replace(lower(upper(mdtext)), '[\p{Cf}\p{M}]', '', 'g'), 'ı', 'i'),
         '[^\p{L}\p{Nd}]+', ' ', 'g')) || ' ' as w
  from merged_unique_documents
  where documentid is not null and regexp_replace(mdtext, '[\s\p{Z}]', '', 'g') <> ''
), split as (
  select id, w, position(' metin ' in w) as pos from texts
), parsed as (
  select id, case when pos > 0 then w[:pos] else ' ' end as header, replace(case when pos > 0 then w[pos + 6:] else w end, ' ', '') as body from split
), canonical as (
  select id, list_sort(list_transform(string_split(regexp_replace(replace(header, ' ', '  '),
         ' (birim|esas  no|karar  no|karar  tarihi|dava  türü) ', chr(1) || '\1' || chr(2), 'g'), chr(1)),
         lambda x: replace(x, ' ', ''))) as fields, body
  from parsed
), classes as (
  select id, min(id) over (partition by fields, body) as keep from canonical
)
"""


def p6_packed(spark: SparkSession, folder: str) -> DataFrame:
    sizes = token_counts(table(spark, folder, "documents"), "doc_id", "text")
    return packed(sizes, table(spark, folder, "container_sizes"))


def p6_fill_report(spark: SparkSession, folder: str) -> DataFrame:
    return fill_report(p6_packed(spark, folder), table(spark, folder, "container_sizes"))


def p6_checks(spark: SparkSession, folder: str) -> DataFrame:
    """For each kind of container: documents packed, containers that hold too much, documents cut though they fit, tokens lost."""
    sizes = written(token_counts(table(spark, folder, "documents"), "doc_id", "text"), "counted")
    kinds = table(spark, folder, "container_sizes")
    placed = written(packed(sizes, kinds).join(F.broadcast(kinds), "container_name"), "placed")
    full = placed.groupBy("container_name", "container").agg(F.sum("n_tokens").alias("held"), F.first("capacity_tokens").alias("capacity"))
    full = full.groupBy("container_name").agg(F.count_if(F.col("held") > F.col("capacity")).alias("n_over_full"))
    docs = placed.groupBy("container_name", "doc_id").agg(F.sum("n_tokens").alias("placed"), F.count_distinct("container").alias("in"), F.first("capacity_tokens").alias("capacity"))
    docs = docs.join(sizes, "doc_id", "right").groupBy("container_name").agg(
        F.count("*").alias("n_docs"), F.count_if((F.col("in") > 1) & (F.col("n_tokens") <= F.col("capacity"))).alias("n_cut"), F.sum(F.abs(F.col("n_tokens") - F.coalesce("placed", F.lit(0)))).alias("n_lost")
    )
    return full.join(docs, "container_name")


def p7_checks(spark: SparkSession, folder: str) -> DataFrame:
    """One row: sources with a target, documents chosen twice, more often than allowed or without a target, and sources with documents that are off
    their share of what all such sources can reach by over two points and the size of the largest document chosen."""
    targets = table(spark, folder, "mix_targets")
    mixed = mixture(table(spark, folder, "documents"), targets)
    limits = targets.select(source_name(F.col("source")).alias("source"), "max_repeats")
    chosen = mixed.chosen.join(F.broadcast(limits), "source", "left")
    used = chosen.agg((F.count("*") - F.count_distinct("doc_id")).alias("n_twice"), F.count_if(F.col("repeats") > F.col("max_repeats")).alias("n_over"), F.count_if(F.col("max_repeats").isNull()).alias("n_foreign"))
    # A row for each source.
    shares = mixed.shares.collect()
    whole = sum(r.target_share for r in shares if r.n_docs) or 1.0
    largest = (mixed.chosen.agg(F.max("n_tokens")).first()[0] or 0) / (sum(r.n_tokens for r in shares) or 1)
    off = [r.source for r in shares if r.n_docs and abs(r.reached_share - r.target_share / whole) > 0.02 + largest]
    return used.withColumns({"n_sources": F.lit(len(shares)).cast("bigint"), "n_off": F.lit(len(off)).cast("bigint")})


def p7_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixture(table(spark, folder, "documents"), table(spark, folder, "mix_targets")).chosen


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    return mixture(table(spark, folder, "documents"), table(spark, folder, "mix_targets")).shares


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return find_residue(table(spark, folder, "documents"), "doc_id", "text").select(F.col("doc").alias("doc_id"))


def p8_unseen_hosts(spark: SparkSession, folder: str) -> DataFrame:
    return residue_on_unseen_hosts(table(spark, folder, "documents"), "doc_id", "text", source_name(F.col("source")))


def p8_unseen_kinds(spark: SparkSession, folder: str) -> DataFrame:
    return residue_on_unseen_kinds(table(spark, folder, "documents"), "doc_id", "text")


_SIMILAR = """
with usable as (
  select id, any_value(embedding::double[]) as v from chunk_embeddings
  where id is not null and len(embedding) = 128 and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))) and list_bool_or(list_transform(embedding, lambda x: x <> 0))
  group by id
), links as (
  select a.id as a, b.id as b, round(list_cosine_similarity(a.v, b.v), 6) as c from usable a, usable b where list_cosine_similarity(a.v, b.v) >= 0.75
)
"""
_P1 = _SIMILAR + """, firsts as (
  select a, min(b) as m, count(*) as d from links group by a
), together as (
  select x.m, count(*) as pairs from links s join firsts x on x.a = s.a join firsts y on y.a = s.b and y.m = x.m group by x.m
), whole as (
  select m from firsts join together using (m) group by m, pairs having count(*) >= 5 and min(d) = count(*) and max(d) = count(*) and pairs = count(*) * count(*)
)
select m as cluster_id, a as id from firsts join whole using (m)"""
_P5 = _SIMILAR + """, ranked as (
  select a, b, row_number() over (partition by a order by c desc, b) as place from links where a <> b
)
select distinct least(a, b) as id_a, greatest(a, b) as id_b from ranked where place <= 3"""


QUERIES = {
    "p1_found": (p1_found, _P1),
    "p1_cluster_profiles": (p1_cluster_profiles, None),
    "p1_profile_checks": (p1_profile_checks, f"select count(distinct cluster_id) as n_clusters, count(*) as n_members, 0::bigint as n_wrong, 0::bigint as n_foreign from ({_P1})"),
    "p2_varied_subsets": (p2_varied_subsets, None),
    "p2_checks": (p2_checks, _SIMILAR.partition(", links as")[0] + "select subset_name, cast(n_select as bigint) as n_ids, 0::bigint as n_unusable from subset_sizes where n_select between 1 and (select count(*) from usable)"),
    "p4_found": (p4_found, _P4 + "select distinct keep as documentid_keep, id as documentid_copy from classes where id <> keep"),
    "p4_record_counts": (
        p4_record_counts,
        _P4 + "select keep as documentid_keep, count(distinct id) as n_ids, cast(count(*) as bigint) as n_rows from classes group by keep",
    ),
    "p5_found": (p5_found, _P5),
    "p6_packed": (p6_packed, None),
    "p6_fill_report": (p6_fill_report, None),
    "p6_checks": (
        p6_checks,
        r"""select container_name, 0::bigint as n_over_full, count(*) as n_docs, 0::bigint as n_cut, 0::bigint as n_lost from container_sizes, documents
            where capacity_tokens > 0 and doc_id is not null and regexp_replace(text, '[\s\p{Z}\x{200B}]', '', 'g') <> '' group by container_name""",
    ),
    "p7_mixture": (p7_mixture, None),
    "p7_checks": (p7_checks, "select 0::bigint as n_twice, 0::bigint as n_over, 0::bigint as n_foreign, count(*) as n_sources, 0::bigint as n_off from mix_targets where target_share > 0 and max_repeats > 0"),
    "p7_shares": (p7_shares, None),
    "p8_found": (p8_found, None),
    "p8_unseen_hosts": (p8_unseen_hosts, None),
    "p8_unseen_kinds": (p8_unseen_kinds, None),
}
