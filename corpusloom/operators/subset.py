"""Assignment to centres, medoids, and a subset by k-means."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.vectors import normalised
from corpusloom.operators.search import vector_matrix

#: Values of the centres in a block (32 MB).
BLOCK_VALUES = 4_000_000


def label_centres(rows: DataFrame, label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """(cid, centre): the mean vector of each label."""
    parts = rows.select(F.col(label_col).alias("cid"), F.posexplode(vector_col).alias("at", "x"))
    means = parts.groupBy("cid", "at").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("s")).select("cid", F.col("s.x").alias("centre"))


def assigned(rows: DataFrame, centres: DataFrame, dim: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, cid, distance): the nearest centre of each vector by squared distance (6 decimals), of equals the smaller cid.

    Rows stay where they are: centres come to them in broadcast blocks of at most BLOCK_VALUES values, and each block's step
    keeps the better of its nearest centre and the one found so far, so nothing is shuffled however many centres there are.
    Null vectors, those of another length and those with a null or NaN element are left out; no centres, no rows."""
    spark = rows.sparkSession
    kind = dict(rows.dtypes)[id_col]
    n = centres.count()
    found = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.lit(None).cast("bigint").alias("cid"), F.lit(None).cast("double").alias("distance")).filter("v is not null")
    blocks = -(-n * dim // BLOCK_VALUES)
    for b in range(blocks):
        block = centres.select(F.col("cid").cast("bigint").alias("cid"), F.col("centre").cast("array<double>").alias("v")).filter(F.pmod(F.xxhash64("cid"), F.lit(blocks)) == b).orderBy("cid").toArrow().combine_chunks()
        at, c = vector_matrix(block.column("v").combine_chunks() if block.num_rows else pa.array([], pa.list_(pa.float64())), dim)
        shared = spark.sparkContext.broadcast((np.asarray(block.column("cid"))[at], c))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, c = shared.value
            square = np.einsum("ij,ij->i", c, c)
            for batch in batches:
                at, x = vector_matrix(batch.column("v"), dim)
                take = pa.array(at)
                cid = np.asarray(pc.fill_null(batch.column("cid"), np.iinfo(np.int64).max).take(take)).copy()
                best = np.asarray(pc.fill_null(batch.column("distance"), np.inf).take(take)).copy()
                for i in range(0, len(x) if len(c) else 0, 1024):
                    part = x[i : i + 1024]
                    d = np.round(np.maximum(np.einsum("ij,ij->i", part, part)[:, None] + square - 2 * part @ c.T, 0), 6)
                    near = d.argmin(axis=1)
                    far, name = d[np.arange(len(part)), near], names[near]
                    old_far, old = best[i : i + 1024], cid[i : i + 1024]
                    better = (far < old_far) | ((far == old_far) & (name < old))
                    best[i : i + 1024], cid[i : i + 1024] = np.where(better, far, old_far), np.where(better, name, old)
                yield pa.RecordBatch.from_arrays([batch.column("id").take(take), batch.column("v").take(take), pa.array(cid), pa.array(best)], ["id", "v", "cid", "distance"])

        found = found.mapInArrow(run, f"id {kind}, v array<double>, cid bigint, distance double")
    return found.filter("distance is not null and distance < double('inf')").select(F.col("id").alias(id_col), "cid", "distance")


def medoids(assignment: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """(cid, id, distance): the row nearest each centre, of equals the smaller id.  NaN distances never win; centres without rows are absent."""
    usable = assignment.filter(~F.isnan("distance") & F.col("distance").isNotNull())
    return usable.groupBy("cid").agg(F.min(F.struct("distance", id_col)).alias("m")).select("cid", f"m.{id_col}", "m.distance")


def members(rows: DataFrame, chosen: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """All rows whose id was chosen; with repeated ids more rows than ids.  Any type of id."""
    return rows.join(chosen.select(id_col).distinct(), id_col, "left_semi")


def kmeans_subset(rows: DataFrame, k: int, dim: int, id_col: str = "vec_id", vector_col: str = "embedding", train_rows: int = 1_000_000, rounds: int = 25, spherical: bool = False, seed: int = 42) -> DataFrame:
    """The rows nearest the centres of ``k`` clusters, at most ``k`` of them; ValueError if ``k`` exceeds the rows.

    Trained on at most about ``train_rows`` rows, chosen by the digest of seed and id.  Centres are held by the driver while
    training (k times dim doubles), which bounds k."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    n = rows.count()
    if k > n:
        raise ValueError(f"{k} rows wanted of {n}")
    vector = normalised(F.col(vector_col)) if spherical else F.transform(vector_col, lambda x: x.cast("double"))
    wide = rows.withColumn("_v", vector)
    share = max(1, round(n / train_rows))
    train = wide.filter(F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(share)) == 0).select(array_to_vector("_v").alias("features"))
    model = KMeans(k=k, maxIter=rounds, seed=seed, distanceMeasure="cosine" if spherical else "euclidean").fit(train)
    centres = rows.sparkSession.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cid bigint, centre array<double>")
    near = assigned(wide.select(id_col, F.col("_v").alias(vector_col)), centres, dim, id_col, vector_col)
    return members(rows, medoids(near, id_col), id_col)
