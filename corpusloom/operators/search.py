"""A vector index as a table: upsert, fetch, statistics, exact and pruned nearest neighbours."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import vectors as V
from corpusloom.operators.filters import filtered

#: Values of the query vectors sent to the tasks at once (64 MB), and query vectors of a cell that one task takes.
QUERY_VALUES, QUERY_BLOCK = 8_000_000, 8192


def top_k(index: DataFrame, query: list[float], k: int = 10, metric: str = "cosine", condition: dict[str, Any] | None = None, id_col: str = "id", vector_col: str = "values", keep: list[str] | None = None) -> DataFrame:
    """(rank, id, score and the columns ``keep``): the ``k`` rows most similar to one vector.

    The condition applies before the ranking.  Scores are rounded to 6 decimals, ties go to the smaller id.
    Null vectors and vectors of another length have no score and are left out; ``k`` beyond the rows gives all of them.
    """
    scored = filtered(index, condition).withColumn("_score", F.round(V.score(metric, F.col(vector_col), V.literal(query)), 6)).filter("_score is not null")
    best = scored.orderBy(F.desc("_score"), id_col).limit(k)
    rank = F.row_number().over(Window.orderBy(F.desc("_score"), id_col))
    return best.select(rank.alias("rank"), F.col(id_col).alias("id"), F.col("_score").alias("score"), *(keep or []))


def vector_matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows with a vector of ``dim`` elements, none of them null, and the vectors in double precision."""
    fits = np.asarray(pc.fill_null(pc.equal(pc.list_value_length(column), dim), False))
    values = column.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    good = ~np.isnan(values).any(axis=1)
    return np.flatnonzero(fits)[good], values[good]


def batch_top_k(index: DataFrame, queries: DataFrame, dim: int, k: int = 10, metric: str = "cosine", id_col: str = "id", vector_col: str = "values", query_id_col: str = "id", skip_self: bool = False) -> DataFrame:
    """(query_id, rank, id, score): for each query vector its ``k`` most similar rows, exactly.

    Queries are taken in blocks of about QUERY_VALUES values, which bounds what is broadcast; for
    each block every task multiplies its rows with the block and keeps the k best so far for each query, so only
    k rows a query and task are shuffled, however many rows a task has.  Scores are rounded to 6 decimals, ties go to the smaller id.
    ``skip_self`` leaves out the row of the query's own id.
    Rows and queries with null vectors, null elements or another length than ``dim`` are left out.
    """
    if metric not in V.METRICS:
        raise ValueError(f"unknown metric {metric!r}; one of {V.METRICS}")
    spark = index.sparkSession
    kind, query_kind = dict(index.dtypes)[id_col], dict(queries.dtypes)[query_id_col]
    schema = f"query_id {query_kind}, id {kind}, score double"
    wanted = queries.select(F.col(query_id_col).alias("query_id"), F.col(vector_col).cast("array<double>").alias("v")).filter("query_id is not null and v is not null")
    rows = index.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter("id is not null and v is not null")
    blocks = max(1, -(-wanted.count() * dim // QUERY_VALUES))
    found = None
    for b in range(blocks):
        block = wanted.filter(F.pmod(F.xxhash64(F.col("query_id").cast("string")), F.lit(blocks)) == b).toArrow().combine_chunks()
        at, matrix = vector_matrix(block.column("v").combine_chunks() if block.num_rows else pa.array([], pa.list_(pa.float64())), dim)
        shared = spark.sparkContext.broadcast((block.column("query_id").take(pa.array(at)).to_pylist(), matrix))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, q = shared.value
            square, names_at = np.einsum("ij,ij->i", q, q), np.array(names)
            best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            kind_of, asked = None, None
            for batch in batches:
                kind_of, asked = batch.schema.field("id").type, pa.array(names).type if query_kind != kind else batch.schema.field("id").type
                rows_at, x = vector_matrix(batch.column("v"), dim)
                ids = np.array(batch.column("id").take(pa.array(rows_at)).to_pylist())
                order = np.argsort(ids, kind="stable")
                ids, x = ids[order], x[order]
                if not len(x):
                    continue
                own = np.einsum("ij,ij->i", x, x)
                for i in range(0, len(q), 256):
                    s = q[i : i + 256] @ x.T
                    if metric == "cosine":
                        length = np.sqrt(square[i : i + 256])[:, None] * np.sqrt(own)
                        s = np.where(length == 0, 0.0, s / np.where(length == 0, 1.0, length))
                    elif metric == "euclidean":
                        s = -np.maximum(square[i : i + 256][:, None] + own - 2 * s, 0)
                    s = np.round(s, 6)
                    if skip_self:
                        s[names_at[i : i + 256, None] == ids] = -np.inf
                    top = np.argsort(-s, axis=1, kind="stable")[:, :k]
                    value, name = np.take_along_axis(s, top, axis=1), ids[top]
                    if i in best:
                        value, name = np.concatenate([best[i][0], value], axis=1), np.concatenate([best[i][1], name], axis=1)
                        top = np.argsort(name, axis=1, kind="stable")
                        top = np.take_along_axis(top, np.argsort(-np.take_along_axis(value, top, axis=1), axis=1, kind="stable"), axis=1)[:, :k]
                        value, name = np.take_along_axis(value, top, axis=1), np.take_along_axis(name, top, axis=1)
                    best[i] = value, name
            out: list[list] = [[], [], []]
            for i, (value, name) in best.items():
                r, c = np.nonzero(value > -np.inf)
                out[0].extend(names[i + j] for j in r.tolist())
                out[1].extend(name[r, c].tolist())
                out[2].extend(value[r, c].tolist())
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], asked), pa.array(out[1], kind_of), pa.array(out[2], pa.float64())], ["query_id", "id", "score"])

        part = rows.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def hydrated(hits: DataFrame, table: DataFrame, on: str, *columns: str, hit_col: str = "id") -> DataFrame:
    """``hits`` with the ``columns`` of the rows of ``table`` they lead to: by an id, or by position if ``on`` is ``row_index``.

    A hit that leads nowhere stays with nulls, one that leads to several rows comes once for each.  Columns that hits have too get ``_row``."""
    rows = table.select(F.col(on).alias("_on"), *[F.col(c).alias(f"{c}_row" if c in hits.columns else c) for c in columns])
    return hits.join(rows, hits[hit_col] == rows["_on"], "left").drop("_on")


def upserted(current: DataFrame, changes: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """``current`` with ``changes``: for each key the row of the highest ``order_col``, of equal ones a changed row.

    Rows of both sides have the same columns; a null ``order_col`` is the lowest."""
    both = current.withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)))
    newest = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order_col).desc_nulls_last(), F.desc("_new")))
    return both.withColumn("_at", newest).filter("_at = 1").drop("_at", "_new")


def fetched(index: DataFrame, ids: list, id_col: str = "id", namespace: str | None = None) -> DataFrame:
    """The rows of the given ids; unknown ids are simply absent."""
    rows = index if namespace is None else index.filter(F.col("namespace") == namespace)
    return rows.filter(F.col(id_col).isin(ids))


def index_stats(index: DataFrame, namespace_col: str = "namespace") -> DataFrame:
    """(namespace, n_vectors): the rows of each namespace, and of all with a null namespace."""
    return index.rollup(F.coalesce(F.col(namespace_col), F.lit("")).alias("namespace")).agg(F.count("*").alias("n_vectors"))


def ivf_top_k(index: DataFrame, query: list[float], centres: list[list[float]], probes: int = 4, k: int = 10, metric: str = "cosine", id_col: str = "id", vector_col: str = "values", cell_col: str = "cell") -> DataFrame:
    """As ``top_k`` over the rows of the ``probes`` cells whose centres are most similar to the query.

    ``index`` has each row's cell in ``cell_col``, best as a partition column so that other cells are not read.
    With as many probes as centres the result is exact."""
    q, c = np.array(query, dtype=np.float64), np.array(centres, dtype=np.float64)
    score = -((c - q) ** 2).sum(axis=1) if metric == "euclidean" else c @ q
    nearest = np.argsort(-score, kind="stable")[:probes].tolist()
    return top_k(index.filter(F.col(cell_col).isin(nearest)), query, k, metric, None, id_col, vector_col)


#: Rows a cell is trained on, most rows to train on, rows to choose the probes with.
TRAINED, TRAIN_ROWS, TRIED = 64, 1_000_000, 256


def cell_centres(index: DataFrame, dim: int, id_col: str = "id", vector_col: str = "values", rounds: int = 10, seed: int = 7) -> np.ndarray:
    """Centres of length 1 of about sqrt(n) cells, by k-means over the directions of about ``TRAIN_ROWS`` rows at most."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    v = F.col(vector_col).cast("array<double>")
    usable = index.select(F.col(id_col).alias("id"), v.alias("v")).filter((F.size("v") == dim) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x)) & (V.norm(F.col("v")) > 0))
    n = usable.count()
    if not n:
        return np.empty((0, dim))
    train = usable.filter(F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(max(1, round(n / TRAIN_ROWS)))) == 0)
    k = max(1, min(round(n**0.5), n // TRAINED, TRAIN_ROWS // TRAINED))
    if k == 1:
        return np.ones((1, dim)) / dim**0.5
    model = KMeans(k=k, maxIter=rounds, seed=seed).fit(train.select(array_to_vector(V.normalised(F.col("v"))).alias("features")))
    centres = np.array(model.clusterCenters(), np.float64)
    return centres / np.maximum(np.linalg.norm(centres, axis=1), 1e-12)[:, None]


def in_cells(rows: DataFrame, centres: np.ndarray, most: int, id_col: str = "id", vector_col: str = "values") -> DataFrame:
    """(id, v, cell, place): each usable vector once for each of its ``most`` nearest cells by cosine, the nearest at place 0."""
    shared, dim = rows.sparkSession.sparkContext.broadcast(centres), centres.shape[1]
    wanted = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter("id is not null and v is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = vector_matrix(batch.column("v"), dim)
            for i in range(0, len(at), 1024):
                cells = np.argsort(-(x[i : i + 1024] @ shared.value.T), axis=1, kind="stable")[:, :most]
                take = pa.array(np.repeat(at[i : i + 1024], cells.shape[1]))
                place = np.tile(np.arange(cells.shape[1]), len(cells))
                yield pa.RecordBatch.from_arrays([batch.column("id").take(take), batch.column("v").take(take), pa.array(cells.ravel(), pa.int32()), pa.array(place, pa.int32())], ["id", "v", "cell", "place"])

    return wanted.mapInArrow(run, f"id {dict(rows.dtypes)[id_col]}, v array<double>, cell int, place int")


def enough_probes(index: DataFrame, centres: np.ndarray, k: int = 10, share: float = 0.95, id_col: str = "id", vector_col: str = "values") -> int:
    """The fewest cells to search for ``share`` of the true ``k`` nearest by cosine, measured with about TRIED of the rows as queries."""
    tried = index.filter(F.pmod(F.xxhash64(F.col(id_col), F.lit("tried")), F.lit(max(1, index.count() // TRIED))) == 0).limit(2 * TRIED)
    exact = batch_top_k(index, tried, centres.shape[1], k, "cosine", id_col, vector_col, id_col, skip_self=True).select("query_id", "id")
    homes = in_cells(index, centres, 1, id_col, vector_col).select("id", "cell").join(F.broadcast(exact), "id")
    order = in_cells(tried, centres, len(centres), id_col, vector_col).select(F.col("id").alias("query_id"), "cell", "place")
    places = {r.place: r.n for r in homes.join(order, ["query_id", "cell"]).groupBy("place").agg(F.count("*").alias("n")).collect()}
    counts = np.array([places.get(i, 0) for i in range(len(centres))])
    return int(np.searchsorted(counts.cumsum(), share * counts.sum())) + 1 if counts.sum() else len(centres)


def ivf_batch_top_k(index: DataFrame, queries: DataFrame, centres: np.ndarray, probes: int, k: int = 10, id_col: str = "id", vector_col: str = "values", skip_self: bool = False) -> DataFrame:
    """As ``batch_top_k`` by cosine, for each query over the rows of the ``probes`` cells nearest to it.

    With as many probes as centres the result is exact.  The queries of a cell are taken in blocks of about QUERY_BLOCK."""
    kind, dim = dict(index.dtypes)[id_col], centres.shape[1]
    homes = in_cells(index, centres, 1, id_col, vector_col).select("cell", "id", "v")
    asked = in_cells(queries, centres, probes, id_col, vector_col).select("cell", "id", "v")
    parts = asked.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("parts"))
    # Expressions by name: both sides come from the same rows.
    homes = homes.join(parts.selectExpr("cell", "parts as copies"), "cell").selectExpr("cell", "explode(sequence(0, copies - 1)) as part", "id", "v")
    asked = asked.join(parts, "cell").selectExpr("cell", "cast(pmod(xxhash64(id), parts) as int) as part", "id", "v")

    def run(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        kept = []
        sides = []
        for side in (rows, wanted):
            x = side.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim)
            ids = np.array(side.column("id").to_pylist())
            order = np.argsort(ids, kind="stable")
            sides.append((ids[order], x[order], np.sqrt(np.einsum("ij,ij->i", x, x))[order]))
        (ids, x, own), (names, q, length) = sides
        for i in range(0, len(q) if len(x) else 0, 256):
            norm = length[i : i + 256, None] * own
            s = np.round(np.where(norm == 0, 0.0, q[i : i + 256] @ x.T / np.where(norm == 0, 1.0, norm)), 6)
            if skip_self:
                s[names[i : i + 256, None] == ids] = -np.inf
            top = np.argsort(-s, axis=1, kind="stable")[:, :k]
            value = np.take_along_axis(s, top, axis=1)
            r, c = np.nonzero(value > -np.inf)
            kept.append((names[i + r], ids[top[r, c]], value[r, c]))
        kind_of = rows.schema.field("id").type
        columns = [np.concatenate(c) for c in zip(*kept)] if kept else [[], [], []]
        return pa.table([pa.array(columns[0], kind_of), pa.array(columns[1], kind_of), pa.array(columns[2], pa.float64())], ["query_id", "id", "score"])

    found = homes.groupBy("cell", "part").cogroup(asked.groupBy("cell", "part")).applyInArrow(run, f"query_id {kind}, id {kind}, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def vector_search(index: DataFrame, query: list[float], k: int = 10, namespace: str = "", condition: dict[str, Any] | None = None, include_metadata: bool = True, include_values: bool = False, metric: str = "cosine") -> DataFrame:
    """``top_k`` within a namespace over a table (namespace, id, values, metadata), with the parts asked for."""
    keep = ["metadata"] * include_metadata + ["values"] * include_values
    return top_k(index.filter(F.col("namespace") == namespace), query, k, metric, condition, keep=keep)


def text_search(index: DataFrame, text: str, model: Any, k: int = 10, role: str = "query", **options: Any) -> DataFrame:
    """``vector_search`` for the vector of a text; ValueError for blank text."""
    from corpusloom.operators.embedding import query_vector

    return vector_search(index, query_vector(text, model, role), k, **options)
