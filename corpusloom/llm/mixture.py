"""Mixing sources to target weights with soft membership."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from corpusloom.functions.casts import not_blank, stripped
from corpusloom.llm.shapes import pieces, sparse_vectors, words_of
from corpusloom.llm.tokens import VOCABULARY, count
from corpusloom.operators.skew import hot_keys, repeat_rows, split_rows
from corpusloom.session import discarded, written

#: Hashed features of the classifier, the most labelled documents it is trained on, and the parts of 1 to which memberships are rounded.
FEATURES, TRAINED_ON, GRID = 1 << 13, 20_000, 64


def source_name(col: Column) -> Column:
    """One spelling of a source: small letters, ``_`` for blanks and ``-``; blank is null."""
    name = F.regexp_replace(F.lower(stripped(col)), r"[\s\p{Z}_-]+", "_")
    return F.when(name != "", name)


@dataclass(frozen=True)
class Mixture:
    """chosen: (doc_id, source, repeats, n_tokens) of the documents used, each with the source it counts for.
    shares: (source, target_share, reached_share, expected_share, n_docs, n_tokens, converged) for every source.
    rounds: the gradient steps taken.  residual: the largest distance of a source's expected tokens from its goal, as a share of all.
    converged: whether that is within the tolerance."""

    chosen: DataFrame
    shares: DataFrame
    rounds: int
    residual: float
    converged: bool


def _classifier(rows: DataFrame, names: list[str], n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (features, names) and biases of a multinomial classifier of the label's number, trained on at most about
    TRAINED_ON of ``rows`` (id, text, label), chosen by the hash of their id; and 1 for the labels it saw, the only ones it knows."""
    step = max(1, -(-n_rows // TRAINED_ON))
    sample = rows.filter((F.col("label") >= 0) & (F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("mixture")), F.lit(step)) == 0)).select("text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = np.asarray(batch.column("label")).astype(np.float64)
            for i, data, offsets in pieces(batch.column("text")):
                n = len(offsets) - 1
                yield pa.RecordBatch.from_arrays([pa.array(label[i : i + n]), sparse_vectors(*words_of(data, offsets, FEATURES), n, FEATURES)], ["label", "features"])

    data = sample.mapInArrow(run, StructType().add("label", DoubleType()).add("features", VectorUDT())).persist()
    try:
        present = [int(r[0]) for r in data.select("label").distinct().collect()]
        weights, bias, seen = np.zeros((FEATURES, len(names)), np.float32), np.zeros(len(names)), np.zeros(len(names))
        seen[present] = 1
        if len(present) > 1:
            model = LogisticRegression(family="multinomial", maxIter=25, regParam=0.01).fit(data)
            known = model.numClasses
            weights[:, :known] = model.coefficientMatrix.toArray().T
            bias[:known] = model.interceptVector.toArray()
        return weights, bias, seen
    finally:
        data.unpersist()


def mixture(rows: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", trust: float = 0.95, total_tokens: int | None = None, rounds: int = 60, tolerance: float = 1e-3, path: str = VOCABULARY) -> Mixture:
    """A choice of documents with repeats in which each source has its target share of all tokens.

    ``targets`` (source, target_share, max_repeats) is a small table by its nature and read on the driver.  Equal texts count
    as one, before anything is computed of them: under the smallest id of those with a target's source, else of those without a source, else of all.
    A classifier trained on labelled documents gives each document a probability for
    every source; a document is a member of the sources by these probabilities, and of a known source by ``trust`` of the whole on
    top of the rest of them.  Memberships are rounded to 1/GRID.  The rates at which documents are used
    solve a least-squares problem, expected tokens per source against target share times total, between
    0 and the ``max_repeats`` of the document's source (1 for a document without a known source), by projected
    gradient steps.  Documents of equal memberships and limit have equal rates, so they are added up once, and each step is one
    pass over these sums that carries their rates along.  It ends within ``tolerance`` of the total or after ``rounds`` steps; the result tells
    which.  Rates become whole repeats so that within a partition and source what rounding takes from one document the next one gets.

    ``total_tokens`` is by default the most with which every source that has documents can reach its share.
    Sources without documents reach nothing, and the others' reached shares are larger in proportion.  Documents of sources
    that have no target are not used.  Null and blank texts and null ids are left out; spellings of a source that differ in
    case, blanks and ``-`` are one.  Targets that are null, or of null sources, are ignored; without targets or documents nothing is chosen.
    """
    spark = rows.sparkSession
    wanted = targets.select(source_name(F.col("source")).alias("s"), "target_share", "max_repeats").filter("s is not null and target_share > 0 and max_repeats > 0")
    wanted = [(r.s, float(r.target_share), int(r.max_repeats)) for r in wanted.orderBy("s").collect()]
    names, share, cap = [w[0] for w in wanted] + ["(no target)"], np.array([w[1] for w in wanted] + [0.0]), [w[2] for w in wanted] + [0]
    k = len(names)

    cores = spark.sparkContext.defaultParallelism
    texts = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), source_name(F.col(source_col)).alias("source"))
    texts = texts.filter(F.col("id").isNotNull() & not_blank(F.col("text")))
    known = F.array_position(F.lit(names), F.col("source"))
    label = F.when(F.col("source").isNull(), -1).when((known > 0) & (known < k), known - 1).otherwise(k - 1).cast("int")
    texts = texts.select("id", "text", label.alias("label"))
    classifier = _classifier(texts, names, rows.count())
    # First sources with a target, then none, then others.
    rank = F.when(F.col("label") < 0, 1).when(F.col("label") < k - 1, 0).otherwise(2)
    unique = texts.groupBy(F.sha2("text", 256).alias("copy")).agg(F.min(F.struct(rank.alias("rank"), "id", "label")).alias("x"), F.first("text").alias("text")).select("x.id", "x.label", "text")
    unique = unique.repartition(cores, "id") if rows.rdd.getNumPartitions() < cores else unique
    model = spark.sparkContext.broadcast(classifier)
    caps = np.array(cap + [1.0])

    def membered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, base, seen = model.value
        for batch in batches:
            label = np.asarray(batch.column("label"))
            column = batch.column("text")
            tokens = [count(t, path) for t in column.to_pylist()]
            score = np.zeros((batch.num_rows, k))
            for i, data, offsets in pieces(column):
                owner, index = words_of(data, offsets, FEATURES)
                first = np.flatnonzero(np.diff(owner, prepend=-1))
                if len(first):
                    score[i + owner[first]] = np.add.reduceat(w[index], first, axis=0)
            score += base
            p = np.exp(score - score.max(axis=1, keepdims=True)) * seen
            p /= np.maximum(p.sum(axis=1), 1e-12)[:, None]
            labelled = label >= 0
            p[labelled] *= 1 - trust
            p[labelled, label[labelled]] += trust
            grid = pa.array(list(np.round(p * GRID).astype(np.int32)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(caps[np.where(labelled, label, k)]), pa.array(tokens, pa.int64()), grid], ["id", "label", "most", "n_tokens", "grid"])

    kind = dict(texts.dtypes)["id"]
    member = written(unique.mapInArrow(membered, f"id {kind}, label int, most double, n_tokens bigint, grid array<int>").withColumn("cell", F.xxhash64("grid", "most")), "members")

    def memberships(column: pa.Array) -> np.ndarray:
        p = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k).astype(np.float64)
        return p / np.maximum(p.sum(axis=1), 1)[:, None]

    def totals(state: DataFrame, of: str) -> tuple[np.ndarray, np.ndarray]:
        """Expected tokens per source at the rates in column ``of``, and the scale of the problem."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(2 * k)
            for batch in batches:
                p, tokens = memberships(batch.column("grid")), np.asarray(batch.column("n_tokens")).astype(np.float64)
                total[:k] += (np.asarray(batch.column(of)) * tokens) @ p
                total[k:] += tokens @ p**2
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(2 * k), pa.int32()), pa.array(total)], ["i", "v"])

        out = np.zeros(2 * k)
        for r in state.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
            out[r.i] = r.v
        return out[:k], np.maximum(out[k:], 1e-9)

    def stepped(state: DataFrame, step: np.ndarray) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rate = np.clip(np.asarray(batch.column("rate")) - memberships(batch.column("grid")) @ step, 0, np.asarray(batch.column("most")))
                yield pa.RecordBatch.from_arrays([batch.column("grid"), batch.column("most"), batch.column("n_tokens"), pa.array(rate)], ["grid", "most", "n_tokens", "rate"])

        return state.mapInArrow(run, "grid array<int>, most double, n_tokens bigint, rate double")

    cells = written(member.groupBy("cell", "grid", "most").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("count")), "cells")
    state = written(cells.select("grid", "most", "n_tokens", F.lit(0.0).alias("rate")), "rates")
    most, scale = totals(state, "most")
    reachable = (share > 0) & (most > 0)
    total = float(total_tokens or (min(most[reachable] / share[reachable]) if reachable.any() else 0))
    goal = share * total
    taken, residual = 0, 1.0
    while total > 0:
        off = totals(state, "rate")[0] - goal
        residual = float(np.abs(off[reachable]).max() / total)
        if residual <= tolerance or taken >= rounds:
            break
        after = written(stepped(state, off / scale), "rates")
        discarded(state)
        state, taken = after, taken + 1

    # Many documents may have the same memberships.
    hot = hot_keys(cells.groupBy("cell").agg(F.sum("count").alias("count")), "cell", member.count())
    rate = repeat_rows(state.select(F.xxhash64("grid", "most").alias("cell"), "grid", "most", "rate"), hot, "cell")
    rated = split_rows(member, hot, "cell", "id").join(rate, ["cell", "part", "grid", "most"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owed = np.zeros(k + 1)
        for batch in batches:
            p, tokens, label = memberships(batch.column("grid")), np.asarray(batch.column("n_tokens")).astype(np.float64), np.asarray(batch.column("label"))
            r, limit = np.asarray(batch.column("rate")), np.asarray(batch.column("most"))
            counted = np.where(label >= 0, label, p[:, :-1].argmax(axis=1) if k > 1 else 0)
            repeats = np.zeros(len(r), np.int64)
            for i, (rate, n, s, most_) in enumerate(zip(r.tolist(), tokens.tolist(), counted.tolist(), limit.tolist())):
                # Down or up, whichever leaves less to make good.
                low = int(rate)
                up = low + 1 <= most_ and rate > low and owed[s] + (rate - low) * n >= n / 2
                repeats[i] = low + up
                owed[s] += (rate - repeats[i]) * n
            soft = (repeats * tokens)[:, None] * p
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([names[c] for c in counted], pa.string()), pa.array(repeats), batch.column("n_tokens"), pa.array(list(soft), pa.list_(pa.float64()))],
                ["id", "source", "repeats", "n_tokens", "soft"],
            )

    used = written(rated.mapInArrow(whole, f"id {kind}, source string, repeats bigint, n_tokens bigint, soft array<double>").filter("repeats > 0"), "used")
    chosen = used.select(F.col("id").alias(id_col), "source", "repeats", "n_tokens")
    tokens = F.col("repeats") * F.col("n_tokens")
    reached = used.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum(tokens).alias("n_tokens"))
    expected = used.select(F.posexplode("soft")).groupBy("pos").agg(F.sum("col").alias("expected"))
    expected = expected.select(F.get(F.lit(names), F.col("pos")).alias("source"), "expected")
    all_tokens = used.agg(F.coalesce(F.sum(tokens), F.lit(0))).first()[0] or 1
    aims = spark.createDataFrame([(w[0], w[1]) for w in wanted], "source string, target_share double")
    shares = aims.join(reached, "source", "left").join(expected, "source", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    converged = bool(total == 0 or residual <= tolerance)
    shares = shares.select("source", "target_share", F.round(zero(F.col("n_tokens")) / all_tokens, 6).alias("reached_share"), F.round(zero(F.col("expected")) / all_tokens, 6).alias("expected_share"), zero(F.col("n_docs")).alias("n_docs"), zero(F.col("n_tokens")).alias("n_tokens"), F.lit(converged).alias("converged"))
    return Mixture(chosen, shares, taken, residual, converged)
