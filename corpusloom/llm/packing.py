"""Filling containers of fixed capacity: bounded-space online best fit."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import written

#: Bins open at once.
OPEN = 512


class BestFit:
    """At most ``most`` open bins of ``capacity``, best fit.

    The open bins are keyed by their free space; a bitset (a Python integer) tells which amounts of free
    space occur, so the bin with the least room that suffices is found by its lowest set bit.  An item that fits in
    no open bin opens one; if there are too many then, the fullest is closed."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.bits, self.bins, self.n_open, self.made = 0, {}, 0, 0

    def _keep(self, bin_: int, free: int) -> None:
        if free > 0:
            self.bins.setdefault(free, []).append(bin_)
            self.bits |= 1 << free
            self.n_open += 1

    def _take(self, free: int) -> int:
        here = self.bins[free]
        bin_ = here.pop()
        if not here:
            del self.bins[free]
            self.bits ^= 1 << free
        self.n_open -= 1
        return bin_

    def place(self, size: int) -> int:
        """The number of the bin for an item of ``size`` (1 to the capacity)."""
        enough = self.bits >> size
        if enough:
            free = size + (enough & -enough).bit_length() - 1
            bin_ = self._take(free)
        else:
            free, bin_ = self.capacity, self.made
            self.made += 1
            if self.n_open >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
        self._keep(bin_, free - size)
        return bin_


def packed(sizes: DataFrame, containers: DataFrame, id_col: str = "doc_id", size_col: str = "n_tokens", name_col: str = "container_name", capacity_col: str = "capacity_tokens", lanes: int | None = None, items_per_lane: int = 50_000, most_open: int = OPEN) -> DataFrame:
    """(container_name, container, id, piece, n_pieces, start, n_tokens): every item in one container of
    each kind, in pieces only if it alone exceeds the capacity.

    ``sizes`` has each item's size, ``containers`` each kind's name and capacity (a small table by its
    nature, read on the driver).  Items are spread over lanes by the hash of their id, within a lane they
    come in the order of that hash, and each lane fills its own containers of every kind, so
    a result is the same however often a task is run again.  All pieces of an oversized item but the last fill a container each;
    the last is placed like any other item.  ``start`` is the number of tokens before the piece.

    At the end of a lane up to ``most_open`` containers are left with room; a lane has about
    ``items_per_lane`` items so that these do not matter.  Null ids, and null, zero or negative sizes, are left out;
    an id that occurs twice is two items of the same lane; kinds with a null or non-positive capacity get nothing.
    """
    kinds = [(r[0], int(r[1])) for r in containers.select(name_col, capacity_col).distinct().orderBy(name_col, capacity_col).collect() if r[1] and r[1] > 0]
    items = sizes.select(F.col(id_col), F.col(size_col).cast("bigint").alias("_size")).filter(F.col(id_col).isNotNull() & (F.col("_size") > 0))
    items = written(items.withColumn("_hash", F.xxhash64(F.col(id_col).cast("string"))), "sizes")
    lanes = lanes or max(1, round(items.count() / items_per_lane))
    spread = items.repartition(lanes, "_hash").sortWithinPartitions("_hash", id_col, "_size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane = TaskContext.get().partitionId()
        bins = [(name, capacity, BestFit(capacity, most_open)) for name, capacity in kinds]
        for batch in batches:
            size = batch.column("_size").to_pylist()
            for name, capacity, fit in bins:
                row, container, piece, pieces, start, tokens = [], [], [], [], [], []
                for i, whole in enumerate(size):
                    n = -(-whole // capacity)
                    for p in range(n):
                        part = min(capacity, whole - p * capacity)
                        row.append(i)
                        container.append(fit.place(part))
                        piece.append(p)
                        start.append(p * capacity)
                        tokens.append(part)
                    pieces.extend([n] * n)
                label = [f"{lane}-{c}" for c in container]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(row), pa.string()), pa.array(label), batch.column(id_col).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(pieces, pa.int32()), pa.array(start, pa.int64()), pa.array(tokens, pa.int64())],
                    [name_col, "container", id_col, "piece", "n_pieces", "start", "n_tokens"],
                )

    kind = dict(items.dtypes)[id_col]
    return spread.mapInArrow(run, f"{name_col} string, container string, {id_col} {kind}, piece int, n_pieces int, start bigint, n_tokens bigint")


def fill_report(packing: DataFrame, containers: DataFrame, name_col: str = "container_name", capacity_col: str = "capacity_tokens") -> DataFrame:
    """(name, capacity, n_containers, n_tokens, filled): how full the containers of each kind are."""
    used = packing.groupBy(name_col).agg(F.count_distinct("container").alias("n_containers"), F.sum("n_tokens").alias("n_tokens"))
    return used.join(containers.select(name_col, capacity_col), name_col).withColumn("filled", F.round(F.col("n_tokens") / (F.col("n_containers") * F.col(capacity_col)), 6))
