"""Usable vectors, and their division into overlapping cells.

All steps work on Arrow batches with numpy inside Spark's tasks.  A vector travels as bytes, in half
precision where that is exact and in single precision where it is not, so nothing is lost.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import discarded, written

#: Ids that come more than once are broadcast up to this number, beyond it they are shuffled.
BROADCAST_IDS = 50_000


def pack(x: np.ndarray) -> pa.Array:
    """Rows of a float32 matrix as bytes."""
    with np.errstate(over="ignore"):
        half = x.astype(np.float16)
    exact = (half.astype(np.float32) == x).all(axis=1)
    if exact.all():
        kind = pa.binary(2 * x.shape[1])
        return pa.Array.from_buffers(kind, len(x), [None, pa.py_buffer(np.ascontiguousarray(half))]).cast(pa.binary())
    return pa.array([(h if e else s).tobytes() for h, s, e in zip(half, x, exact)], pa.binary())


def unpack(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """The float32 matrix of packed rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    out = np.empty((len(column), dim), np.float32)
    if not len(column):
        return out
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False)
    for size, kind in ((2 * dim, np.float16), (4 * dim, np.float32)):
        chosen = lengths == size
        if chosen.any():
            part = column if chosen.all() else column.filter(pa.array(chosen))
            joined = b"".join(part.to_pylist()) if not chosen.all() else _bytes(part)
            out[chosen] = np.frombuffer(joined, kind).reshape(-1, dim)
    return out


def _bytes(column: pa.Array):
    """The values of a binary array, one after another."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    at = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1]
    return memoryview(column.buffers()[2])[at[0] : at[-1]]


def units(x: np.ndarray) -> np.ndarray:
    """Rows in double precision, of length 1."""
    wide = x.astype(np.float64)
    return wide / np.sqrt(np.einsum("ij,ij->i", wide, wide))[:, None]


def directions(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """As ``units`` of packed rows, in single precision; only a part of them is in double precision at once."""
    x = unpack(column, dim)
    for i in range(0, len(x), 16_384):
        x[i : i + 16_384] = units(x[i : i + 16_384])
    return x


def _packed(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            fits = np.asarray(pc.fill_null(pc.equal(pc.list_value_length(column), dim), False))
            flat = column.filter(pa.array(fits)).flatten()
            x = flat.to_numpy(zero_copy_only=False).astype(np.float32, copy=False).reshape(-1, dim)
            good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
            rows = np.flatnonzero(fits)[good]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows)), pack(x[good])], ["id", "vec"])

    return run


def usable_vectors(rows: DataFrame, dim: int, id_col: str = "id", vector_col: str = "embedding") -> DataFrame:
    """(id, vec): each id once, with its usable vector: ``dim`` finite elements, not all zero.

    Null ids, and null, short, long, all-zero or non-finite vectors are left out.  Of an id with several
    usable vectors the smallest in byte order is taken.  Only the ids that come more than once are
    grouped; they are counted first and broadcast if they are few, else joined by shuffle.
    """
    raw = _raw(rows, id_col, vector_col)
    once, many, _ = _usable(raw, dim)
    return once(raw).unionByName(many(raw)) if many else once(raw)


def usable_and_drawn(rows: DataFrame, n_rows: int, dim: int, id_col: str = "id", vector_col: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """``usable_vectors`` of a table of ``n_rows``, and of its ``drawn_rows``; ids that come more than once are looked for once for both.

    The vectors of those are written if they are few, a row for each id, so their rows are read once too."""
    raw = _raw(rows, id_col, vector_col)
    once, many, few = _usable(raw, dim)
    drawn = drawn_rows(raw, n_rows)
    if not many:
        return once(raw), once(drawn)
    if not few:
        return once(raw).unionByName(many(raw)), once(drawn).unionByName(many(drawn))
    chosen = written(many(raw), "many")
    return once(raw).unionByName(chosen), once(drawn).unionByName(drawn_rows(chosen, n_rows))


def _raw(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return rows.select(F.col(id_col).cast("string").alias("id"), F.col(vector_col).cast("array<float>").alias("embedding")).filter("id is not null and embedding is not null")


def _usable(raw: DataFrame, dim: int) -> tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame] | None, bool]:
    """What gives the usable vectors of the ids of ``raw`` that come once, and of the others, None if there are none; whether those are few."""
    repeated = written(raw.groupBy("id").count().filter("count > 1").select("id"), "repeated")
    n = repeated.count()
    packed = lambda part: part.mapInArrow(_packed(dim), "id string, vec binary")
    if not n:
        return packed, None, True
    few = n <= BROADCAST_IDS
    repeated = F.broadcast(repeated) if few else repeated
    once = lambda part: packed(part.join(repeated, "id", "left_anti"))
    many = lambda part: packed(part.join(repeated, "id", "left_semi")).groupBy("id").agg(F.min("vec").alias("vec"))
    return once, many, few


def sample_vectors(vectors: DataFrame, n_rows: int, size: int, dim: int) -> np.ndarray:
    """About ``size`` (never over twice that) vectors of length 1, chosen by the hash of their id."""
    step = max(1, n_rows // size)
    chosen = vectors.filter(F.pmod(F.xxhash64("id"), F.lit(step)) == 0).select("vec").limit(2 * size).toArrow()
    return directions(chosen.column("vec"), dim)


def spherical_kmeans(sample: np.ndarray, k: int, rounds: int = 6, seed: int = 1) -> np.ndarray:
    """``k`` directions that the sample's vectors gather around."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        nearest = np.concatenate([(part @ centres.T).argmax(axis=1) for part in np.array_split(sample, max(1, len(sample) * max(len(centres), 1024) // (4096 * 1024)))])
        order = np.argsort(nearest, kind="stable")
        found, first = np.unique(nearest[order], return_index=True)
        sums = np.zeros_like(centres)
        sums[found] = np.add.reduceat(sample[order], first, axis=0)
        length = np.linalg.norm(sums, axis=1)
        empty = length < 1e-6
        sums[empty] = sample[rng.choice(len(sample), int(empty.sum()))]
        length = np.where(empty, np.linalg.norm(sums, axis=1), length)
        centres = sums / length[:, None]
    return centres


def two_level_kmeans(sample: np.ndarray, k: int) -> np.ndarray:
    """As ``spherical_kmeans``; more than FLAT centres in two levels, each coarse group getting its share of them."""
    if k <= FLAT:
        return spherical_kmeans(sample, k)
    coarse = spherical_kmeans(sample, round(math.sqrt(k)))
    own = nearest_cells(sample, coarse, 1, 0.0)[:, 0]
    groups = [sample[own == g] for g in np.unique(own)]
    return np.concatenate([spherical_kmeans(group, max(1, round(k * len(group) / len(sample)))) for group in groups])


def without_near_copies(centres: np.ndarray, sample: np.ndarray, alike: float) -> np.ndarray:
    """Centres with a cosine of at least ``alike`` to a heavier one join it, weighted by their vectors in the sample;
    where there are over FLAT, within groups of centres.

    K-means gives a large group of similar vectors many centres, which would tear its members apart."""
    index = Centres.of(centres)
    return _without_near_copies(index, _weights(index, sample), alike)


def _weights(index: Centres, sample: np.ndarray) -> np.ndarray:
    """How many of the sample are nearest to each centre, one at least."""
    return np.maximum(np.bincount(index.nearest(sample, 1, 0.0)[:, 0], minlength=len(index.all)), 1)


def _without_near_copies(index: Centres, weight: np.ndarray, alike: float) -> np.ndarray:
    centres, weight = index.all, weight.astype(np.float32)
    out = []
    for group in index.lists:
        own, heavy = centres[group], weight[group]
        left = np.ones(len(own), bool)
        for i in np.argsort(-heavy, kind="stable"):
            if left[i]:
                near = left & (own @ own[i] >= alike)
                near[i] = True
                out.append((own[near] * heavy[near, None]).sum(axis=0))
                left &= ~near
    sums = np.array(out, np.float32)
    return sums / np.linalg.norm(sums, axis=1)[:, None]


#: Vectors to a centre, sampled vectors to a centre, the centres from which they are searched in two levels, and the most centres
#: there are (32 MB at 128 dimensions, and a sample of about a million vectors); from 6.5 million vectors cells grow with the table.
PER_CENTRE, SAMPLED, FLAT, MOST_CENTRES = 100, 16, 4096, 65_536
#: Groups of centres in which a vector's nearest are looked for, and the number of largest up to which each is picked by a pass of its own.
GROUPS, PICKED = 16, 8


def pairs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of a matrix's true entries, as ``np.nonzero``, which takes several times as long where they are few."""
    return np.divmod(np.flatnonzero(mask), mask.shape[1])


def nearest_cells(x: np.ndarray, centres: np.ndarray, most: int, margin: float) -> np.ndarray:
    """(rows, most): cells of each row, nearest first, -1 for none."""
    most = min(most, len(centres))
    out = np.empty((len(x), most), np.int32)
    rows = max(64, 512 * FLAT // max(len(centres), FLAT))
    for i in range(0, len(x), rows):
        out[i : i + rows] = _within(*_top(x[i : i + rows] @ centres.T, most), margin)
    return out


def _top(dots: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns and values of the ``most`` largest of each row, largest first; where they are few, ``dots`` is used up."""
    if most <= PICKED:
        top, value, at = np.empty((len(dots), most), np.int64), np.empty((len(dots), most), dots.dtype), np.arange(len(dots))
        for i in range(most):
            top[:, i] = dots.argmax(axis=1)
            value[:, i] = dots[at, top[:, i]]
            dots[at, top[:, i]] = -np.inf
        return top, value
    top = np.argpartition(-dots, most - 1, axis=1)[:, :most] if most < dots.shape[1] else np.tile(np.arange(dots.shape[1]), (len(dots), 1))
    value = np.take_along_axis(dots, top, axis=1)
    order = np.argsort(-value, axis=1, kind="stable")
    return np.take_along_axis(top, order, axis=1), np.take_along_axis(value, order, axis=1)


def _within(top: np.ndarray, value: np.ndarray, margin: float) -> np.ndarray:
    return np.where(value >= value[:, :1] - margin, top, -1)


@dataclass(frozen=True)
class Centres:
    """Directions, in groups around ``heads`` if there are over FLAT: a vector's nearest are then looked for in the GROUPS groups nearest to it."""

    all: np.ndarray
    heads: np.ndarray
    lists: list[np.ndarray]

    @classmethod
    def of(cls, centres: np.ndarray) -> Centres:
        if len(centres) <= FLAT:
            return cls(centres, centres[:1], [np.arange(len(centres))])
        heads = spherical_kmeans(centres, round(math.sqrt(len(centres))))
        own = nearest_cells(centres, heads, 1, 0.0)[:, 0]
        found = np.unique(own)
        return cls(centres, heads[found], [np.flatnonzero(own == g) for g in found])

    def nearest(self, x: np.ndarray, most: int, margin: float) -> np.ndarray:
        """As ``nearest_cells``."""
        if len(self.lists) == 1:
            return nearest_cells(x, self.all, most, margin)
        most = min(most, len(self.all))
        out = np.empty((len(x), most), np.int32)
        for i in range(0, len(x), 16_384):
            part = x[i : i + 16_384]
            asked = nearest_cells(part, self.heads, GROUPS, 4.0)
            best, value = np.full((len(part), most), -1, np.int64), np.full((len(part), most), -4.0, np.float32)
            for g, group in enumerate(self.lists):
                rows = np.flatnonzero((asked == g).any(axis=1))
                if len(rows):
                    top, dots = _top(part[rows] @ self.all[group].T, min(most, len(group)))
                    both = np.concatenate([best[rows], group[top]], axis=1)
                    order, value[rows] = _top(np.concatenate([value[rows], dots], axis=1), most)
                    best[rows] = np.take_along_axis(both, order, axis=1)
            out[i : i + 16_384] = _within(best, value, margin)
        return out


@dataclass(frozen=True)
class Cells:
    """Overlapping cells: a vector lies in the cells of its ``most`` nearest centres whose cosine is within
    ``margin`` of the best, which is its home.  A cell of over ``block`` vectors (estimated from the sample) is cut into
    blocks by the hash of the id; each pair of its blocks is a tile, so every pair of a cell's vectors
    meets in a tile however many vectors the cell holds, and no task gets more than two blocks."""

    centres: np.ndarray
    blocks: np.ndarray
    most: int
    margin: float

    @property
    def bases(self) -> np.ndarray:
        """The number of each cell's first tile."""
        return np.concatenate([[0], np.cumsum(self.blocks * (self.blocks + 1) // 2)])[:-1]


def train_cells(sample: np.ndarray, n_rows: int, most: int = 3, margin: float = 0.15, block: int = 16_384, alike: float = 0.85) -> Cells:
    """Cells for about ``n_rows`` vectors, from a sample of them; their number grows with the rows, up to MOST_CENTRES."""
    k = max(1, min(centres_for(n_rows), len(sample)))
    centres = without_near_copies(two_level_kmeans(sample, k), sample, alike)
    counts = np.bincount(Centres.of(centres).nearest(sample, most, margin).ravel() + 1, minlength=len(centres) + 1)[1:]
    expected = counts * (n_rows / max(len(sample), 1))
    return Cells(centres, np.maximum(1, np.ceil(expected / block)).astype(np.int64), most, margin)


def centres_for(n_rows: int) -> int:
    """The number of centres for about ``n_rows`` vectors."""
    return min(2 ** round(math.log2(max(n_rows / PER_CENTRE, 1))), MOST_CENTRES)


def train_wide_cells(drawn: DataFrame, n_rows: int, dim: int, most: int = 3, margin: float = 0.15, block: int = 16_384, alike: float = 0.85) -> tuple[Cells, np.ndarray] | None:
    """As ``train_cells`` in two levels, for a sample (id, vec) that stays in the shared folder, and a part of it.  None if it is empty.

    The coarse groups come from SAMPLED x FLAT of the sample on the driver, the centres within each from all its vectors, in tasks of their own, so the driver
    holds the centres but never the sample.  A group of over that number is trained in parts, each with its share of the centres."""
    spark = drawn.sparkSession
    k, whole = centres_for(n_rows), SAMPLED * FLAT
    drawn = written(drawn.select("id", "vec"), "sample")
    total = drawn.count()
    if not total:
        return None
    few = drawn.filter(F.pmod(F.xxhash64("id", F.lit("coarse")), F.lit(max(1, total // whole))) == 0).toArrow().sort_by("id")
    few = directions((few if few.num_rows else drawn.limit(whole).toArrow()).column("vec"), dim)
    heads = spark.sparkContext.broadcast(spherical_kmeans(few, round(math.sqrt(k))))

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = nearest_cells(directions(batch.column("vec"), dim), heads.value, 1, 0.0)[:, 0]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), batch.column("id"), batch.column("vec")], ["head", "id", "vec"])

    def centred(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        x = directions(table.column("vec"), dim)
        distinct = len(set(table.column("vec").to_pylist()))
        index = Centres.of(two_level_kmeans(x, max(1, min(round(k * len(x) / total), distinct))))
        n = len(index.all)
        first = [pa.array(np.full(n, table.column(c)[0].as_py()), pa.int32()) for c in ("head", "part")]
        return pa.table([*first, pa.array(np.arange(n), pa.int32()), pa.array(_weights(index, x), pa.int64()), pa.array([c.tobytes() for c in index.all], pa.binary())], ["head", "part", "at", "weight", "centre"])

    grouped = drawn.mapInArrow(headed, "head int, id string, vec binary")
    # A row for each head.
    parts = grouped.groupBy("head").count().select("head", F.ceil(F.col("count") / whole).cast("int").alias("parts"))
    grouped = grouped.join(F.broadcast(parts), "head").withColumn("part", F.pmod(F.xxhash64("id", F.lit("part")), F.col("parts")).cast("int"))
    found = grouped.groupBy("head", "part").applyInArrow(centred, "head int, part int, at int, weight bigint, centre binary").toArrow()
    found = found.take(pc.sort_indices(found, [(c, "ascending") for c in ("head", "part", "at")]))
    centres, weight = np.frombuffer(_bytes(found.column("centre").combine_chunks()), np.float32).reshape(-1, dim), found.column("weight").to_numpy()
    del found
    index = Centres.of(_without_near_copies(Centres.of(centres), weight, alike))
    del centres
    shared = spark.sparkContext.broadcast(index)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        n = np.zeros(len(index.all), np.int64)
        for batch in batches:
            n += np.bincount(index.nearest(directions(batch.column("vec"), dim), most, margin).ravel() + 1, minlength=len(n) + 1)[1:]
        cell = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(n[cell], pa.int64())], ["cell", "n"])

    # A row for each centre.
    held = drawn.mapInArrow(counted, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    expected = np.zeros(len(index.all))
    expected[held.column("cell").to_numpy()] = held.column("n").to_numpy() * (n_rows / total)
    for b in (heads, shared):
        b.destroy()
    discarded(drawn)
    return Cells(index.all, np.maximum(1, np.ceil(expected / block)).astype(np.int64), most, margin), few


def cells_for(vectors: DataFrame, drawn: DataFrame, n_rows: int, dim: int, train: Callable[[np.ndarray, int], Cells], most: int = 3, margin: float = 0.15) -> tuple[Cells | None, np.ndarray]:
    """Cells for the ``vectors`` (id, vec) of a table of ``n_rows``, and a bounded sample of them.  ``drawn`` has those whose ids the sample takes.

    Up to FLAT centres their sample comes to the driver, which then calls ``train``.  No cells if there are no vectors."""
    found = train_wide_cells(drawn, n_rows, dim, most, margin) if centres_for(n_rows) > FLAT else None
    if found:
        return found
    sample = sample_vectors(drawn, n_rows, sample_size(n_rows), dim)
    if not len(sample):
        # A sample may miss the few there are.
        sample = sample_vectors(vectors, 1, sample_size(1), dim)
    return (train(sample, n_rows) if len(sample) else None), sample


def drawn_rows(rows: DataFrame, n_rows: int, id_col: str = "id") -> DataFrame:
    """Of ``n_rows`` rows those whose ids ``sample_vectors`` takes to train cells."""
    return rows.filter(F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(max(1, n_rows // sample_size(n_rows)))) == 0)


def sample_size(n_rows: int) -> int:
    """Rows to train cells on: SAMPLED for each centre, so at most SAMPLED times MOST_CENTRES."""
    return int(min(max(n_rows / PER_CENTRE * SAMPLED, 4096), SAMPLED * MOST_CENTRES))


def tiled(vectors: DataFrame, cells: Cells, dim: int) -> DataFrame:
    """(tile, cell, side, id, vec): each vector once for each tile of each of its cells.  ``side`` is its
    block within the tile: -1 where the tile has one block, else 0 or 1."""
    shared = vectors.sparkSession.sparkContext.broadcast((Centres.of(cells.centres), cells.blocks, cells.bases))
    most, margin = cells.most, cells.margin

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, blocks, bases = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = units(unpack(batch.column("vec"), dim)).astype(np.float32)
            own = centres.nearest(x, most, margin)
            row, slot = np.nonzero(own >= 0)
            cell = own[row, slot]
            n, block = blocks[cell], np.asarray(batch.column("hash"))[row] % blocks[cell]
            # A vector of block i is in the tiles {i, j} for every j of the cell.
            times = n
            row, cell, block, n = (np.repeat(v, times) for v in (row, cell, block, n))
            other = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            low, high = np.minimum(block, other), np.maximum(block, other)
            tile = bases[cell] + low * n - low * (low - 1) // 2 + (high - low)
            side = np.where(low == high, -1, (block == high).astype(np.int64))
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tile, pa.int64()), pa.array(cell, pa.int32()), pa.array(side, pa.int32()), batch.column("id").take(take), batch.column("vec").take(take)],
                ["tile", "cell", "side", "id", "vec"],
            )

    keyed = vectors.withColumn("hash", F.pmod(F.xxhash64("id", F.lit("block")), F.lit(1 << 40)))
    return keyed.mapInArrow(run, "tile bigint, cell int, side int, id string, vec binary")


def home_tiled(vectors: DataFrame, cells: Cells, dim: int) -> DataFrame:
    """(tile, whole, role, id, hash, vec): tiles in which the vectors at home in a cell meet all vectors of the cell, each pair once.

    ``role`` is 1 for a row of a tile (a vector at home), 0 for a column, 2 for both.  A cell of n blocks has n x n tiles, a block at home
    in each against one of all blocks; ``whole`` tells of a cell of one tile."""
    bases = np.concatenate([[0], np.cumsum(cells.blocks**2)])[:-1]
    shared = vectors.sparkSession.sparkContext.broadcast((Centres.of(cells.centres), cells.blocks, bases))
    most, margin = cells.most, cells.margin

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, blocks, bases = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            own = centres.nearest(units(unpack(batch.column("vec"), dim)).astype(np.float32), most, margin)
            hashed = np.asarray(batch.column("hash"))
            row, slot = np.nonzero(own >= 0)
            out = []
            # As columns in the tiles of every row block, and those at home as rows in the tiles of every column block.
            for chosen, is_row in ((np.ones(len(row), bool), False), (slot == 0, True)):
                r, cell = row[chosen], own[row[chosen], slot[chosen]]
                n, block = blocks[cell], hashed[r] % blocks[cell]
                times = np.repeat(n, n)
                other = np.arange(len(times)) - np.repeat(np.cumsum(n) - n, n)
                r, cell, block, at_home = (np.repeat(v, n) for v in (r, cell, block, slot[chosen] == 0))
                i, j = (block, other) if is_row else (other, block)
                both = (i == j) & at_home
                # A vector that is row and column of a tile comes once, as a column.
                kept = ~both if is_row else np.ones(len(r), bool)
                role = np.where(both, 2, int(is_row))
                out.append([x[kept] for x in (bases[cell] + i * times + j, times == 1, role, r)])
            tile, whole, role, r = (np.concatenate(x) for x in zip(*out))
            take = pa.array(r)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tile, pa.int64()), pa.array(whole), pa.array(role, pa.int32()), batch.column("id").take(take), batch.column("hash").take(take), batch.column("vec").take(take)],
                ["tile", "whole", "role", "id", "hash", "vec"],
            )

    keyed = vectors.withColumn("hash", F.pmod(F.xxhash64("id", F.lit("block")), F.lit(1 << 40)))
    return keyed.mapInArrow(run, "tile bigint, whole boolean, role int, id string, hash bigint, vec binary")
