"""The k most similar vectors of every vector: anisotropic quantisation, four-bit scans, exact reranking."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.vectors import Cells, cells_for, drawn_rows, nearest_cells, tiled, train_cells, units, unpack, usable_vectors

#: Codewords of a subspace: four bits.  Rows encoded at once; rows to train codebooks on.
WORDS, ENCODED, TRAINED = 16, 4096, 8192


@dataclass(frozen=True)
class Codebooks:
    """``words`` (subspaces, 16, width): codewords for what is left of a vector beside its cell's centre,
    brought to length 1, since vectors near their centre leave little.  ``weight``: by how much an error along the vector costs more than one across it."""

    words: np.ndarray
    weight: float

    def errors(self, rest: np.ndarray, code: np.ndarray) -> np.ndarray:
        """By how much the score of each row may be off for any query of length 1: the length of what its code leaves."""
        m, _, w = self.words.shape
        left = rest.reshape(-1, m, w).copy()
        for j in range(m):
            left[:, j] -= self.words[j][code[:, j]]
        return np.sqrt(np.einsum("ijk,ijk->i", left, left))

    def encode(self, rest: np.ndarray, unit: np.ndarray, rounds: int = 1) -> np.ndarray:
        """(rows, subspaces): the codeword numbers that make the anisotropic loss small: the squared error,
        with its part along the vector counted ``weight`` times.  Coordinate descent from the nearest words."""
        if len(rest) > ENCODED:
            return np.concatenate([self.encode(rest[i : i + ENCODED], unit[i : i + ENCODED], rounds) for i in range(0, len(rest), ENCODED)])
        m, _, w = self.words.shape
        rest, unit = rest.reshape(-1, m, w), unit.reshape(-1, m, w)
        squares = (self.words**2).sum(axis=2)
        # (subspaces, rows, words): the squared error of every word but for the row's own square.
        error = squares[:, None] - 2 * np.matmul(rest.transpose(1, 0, 2), self.words.transpose(0, 2, 1))
        code = error.argmin(axis=2).astype(np.uint8).T
        if not rounds:
            return code
        each = np.arange(len(rest))
        # The same of the error's part along the vector.
        part = (rest * unit).sum(axis=2).T[:, :, None] - np.matmul(unit.transpose(1, 0, 2), self.words.transpose(0, 2, 1))
        along = np.take_along_axis(part, code.T[:, :, None].astype(np.intp), axis=2).sum(axis=(0, 2))
        for _ in range(rounds):
            for j in range(m):
                others = along - part[j, each, code[:, j]]
                cost = (others[:, None] + part[j]) ** 2
                cost *= self.weight - 1
                cost += error[j]
                code[:, j] = cost.argmin(axis=1)
                along = others + part[j, each, code[:, j]]
        return code


def drawn(sample: np.ndarray, most: int, seed: int = 3) -> np.ndarray:
    """At most ``most`` rows of the whole sample, at random."""
    return sample if len(sample) <= most else sample[np.sort(np.random.default_rng(seed).choice(len(sample), most, replace=False))]


def _lengths(rest: np.ndarray) -> np.ndarray:
    return np.maximum(np.linalg.norm(rest, axis=1), 1e-12)


def train_codebooks(unit: np.ndarray, cells: Cells, subspaces: int, threshold: float = 0.2, rounds: int = 4, seed: int = 2) -> Codebooks:
    """Codebooks for a bounded sample of vectors of length 1.  ``threshold`` is the cosine from which a
    score matters; it sets the weight of an error along the vector to (d - 1) t^2 / (1 - t^2)."""
    dim = unit.shape[1]
    width = dim // subspaces
    rest = unit - cells.centres[nearest_cells(unit, cells.centres, 1, 0.0)[:, 0]]
    rng = np.random.default_rng(seed)
    rest /= _lengths(rest)[:, None]
    start = rest[rng.choice(len(rest), WORDS, replace=len(rest) < WORDS)]
    words = start.reshape(WORDS, subspaces, width).transpose(1, 0, 2).copy()
    weight = max(1.0, (dim - 1) * threshold**2 / (1 - threshold**2))
    r, u = rest.reshape(-1, subspaces, width), unit.reshape(-1, subspaces, width)
    for step in range(2 * rounds):
        # Plain k-means first, then the anisotropic loss.
        books = Codebooks(words, weight if step >= rounds else 1.0)
        code = books.encode(rest, unit, rounds=int(step >= rounds))
        error = np.stack([r[:, j] - words[j][code[:, j]] for j in range(subspaces)], axis=1)
        along = (error * u).sum(axis=(1, 2))
        words = words.copy()
        for j in range(subspaces):
            others = along - (error[:, j] * u[:, j]).sum(axis=1)
            for k in range(WORDS):
                own = code[:, j] == k
                if not own.any():
                    continue
                a, t, e = u[own, j], r[own, j], books.weight - 1
                left = np.eye(width) * own.sum() + e * a.T @ a
                right = t.sum(axis=0) + e * ((others[own] + (t * a).sum(axis=1))[:, None] * a).sum(axis=0)
                words[j, k] = np.linalg.solve(left, right)
    return Codebooks(words.astype(np.float32), weight)


def _scan(tables: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """(queries, rows): sums of table entries.  tables: (groups, entries, queries), codes: (groups, rows)."""
    total = np.zeros((codes.shape[1], tables.shape[2]), np.uint16)
    entry = np.empty_like(total)
    for table, code in zip(tables, codes):
        np.take(table, code, axis=0, out=entry, mode="clip")
        total += entry
    return total.T


#: Queries scanned at once; rows from which two four-bit codes are looked up as one byte, which sums the same words in half the steps.
QUERIES, PAIRED = 128, 1024


class _Side:
    """Distinct vectors of one side of a tile, with all their ids in order."""

    def __init__(self, ids: np.ndarray, unit: np.ndarray, k: int):
        keys: dict[bytes, int] = {}
        group = np.array([keys.setdefault(row.tobytes(), len(keys)) for row in np.round(unit, 9) + 0.0], np.int64)
        self.group, (_, first) = group, np.unique(group, return_index=True)
        self.ids, self.unit = ids, unit[first]
        # The first k + 1 ids of each distinct vector; a query leaves out at most one, its own.
        order = np.argsort(group, kind="stable")
        start = np.searchsorted(group[order], np.arange(len(first)))
        place = np.arange(len(order)) - start[group[order]]
        self.first = np.full((len(first), k + 1), -1, np.int64)
        kept = place <= k
        self.first[group[order][kept], place[kept]] = order[kept]


def _best(queries: _Side, rows: _Side, own: bool, codes: np.ndarray, length: np.ndarray, error: np.ndarray, books: Codebooks, centre: np.ndarray, k: int, least: float, shortlist: int):
    """(query's row, other row, cosine) of the k best for each row of ``queries`` among the rows of ``rows``.

    A query for which no row can reach ``least``, with the row's own error added to its score, is done after the scan."""
    m, _, w = books.words.shape
    paired = len(rows.unit) >= PAIRED
    code = np.ascontiguousarray((codes[:, ::2] | codes[:, 1::2] << 4).T if paired else codes.T).astype(np.intp)
    size = min(shortlist, len(rows.unit))
    for i in range(0, len(queries.unit), QUERIES):
        unit = queries.unit[i : i + QUERIES]
        tables = books.words @ np.ascontiguousarray(unit.T.astype(np.float32)).reshape(m, w, -1)
        if paired:
            tables = (tables[1::2, :, None] + tables[::2, None]).reshape(m // 2, WORDS * WORDS, -1)
        low = tables.min(axis=1, keepdims=True)
        step = (tables.max(axis=1) - low[:, 0]).sum(axis=0) / 65_000 + 1e-12
        total = _scan(((tables - low) / step + 0.5).astype(np.uint16), code).astype(np.float32)
        total *= step[:, None].astype(np.float32)
        total += low.sum(axis=(0, 1))[:, None]
        total *= length
        # What rounding the tables may have cost: half a step for each of them.
        rounded = step * len(code) / 2 * float(length.max()) + 1e-4
        good = np.flatnonzero((total + error).max(axis=1) + unit @ centre >= least - rounded)
        if not len(good):
            continue
        total = total[good]
        top = np.argpartition(total, total.shape[1] - size, axis=1)[:, -size:] if size < total.shape[1] else np.tile(np.arange(size), (len(good), 1))
        top.sort(axis=1)
        cosine = np.round(np.matmul(rows.unit[top], unit[good][:, :, None])[:, :, 0], 6)
        # Distinct vectors by cosine, ties by their smallest id; then their ids.
        first = np.argsort(rows.first[top, 0], axis=1, kind="stable")
        first = np.take_along_axis(first, np.argsort(-np.take_along_axis(cosine, first, 1), axis=1, kind="stable"), 1)[:, : k + 1]
        cosine, top = np.take_along_axis(cosine, first, 1), np.take_along_axis(top, first, 1)
        other = rows.first[top].reshape(len(good), -1)
        cosine = np.repeat(cosine, k + 1, axis=1)
        cosine[(other < 0) | (cosine < least)] = -2
        order = np.argsort(other, axis=1, kind="stable")
        order = np.take_along_axis(order, np.argsort(-np.take_along_axis(cosine, order, 1), axis=1, kind="stable"), 1)[:, : k + 1]
        cosine, other = np.take_along_axis(cosine, order, 1), np.take_along_axis(other, order, 1)
        # Every id of the distinct vector, without itself.
        place = np.full(len(queries.unit), -1)
        place[i + good] = np.arange(len(good))
        query = np.flatnonzero(place[queries.group] >= 0)
        at = place[queries.group[query]]
        cos, oth = cosine[at], other[at]
        valid = (cos > -2) & ~((oth == query[:, None]) if own else False)
        valid &= valid.cumsum(axis=1) <= k
        r, c = np.nonzero(valid)
        yield query[r], oth[r, c], cos[r, c]


def _tile(table: pa.Table, k: int, least: float, shortlist: int, dim: int, centres: np.ndarray, books: Codebooks) -> pa.Table:
    side, ids = np.asarray(table.column("side")), table.column("id").to_numpy()
    x = unpack(table.column("vec"), dim)
    centre = centres[table.column("cell")[0].as_py()].astype(np.float64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for s in np.unique(side):
        at = np.flatnonzero(side == s)
        own, first = np.unique(ids[at], return_index=True)
        parts.append((own, units(x[at[first]])))
    sides = [_Side(own, unit, k) for own, unit in parts]
    rests = [(s.unit - centre).astype(np.float32) for s in sides]
    lengths = [_lengths(r) for r in rests]
    rests = [r / n[:, None] for r, n in zip(rests, lengths)]
    codes = [books.encode(r, s.unit.astype(np.float32)) for s, r in zip(sides, rests)]
    errors = [(books.errors(r, c) * n).astype(np.float32) for r, c, n in zip(rests, codes, lengths)]
    if (side == -1).all():
        pairs = [(0, 0)]
    else:
        pairs = [(0, 1), (1, 0)] if len(sides) == 2 else []
    out: list[list] = [[], [], []]
    for a, b in pairs:
        for q, o, cos in _best(sides[a], sides[b], a == b, codes[b], lengths[b], errors[b], books, centre, k, least, max(shortlist, len(sides[b].unit) // 40)):
            out[0].append(sides[a].ids[q])
            out[1].append(sides[b].ids[o])
            out[2].append(cos)
    names = ["id", "other", "cosine"]
    if not out[0]:
        return pa.table([pa.array([], t) for t in (pa.string(), pa.string(), pa.float64())], names)
    return pa.table([pa.array(np.concatenate(out[0]), pa.string()), pa.array(np.concatenate(out[1]), pa.string()), pa.array(np.concatenate(out[2]))], names)


def most_similar(rows: DataFrame, dim: int, k: int = 3, least: float = 0.75, id_col: str = "id", vector_col: str = "embedding", subspaces: int | None = None, shortlist: int = 96) -> DataFrame:
    """(id, rank, other, cosine): for each id with a usable vector the ``k`` others of highest cosine (in
    double precision from the stored values, rounded to 6 decimals, ties to the smaller id), without those below ``least``.

    Cells and their centres come from a sample that grows with the rows (``sample_size``), the four-bit codebooks from TRAINED of it; all
    vectors are indexed and all are queries.  Within a tile of a cell the residuals are quantised with the
    anisotropic loss, table scans pick ``shortlist`` candidates (or 1/40 of the tile, if more: from 40 times as many rows
    the list grows with the tile, since more rows are then nearly as good as the best), and these
    are ranked by exact cosines.  A scan ends a query only where the rows' own errors rule out any cosine of ``least``.  Equal vectors count once in a scan and keep their k + 1 smallest ids, so
    ties among any number of copies come out right.  Neighbours that share no tile are missed; the tests
    measure the share found.

    Null ids and unusable vectors (see ``usable_vectors``) are neither queries nor results; an empty table
    gives an empty result.  Other columns are ignored.
    """
    n = rows.count()
    vectors = usable_vectors(rows, dim, id_col, vector_col)
    spark = rows.sparkSession
    cells, sample = cells_for(vectors, usable_vectors(drawn_rows(rows, n, id_col), dim, id_col, vector_col), n, dim, lambda sample, n: train_cells(sample, n))
    if cells is None:
        return spark.createDataFrame([], "id string, rank int, other string, cosine double")
    books = train_codebooks(drawn(sample, TRAINED), cells, subspaces or dim // 2)
    shared = spark.sparkContext.broadcast((cells.centres, books))

    def run(table: pa.Table) -> pa.Table:
        return _tile(table, k, least, shortlist, dim, *shared.value)

    found = tiled(vectors, cells, dim).groupBy("tile").applyInArrow(run, "id string, other string, cosine double")
    best = F.slice(F.array_sort(F.collect_set(F.struct((-F.col("cosine")).alias("far"), F.col("other")))), 1, k)
    ranked = found.groupBy("id").agg(best.alias("best")).select("id", F.posexplode("best").alias("rank", "x"))
    return ranked.select("id", (F.col("rank") + 1).alias("rank"), F.col("x.other").alias("other"), (-F.col("x.far")).alias("cosine"))


def similar_pairs(neighbours: DataFrame) -> DataFrame:
    """(id_a, id_b): each unordered pair of ``most_similar`` once, the smaller id first."""
    return neighbours.select(F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b")).distinct()
