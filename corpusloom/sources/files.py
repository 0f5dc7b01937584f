"""Readers and writers: Parquet ranges, JSON lines, sidecars, raw matrices, shards."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import file_system


def read_rows(spark: SparkSession, path: str, *columns: str, start: int = 0, end: int | None = None) -> DataFrame:
    """Rows [start, end) of each Parquet file by position, with ``row_index``; nothing if out of range."""
    df = spark.read.parquet(path)
    at = F.col("_metadata.row_index")
    kept = df.filter(at >= start) if end is None else df.filter((at >= start) & (at < end))
    return kept.select(at.alias("row_index"), *(columns or df.columns))


def read_json_lines(spark: SparkSession, path: str, field: str = "content") -> DataFrame:
    """(field): one row for each line; what is no object, has no such field or a null one is ``""``."""
    return spark.read.text(path).select(F.coalesce(F.get_json_object("value", f"$.{field}"), F.lit("")).alias(field))


def write_json_lines(df: DataFrame, path: str, field: str, name: str = "content") -> None:
    """One object with ``name`` for each row; null becomes ``""``, other characters than ASCII stay."""
    df.select(F.to_json(F.struct(F.coalesce(F.col(field).cast("string"), F.lit("")).alias(name))).alias("value")).write.text(path)


def read_sidecar(spark: SparkSession, path: str) -> DataFrame:
    """The description of a shard from a JSON file, with the fields of a description that are missing as null."""
    schema = "model string, prefix string, dim int, normalized boolean, dtype string, max_len int, n_vectors bigint, source string, text_col string"
    return spark.read.schema(schema).option("multiLine", True).json(path).withColumn("shard", shard_of(F.input_file_name()))


def write_report(df: DataFrame, path: str) -> None:
    """A small report as JSON lines in one file."""
    df.coalesce(1).write.json(path)


def write_duplicates(df: DataFrame, id_col: str, path: str) -> None:
    """Repeated rows as CSV with a header, sorted by id."""
    df.orderBy(F.col(id_col).asc_nulls_last()).write.option("header", True).csv(path)


def read_matrix(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """(row_index, embedding) of a headerless half-precision matrix file with ``dim`` columns, on any file system Spark reads.

    Tasks read ranges of whole rows, so the file never has to fit in one of them.  A size that is no multiple of a row raises ValueError."""
    files, at = file_system(spark, path)
    if files.getFileStatus(at).getLen() % (2 * dim):
        raise ValueError(f"{path} holds no whole number of rows of {dim} half-precision numbers")
    # Fixed-length records are the one format of Spark for raw bytes; it has no DataFrame reader.
    records = spark.sparkContext.binaryRecords(path, 2 * dim).zipWithIndex()
    raw = spark.createDataFrame(records, "value binary, row_index bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("value").to_pylist()), np.float16).astype(np.float32)
            offsets = pa.array(np.arange(0, len(x) + 1, dim), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("row_index"), pa.ListArray.from_arrays(offsets, pa.array(x))], ["row_index", "embedding"])

    return raw.mapInArrow(run, "row_index bigint, embedding array<float>")


def zipped(left: DataFrame, right: DataFrame, on: str = "row_index", strict: bool = True) -> DataFrame:
    """Rows of two tables side by side by their position: row i of one with row i of the other.

    Both have the position in ``on``, each once (see ``read_rows`` and ``read_matrix``).  With ``strict``, tables of different
    lengths raise ValueError; else what has no partner is left out.  Names that both have get ``_right`` on the right side."""
    if strict:
        a, b = left.count(), right.count()
        if a != b:
            raise ValueError(f"{a} rows on the left, {b} on the right")
    other = right.select(on, *[F.col(f"`{c}`").alias(f"{c}_right" if c in left.columns else c) for c in right.columns if c != on])
    return left.join(other, on)


def file_statistics(spark: SparkSession, path: str) -> DataFrame:
    """(file, n_rows, n_columns, columns) of each Parquet file under ``path``, which may be a pattern; no column's data is read."""
    df = spark.read.parquet(path)
    kinds = ", ".join(f"{c} {kind}" for c, kind in df.dtypes)
    counted = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n_rows"))
    return counted.select("file", "n_rows", F.lit(len(df.columns)).alias("n_columns"), F.lit(kinds).alias("columns"))


def shard_of(path: Column) -> Column:
    """The name ``docs_<a>_<b>`` in a path; null if there is none."""
    found = F.regexp_extract(path, r"docs_[^/_]+_[^/]+?(?=/|\.[A-Za-z]|$)", 0)
    return F.when(found != "", found)


def shard_order(shard: Column) -> Column:
    """The first number of ``docs_<n>m_``, else 0."""
    return F.coalesce(F.regexp_extract(shard, r"^docs_(\d+(?:\.\d+)?)m_", 1).try_cast("double"), F.lit(0.0))


def find_files(spark: SparkSession, root: str, pattern: str = r"\.parquet$") -> list[str]:
    """Paths of files under ``root`` that match, each once, sorted; nothing if there is no such folder."""
    files, at = file_system(spark, root)
    if not files.exists(at):
        return []
    found, listed = set(), files.listFiles(at, True)
    while listed.hasNext():
        path = listed.next().getPath().toString()
        if re.search(pattern, path):
            found.add(path)
    return sorted(found)


def shard_files(spark: SparkSession, root: str, first: str, last: str) -> dict[str, str]:
    """Chunks, vectors and description of a shard; FileNotFoundError names what is missing."""
    label = f"{first}_{last}"
    folder = f"{root.rstrip('/')}/docs_{label}"
    names = {"chunks": f"chunks_{label}.parquet", "embeddings": f"embeddings_{label}.fp16.npy", "meta": f"meta_{label}.json"}
    paths = {k: f"{folder}/{v}" for k, v in names.items()}
    missing = [k for k, p in paths.items() if not _exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"{folder}: no {', '.join(missing)}")
    return paths


def _exists(spark: SparkSession, path: str) -> bool:
    files, at = file_system(spark, path)
    return files.exists(at)


def resolve_shard(spark: SparkSession, root: str, first: str, last: str | None = None) -> str:
    """The folder of a shard: the exact name, else the first by name that begins at ``first``."""
    if last and _exists(spark, f"{root.rstrip('/')}/docs_{first}_{last}"):
        return f"{root.rstrip('/')}/docs_{first}_{last}"
    files, at = file_system(spark, root)
    begun = sorted(x.getPath().toString() for x in files.listStatus(at) if x.isDirectory() and x.getPath().getName().startswith(f"docs_{first}_"))
    if not begun:
        raise FileNotFoundError(f"{root}: no shard that begins at {first}")
    return begun[0]
