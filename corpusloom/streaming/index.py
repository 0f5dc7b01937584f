"""An extension: keeping an index up to date from a stream of vector records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.search import upserted
from corpusloom.session import file_system


KEYS, ORDER = ("namespace", "id"), "updated_at"


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...] = KEYS, order_col: str = ORDER) -> StreamingQuery:
    """Adds every micro-batch to the index at ``path``: a batch writes only its own newest rows, as ``v=<batch>``, and a reader
    takes of each key the newest row of all batches, so a batch that is run again replaces its own rows only.

    ``compact`` merges the batches into one table from time to time."""

    def apply(batch: DataFrame, number: int) -> None:
        upserted(batch.limit(0), batch, list(keys), order_col).write.mode("overwrite").parquet(f"{path}/v={number}")

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _complete(spark: SparkSession, path: str) -> tuple[list[int], list[int]]:
    """Numbers of the complete merged tables (``m=``) and batches (``v=``) at ``path``, in order."""
    files, root = file_system(spark, path)
    if not files.exists(root):
        return [], []
    names = [s.getPath().getName() for s in files.listStatus(root) if files.exists(file_system(spark, f"{s.getPath().toString()}/_SUCCESS")[1])]
    return tuple(sorted(int(n[2:]) for n in names if n.startswith(kind)) for kind in ("m=", "v="))


def latest_index(spark: SparkSession, path: str, keys: tuple[str, ...] = KEYS, order_col: str = ORDER) -> DataFrame | None:
    """The index as it stands after all complete batches: of each key the row of the highest ``order_col``, of equal
    ones that of the later batch; None if there is nothing."""
    merged, batches = _complete(spark, path)
    base = merged[-1] if merged else -1
    parts = [(base, f"{path}/m={base}")] * bool(merged) + [(n, f"{path}/v={n}") for n in batches if n > base]
    if not parts:
        return None
    rows = reduce(DataFrame.unionByName, [spark.read.parquet(p).withColumn("_batch", F.lit(n)) for n, p in parts])
    newest = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order_col).desc_nulls_last(), F.desc("_batch")))
    return rows.withColumn("_at", newest).filter("_at = 1").drop("_at", "_batch")


def compact(spark: SparkSession, path: str, keys: tuple[str, ...] = KEYS, order_col: str = ORDER) -> None:
    """Merges all complete batches into one table and removes what it replaces; not while a reader uses them."""
    merged, batches = _complete(spark, path)
    new = [n for n in batches if not merged or n > merged[-1]]
    if not new:
        return
    latest_index(spark, path, keys, order_col).write.mode("overwrite").parquet(f"{path}/m={new[-1]}")
    for old in [f"{path}/m={n}" for n in merged] + [f"{path}/v={n}" for n in batches]:
        files, at = file_system(spark, old)
        files.delete(at, True)


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events and their mean value per hour and type, with a watermark; for streams and for tables alike."""
    stamped = events.withColumn("ts", F.col("ts").cast("timestamp"))
    stamped = stamped.withWatermark("ts", late) if events.isStreaming else stamped
    return stamped.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean_value")).select(F.col("w.start").alias("start"), "event_type", "n", "mean_value")
