"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import gc
import re
import tempfile
import threading
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "corpusloom", cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for one machine; on a cluster, use the session it gives you."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only on one machine a temporary one stands in where none is named; on a cluster that raises ValueError, since executors
    share no local folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return spark.sparkContext.getCheckpointDir()


def file_system(spark: SparkSession, path: str) -> tuple:
    """Hadoop's file system of ``path``, and the path for it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


#: Whether Spark removes the shuffle files of a query as soon as it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, let_go: bool = False) -> DataFrame:
    """``df`` written once to the shared folder and read back: its lineage is cut there,
    later stages reread it instead of computing it again, and a lost executor loses nothing.

    The table is removed when the application ends, or before by ``discarded``.  With ``let_go`` the shuffle files of the query that writes it
    are removed at once, without waiting for the driver's collector (see ``released``)."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/corpusloom/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    try:
        if let_go:
            spark.conf.set(CLEANUP, "true")
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if let_go:
            spark.conf.set(CLEANUP, before)
    files, at = file_system(spark, path)
    files.deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


class _Reached:
    """An entry of the queue in which Python lets go objects of the JVM, which tells when all before it are gone."""

    def __init__(self) -> None:
        self.event = threading.Event()

    def garbage_collect_object(self, target_id: str, enqueue: bool = False) -> None:
        self.event.set()


def released(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of finished work, which it does when the driver's JVM finds that nothing refers to them any more.

    Python's objects for those of the JVM refer to themselves, so what is done with is only let go by Python's own collector, which comes first, and
    only in a thread that may sleep for a second, which is waited for."""
    gc.collect()
    queue = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", None)
    if queue is not None:
        reached = _Reached()
        queue.appendleft((reached, ""))
        reached.event.wait(10)
    spark.sparkContext._jvm.System.gc()


def discarded(df: DataFrame) -> None:
    """Removes a table of ``written`` that nothing will read any more."""
    files, at = file_system(df.sparkSession, df._written_to)
    files.delete(at, True)


def ship_package(spark: SparkSession) -> None:
    """Lets Python workers import this package wherever they start; once for each application."""
    sc = spark.sparkContext
    if any("corpusloom" in str(p) for p in getattr(sc, "_python_includes", [])):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="spark-")) / "corpusloom.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(archive))
