"""Session settings, and the one way this package cuts lineage: tables in the shared folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from multiprocessing.pool import ThreadPool
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Shuffles land on one layout per key set, times are read as UTC everywhere.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A side already spread by some of the join keys is not shuffled again for all of them.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application."""
    context = spark.sparkContext
    if any(f.rsplit("/", 1)[-1].startswith("riskweave-") for f in context.listFiles):
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="riskweave-")) / f"riskweave-{context.applicationId}"
    context.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("riskweave")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """Folder for kept and staged tables: the cluster's, or a scratch one in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on this cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="riskweave-"))
    return context.getCheckpointDir()


_OWNED: set[str] = set()


def _own(spark: SparkSession, folder: str) -> None:
    """Have the application's folder removed when the application ends."""
    if folder not in _OWNED:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
        _OWNED.add(folder)


def materialise(df: DataFrame) -> DataFrame:
    """Compute once into a table in the shared folder and go on from there.

    Lineage ends at the table, so a lost executor costs nothing that is already written; and,
    unlike an RDD checkpoint, later readers still prune columns and see the table's size. Tables
    live until ``release`` frees them, at the latest as long as the application.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/riskweave-tables/{spark.sparkContext.applicationId}"
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _own(spark, folder)
    _KEPT.append(path)
    return spark.read.schema(df.schema).parquet(path)


_KEPT: list[str] = []


def kept_tables() -> int:
    """A mark for ``release``: how many kept tables there are."""
    return len(_KEPT)


def release(spark: SparkSession, *needed: DataFrame, since: int = 0) -> None:
    """Free kept tables made since a mark, but for those that ``needed`` read."""
    files = [f for df in needed for f in df.inputFiles()]
    held = {path for path in _KEPT[since:] if any(path.rsplit("/", 1)[1] in f for f in files)}
    for path in _KEPT[since:]:
        if path not in held:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    _KEPT[since:] = [path for path in _KEPT[since:] if path in held]


#: Payments of a task that joins and sorts them, about: some hundred MB.
TASK_ROWS = 50_000


def tasks_for(rows: int) -> int:
    """Tasks for wide rows: as many as the rows fill, so that what one holds does not grow with them."""
    return max(1, -(-rows // TASK_ROWS))


#: Independent jobs that a driver runs next to each other.
JOBS = 8


def side_by_side(spark: SparkSession, function, items: list) -> list:
    """Run independent Spark jobs from several driver threads, as Spark's own tuning does."""
    if not items:
        return []
    with ThreadPool(min(JOBS, len(items))) as pool:
        return pool.map(inheritable_thread_target(spark)(function), items)
