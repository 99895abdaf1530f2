"""Session settings and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from math import ceil
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# What a job of this package expects.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# A shuffle task takes this much of the input. Beyond the highest number of
# tasks the many small blocks of a shuffle cost more than tasks that spill.
TASK_BYTES = 256 * 1024 * 1024
MAX_TASKS = 50_000


def sizing(input_bytes: int) -> dict[str, str]:
    """Settings for the amount of data; adaptive execution merges tasks that get little."""
    tasks = min(MAX_TASKS, max(8, ceil(input_bytes / TASK_BYTES)))
    return {
        "spark.sql.shuffle.partitions": str(tasks),
        "spark.sql.files.maxPartitionBytes": str(TASK_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES // 2),
    }


def build_session(
    app_name: str = "voltalake", input_bytes: int | None = None, **extra: str
) -> SparkSession:
    """Get or create a session with the settings above, sized if the input is known."""
    builder = SparkSession.builder.appName(app_name)
    sized = {} if input_bytes is None else sizing(input_bytes)
    for key, value in {**SETTINGS, **sized, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    It is the one named in ``spark.checkpoint.dir`` (or set on the context).
    Only a local session without one gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    on_context = context.getCheckpointDir()
    if on_context:
        return on_context
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="voltalake-"))
    return context.getCheckpointDir()


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no one else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: later steps reread the files, column by column,
    and a lost executor costs a file scan and not the whole plan again.
    The files stay; a job that names its own ``folder`` can drop it when done.
    """
    spark = df.sparkSession
    path = f"{folder}/{name}" if folder else fresh_folder(spark, name)
    with freed_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Drop the shuffle files of each query inside as soon as it has ended.

    Otherwise they stay on the executors' disks until the driver happens to collect
    its garbage. What a query has written needs them no more.
    """
    with settings(spark, {SHUFFLE_CLEANUP: "true"}):
        yield


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Other settings of the session for the queries that start inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def work_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A fresh folder for the staged rows of one job, dropped at its end."""
    path = fresh_folder(spark, name)
    try:
        yield path
    finally:
        location = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        system.delete(location, True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, which may not see its folder."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="voltalake-")) / package.name
    context.addPyFile(shutil.make_archive(str(archive), "zip", package.parent, package.name))
    _SHIPPED.add(context.applicationId)
