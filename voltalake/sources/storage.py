"""Small files and folders in any store that Spark can reach, handled from the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """The path and its file system."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    location, system = _at(spark, path)
    return system.exists(location)


def make_folder(spark: SparkSession, path: str) -> None:
    location, system = _at(spark, path)
    system.mkdirs(location)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    location, system = _at(spark, folder)
    if not system.exists(location):
        return []
    return sorted(x.getPath().getName() for x in system.listStatus(location))


def folders(spark: SparkSession, folder: str) -> dict[str, int]:
    """Folders in a folder, with the time of their last change (0 where a store has
    none); without those that Spark hides."""
    location, system = _at(spark, folder)
    if not system.exists(location):
        return {}
    found = [x for x in system.listStatus(location) if x.isDirectory()]
    named = {x.getPath().getName(): x.getModificationTime() for x in found}
    return {k: v for k, v in named.items() if k[0] not in "._"}


def delete(spark: SparkSession, path: str) -> None:
    """Drop a file or folder, if it is there."""
    location, system = _at(spark, path)
    system.delete(location, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Move a file to another folder's path, making that folder; a missing file stays so."""
    location, system = _at(spark, path)
    goal = spark._jvm.org.apache.hadoop.fs.Path(target)
    if system.exists(location):
        system.mkdirs(goal.getParent())
        system.rename(location, goal)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if it is not there."""
    location, system = _at(spark, path)
    if not system.exists(location):
        return None
    stream = system.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place of what was there, in one step where renaming is one."""
    location, system = _at(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(location.getParent(), f".{location.getName()}")
    stream = system.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if system.exists(location):
        system.delete(location, False)
    system.rename(draft, location)
