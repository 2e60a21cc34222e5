"""Small questions to the file system of a path, through Spark's own Hadoop client."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    resolved = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return resolved.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), resolved


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any file or folder matches the glob."""
    system, path = _resolve(spark, pattern)
    return bool(system.globStatus(path))


def has_data(spark: SparkSession, folder: str) -> bool:
    """Whether the folder holds files or partitions, beyond markers and staging folders."""
    return matches(spark, f"{folder.rstrip('/')}/[!_.]*")


def delete(spark: SparkSession, folder: str, parents: int = 0) -> None:
    """Remove a folder, and as many of its parent folders as given while they are empty."""
    system, path = _resolve(spark, folder)
    system.delete(path, True)
    for _ in range(parents):
        path = path.getParent()
        if not system.exists(path) or len(system.listStatus(path)):
            return
        system.delete(path, False)


def move(spark: SparkSession, folder: str, to: str) -> None:
    """Put a folder in the place of another one; no file is read or copied where renames are cheap.

    Repeating it after it was done changes nothing.
    """
    system, source = _resolve(spark, folder)
    _, target = _resolve(spark, to)
    if not system.exists(source):
        return
    system.delete(target, True)
    system.mkdirs(target.getParent())
    if not system.rename(source, target):
        raise OSError(f"{folder} could not be moved to {to}")
