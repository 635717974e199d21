"""Folders of the shared store: what is in them, whether they are complete, and their removal."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import SparkSession


class Entry(NamedTuple):
    name: str
    changed: float  # seconds since 1970


def _path(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def complete(spark: SparkSession, folder: str) -> bool:
    """Whether a write to ``folder`` came to its end: the success file is written last."""
    path, system = _path(spark, f"{folder}/_SUCCESS")
    return system.exists(path)


def entries(spark: SparkSession, folder: str) -> list[Entry]:
    """Names in ``folder``, none if there is no such folder."""
    path, system = _path(spark, folder)
    if not system.exists(path):
        return []
    return sorted(Entry(s.getPath().getName(), s.getModificationTime() / 1000) for s in system.listStatus(path))


def remove(spark: SparkSession, folder: str) -> None:
    path, system = _path(spark, folder)
    system.delete(path, True)
