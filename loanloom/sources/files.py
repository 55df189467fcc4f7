"""Folders and small files of the storage all executors share, through Hadoop's file systems."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def names(spark: SparkSession, folder: str, before: float | None = None) -> list[str]:
    """Names in a folder, or of those last changed before a time; none without the folder."""
    fs, target = file_system(spark, folder)
    if not fs.exists(target):
        return []
    return [
        s.getPath().getName()
        for s in fs.listStatus(target)
        if before is None or s.getModificationTime() < before * 1000
    ]


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def partition_dates(spark: SparkSession, path: str, column: str) -> list[dt.date]:
    """The dates a store has partitions of, from the folders' names: no file is opened."""
    mark = f"{column}="
    values = (n.removeprefix(mark) for n in names(spark, path) if n.startswith(mark))
    return sorted(dt.date.fromisoformat(v) for v in values if not v.startswith("__"))
