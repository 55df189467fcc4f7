"""Sinks: partitioned Parquet stores and small exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_partitions(df: DataFrame, path: str, by: str, laid_out: bool = False) -> int:
    """Replace the partitions present in ``df`` and keep all others; returns the rows written.

    The rebalance hint lets AQE split a partition value that holds much of the data
    over many files and merge small ones. Rows that are ``laid_out`` by the column
    already, or all have one value of it, are written as they come, without a shuffle.
    Rows are counted on their way into the files, behind the last shuffle, where a task that is
    tried again counts once.
    """
    rows, seen = observed(df if laid_out else df.hint("rebalance", F.col(by)))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )
    return counted(seen)


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with an observation of its rows, known once a job has run over it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def counted(seen: Observation) -> int:
    """Rows of an observed DataFrame; a plan found empty beforehand observes nothing."""
    return seen.get.get("n") or 0


def stored(df: DataFrame, path: str) -> DataFrame:
    """The rows written to ``path`` and read back: later jobs reread them, not what made them."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_csv(df: DataFrame, path: str, *order: str) -> None:
    """Small sorted result as one CSV file."""
    df.orderBy(*order).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    """Small result as JSON documents, one per row."""
    df.coalesce(1).write.mode("overwrite").json(path)
