"""What the operators of this folder share: the shared folder and cut lineage."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder driver and executors share, as ``spark.checkpoint.dir`` names it.

    Only a local session that names none, as in tests, gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="loanloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """The same rows, read back from the shared folder: lost executors cost no rerun.

    What was shuffled on the way is not needed after that; its files go at once.
    """
    spark = df.sparkSession
    shared_dir(spark)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        # A plan of its own, so that no other DataFrame's shuffles are removed.
        return df.select("*").checkpoint()
    finally:
        spark.conf.set(CLEANUP, before)


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session; a job sizes them to its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def worker_memory() -> dict:
    """What a Python worker keeps from task to task."""
    return sys.__dict__.setdefault("_loanloom_kept", {})


#: Bytes of values after which a batch of result rows goes out.
BATCH_BYTES = 4_000_000


def map_rows(
    batches: Iterator[pa.RecordBatch], work: Callable[..., tuple[tuple, int]], columns: dict[str, pa.DataType]
) -> Iterator[pa.RecordBatch]:
    """The first column of each batch beside what ``work`` makes of the others, row by row.

    ``work`` takes a row's other values and returns the values of ``columns`` and their bytes;
    a batch goes out as soon as it holds BATCH_BYTES, so long values are not gathered.
    """
    for batch in batches:
        first, kept, size = 0, [], 0
        for i in range(batch.num_rows):
            values, weight = work(*(batch.column(j)[i].as_py() for j in range(1, batch.num_columns)))
            kept.append(values)
            size += weight
            if size >= BATCH_BYTES or i + 1 == batch.num_rows:
                arrays = [pa.array(v, t) for v, t in zip(zip(*kept), columns.values())]
                keys = batch.column(0).slice(first, len(kept))
                yield pa.RecordBatch.from_arrays([keys, *arrays], [batch.schema.names[0], *columns])
                first, kept, size = i + 1, [], 0
