"""Folders of Parquet files bucketed and sorted by a key, so that joins on it shuffle no store.

The files are ordinary ones and any reader may read the folder; only their bucketed reader must know
key and number of buckets, which therefore are fixed for the life of a folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from loanloom.functions.cleaning import quoted


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Replace the folder by the rows, one file or more per bucket of the key's hash."""
    # Dealt out by the same hash, so that a bucket is one file.
    dealt = df.repartition(buckets, key)
    name = f"loanloom_write_{uuid.uuid4().hex}"
    writer = dealt.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    # The files stay: the table is external.
    df.sparkSession.sql(f"DROP TABLE {name}")


def read_bucketed(spark: SparkSession, path: str, schema: str, key: str, buckets: int) -> DataFrame:
    """The folder as a table that Spark knows to be bucketed; its name is gone once it is resolved."""
    name = f"loanloom_read_{uuid.uuid4().hex}"
    by = quoted(key)
    spark.sql(
        f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
        f"INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")
