"""Scans: raw CSV, partitioned stores, reference tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from loanloom.config import DEFAULTS, Settings
from loanloom.functions.cleaning import quoted
from loanloom.functions.dates import date_literal, month_start, partition_date
from loanloom.schemas import RAW

CORRUPT = "_corrupt"


def read_raw(
    spark: SparkSession, path: str, source: str, schema: T.StructType | None = None
) -> DataFrame:
    """Raw CSV as text, its columns found by the names in the header line.

    The declared columns come first, whatever their order in the file, then columns that
    were not declared. A declared column the header lacks is an error, as are files of one
    source whose headers differ. Lines that do not fit the layout keep their text in
    ``_corrupt``.
    """
    declared = (schema or RAW[source]).names
    names = spark.read.option("header", True).csv(path).columns
    if lacking := [c for c in declared if c not in names]:
        raise ValueError(f"{path}: the header lacks {', '.join(lacking)}")
    layout = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
    rows = (
        spark.read.schema(layout)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    extra = [c for c in names if c not in declared]
    return rows.selectExpr(*map(quoted, [*declared, *extra, CORRUPT]))


def raw_months(
    raw: DataFrame, month: str | None = None, settings: Settings = DEFAULTS
) -> DataFrame:
    """Raw rows of one month, or of every configured month, with a typed snapshot date."""
    typed = raw.selectExpr(
        *[
            "try_cast(snapshot_date AS DATE) AS snapshot_date" if c == "snapshot_date" else quoted(c)
            for c in raw.columns
        ]
    )
    if month is not None:
        return typed.where(f"snapshot_date = {date_literal(month)}")
    first, last = date_literal(settings.snapshot_start), date_literal(settings.snapshot_end)
    return typed.where(
        f"snapshot_date BETWEEN {first} AND {last} AND snapshot_date = {month_start('snapshot_date')}"
    )


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def store_exists(spark: SparkSession, path: str) -> bool:
    """Whether a store has been written."""
    try:
        spark.read.format("parquet").load(path)
    except AnalysisException as error:
        if _missing(error):
            return False
        raise
    return True


def read_store(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None
) -> DataFrame:
    """Whole store, all partitions, columns matched by name.

    With a declared schema, columns a generation lacks read as NULL and a store that
    does not exist yet reads as no rows. Without one, the schemas of the partitions
    are merged.
    """
    try:
        if schema is None:
            return spark.read.option("mergeSchema", True).parquet(path)
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if schema is None or not _missing(error):
            raise
        return spark.createDataFrame([], schema)


def union_stores(frames: list[DataFrame]) -> DataFrame:
    """Rows of several generations of a store; columns one lacks are NULL."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def read_dated_files(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Parquet files that carry their date as YYYY_MM_DD in the name, with that date.

    Files without a date get NULL.
    """
    files = spark.read.option("mergeSchema", True).parquet(path)
    return files.selectExpr("*", f"{partition_date('_metadata.file_path')} AS {quoted(column)}")


def read_csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Exported CSV table under a declared schema; no rows when it does not exist."""
    try:
        return spark.read.schema(schema).option("header", True).csv(path)
    except AnalysisException as error:
        if not _missing(error):
            raise
        return spark.createDataFrame([], schema)


def read_json_table(
    spark: SparkSession, path: str, schema: str, multi_line: bool = False
) -> DataFrame:
    """JSON documents under a declared schema; no rows when there are none.

    One document per line, or per file with ``multi_line``.
    """
    try:
        return spark.read.schema(schema).option("multiLine", multi_line).json(path)
    except AnalysisException as error:
        if not _missing(error):
            raise
        return spark.createDataFrame([], schema)
