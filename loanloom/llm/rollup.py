"""Token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are sums of signed deltas: an insert adds a
document and its tokens, a delete takes both away, a revised count takes the old one away and
adds the new one. The versions here are estimates that need no vocabulary: words between
blanks, and a quarter of the characters; ``counters`` takes others. A batch of changes is combined to one row per key, written as one partition
of the rollup, and counts once its commit marker stands. A batch that is sent again after its
commit changes nothing; one that failed before it is written anew. So totals never depend on
how often a batch was tried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "version")
#: Counting expressions over ``text``, by tokenizer version.
COUNTERS = {
    "words-1": "CAST(regexp_count(text, '[^ \\\\t\\\\n\\\\r]+') AS BIGINT)",
    "quarters-1": "CAST(ceil(length(text) / 4) AS BIGINT)",
}


def numbers(text: str = "text", counters: dict[str, str] = COUNTERS) -> str:
    """SQL expression: one count per version over a whole text, null as an empty one.

    An array of whole numbers, so that rows can be joined or kept without their texts.
    """
    each = ", ".join(counters.values())
    return f"transform(array(coalesce({text}, '')), text -> array({each}))[0]"


def by_version(counted: DataFrame, numbers: str = "numbers", counters: dict[str, str] = COUNTERS) -> DataFrame:
    """(source, lang, version, tokens) per row and version, from rows that hold ``numbers``."""
    names = ", ".join(f"'{v}'" for v in counters)
    each = counted.selectExpr("source", "lang", f"inline(arrays_zip(array({names}), {numbers}))")
    return each.toDF(*KEYS, "tokens")


def counts(documents: DataFrame, counters: dict[str, str] = COUNTERS) -> DataFrame:
    """(source, lang, version, tokens) per row and version, over whole texts; null text is empty."""
    return by_version(documents.selectExpr("source", "lang", f"{numbers(counters=counters)} AS numbers"), counters=counters)


def signed(rows: DataFrame, sign: int) -> DataFrame:
    """Deltas of inserted (1) or deleted (-1) counts."""
    return rows.selectExpr(*KEYS, f"CAST({sign} AS BIGINT) AS docs", f"{sign} * tokens AS tokens")


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    """Deltas of counts that replace others."""
    return signed(old, -1).union(signed(new, 1))


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def commit(deltas: DataFrame, base: str, batch: str) -> bool:
    """Add a batch to the rollup at ``base``; False if it was committed before.

    ``deltas`` has the keys and signed ``docs`` and ``tokens``; null keys are keys of their
    own. Rows are combined before the shuffle, so a key's share of them does not matter.
    """
    spark = deltas.sparkSession
    if _exists(spark, f"{base}/commits/{batch}/_SUCCESS"):
        return False
    combined = deltas.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    combined.write.mode("overwrite").parquet(f"{base}/deltas/batch={batch}")
    spark.createDataFrame([(batch,)], "batch string").coalesce(1).write.mode("overwrite").parquet(f"{base}/commits/{batch}")
    return True


def totals(spark: SparkSession, base: str) -> DataFrame:
    """(source, lang, version, docs, tokens) over all committed batches.

    Keys whose documents are all gone are left out. Batches without a commit do not count.
    """
    if not _exists(spark, f"{base}/commits"):
        return spark.createDataFrame([], "source string, lang string, version string, docs long, tokens long")
    commits = spark.read.parquet(f"{base}/commits/*").select("batch").distinct()
    # A declared type, so that a batch named 007 stays 007.
    kinds = "source string, lang string, version string, docs long, tokens long, batch string"
    deltas = spark.read.schema(kinds).parquet(f"{base}/deltas")
    counted = deltas.join(commits, "batch", "left_semi")
    return (
        counted.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        .where("docs <> 0 OR tokens <> 0")
    )
