"""Catch-up as a stream: all files not read so far, in one resumable run that then ends.

The source remembers files in its checkpoint, the sink which files belong to finished batches. A run that
dies anywhere, also between the write of a batch and its commit, is continued by the next one, and a reader
of the sink's folder sees each finished batch once. Applications are stateless rows: the as-of lookup
is a join with a table that states from when until when each snapshot is the last known one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom import schemas as S
from loanloom.config import DEFAULTS, Settings
from loanloom.functions.cleaning import quoted
from loanloom.operators import ledger
from loanloom.operators.features import dedupe_snapshots, prepare_features
from loanloom.operators.skew import latest_per
from loanloom.plans.inference import predicted
from loanloom.sources.mart import Mart, champion
from loanloom.sources.sinks import write_partitions
from loanloom.sources.stores import read_store, store_exists

#: Files of a micro-batch.
FILES = 1000


def intervals(features: DataFrame) -> DataFrame:
    """Snapshots with ``_until``, the date of the customer's next one; NULL for the last.

    One row per customer and date, so a window holds at most the calendar dates.
    """
    following = "lead(feat_snapshot) OVER (PARTITION BY Customer_ID ORDER BY feat_snapshot) AS _until"
    return dedupe_snapshots(features.where("Customer_ID IS NOT NULL AND snapshot_date IS NOT NULL")).selectExpr("*", following)


def asof_stream(apps: DataFrame, features: DataFrame) -> DataFrame:
    """Streamed applications with the snapshot last known in their ``orig_month``; NULL without one.

    ``features`` is a table as it stands when a batch runs.
    """
    known = intervals(features)
    payload = [c for c in known.columns if c not in ("Customer_ID", "_until")]
    side = known.selectExpr(
        "Customer_ID AS _who", "feat_snapshot AS _from", "_until", *[f"{quoted(c)} AS {quoted('_r_' + c)}" for c in payload]
    )
    at = (F.col("Customer_ID") == F.col("_who")) & F.expr("orig_month >= _from AND (_until IS NULL OR orig_month < _until)")
    return apps.join(side, at, "left").selectExpr(
        *map(quoted, apps.columns), *[f"{quoted('_r_' + c)} AS {quoted(c)}" for c in payload]
    )


def run_stream(rows: DataFrame, folder: str, by: str | None = None) -> DataFrame:
    """Run a stream over all files it has not seen, and return what its sink holds now.

    ``folder`` keeps the rows and the checkpoint, on storage all executors share.
    """
    writer = rows.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
    if by:
        writer = writer.partitionBy(by)
    query = writer.option("path", f"{folder}/rows").trigger(availableNow=True).start()
    query.awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{folder}/rows")


def catch_up(spark: SparkSession, mart: Mart, settings: Settings = DEFAULTS, files: int = FILES) -> dict:
    """Score the applications in all loan files that came since the last run.

    Batches of scored rows go to a store of their own. Cohorts with rows that the predictions
    lack are then replaced as a whole, each loan with its last score; a run that dies before that
    is made up for by the next. A month that is built again is scored again.
    """
    meta = champion(spark, mart)
    if meta is None:
        return {"scored": 0, "status": "no_champion"}
    if not (store_exists(spark, mart.gold("feature_store")) and store_exists(spark, mart.silver("loans"))):
        return {"scored": 0, "status": "no_data"}
    loans = spark.readStream.schema(S.SILVER_LOANS).option("maxFilesPerTrigger", files).parquet(mart.silver("loans"))
    apps = ledger.applications(loans).where("orig_month IS NOT NULL")
    features = prepare_features(read_store(spark, mart.gold("feature_store"), S.FEATURE_STORE))
    streamed = run_stream(predicted(spark, meta, asof_stream(apps, features)), mart.gold("caught_up"), "orig_month")
    return {"scored": publish(spark, streamed, mart), "status": "ok"}


def publish(spark: SparkSession, streamed: DataFrame, mart: Mart) -> int:
    """Replace the cohorts for which the stream has loans or scores that the predictions lack."""
    path = mart.gold("model_predictions")
    last = latest_per(streamed, ["loan_id", "orig_month"], ["scored_at"])
    done = read_store(spark, path, S.PREDICTIONS).select("loan_id", "orig_month", "scored_at")
    news = last.join(done, ["loan_id", "orig_month", "scored_at"], "left_anti").select("orig_month")
    # One row per calendar month at most.
    counted = news.groupBy("orig_month").agg(F.expr("count(*) AS n")).collect()
    if counted:
        months = ", ".join(f"DATE '{r['orig_month']}'" for r in counted)
        write_partitions(last.where(f"orig_month IN ({months})"), path, "orig_month")
    return sum(r["n"] for r in counted)
