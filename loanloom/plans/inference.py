"""Batch scoring of the cohorts no earlier run has scored."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession

from loanloom import schemas as S
from loanloom.config import DEFAULTS, Settings
from loanloom.functions.dates import date_literal
from loanloom.operators import asof_state, ledger, model
from loanloom.operators.features import asof_features, feature_align, known_to, prepare_features
from loanloom.sources.files import partition_dates
from loanloom.sources.mart import Mart, champion
from loanloom.sources.sinks import write_partitions
from loanloom.sources.stores import read_store, store_exists
from loanloom.streaming.incremental import unseen_cohorts


def run_inference(spark: SparkSession, mart: Mart, settings: Settings = DEFAULTS) -> dict:
    """Score every unseen cohort with the model in production.

    Known cohorts are dropped first, and of the feature store only the customers of the
    others are prepared, up to their newest application. Applications without features are scored on imputed
    values.
    """
    meta = champion(spark, mart)
    if meta is None:
        return {"scored": 0, "status": "no_champion"}
    if not (store_exists(spark, mart.gold("feature_store")) and store_exists(spark, mart.silver("loans"))):
        return {"scored": 0, "status": "no_data"}
    loans = read_store(spark, mart.silver("loans"), S.SILVER_LOANS)
    done = read_store(spark, mart.gold("model_predictions"), S.PREDICTIONS)
    apps = unseen_cohorts(ledger.applications(loans), done)
    # Prepared before the lookup, so that applications without features stay NULL.
    store = read_store(spark, mart.gold("feature_store"), S.FEATURE_STORE)
    prepared = prepare_features(known_to(apps, store))
    rows = predicted(spark, meta, asof_features(apps, prepared))
    return {"scored": write_partitions(rows, mart.gold("model_predictions"), "orig_month"), "status": "ok"}


def score_month(
    spark: SparkSession, mart: Mart, month: str, settings: Settings = DEFAULTS, late: Sequence[str] = ()
) -> dict:
    """Score the cohort of one month, moving the as-of state on to it.

    Reads that month's loans and the snapshots since the month before, not the history. ``late``
    names earlier months whose snapshots came or changed since. A month already scored is
    skipped; one that died on the way is done again. Months are taken in order: an older one than
    the state's is an error (``run_inference`` scores any).
    """
    meta = champion(spark, mart)
    if meta is None:
        return {"scored": 0, "status": "no_champion"}
    path = mart.gold("model_predictions")
    if dt.date.fromisoformat(month) in partition_dates(spark, path, "orig_month"):
        return {"scored": 0, "status": "scored_before"}
    loans = ledger.snapshot_slice(read_store(spark, mart.silver("loans"), S.SILVER_LOANS), month)
    apps = ledger.applications(loans).where("orig_month IS NOT NULL")
    store = read_store(spark, mart.gold("feature_store"), S.FEATURE_STORE)
    prepared = prepare_features(store)
    state = asof_state.asof_state(spark, mart.gold("asof_state"), prepared.schema, settings.asof_buckets)
    at = asof_state.known_until(state)
    since = f"snapshot_date > {date_literal(at.isoformat())} AND " if at else ""
    wanted = f"{since}snapshot_date <= {date_literal(month)}"
    if late:
        wanted = f"({wanted}) OR snapshot_date IN ({', '.join(map(date_literal, late))})"
    asof_state.advance(state, month, prepared.where(wanted), " ".join(["late", *late]) if late else "")
    # Read by one month's apps only, and written once.
    rows = predicted(spark, meta, asof_state.lookup(state, apps))
    return {"scored": write_partitions(rows, path, "orig_month", laid_out=True), "status": "ok"}


def predicted(spark: SparkSession, meta: Row, known: DataFrame) -> DataFrame:
    """Prediction rows of applications with their features, by the model in production."""
    aligned = feature_align(known, meta["numeric_columns"], meta["categorical"])
    scored = model.score(model.load_fitted(spark, meta["model_path"], meta["categorical"]), aligned)
    return model.predictions(scored, meta["model_name"], meta["version"], meta["decision_threshold"])
