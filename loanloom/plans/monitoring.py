"""Monitoring of all scored cohorts, and the report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom import schemas as S
from loanloom.config import DEFAULTS, Settings
from loanloom.functions.dates import origination_month
from loanloom.operators import governance, monitor, monitor_state
from loanloom.operators.metrics import score_counts, score_histogram
from loanloom.sources.files import partition_dates
from loanloom.sources.mart import (
    Mart,
    champion,
    read_baselines,
    read_leaderboard,
    read_monitoring,
    read_registry,
)
from loanloom.sources.sinks import export_csv, export_json, write_partitions
from loanloom.sources.stores import read_store, store_exists


#: Batches of the monitoring state after which its deltas are merged.
COMPACT_PARTS = 64


def run_monitoring(spark: SparkSession, mart: Mart, settings: Settings = DEFAULTS) -> dict:
    """One row per scored cohort, written by month, plus the sorted CSV summary."""
    if not store_exists(spark, mart.gold("model_predictions")):
        return {"cohorts": 0, "status": "no_predictions"}
    meta = champion(spark, mart)
    rows = monitor.cohort_monitor(
        read_store(spark, mart.gold("model_predictions"), S.PREDICTIONS),
        read_store(spark, mart.gold("label_store"), S.LABEL_STORE),
        read_baselines(spark, mart),
        meta["version"] if meta else None,
        settings,
    )
    write_partitions(rows, mart.gold("model_monitoring"), "month")
    summary = read_monitoring(spark, mart)
    export_csv(summary, mart.gold("monitoring_summary"), "month")
    return {"cohorts": summary.count(), "status": "ok"}


def update_monitoring(
    spark: SparkSession, mart: Mart, settings: Settings = DEFAULTS, again: tuple[str, ...] = ()
) -> dict:
    """Bring the monitoring table up to date with what came since the last update.

    New cohorts and label months are added to the monitoring state, and only the cohorts they
    touch are measured anew and replaced: a month reads one month of labels, the predictions
    of the cohort it matures and their state. A loan's label is dated ``mob_label`` months after
    its cohort. ``again`` names label months that were rebuilt since, to be read once more; a
    label taken back there needs a later date to count. A cohort without a baseline of its own
    keeps the drift measured against the model then in production; ``run_monitoring`` measures all.
    """
    cohorts = partition_dates(spark, mart.gold("model_predictions"), "orig_month")
    if not cohorts:
        return {"cohorts": 0, "batches": [], "status": "no_predictions"}
    state = monitor_state.monitor_state(spark, mart.gold("monitor_state"))
    predictions = read_store(spark, mart.gold("model_predictions"), S.PREDICTIONS)
    labels = read_store(spark, mart.gold("label_store"), S.LABEL_STORE)
    known = set(state.manifest().batches)
    touched, added = set(), []
    for month in cohorts:
        batch = f"scored {month}"
        if batch not in known:
            monitor_state.add_predictions(state, batch, monitor_state.of_months(predictions, [month]))
            touched.add(month)
            added.append(batch)
    cohort = origination_month("snapshot_date", settings.mob_label)
    for month in partition_dates(spark, mart.gold("label_store"), "snapshot_date"):
        batch = f"labels {month}"
        if batch in known and month.isoformat() in again:
            batch = f"{batch} again {state.manifest().version}"
        if batch not in known:
            wave = monitor_state.of_months(labels, [month], "snapshot_date").selectExpr("*", f"{cohort} AS orig_month")
            monitor_state.add_labels(state, batch, wave, predictions)
            touched |= set(monitor_state.months_of(wave)) & set(cohorts)
            added.append(batch)
    meta = champion(spark, mart)
    if len(state.manifest().parts) > COMPACT_PARTS:
        monitor_state.compact(state)
    if touched:
        rows = monitor_state.monitoring(
            state, read_baselines(spark, mart), meta["version"] if meta else None, sorted(touched), settings
        )
        write_partitions(rows, mart.gold("model_monitoring"), "month")
        export_csv(read_monitoring(spark, mart), mart.gold("monitoring_summary"), "month")
    return {"cohorts": len(touched), "batches": added, "status": "ok"}


def report_tables(
    spark: SparkSession, mart: Mart, settings: Settings = DEFAULTS
) -> dict[str, DataFrame]:
    """The tables behind the monitoring charts."""
    monitoring = read_monitoring(spark, mart)
    tables = {
        "performance_series": monitor.performance_series(monitoring, settings),
        "psi_series": governance.psi_series(monitoring, settings),
        "pred_vs_actual": monitor.pred_vs_actual(monitoring),
        "model_eras": governance.model_eras(monitoring),
        "training_events": governance.training_events(read_registry(spark, mart)),
        "leaderboard": governance.leaderboard(
            read_leaderboard(spark, mart).selectExpr("model", "ordinal", "split", "auc"),
            settings=settings,
        ),
    }
    meta = champion(spark, mart)
    if meta is not None:
        tables["score_drift"] = score_drift(spark, mart, meta["version"])
    return tables


def score_drift(spark: SparkSession, mart: Mart, version: str) -> DataFrame:
    """Score density of the training baseline and of the newest scored cohort."""
    predictions = read_store(spark, mart.gold("model_predictions"), S.PREDICTIONS)
    newest = predictions.selectExpr("max(orig_month) AS orig_month")
    # One row, and a partition column: only the newest partition is read.
    latest = predictions.join(F.broadcast(newest), "orig_month")
    baseline = read_baselines(spark, mart).where(F.col("model_version") == version)
    both = baseline.selectExpr("'baseline' AS series", "micro", "n").unionByName(
        score_counts(latest.withColumn("series", F.lit("latest")), ["series"], label=None)
    )
    return score_histogram(both, ["series"])


def run_reports(spark: SparkSession, mart: Mart, settings: Settings = DEFAULTS) -> dict:
    """Write the report tables; nothing to do before the first monitoring run."""
    if not store_exists(spark, mart.gold("model_monitoring")):
        return {"tables": [], "status": "no_monitoring"}
    tables = report_tables(spark, mart, settings)
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(mart.report(name))
    export_json(read_leaderboard(spark, mart), mart.report("leaderboard_json"))
    export_csv(read_registry(spark, mart), mart.report("registry_csv"), "train_date")
    return {"tables": sorted(tables), "status": "ok"}
