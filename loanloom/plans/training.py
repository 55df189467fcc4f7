"""Monthly training: decide, fit the candidates, select, record."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom import schemas as S
from loanloom.config import DEFAULTS, Settings
from loanloom.functions.cleaning import quoted
from loanloom.functions.dates import date_literal, window_bounds
from loanloom.operators import governance, model
from loanloom.operators.features import feature_columns, modelling_table, window_split
from loanloom.session import use_checkpoint_dir
from loanloom.sources.mart import Mart, champion, champion_table, leaderboard_table, read_monitoring, registry_table
from loanloom.sources.sinks import write_partitions
from loanloom.sources.stores import read_store, store_exists


def run_training(
    spark: SparkSession,
    mart: Mart,
    run_date: str,
    settings: Settings = DEFAULTS,
    mode: str = "latest_then_filter",
    max_iter: int | None = None,
    parallel: bool = True,
) -> dict:
    """Train for the month of ``run_date`` if governance asks for it.

    Always returns a status with ``action`` and ``reason``. ``max_iter`` shortens the
    boosting runs; ``parallel`` fits the candidates side by side, with the same result.
    """
    month = run_date[:10]
    current = champion(spark, mart)
    last_train = current["train_date"].isoformat() if current else None
    decided = governance.decide_training_action(
        read_monitoring(spark, mart), month, last_train, settings
    ).first()
    action, reason = decided["action"], decided["reason"]
    if action is None:
        return {"action": None, "reason": reason}
    if not all(store_exists(spark, mart.gold(s)) for s in ("feature_store", "label_store")):
        return {"action": None, "reason": "no_data"}

    version = "credit_model_" + month.replace("-", "_")
    frame, numeric, categorical = _training_rows(spark, mart, version, month, settings, mode)
    counts = {
        r["split"]: r
        for r in frame.groupBy("split")
        .agg(F.expr("count(*) AS n"), F.expr("min(label) < max(label) AS both"))
        .collect()
    }
    if "train" not in counts or not counts["train"]["both"]:
        return {"action": None, "reason": "insufficient_train"}

    use_checkpoint_dir(spark, mart.bank("checkpoints"))
    names = [settings.initial_model] if action == "bootstrap" else list(model.CANDIDATES)
    train = frame.where("split = 'train'")
    preparation = model.fit_preparation(train, numeric, categorical).stored(mart.bank(f"{version}/rare"))

    def fit(name: str) -> tuple[model.Fitted, dict]:
        made = model.fit_candidate(
            name, train, numeric, categorical, settings, preparation, max_iter, mart.bank(f"{version}/fit/{name}")
        )
        return made, {r["split"]: r for r in model.split_metrics(made, frame).collect()}

    baked = model.bake_off(spark, names, fit, parallel)
    fitted, metrics = ({name: pair[i] for name, pair in baked.items()} for i in (0, 1))

    board = _leaderboard_rows(spark, metrics, names, month, action)
    chosen = governance.champion_select(
        board.selectExpr("model", "ordinal", "split", "auc"), settings=settings
    ).first()
    best, promoted = chosen["model"], chosen["promoted"]
    judged = "test" if "test" in counts else "train"
    threshold = (
        model.split_threshold(fitted[best], frame.where(F.col("split") == judged), settings)
        .first()["threshold"]
    )
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    path = mart.bank(f"{version}/model")
    fitted[best].save(path)
    baseline = model.score(fitted[best], train).withColumn("model_version", F.lit(version))
    write_partitions(model.baseline_counts(baseline), mart.bank("baselines"), "model_version")
    rows = board.withColumns(
        {"selected": F.col("model") == best, "threshold": F.lit(threshold), "trained_at": F.lit(now)}
    )
    # Small tables, each swapped as a whole: a run that dies leaves the old one in place.
    leaderboard_table(spark, mart).replace(
        lambda old: old.where(f"month <> {date_literal(month)}").unionByName(rows).coalesce(1)
    )

    by_split = metrics[best]
    auc = {s: by_split[s]["auc"] if s in by_split else None for s in ("train", "test", "oot")}
    n = {s: counts[s]["n"] if s in counts else 0 for s in ("train", "test", "oot")}
    registry = (
        dt.date.fromisoformat(month), version, action, reason, best, "|".join(names), promoted,
        threshold, auc["train"], auc["test"], auc["oot"], n["train"], n["test"], n["oot"], now,
    )
    entry = spark.createDataFrame([registry], S.REGISTRY)
    registry_table(spark, mart).replace(lambda old: governance.registry_upsert(old, entry).coalesce(1))
    status = {
        "action": action, "reason": reason, "model_name": best, "version": version,
        "train_date": month, "promoted": promoted, "decision_threshold": threshold,
        "auc": auc, "n": n, "candidates": names,
    }
    if settings.enforce_gate and not promoted:
        # The run stays on record, but production keeps its model.
        return {**status, "in_production": False}
    meta = (
        best, version, dt.date.fromisoformat(month), action, reason, promoted, "oot_auc", threshold,
        settings.label_def, list(numeric), list(categorical), _windows(spark, month, settings),
        {s: tuple(r[c] for c in ("auc", "auc_pr", "gini", "ks", "bad_rate", "n"))
         for s, r in by_split.items()},
        path, now,
    )
    crowned = spark.createDataFrame([meta], S.CHAMPION)
    # The last step: until it is done, production is the model before.
    champion_table(spark, mart).replace(
        lambda old: old.where(F.col("version") != version).unionByName(crowned).coalesce(1)
    )
    return {**status, "in_production": True}


def _training_rows(
    spark: SparkSession, mart: Mart, version: str, month: str, settings: Settings, mode: str
) -> tuple[DataFrame, list[str], list[str]]:
    """Labelled rows of the three windows, written once and read back.

    Every fit and metric rereads this narrow table, so no iteration depends on the
    joins behind it and a lost executor costs a file scan.
    """
    features = read_store(spark, mart.gold("feature_store"), S.FEATURE_STORE)
    labels = read_store(spark, mart.gold("label_store"), S.LABEL_STORE)
    table = modelling_table(labels, features, settings, mode)
    numeric, categorical = feature_columns(table)
    kept = ["loan_id", "orig_month", "label", *numeric, *categorical]
    split = window_split(table.selectExpr(*map(quoted, kept)), month, settings)
    path = mart.bank(f"{version}/training_rows")
    rows = split.where("split IS NOT NULL")
    write_partitions(rows, path, "split")
    return read_store(spark, path, rows.schema), numeric, categorical


def _leaderboard_rows(
    spark: SparkSession, metrics: dict, names: list[str], month: str, action: str
) -> DataFrame:
    """Metrics of each candidate and split; a few rows."""
    rows = [
        (
            dt.date.fromisoformat(month), action, name, i, split,
            r["auc"], r["auc_pr"], r["gini"], r["ks"], r["bad_rate"], r["n"],
        )
        for i, name in enumerate(names)
        for split, r in metrics[name].items()
    ]
    return spark.createDataFrame(rows, S.LEADERBOARD.split(", selected")[0])


def _windows(spark: SparkSession, month: str, settings: Settings) -> dict[str, str]:
    bounds = window_bounds(date_literal(month), settings)
    row = spark.range(1).selectExpr(*[f"CAST({e} AS STRING) AS {k}" for k, e in bounds.items()])
    return row.first().asDict()
