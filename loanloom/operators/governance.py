"""Retraining decisions, model registry, candidate selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.config import DEFAULTS, Settings
from loanloom.functions.dates import date_literal, months_diff
from loanloom.functions.scoring import psi_band
from loanloom.operators.metrics import exprs
from loanloom.operators.skew import latest_per


def decision_reason(
    month: str, train_date: str, auc: str, psi: str, settings: Settings = DEFAULTS
) -> str:
    """Why to train or not in ``month``; the first rule that holds wins.

    ``train_date`` is NULL while there is no champion; ``auc`` and ``psi`` are the
    latest known values.
    """
    return (
        f"CASE WHEN {month} < {date_literal(settings.anchor)} THEN 'before_anchor' "
        f"WHEN {train_date} IS NULL THEN 'bootstrap_initial' "
        f"WHEN {months_diff(train_date, month)} >= {settings.refresh_months} THEN 'scheduled_cadence' "
        f"WHEN {auc} < {settings.auc_floor!r}D THEN 'trigger_auc_below_floor' "
        f"WHEN {psi} >= {settings.psi_retrain!r}D THEN 'trigger_psi_breach' "
        "ELSE 'within_sla' END"
    )


def decision_action(reason: str) -> str:
    """Training that follows from a reason; NULL when nothing is to be done."""
    return (
        f"CASE WHEN {reason} = 'bootstrap_initial' THEN 'bootstrap' "
        f"WHEN {reason} NOT IN ('before_anchor', 'within_sla') THEN 'refresh' END"
    )


def _decided(df: DataFrame, settings: Settings) -> DataFrame:
    reason = decision_reason("month", "train_date", "auc", "psi", settings)
    return df.selectExpr("*", f"{reason} AS reason").selectExpr(
        "*", f"{decision_action('reason')} AS action"
    )


def latest_metrics(monitoring: DataFrame) -> DataFrame:
    """One row: the newest non-NULL AUC and PSI of the monitoring table."""
    newest = [
        f"max(CASE WHEN {m} IS NOT NULL THEN struct(month, model_version, {m}) END).{m} AS {m}"
        for m in ("auc", "psi")
    ]
    return monitoring.agg(*exprs(*newest))


def decide_training_action(
    monitoring: DataFrame, month: str, train_date: str | None, settings: Settings = DEFAULTS
) -> DataFrame:
    """One row (action, reason) for one month, from the current monitoring table."""
    one = latest_metrics(monitoring).selectExpr(
        "*", f"{date_literal(month)} AS month", f"{date_literal(train_date)} AS train_date"
    )
    return _decided(one, settings).select("action", "reason")


def governance_decisions(
    months: DataFrame, monitoring: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """The decision of every month in ``months`` (month, train_date), as known then.

    A month sees the metrics of earlier cohorts only. Both inputs have a row per
    calendar month and version, so the ordered window is over calendar months.
    """
    newest = [
        f"max(CASE WHEN {m} IS NOT NULL THEN struct(model_version, {m}) END).{m} AS {m}"
        for m in ("auc", "psi")
    ]
    earlier = "(ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    known = months.join(monitoring.groupBy("month").agg(*exprs(*newest)), "month", "left").selectExpr(
        "month",
        "train_date",
        *[f"last({m}, true) OVER {earlier} AS {m}" for m in ("auc", "psi")],
    )
    return _decided(known, settings)


def registry_upsert(registry: DataFrame, rows: DataFrame) -> DataFrame:
    """Registry with ``rows`` added; the row with the highest ``seq`` wins per version."""
    both = registry.unionByName(rows, allowMissingColumns=True)
    return latest_per(both, ["model_version"], ["seq"])


def candidate_scores(split_metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per candidate its AUC per split and the value it is ranked by.

    Out-of-time AUC ranks first, then test AUC, then zero. The gate looks at
    ``measured``, where an out-of-time AUC of exactly zero counts as missing.
    """
    splits = [
        f"max(CASE WHEN split = '{s}' THEN auc END) AS auc_{s}" for s in ("train", "test", "oot")
    ]
    return (
        split_metrics.groupBy(*by, "model", "ordinal")
        .agg(*exprs(*splits))
        .selectExpr(
            "*",
            "coalesce(auc_oot, auc_test, 0D) AS ranking_auc",
            "coalesce(nullif(auc_oot, 0D), auc_test) AS measured",
        )
    )


def champion_select(
    split_metrics: DataFrame, by: Sequence[str] = (), settings: Settings = DEFAULTS
) -> DataFrame:
    """The winning candidate per ``by`` and whether it passes the gate.

    Takes (by..., model, ordinal, split, auc); the first candidate wins ties.
    """
    best = "max(struct(ranking_auc, -ordinal AS first, model, measured)) AS b"
    gate = f"coalesce(b.measured >= {settings.promotion_gate_auc!r}D, false) AS promoted"
    return (
        candidate_scores(split_metrics, by)
        .groupBy(*by)
        .agg(F.expr(best))
        .selectExpr(*by, "b.model AS model", "b.ranking_auc AS ranking_auc", gate)
    )


def leaderboard(
    split_metrics: DataFrame, by: Sequence[str] = (), settings: Settings = DEFAULTS
) -> DataFrame:
    """Every candidate with its AUC, whether it was selected and whether it passes the gate."""
    group = f"PARTITION BY {', '.join(by)} " if by else ""  # a few candidates per group
    first = f"row_number() OVER ({group}ORDER BY ranking_auc DESC, ordinal) = 1 AS selected"
    return candidate_scores(split_metrics, by).selectExpr(
        *by,
        "model",
        "ordinal",
        "ranking_auc AS auc",
        first,
        f"ranking_auc >= {settings.promotion_gate_auc!r}D AS passes_gate",
    )


def model_eras(monitoring: DataFrame) -> DataFrame:
    """First and last cohort month of each model version."""
    return (
        monitoring.where("model_version IS NOT NULL")
        .groupBy("model_version")
        .agg(*exprs("min(month) AS first_month", "max(month) AS last_month"))
    )


def training_events(registry: DataFrame) -> DataFrame:
    """Training dates with their kind, for marking on a time axis."""
    kind = "CASE WHEN action = 'bootstrap' THEN 'bootstrap' ELSE 'refresh' END AS event"
    return registry.selectExpr("train_date", "model_version", kind)


def psi_series(monitoring: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    band = psi_band("psi", settings)
    return monitoring.where("psi IS NOT NULL").selectExpr(
        "month", "model_version", "psi", f"{band} AS band"
    )
