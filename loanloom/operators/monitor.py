"""Cohort monitoring: labels, drift and ranking metrics in one job for all cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.config import DEFAULTS, Settings
from loanloom.functions.scoring import MICRO
from loanloom.operators.metrics import (
    BINS,
    baseline_shape,
    bin_sums,
    cumulate,
    exprs,
    psi_value,
    ranking_aggs,
    round_to,
    score_counts,
    with_baseline,
    with_bin,
)
from loanloom.operators.skew import keyed_join

COHORT = ("orig_month", "model_version")


def one_label_per_loan(labels: DataFrame) -> DataFrame:
    """The newest label of each loan, the worse one on ties, combined map-side.

    The order is one number, so that the aggregate stays hash-based.
    """
    recency = "coalesce(unix_date(snapshot_date), -1000000) * 2 + label"
    return (
        labels.where("loan_id IS NOT NULL")
        .groupBy("loan_id")
        .agg(F.expr(f"max_by(label, {recency}) AS label"))
    )


def attach_labels(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """Predictions with the label of their loan, NULL while it has not matured."""
    return keyed_join(predictions, one_label_per_loan(labels), ["loan_id"])


def cohort_monitor(
    predictions: DataFrame,
    labels: DataFrame,
    baseline: DataFrame,
    production_version: str | None = None,
    settings: Settings = DEFAULTS,
    digits: int | None = 4,
) -> DataFrame:
    """One monitoring row per cohort and model version.

    Predictions meet labels once, are counted per score, and every metric of the
    cohort comes from that histogram.
    """
    if "model_version" not in predictions.columns:
        predictions = predictions.withColumn("model_version", F.lit("unknown"))
    scored = predictions.where("orig_month IS NOT NULL").select(
        "loan_id", *COHORT, "score", "prediction"
    )
    hist = score_counts(attach_labels(scored, labels), COHORT, prediction="prediction")
    return cohort_metrics(hist, baseline, production_version, settings, digits)


def cohort_metrics(
    hist: DataFrame,
    baseline: DataFrame,
    production_version: str | None = None,
    settings: Settings = DEFAULTS,
    digits: int | None = 4,
) -> DataFrame:
    """Monitoring rows from the histogram of each cohort: (cohort, micro, n, positive, bad, good)."""
    shape = baseline_shape(baseline)
    rows = cumulate(with_bin(hist, shape, production_version), COHORT)
    ranking = ranking_aggs()
    counted = rows.groupBy(*COHORT).agg(
        *exprs(
            "sum(n) AS n_scored",
            "sum(bad) AS n_bad",
            "sum(bad) + sum(good) AS n_labelled",
            "sum(positive) AS n_positive",
            "sum(CAST(micro * n AS DOUBLE)) AS micros",
            "sum(CASE WHEN micro IS NOT NULL THEN n END) AS n_with_score",
            *[f"{e} AS {name}" for name, e in ranking.items()],
            *bin_sums(),
        )
    )
    binned = f"array({', '.join(f'b{i}' for i in range(BINS))}) AS binned"
    totals = with_baseline(counted, shape, "expected", production_version).selectExpr("*", binned)
    enough = f"n_labelled >= {settings.min_labelled}"
    measured = f"{enough} AND auc IS NOT NULL"
    numbers = {
        "avg_score": f"micros / n_with_score / {MICRO}",
        "pred_positive_rate": "n_positive / n_scored",
        "psi": psi_value("binned", "n_with_score", "expected"),
        **{c: f"CASE WHEN {measured} THEN {c} END" for c in ranking},
        "actual_bad_rate": f"CASE WHEN {measured} THEN n_bad / n_labelled END",
    }
    return totals.selectExpr(
        "orig_month AS month",
        "model_version",
        f"CASE WHEN {enough} THEN 'labelled' ELSE 'unlabelled' END AS cohort_type",
        "n_scored",
        "n_labelled",
        *[f"{round_to(e, digits)} AS {c}" for c, e in numbers.items()],
    )


def performance_series(monitoring: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Matured cohorts with their AUC and whether it is under the floor."""
    return monitoring.where("auc IS NOT NULL").selectExpr(
        "month", "model_version", "auc", f"auc < {settings.auc_floor!r}D AS below_floor"
    )


def pred_vs_actual(monitoring: DataFrame) -> DataFrame:
    return monitoring.select("month", "model_version", "pred_positive_rate", "actual_bad_rate")
