"""Monitoring state: score histograms of all cohorts, kept up to date by signed deltas.

The state of a cohort is its histogram (version, score in millionths: rows, positives, bad, good)
and the label known for each of its loans. A batch of new predictions adds rows; a batch of labels, late,
corrected or repeated, takes the old label of a loan out and puts the new one in. Both read the
predictions and the state of the cohorts they touch, and no others. The metrics of a cohort come
from its summed deltas, so a month costs what it brought, whatever the length of the history.

Rows of both kinds lie in one versioned table, so a batch takes effect as a whole, and once: a batch
sent again changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.config import DEFAULTS, Settings
from loanloom.functions.dates import date_literal
from loanloom.functions.scoring import to_micro
from loanloom.operators.metrics import exprs
from loanloom.operators.monitor import COHORT, cohort_metrics
from loanloom.operators.skew import keyed_join
from loanloom.sources.versioned import VersionedTable

SCHEMA = (
    "model_version string, micro bigint, n bigint, positive bigint, bad bigint, good bigint, "
    "loan_id string, label int, recency bigint, kind string, orig_month date"
)
COUNTS = ("n", "positive", "bad", "good")
LOAN = ["loan_id", "orig_month"]


def monitor_state(spark: SparkSession, root: str) -> VersionedTable:
    """The state at ``root``; a folder that does not exist yet is an empty state."""
    return VersionedTable(spark, root, SCHEMA, ("kind", "orig_month"))


def months_of(df: DataFrame, column: str = "orig_month") -> list[dt.date]:
    """The calendar months in a column; NULL is none."""
    return sorted(r[0] for r in df.where(f"{column} IS NOT NULL").select(column).distinct().collect())


def of_months(df: DataFrame, months: Sequence[dt.date] | None, column: str = "orig_month") -> DataFrame:
    """Rows of these months, as a filter on partitions; all rows without a list."""
    if months is None:
        return df
    return df.where(f"{column} IN ({', '.join(date_literal(m.isoformat()) for m in months)})" if months else "false")


def histograms(state: VersionedTable, months: Sequence[dt.date] | None = None) -> DataFrame:
    """(orig_month, model_version, micro, n, positive, bad, good) of cohorts: summed deltas."""
    rows = of_months(state.read().where("kind = 'count'"), months)
    return _summed(rows).where("n <> 0")


def known_labels(state: VersionedTable, months: Sequence[dt.date] | None = None) -> DataFrame:
    """(loan_id, orig_month, label, recency): the newest label of each loan of the cohorts."""
    return _newest(of_months(state.read().where("kind = 'label'"), months))


def add_predictions(state: VersionedTable, batch: str, predictions: DataFrame) -> bool:
    """Count a batch of predictions, with the labels that came before them.

    Rows without a cohort month are left out. Returns whether the batch was new.
    """
    if "model_version" not in predictions.columns:
        predictions = predictions.withColumn("model_version", F.lit("unknown"))
    scored = predictions.where("orig_month IS NOT NULL").selectExpr(
        *LOAN, "model_version", f"{to_micro('score')} AS micro", "CAST(prediction AS BIGINT) AS positive"
    )
    labels = known_labels(state, months_of(scored)).drop("recency")
    counted = keyed_join(scored, labels, LOAN).selectExpr(
        *COHORT, "micro", "1L AS n", "positive", "CAST(label = 1 AS BIGINT) AS bad", "CAST(label = 0 AS BIGINT) AS good"
    )
    return state.append(_count_rows(_summed(counted)), batch)


def add_labels(state: VersionedTable, batch: str, labels: DataFrame, predictions: DataFrame) -> bool:
    """Count a batch of labels (loan_id, label, snapshot_date, orig_month) in their loans' cohorts.

    ``orig_month`` is the cohort the loan was scored in; ``predictions`` is the store of all of
    them. Of a loan's labels the newest counts, the worse one on ties; a batch may hold labels
    known already, and older ones, which change nothing. A label that comes before its prediction waits.
    Returns whether the batch was new.
    """
    arrived = _newest(
        labels.where("loan_id IS NOT NULL AND orig_month IS NOT NULL AND label IS NOT NULL").selectExpr(
            *LOAN, "CAST(label AS INT) AS label", "coalesce(unix_date(snapshot_date), -1000000) * 2L + label AS recency"
        )
    )
    touched = months_of(arrived)
    before = known_labels(state, touched).toDF(*LOAN, "old", "seen")
    news = keyed_join(arrived, before, LOAN).where("seen IS NULL OR recency > seen")
    if "model_version" not in predictions.columns:
        predictions = predictions.withColumn("model_version", F.lit("unknown"))
    scored = of_months(predictions, touched).selectExpr(*LOAN, "model_version", f"{to_micro('score')} AS micro")
    moved = keyed_join(scored, news, LOAN, "inner").selectExpr(
        *COHORT, "micro", "0L AS n", "0L AS positive",
        "CAST(label = 1 AS BIGINT) - coalesce(CAST(old = 1 AS BIGINT), 0L) AS bad",
        "CAST(label = 0 AS BIGINT) - coalesce(CAST(old = 0 AS BIGINT), 0L) AS good",
    )
    changes = _summed(moved).where("bad <> 0 OR good <> 0")
    return state.append(_count_rows(changes).unionByName(_label_rows(news)), batch)


def compact(state: VersionedTable) -> None:
    """One row per cohort and score, and one per labelled loan, in place of all deltas."""

    def merged(rows: DataFrame) -> DataFrame:
        counts = _summed(rows.where("kind = 'count'")).where("n <> 0 OR bad <> 0 OR good <> 0")
        return _count_rows(counts).unionByName(_label_rows(_newest(rows.where("kind = 'label'"))))

    state.replace(merged)


def monitoring(
    state: VersionedTable,
    baseline: DataFrame,
    production_version: str | None = None,
    months: Sequence[dt.date] | None = None,
    settings: Settings = DEFAULTS,
    digits: int | None = 4,
) -> DataFrame:
    """The monitoring rows of all cohorts, or of some, from the state alone."""
    return cohort_metrics(histograms(state, months), baseline, production_version, settings, digits)


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*COHORT, "micro").agg(*exprs(*[f"coalesce(sum({c}), 0L) AS {c}" for c in COUNTS]))


def _newest(rows: DataFrame) -> DataFrame:
    """One row per loan and cohort, the one seen last; both aggregates combine map-side."""
    return rows.groupBy(*LOAN).agg(*exprs("max_by(label, recency) AS label", "max(recency) AS recency"))


def _count_rows(counts: DataFrame) -> DataFrame:
    return counts.selectExpr(
        "model_version", "CAST(micro AS BIGINT) AS micro", *COUNTS, "CAST(NULL AS STRING) AS loan_id",
        "CAST(NULL AS INT) AS label", "CAST(NULL AS BIGINT) AS recency", "'count' AS kind", "orig_month",
    )


def _label_rows(labels: DataFrame) -> DataFrame:
    return labels.selectExpr(
        "CAST(NULL AS STRING) AS model_version", "CAST(NULL AS BIGINT) AS micro", *[f"CAST(NULL AS BIGINT) AS {c}" for c in COUNTS],
        "loan_id", "label", "recency", "'label' AS kind", "orig_month",
    )
