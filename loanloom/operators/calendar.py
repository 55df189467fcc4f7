"""Month calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanloom.config import DEFAULTS, Settings
from loanloom.functions.dates import date_literal, month_start


def month_calendar(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per month start from ``first`` to ``last``, both included, per row of ``bounds``."""
    months = f"sequence({month_start(first)}, try_cast({last} AS DATE), INTERVAL 1 MONTH)"
    return bounds.selectExpr(f"explode({months}) AS month")


def run_months(
    spark: SparkSession, run_date: str | None, settings: Settings = DEFAULTS
) -> DataFrame:
    """Months a run covers: the month of ``run_date`` if configured, else the whole span."""
    span = spark.range(1).selectExpr(
        f"'{settings.snapshot_start}' AS first", f"'{settings.snapshot_end}' AS last"
    )
    months = month_calendar(span, "first", "last")
    if run_date is None:
        return months
    return months.where(f"month = {month_start(date_literal(run_date))}")
