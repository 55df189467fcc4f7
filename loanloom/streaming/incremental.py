"""Incremental processing: a run handles only the cohorts no earlier run has written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unseen_cohorts(scored: DataFrame, done: DataFrame, cohort: str = "orig_month") -> DataFrame:
    """Rows of ``scored`` whose cohort month is not in ``done``; rows without one are left out.

    ``done`` is reduced to its distinct months, one row per calendar month at most,
    which is what is broadcast.
    """
    months = done.where(f"{cohort} IS NOT NULL").select(cohort).distinct()
    return scored.where(f"{cohort} IS NOT NULL").join(F.broadcast(months), cohort, "left_anti")
