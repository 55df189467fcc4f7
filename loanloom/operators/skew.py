"""Joins and picks that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from loanloom.functions.cleaning import quoted


def keyed_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", *more: DataFrame) -> DataFrame:
    """Equi-join (``left`` or ``inner``) with ``right`` and then each of ``more``.

    The plain join: inputs are read once, and filters reach their scans. A key that holds
    much of the left side, NULL included, is split at run time by the measured size of its
    partition (the session forces that also where a later step then needs one more
    shuffle), so there is no threshold, list of keys or number of salts to outgrow.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"keyed_join supports left and inner joins, not {how!r}")
    joined = left.join(right, list(on), how)
    for extra in more:
        joined = joined.join(extra, list(on), how)
    return joined


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last in ``order`` (column names, NULLs first).

    Spark turns the rank filter into a group limit before the shuffle, so a task
    ships one row per key and a hot key costs one row per map task.
    """
    by = ", ".join(quoted(k) for k in keys)
    last_first = ", ".join(f"{quoted(o)} DESC NULLS LAST" for o in order)
    rank = f"row_number() OVER (PARTITION BY {by} ORDER BY {last_first}) AS _rn"
    return df.selectExpr("*", rank).where("_rn = 1").drop("_rn")
