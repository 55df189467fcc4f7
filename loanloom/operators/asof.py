"""As-of join: for each left row the last right row at or before its time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.functions.cleaning import quoted
from loanloom.operators.skew import keyed_join


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str,
    left_on: str,
    right_on: str,
) -> DataFrame:
    """Backward as-of join, exact matches allowed, unmatched left rows kept.

    ``right`` must hold one row per (``by``, ``right_on``). The carry window runs over the rows
    of ``right`` and the *distinct* (key, date) pairs of ``left``, so one key costs at most two
    rows per calendar date however many rows it has. ``right`` is read and shuffled once; the
    left rows fetch what was carried to their date with one equi-join.
    """
    key = quoted(by)
    payload = [c for c in right.columns if c != by]
    row = f"struct({', '.join(map(quoted, payload))})"
    known = right.where(f"{key} IS NOT NULL AND {quoted(right_on)} IS NOT NULL").selectExpr(
        key, f"{quoted(right_on)} AS _t", f"{row} AS _row"
    )
    asked = (
        left.where(f"{key} IS NOT NULL AND {quoted(left_on)} IS NOT NULL")
        .selectExpr(key, f"{quoted(left_on)} AS _t")
        .distinct()
        .selectExpr(key, "_t", "NULL AS _row")
    )
    # On a shared date the snapshot comes first.
    carried = (
        f"last(_row, true) OVER (PARTITION BY {key} ORDER BY _t, _row IS NULL "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _last"
    )
    matched = (
        known.unionByName(asked)
        .selectExpr(key, "_t", "_row", carried)
        .where("_row IS NULL AND _last IS NOT NULL")
        .selectExpr(key, f"_t AS {quoted(left_on)}", "_last")
    )
    found = keyed_join(left, matched, [by, left_on], "left")
    return found.selectExpr(*map(quoted, left.columns), *[f"_last.{quoted(c)} AS {quoted(c)}" for c in payload])
