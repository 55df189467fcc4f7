"""Incremental as-of lookups: the last known snapshot of each customer, moved on period by period.

The state holds one row per customer, bucketed by it. Moving on reads the state and the snapshots
that arrived since, not the history; a lookup joins applications to the state, which is not
shuffled, and to the snapshots of its own period. Snapshots may arrive late and out of order: a
state keeps the newest by date whenever it came, so moving on by the same snapshots again, or by older ones,
changes nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.cleaning import quoted
from loanloom.functions.dates import date_literal
from loanloom.operators.asof import asof_join
from loanloom.operators.skew import keyed_join
from loanloom.sources.versioned import VersionedTable

KEY, DATE = "Customer_ID", "feat_snapshot"
BUCKETS = 200


def asof_state(spark: SparkSession, root: str, snapshots: T.StructType, buckets: int = BUCKETS) -> VersionedTable:
    """The state at ``root`` for snapshots of this schema (Customer_ID, snapshot_date, features).

    ``buckets`` is fixed for the life of a state: its files are as large as the customers divided
    by it.
    """
    columns = ", ".join(
        f"{quoted(DATE if f.name == 'snapshot_date' else f.name)} {f.dataType.simpleString()}" for f in snapshots.fields
    )
    return VersionedTable(spark, root, columns, bucket_by=KEY, buckets=buckets)


def known_until(state: VersionedTable) -> dt.date | None:
    """The date the state was last moved on to."""
    batches = state.manifest().batches
    return max((dt.date.fromisoformat(b.split()[0]) for b in batches), default=None)


def advance(state: VersionedTable, until: str, arrivals: DataFrame, wave: str = "") -> bool:
    """Take in the snapshots that arrived, up to those dated ``until``; later ones wait for their own period.

    One step per date; ``wave`` names further ones, for snapshots that come after it. Returns
    whether the step was new; a step that died before its end is done again.
    """
    if (at := known_until(state)) is not None and until < at.isoformat():
        raise ValueError(f"the state is at {at} already; pass late snapshots with the current date and a wave")
    columns = _columns(state)
    newest = (
        _named(arrivals)
        .where(f"{quoted(KEY)} IS NOT NULL AND {DATE} <= {date_literal(until)}")
        .groupBy(KEY)
        .agg(F.expr(f"max({_ordered(columns)}) AS new"))
    )

    def moved(old: DataFrame) -> DataFrame:
        kept = old.selectExpr(quoted(KEY), f"{_ordered(columns)} AS old")
        both = kept.join(newest, KEY, "full_outer").selectExpr(quoted(KEY), "greatest(old, new) AS s")
        return both.selectExpr(*[quoted(c) if c == KEY else f"s.{quoted(c)} AS {quoted(c)}" for c in columns])

    return state.replace(moved, " ".join([until[:10], wave]).strip())


def lookup(state: VersionedTable, apps: DataFrame, arrivals: DataFrame | None = None) -> DataFrame:
    """Applications with the newest snapshot at or before their ``orig_month``; NULL without one.

    Sees the state and ``arrivals``, the snapshots that came since. An application from before the
    state is an error: the snapshot it needs may be gone. Without ``arrivals`` the state must be that of the
    applications' month.
    """
    at, columns = known_until(state), _columns(state)
    if at is not None:
        first = apps.selectExpr("min(orig_month) AS first").first()["first"]
        if first is not None and first < at:
            raise ValueError(f"applications of {first} need an older state than that of {at}")
    rows = state.read().selectExpr(quoted(KEY), f"{_ordered(columns)} AS _state")
    found = keyed_join(apps, rows, [KEY], "left")
    best = "_state"
    if arrivals is not None:
        one = (
            _named(arrivals)
            .where(f"{quoted(KEY)} IS NOT NULL AND {DATE} IS NOT NULL")
            .groupBy(KEY, DATE)
            .agg(F.expr(f"max({_ordered(columns)}) AS _new"))
        )
        found = asof_join(found, one, KEY, "orig_month", DATE).drop(DATE)
        best = "greatest(_state, _new)"
    picked = found.selectExpr(*map(quoted, apps.columns), f"{best} AS _s")
    return picked.selectExpr(*map(quoted, apps.columns), *[f"_s.{quoted(c)} AS {quoted(c)}" for c in columns if c != KEY])


def _columns(state: VersionedTable) -> list[str]:
    return T.StructType.fromDDL(state.schema).names


def _named(arrivals: DataFrame) -> DataFrame:
    return arrivals.withColumnRenamed("snapshot_date", DATE) if "snapshot_date" in arrivals.columns else arrivals


def _ordered(columns: list[str]) -> str:
    """A struct that sorts by date, then by the other columns in name order, which settle ties."""
    rest = sorted(c for c in columns if c not in (KEY, DATE))
    return f"struct({', '.join([DATE, *map(quoted, rest)])})"
