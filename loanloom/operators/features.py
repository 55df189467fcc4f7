"""Feature store: preparation, joins, snapshot choice, modelling table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.config import (
    CATEGORICAL,
    CLICK_FEATURES,
    CLIP_BOUNDS,
    DEFAULTS,
    DIRTY_NUMERIC,
    NON_FEATURES,
    Settings,
)
from loanloom.functions.cleaning import (
    clean_category,
    clean_numeric,
    clip,
    count_list_items,
    credit_history_months,
    quoted,
    ratio,
)
from loanloom.functions.dates import date_literal, origination_month, split_name, window_bounds
from loanloom.operators.asof import asof_join
from loanloom.operators.skew import keyed_join, latest_per


def clickstream_agg(clicks: DataFrame) -> DataFrame:
    """Mean of each click feature per customer and snapshot; NULLs are skipped."""
    return clicks.groupBy("Customer_ID", "snapshot_date").agg(
        *[F.expr(f"avg({c}) AS {c}_mean") for c in CLICK_FEATURES if c in clicks.columns]
    )


def feature_store(attributes: DataFrame, financials: DataFrame, clicks: DataFrame) -> DataFrame:
    """Attributes with financials and averaged clicks of the same snapshot.

    The month is part of the key, so one job builds all months. Clicks are
    aggregated before they are joined. Stores of one month, given as a constant, that are
    bucketed by customer are joined and aggregated where they lie.
    """
    key = ["Customer_ID", "snapshot_date"]
    return keyed_join(attributes, financials, key, "left", clickstream_agg(clicks))


# Derived ratios, bounded to [0, 5].
RATIOS = {
    "emi_to_salary": ("Total_EMI_per_month", "Monthly_Inhand_Salary"),
    "debt_to_income": ("Outstanding_Debt", "Annual_Income"),
}


def prepare_features(df: DataFrame, null_label: str = "Unknown") -> DataFrame:
    """Clean every known column that is present and add the derived features.

    Three stacked projections: clean, then clip and divide, then clip the ratios.
    A value used twice is a column of the projection below, so generated code
    computes it once and stays small.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cleaned = {c: clean_numeric(c, types[c]) for c in DIRTY_NUMERIC if c in types}
    cleaned |= {
        c: clean_category(f"CAST({c} AS STRING)", null_label) for c in CATEGORICAL if c in types
    }
    names = [c for c in df.columns if c != "Credit_History_Age"]
    out = [f"{cleaned[c]} AS {quoted(c)}" if c in cleaned else quoted(c) for c in names]
    if "Credit_History_Age" in types:
        out.append(f"{credit_history_months('Credit_History_Age')} AS credit_history_months")
        names.append("credit_history_months")
    if "Type_of_Loan" in types:
        out.append(f"{count_list_items('Type_of_Loan')} AS num_loan_types")
        names.append("num_loan_types")
    clipped = [
        f"{clip(c, *CLIP_BOUNDS[c])} AS {c}" if c in CLIP_BOUNDS else quoted(c) for c in names
    ]
    ratios = {r: pair for r, pair in RATIOS.items() if set(pair) <= set(types)}
    divided = [f"{ratio(*pair)} AS {r}" for r, pair in ratios.items()]
    prepared = df.selectExpr(*out).selectExpr(*clipped, *divided)
    if not ratios:
        return prepared
    return prepared.selectExpr(
        *[quoted(c) for c in names], *[f"{clip(r, 0, 5)} AS {r}" for r in ratios]
    )


def feature_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric and categorical model inputs, from the schema alone."""
    categorical = [c for c in CATEGORICAL if c in df.columns]
    skipped = {*NON_FEATURES, *categorical}
    numeric = [
        f.name
        for f in df.schema.fields
        if f.name not in skipped and isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]
    return numeric, categorical


def feature_align(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()
) -> DataFrame:
    """Add the expected feature columns that are absent, as NULL."""
    wanted = {**{c: "DOUBLE" for c in numeric}, **{c: "STRING" for c in categorical}}
    missing = [
        f"CAST(NULL AS {t}) AS {quoted(c)}" for c, t in wanted.items() if c not in df.columns
    ]
    return df.selectExpr("*", *missing)


def _snapshots(features: DataFrame) -> DataFrame:
    return features.withColumnRenamed("snapshot_date", "feat_snapshot")


def _rest(df: DataFrame, *used: str) -> list[str]:
    """The other columns in a fixed order: they settle ties between snapshots."""
    return sorted(c for c in df.columns if c not in used)


def latest_features(features: DataFrame) -> DataFrame:
    """Each customer's newest snapshot over the whole history."""
    snaps = _snapshots(features)
    order = ["feat_snapshot", *_rest(snaps, "Customer_ID", "feat_snapshot")]
    return latest_per(snaps, ["Customer_ID"], order)


def dedupe_snapshots(features: DataFrame) -> DataFrame:
    """One row per customer and snapshot."""
    snaps = _snapshots(features)
    keys = ["Customer_ID", "feat_snapshot"]
    return latest_per(snaps, keys, _rest(snaps, *keys))


def known_to(apps: DataFrame, features: DataFrame) -> DataFrame:
    """The snapshots an as-of lookup for ``apps`` can reach; columns as given."""
    until = apps.groupBy(F.col("Customer_ID").alias("_who")).agg(F.max("orig_month").alias("_until"))
    return features.join(until, F.expr("Customer_ID = _who AND snapshot_date <= _until"), "left_semi")


def asof_features(
    apps: DataFrame, features: DataFrame
) -> DataFrame:
    """Features known at each application's origination month, none from later."""
    return asof_join(
        apps,
        dedupe_snapshots(features),
        "Customer_ID",
        "orig_month",
        "feat_snapshot",
    )


def modelling_table(
    labels: DataFrame,
    features: DataFrame,
    settings: Settings = DEFAULTS,
    mode: str = "latest_then_filter",
    prepare: bool = True,
) -> DataFrame:
    """Labelled loans with the features known when they were originated.

    ``latest_then_filter`` takes each customer's newest snapshot and drops the loans
    it postdates; ``asof`` looks up the snapshot that was current at origination.
    """
    matured = origination_month("snapshot_date", settings.mob_label)
    dated = labels.selectExpr("*", f"{matured} AS orig_month")
    ready = prepare_features if prepare else (lambda df: df)
    if mode == "asof":
        joined = ready(asof_features(dated, features))
        return joined.where("feat_snapshot IS NOT NULL")
    if mode != "latest_then_filter":
        raise ValueError(f"unknown mode {mode!r}")
    joined = keyed_join(dated, ready(latest_features(features)), ["Customer_ID"], "inner")
    return joined.where("feat_snapshot <= orig_month")


def window_split(df: DataFrame, month: str, settings: Settings = DEFAULTS) -> DataFrame:
    """Add ``split`` (train, test, oot or NULL) by origination month."""
    bounds = window_bounds(date_literal(month), settings)
    return df.selectExpr("*", f"{split_name('orig_month', bounds)} AS split")
