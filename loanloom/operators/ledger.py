"""Loan ledger: typing, delinquency, labels, applications."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.config import DEFAULTS, PII, Settings
from loanloom.functions.cleaning import clean_numeric, quoted, to_int
from loanloom.functions.dates import date_literal
from loanloom.schemas import ATTRIBUTE_TYPES, CLICKSTREAM_TYPES, FINANCIAL_TYPES, LOAN_TYPES

# Numeric loan columns whose NULLs become zero once delinquency is derived.
ZERO_FILLED = (
    "tenure",
    "installment_num",
    "loan_amt",
    "due_amt",
    "paid_amt",
    "overdue_amt",
    "balance",
)


def snapshot_slice(df: DataFrame, month: str) -> DataFrame:
    """Rows of one monthly snapshot; a partition filter on partitioned stores."""
    return df.where(f"snapshot_date = {date_literal(month)}")


def snapshot_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("snapshot_date").agg(F.expr("count(*) AS row_count"))


def enforce_types(df: DataFrame, types: Mapping[str, T.DataType], clean: bool = False) -> DataFrame:
    """Cast the listed columns in one projection; unreadable values become NULL.

    With ``clean`` underscores are stripped from numeric text before the cast, so
    that a value such as ``52312.68_`` survives.
    """
    out = []
    for f in df.schema.fields:
        c, wanted = quoted(f.name), types.get(f.name)
        if wanted is None or wanted == f.dataType:
            out.append(c)
            continue
        expr = c
        if clean and isinstance(wanted, (T.IntegerType, T.FloatType)):
            expr = clean_numeric(c, f.dataType)
        kind = wanted.simpleString()
        if isinstance(wanted, T.IntegerType):
            expr = to_int(expr)
        elif isinstance(wanted, T.FractionalType):
            # The text 'NaN' casts, but means missing.
            expr = f"nullif(try_cast({expr} AS {kind}), CAST('NaN' AS {kind}))"
        else:
            expr = f"try_cast({expr} AS {kind})"
        out.append(f"{expr} AS {c}")
    return df.selectExpr(*out)


def typed_loans(raw: DataFrame) -> DataFrame:
    return enforce_types(raw, LOAN_TYPES)


def typed_attributes(raw: DataFrame, strict_parity: bool = False) -> DataFrame:
    return drop_pii(enforce_types(raw, ATTRIBUTE_TYPES, clean=not strict_parity))


def typed_financials(raw: DataFrame, strict_parity: bool = False) -> DataFrame:
    """Type the money columns. ``strict_parity`` casts before any cleaning, which
    turns values with stray underscores into NULL."""
    return enforce_types(raw, FINANCIAL_TYPES, clean=not strict_parity)


def typed_clickstream(raw: DataFrame) -> DataFrame:
    return enforce_types(raw, CLICKSTREAM_TYPES)


def drop_pii(df: DataFrame) -> DataFrame:
    return df.drop(*PII)


def delinquency(loans: DataFrame) -> DataFrame:
    """Month on book, missed instalments, first missed date and days past due.

    Missed instalments come from the amounts as given; only then do NULL numbers
    become zero. Overdue with nothing due counts as no missed instalment.
    """
    missed = "coalesce(try_cast(ceil(try_divide(overdue_amt, due_amt)) AS INT), 0)"
    filled = [
        f"coalesce({quoted(f.name)}, CAST(0 AS {f.dataType.simpleString()})) AS {quoted(f.name)}"
        if f.name in ZERO_FILLED
        else quoted(f.name)
        for f in loans.schema.fields
    ]
    first_missed = (
        "CASE WHEN installments_missed > 0 THEN add_months(snapshot_date, -installments_missed) END"
    )
    return (
        loans.selectExpr(
            *filled,
            "coalesce(CAST(installment_num AS INT), 0) AS mob",
            f"{missed} AS installments_missed",
        )
        .selectExpr("*", f"{first_missed} AS first_missed_date")
        .selectExpr(
            "*",
            "CASE WHEN overdue_amt > 0 THEN datediff(snapshot_date, first_missed_date) ELSE 0 END AS dpd",
        )
    )


def label_store(loans: DataFrame, settings: Settings = DEFAULTS, keep: Sequence[str] = ()) -> DataFrame:
    """Default label of each loan at its maturity month, with the columns to ``keep``."""
    return loans.where(f"mob = {settings.mob_label}").selectExpr(
        "loan_id",
        "Customer_ID",
        f"CASE WHEN dpd >= {settings.dpd_threshold} THEN 1 ELSE 0 END AS label",
        f"'{settings.label_def}' AS label_def",
        "snapshot_date",
        *map(quoted, keep),
    )


def applications(loans: DataFrame) -> DataFrame:
    """Loans in their first month; the snapshot is the origination month."""
    return loans.where("mob = 0").selectExpr("loan_id", "Customer_ID", "snapshot_date AS orig_month")


def ledger_issues(loans: DataFrame) -> DataFrame:
    """Per snapshot, rows overdue with nothing due: they get no missed instalments."""
    return loans.groupBy("snapshot_date").agg(
        F.expr("count(*) AS row_count"),
        F.expr("count_if(overdue_amt > 0 AND coalesce(due_amt, 0) = 0) AS overdue_without_due"),
    )
