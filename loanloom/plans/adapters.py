"""Views of the given tables in the shape of the credit mart.

The projections are plain SQL text that means the same in Spark and in the SQL
used for checking, so both sides start from the same input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH_SHIP = "make_date(year(l_shipdate), month(l_shipdate), 1)"
MONTH_ORDER = "make_date(year(o_orderdate), month(o_orderdate), 1)"

# Loan ledger: a line is one monthly statement of a loan, an order is the loan.
LEDGER = {
    "loan_id": "CAST(l_orderkey AS STRING)",
    "Customer_ID": "CAST(o_custkey AS STRING)",
    "loan_start_date": "CAST(o_orderdate AS DATE)",
    "tenure": "CASE WHEN l_orderkey % 83 = 0 THEN NULL ELSE 10 END",
    "installment_num": "l_linenumber - 1",
    "loan_amt": "CAST(o_totalprice AS FLOAT)",
    "due_amt": "CAST(CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN 0 "
    "ELSE l_quantity * 1000 END AS FLOAT)",
    "paid_amt": "CAST(l_extendedprice * l_tax AS FLOAT)",
    "overdue_amt": "CAST(CASE WHEN o_totalprice + (l_partkey % 7) * 40000 > 350000 "
    "THEN l_extendedprice * l_discount ELSE 0 END AS FLOAT)",
    "balance": "CAST(l_extendedprice AS FLOAT)",
    "snapshot_date": MONTH_SHIP,
}

# The same ledger as raw text, with the damage a CSV export shows.
RAW_LEDGER = {
    "loan_id": LEDGER["loan_id"],
    "Customer_ID": LEDGER["Customer_ID"],
    "loan_start_date": "CASE WHEN l_orderkey % 71 = 0 THEN 'unknown' "
    "ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
    "tenure": "CASE WHEN l_orderkey % 83 = 0 THEN NULL ELSE '10' END",
    "installment_num": "CASE WHEN l_orderkey % 79 = 0 THEN CAST(l_linenumber - 1 AS STRING) || '.7' "
    "WHEN l_orderkey % 73 = 0 THEN CAST(l_linenumber - 1 AS STRING) || '_' "
    "ELSE CAST(l_linenumber - 1 AS STRING) END",
    "loan_amt": "CAST(o_totalprice AS STRING)",
    "due_amt": "CASE WHEN l_orderkey % 97 = 0 THEN '' ELSE CAST(l_quantity * 1000 AS STRING) END",
    "paid_amt": "CASE WHEN l_orderkey % 67 = 0 THEN 'NM' ELSE CAST(l_extendedprice AS STRING) END",
    "overdue_amt": "CAST(l_discount AS STRING)",
    "balance": "CAST(l_extendedprice AS STRING)",
    "snapshot_date": f"CAST({MONTH_SHIP} AS STRING)",
}

APPLICATIONS = {
    "loan_id": "CAST(o_orderkey AS STRING)",
    "Customer_ID": "CAST(o_custkey AS STRING)",
    "orig_month": MONTH_ORDER,
}

SNAPSHOT_ROWS = {
    "Customer_ID": "CAST(o_custkey AS STRING)",
    "snapshot_date": MONTH_SHIP,
    "loan_id": "CAST(o_orderkey AS STRING)",
    "discount_cents": "CAST(floor(l_discount * 100 + 0.5) AS BIGINT)",
    "quantity": "CAST(floor(l_quantity) AS BIGINT)",
}

CLICKS = {
    "Customer_ID": "CAST(user_id AS STRING)",
    "snapshot_date": "make_date(year(ts), month(ts), 1)",
    **{
        f"fe_{i}": f"CASE WHEN event_id % 20 = {i - 1} THEN CAST(floor(value * 100) AS BIGINT) END"
        for i in range(1, 21)
    },
}

# Scores lie on the millionth grid and drift down over the years.
MICRO = (
    "CAST(floor(o_totalprice * 2 * (100 - 3 * (year(o_orderdate) - 1995)) / 100) AS BIGINT)"
)
SCORED = {
    "loan_id": "CAST(o_orderkey AS STRING)",
    "Customer_ID": "CAST(o_custkey AS STRING)",
    "orig_month": MONTH_ORDER,
    "score": f"{MICRO} / CAST(1000000 AS DOUBLE)",
    "prediction": f"CASE WHEN {MICRO} >= 500000 THEN 1 ELSE 0 END",
    "model_version": "'credit_model_' || CAST(year(o_orderdate) AS STRING) || '_01_01'",
    "label": "CASE WHEN o_orderstatus = 'P' THEN NULL "
    "WHEN o_totalprice + (o_orderkey % 7) * 40000 > 350000 THEN 1 ELSE 0 END",
}

# Three candidate scores per loan, as millionths.
CANDIDATES = (
    ("logistic_regression", 0, MICRO),
    ("gbt_shallow", 1, "(o_orderkey * 7919) % 1000001"),
    ("gbt_deep", 2, f"CAST(floor(({MICRO} + (o_orderkey * 7919) % 1000001) / 2) AS BIGINT)"),
)

# Training scores of the yearly models: their own year's orders, 1995 is production.
BASELINE_YEARS = 1998
PRODUCTION_VERSION = "credit_model_1995_01_01"


# Ends of the periods in which as-of lookups move on.
PERIODS = ("1996-06-01", "1998-06-01", "2000-01-01")


def _dirty(text: str, offset: int = 0) -> str:
    k = f"(c_custkey + {offset})"
    return (
        f"CASE WHEN {k} % 13 = 0 THEN NULL WHEN {k} % 11 = 0 THEN 'NM' "
        f"WHEN {k} % 7 = 0 THEN {text} || '_' WHEN {k} % 19 = 0 THEN ' ' || {text} || ' ' "
        f"WHEN {k} % 23 = 0 THEN '__' || {text} WHEN {k} % 41 = 0 THEN '!@9#%8' ELSE {text} END"
    )


def _text(number: str) -> str:
    return f"CAST({number} AS STRING)"


def _sentinel(number: str, every: int, value: int) -> str:
    return _text(f"CASE WHEN c_custkey % {every} = 0 THEN {value} ELSE {number} END")


def _category(values: list[str], offset: int) -> str:
    k = f"(c_custkey + {offset})"
    picks = " ".join(f"WHEN {k} % {len(values)} = {i} THEN '{v}'" for i, v in enumerate(values))
    return (
        f"CASE WHEN {k} % 13 = 0 THEN NULL WHEN {k} % 11 = 0 THEN '_' WHEN {k} % 17 = 0 THEN '!@9#%8' "
        f"WHEN {k} % 29 = 0 THEN ' NM ' {picks} END"
    )


SAME_MONTH = "DATE '2024-01-01'"
SPREAD_MONTH = (
    "make_date(CAST(1995 + floor((c_custkey % 60) / 12) AS INT), CAST(1 + c_custkey % 12 AS INT), 1)"
)

ATTRIBUTES = {
    "Customer_ID": "CAST(c_custkey AS STRING)",
    "Name": "c_name",
    "SSN": "'000-00-' || CAST(c_custkey % 10000 AS STRING)",
    "Age": _dirty(_sentinel("18 + c_custkey % 50", 43, -500), 1),
    "Occupation": "CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN '_______' "
    "WHEN c_custkey % 5 = 0 THEN ' ' || c_mktsegment || ' ' "
    "WHEN c_custkey % 7 = 0 THEN '_' ELSE c_mktsegment END",
    "snapshot_date": SAME_MONTH,
}
FINANCIALS = {
    "Customer_ID": "CAST(c_custkey AS STRING)",
    "Num_of_Loan": _dirty(_sentinel("c_custkey % 9", 31, -100), 2),
    "Num_of_Delayed_Payment": _dirty(_sentinel("c_custkey % 28", 37, 4000), 3),
    "Changed_Credit_Limit": _dirty(f"{_text('c_custkey % 20')} || '.5'", 4),
    "Amount_invested_monthly": _dirty(_text("(c_custkey * 7) % 1000"), 5),
    "Monthly_Balance": "CASE WHEN c_custkey % 53 = 0 THEN '__-333333333333333333333333333__' ELSE "
    + _dirty(_text("(c_custkey * 11) % 900"), 6)
    + " END",
    "Num_Credit_Inquiries": _dirty(_sentinel("c_custkey % 15", 47, 2597), 7),
    "Outstanding_Debt": _dirty(f"{_text('(c_custkey * 37) % 5000')} || '.25'", 8),
    "Annual_Income": _dirty(f"{_text('CAST(floor(c_acctbal * 12) AS BIGINT)')} || '.5'", 9),
    "Monthly_Inhand_Salary": _dirty(
        _text("CASE WHEN c_custkey % 29 = 0 THEN 0 ELSE CAST(floor(c_acctbal) AS BIGINT) END"), 10
    ),
    "Total_EMI_per_month": _dirty(_text("(c_custkey * 13) % 400"), 11),
    "Credit_Utilization_Ratio": _dirty(
        f"'2' || {_text('c_custkey % 10')} || '.' || {_text('c_custkey % 7')}", 12
    ),
    "Interest_Rate": _dirty(_sentinel("c_custkey % 35", 59, 5797), 0),
    "Delay_from_due_date": _dirty(_text("c_custkey % 60 - 5"), 1),
    "Num_Bank_Accounts": _dirty(_sentinel("c_custkey % 11", 61, 1756), 2),
    "Num_Credit_Card": _dirty(_sentinel("c_custkey % 10", 67, 1499), 3),
    "Credit_Mix": _category(["Good", "Standard", "Bad"], 1),
    "Payment_of_Min_Amount": _category(["Yes", "No"], 2),
    "Payment_Behaviour": _category(["Low_spent", "High_spent", "Medium_spent", "Other"], 3),
    "Credit_History_Age": "CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN 'NA' "
    "WHEN c_custkey % 5 = 1 THEN CAST(c_custkey % 30 AS STRING) || ' Years' "
    "WHEN c_custkey % 5 = 2 THEN CAST(c_custkey % 12 AS STRING) || ' Months' "
    "ELSE CAST(c_custkey % 30 AS STRING) || ' Years and ' || CAST(c_custkey % 12 AS STRING) || ' Months' END",
    "Type_of_Loan": "CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 6 = 0 THEN '' "
    "WHEN c_custkey % 6 = 1 THEN 'Auto Loan' WHEN c_custkey % 6 = 2 THEN 'Auto Loan, NaN, Auto Loan' "
    "WHEN c_custkey % 6 = 3 THEN ' , ' WHEN c_custkey % 6 = 4 THEN 'a,,b' "
    "ELSE 'Auto Loan, Personal Loan, and Student Loan' END",
    "snapshot_date": SAME_MONTH,
}


def select_list(columns: dict[str, str]) -> list[str]:
    return [f"{expr} AS {name}" for name, expr in columns.items()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines_with_orders(spark: SparkSession, sf_dir: str, shipped: str | None = None) -> DataFrame:
    """Lines with their orders, all of them or those shipped in one month.

    The month is a range on the stored column, which reaches the file scan.
    """
    lines = table(spark, sf_dir, "lineitem")
    if shipped is not None:
        lines = lines.where(
            f"l_shipdate >= TIMESTAMP_NTZ '{shipped}' "
            f"AND l_shipdate < TIMESTAMP_NTZ '{shipped}' + INTERVAL 1 MONTH"
        )
    return lines.join(table(spark, sf_dir, "orders"), lines["l_orderkey"] == F.col("o_orderkey"))


def ledger(spark: SparkSession, sf_dir: str, month: str | None = None) -> DataFrame:
    return lines_with_orders(spark, sf_dir, month).selectExpr(*select_list(LEDGER))


def raw_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_with_orders(spark, sf_dir).selectExpr(*select_list(RAW_LEDGER))


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*select_list(APPLICATIONS))


def snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_with_orders(spark, sf_dir).selectExpr(*select_list(SNAPSHOT_ROWS))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        snapshot_rows(spark, sf_dir)
        .groupBy("Customer_ID", "snapshot_date")
        .agg(
            F.avg("discount_cents").alias("avg_discount"),
            F.avg("quantity").alias("avg_quantity"),
            F.count(F.lit(1)).alias("n_lines"),
        )
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*select_list(CLICKS))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*select_list(SCORED))


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*select_list(ATTRIBUTES))


def financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*select_list(FINANCIALS))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes and financials side by side, snapshots spread over five years."""
    both = {**ATTRIBUTES, **FINANCIALS, "snapshot_date": SPREAD_MONTH}
    return table(spark, sf_dir, "customer").selectExpr(*select_list(both))
