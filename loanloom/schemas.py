"""Declared schemas. Raw text stays text until the silver step types it."""

from __future__ import annotations

from pyspark.sql import types as T

from loanloom.config import CATEGORICAL, CLICK_FEATURES, DIRTY_NUMERIC, PII


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Column types of the silver loan table.
LOAN_TYPES = {
    "loan_id": T.StringType(),
    "Customer_ID": T.StringType(),
    "loan_start_date": T.DateType(),
    "tenure": T.IntegerType(),
    "installment_num": T.IntegerType(),
    "loan_amt": T.FloatType(),
    "due_amt": T.FloatType(),
    "paid_amt": T.FloatType(),
    "overdue_amt": T.FloatType(),
    "balance": T.FloatType(),
    "snapshot_date": T.DateType(),
}
ATTRIBUTE_TYPES = {
    "Customer_ID": T.StringType(),
    "Age": T.IntegerType(),
    "snapshot_date": T.DateType(),
}
FINANCIAL_TYPES = {
    "Customer_ID": T.StringType(),
    "Annual_Income": T.FloatType(),
    "Monthly_Inhand_Salary": T.FloatType(),
    "Outstanding_Debt": T.FloatType(),
    "snapshot_date": T.DateType(),
}
CLICKSTREAM_TYPES = {
    "Customer_ID": T.StringType(),
    **{c: T.DoubleType() for c in CLICK_FEATURES},
    "snapshot_date": T.DateType(),
}

# Raw CSV layouts: every column as text, bad lines kept aside by the reader.
RAW = {
    "loans": _strings(*LOAN_TYPES),
    "attributes": _strings("Customer_ID", "Name", "Age", "SSN", "Occupation", "snapshot_date"),
    "financials": _strings(
        "Customer_ID",
        *[c for c in DIRTY_NUMERIC if c != "Age"],
        *[c for c in CATEGORICAL if c != "Occupation"],
        "Credit_History_Age",
        "Type_of_Loan",
        "snapshot_date",
    ),
    "clickstream": _strings("Customer_ID", *CLICK_FEATURES, "snapshot_date"),
}


# Stores written by the jobs, as DDL.
SILVER_LOANS = (
    "loan_id string, Customer_ID string, loan_start_date date, tenure int, installment_num int, "
    "loan_amt float, due_amt float, paid_amt float, overdue_amt float, balance float, mob int, "
    "installments_missed int, first_missed_date date, dpd int, snapshot_date date"
)
LABEL_STORE = (
    "loan_id string, Customer_ID string, label int, label_def string, snapshot_date date"
)
# Attributes without personal data, financials as typed, click means.
FEATURE_STORE = T.StructType(
    [
        T.StructField("Customer_ID", T.StringType()),
        *[
            T.StructField(f.name, {**ATTRIBUTE_TYPES, **FINANCIAL_TYPES}.get(f.name, f.dataType))
            for source in ("attributes", "financials")
            for f in RAW[source].fields
            if f.name not in ("Customer_ID", "snapshot_date", *PII)
        ],
        *[T.StructField(f"{c}_mean", T.DoubleType()) for c in CLICK_FEATURES],
        T.StructField("snapshot_date", T.DateType()),
    ]
)
PREDICTIONS = (
    "loan_id string, Customer_ID string, score double, prediction int, model_name string, "
    "model_version string, scored_at timestamp, orig_month date"
)
MONITORING = (
    "model_version string, cohort_type string, n_scored bigint, n_labelled bigint, "
    "avg_score double, pred_positive_rate double, psi double, auc double, auc_pr double, "
    "ks double, actual_bad_rate double, month date"
)
BASELINES = "micro bigint, n bigint, model_version string"
REGISTRY = (
    "train_date date, model_version string, action string, reason string, champion_model string, "
    "candidates string, promoted boolean, decision_threshold double, auc_train double, "
    "auc_test double, auc_oot double, n_train bigint, n_test bigint, n_oot bigint, seq timestamp"
)
CHAMPION = (
    "model_name string, version string, train_date date, action string, reason string, "
    "promoted boolean, selection_metric string, decision_threshold double, label_def string, "
    "numeric_columns array<string>, categorical array<string>, windows map<string,string>, "
    "metrics map<string,struct<auc:double,auc_pr:double,gini:double,ks:double,bad_rate:double,"
    "n:bigint>>, model_path string, trained_at timestamp"
)
LEADERBOARD = (
    "month date, action string, model string, ordinal int, split string, auc double, "
    "auc_pr double, gini double, ks double, bad_rate double, n bigint, selected boolean, "
    "threshold double, trained_at timestamp"
)
