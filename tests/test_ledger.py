import datetime as dt

from loanloom.operators import ledger
from loanloom.operators.features import (
    clickstream_agg, dedupe_snapshots, feature_align, feature_columns, feature_store, latest_features,
    modelling_table, prepare_features,
)

D = dt.date
LOANS = (
    "loan_id string, Customer_ID string, installment_num int, due_amt float, overdue_amt float, "
    "snapshot_date date"
)


def derive(spark, rows):
    df = spark.createDataFrame(
        [(str(i), "c", inst, due, over, day) for i, (inst, due, over, day) in enumerate(rows)], LOANS
    )
    return {int(r["loan_id"]): r for r in ledger.delinquency(df).collect()}


def test_delinquency_edges(spark):
    day = D(2024, 3, 31)
    got = derive(
        spark,
        [
            (6, 0.0, 50.0, day), (6, None, 50.0, day), (6, 100.0, 100.0, day), (6, 100.0, 101.0, day),
            (6, 100.0, 0.0, day), (None, 100.0, None, day), (6, 100.0, 250.0, D(2024, 3, 1)),
        ],
    )
    # Nothing due: no missed instalment, so no date and no days past due.
    for i in (0, 1):
        assert (got[i]["installments_missed"], got[i]["first_missed_date"], got[i]["dpd"]) == (0, None, None)
    assert got[1]["due_amt"] == 0.0
    # One month back from the last of March ends at the last of February.
    assert (got[2]["installments_missed"], got[2]["first_missed_date"], got[2]["dpd"]) == (1, D(2024, 2, 29), 31)
    assert got[3]["installments_missed"] == 2
    assert (got[4]["dpd"], got[4]["first_missed_date"]) == (0, None)
    assert (got[5]["mob"], got[5]["overdue_amt"], got[5]["dpd"]) == (0, 0.0, 0)
    assert got[6]["dpd"] == (D(2024, 3, 1) - D(2023, 12, 1)).days


def test_labels(spark):
    df = spark.createDataFrame(
        [("a", "c", 6, d, D(2024, 1, 1)) for d in (28, 29, 30, 31, None)] + [("b", "c", 5, 90, D(2024, 1, 1))],
        "loan_id string, Customer_ID string, mob int, dpd int, snapshot_date date",
    )
    assert sorted(r["label"] for r in ledger.label_store(df).collect()) == [0, 0, 0, 1, 1]
    assert ledger.label_store(df).first()["label_def"] == "30dpd_6mob"


def test_typing_is_null_safe(spark):
    raw = spark.createDataFrame(
        [("7", "001", "bad", "10", "3.9", "1", "12_", "x", "", "5", "2024-01-01")],
        "loan_id string, Customer_ID string, loan_start_date string, tenure string, installment_num string, "
        "loan_amt string, due_amt string, paid_amt string, overdue_amt string, balance string, snapshot_date string",
    )
    row = ledger.typed_loans(raw).first()
    assert (row["Customer_ID"], row["installment_num"], row["loan_start_date"]) == ("001", 3, None)
    assert (row["due_amt"], row["paid_amt"], row["overdue_amt"]) == (None, None, None)


def test_nan_text_is_missing(spark):
    raw = spark.createDataFrame([("c", "NaN", "3")], "Customer_ID string, fe_1 string, fe_2 string")
    row = ledger.typed_clickstream(raw).first()
    assert (row["fe_1"], row["fe_2"]) == (None, 3.0)


def test_underscored_money(spark):
    raw = spark.createDataFrame([("c", "52312.68_")], "Customer_ID string, Annual_Income string")
    assert abs(ledger.typed_financials(raw).first()["Annual_Income"] - 52312.68) < 0.01
    assert ledger.typed_financials(raw, strict_parity=True).first()["Annual_Income"] is None


def test_issue_counts(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 0.0, 5.0), (D(2024, 1, 1), 1.0, 5.0)], "snapshot_date date, due_amt float, overdue_amt float")
    row = ledger.ledger_issues(df).first()
    assert (row["row_count"], row["overdue_without_due"]) == (2, 1)


def test_feature_store_fans_out_on_duplicate_financials(spark):
    day = D(2024, 1, 1)
    attrs = spark.createDataFrame([("a", 30, day), ("b", 40, day), (None, 1, day)], "Customer_ID string, Age int, snapshot_date date")
    fins = spark.createDataFrame([("a", 1.0, day), ("a", 2.0, day), ("b", 9.0, D(2024, 2, 1)), (None, 5.0, day)], "Customer_ID string, Annual_Income double, snapshot_date date")
    clicks = spark.createDataFrame([("a", 1.0, None, day), ("a", 3.0, None, day)], "Customer_ID string, fe_1 double, fe_2 double, snapshot_date date")
    rows = sorted(
        (r["Customer_ID"] or "-", r["Annual_Income"] or 0.0, r["fe_1_mean"] or 0.0)
        for r in feature_store(attrs, fins, clicks).collect()
    )
    assert rows == [("-", 0.0, 0.0), ("a", 1.0, 2.0), ("a", 2.0, 2.0), ("b", 0.0, 0.0)]
    assert clickstream_agg(clicks).first()["fe_2_mean"] is None


def test_snapshot_choice(spark):
    df = spark.createDataFrame(
        [("a", D(2024, 1, 1), 1), ("a", D(2024, 2, 1), 2), ("a", D(2024, 2, 1), 5), ("b", D(2023, 1, 1), 3)],
        "Customer_ID string, snapshot_date date, x int",
    )
    assert sorted((r["Customer_ID"], r["x"]) for r in latest_features(df).collect()) == [("a", 5), ("b", 3)]
    assert sorted((r["Customer_ID"], r["x"]) for r in dedupe_snapshots(df).collect()) == [("a", 1), ("a", 5), ("b", 3)]


def test_modelling_table_modes(spark):
    feats = spark.createDataFrame(
        [("a", D(2023, 1, 1), 1.0), ("a", D(2024, 1, 1), 2.0), ("b", D(2023, 1, 1), 3.0)],
        "Customer_ID string, snapshot_date date, x double",
    )
    labels = spark.createDataFrame(
        [("1", "a", 1, D(2023, 9, 1)), ("2", "b", 0, D(2023, 9, 1)), ("3", "b", 0, D(2023, 5, 1))],
        "loan_id string, Customer_ID string, label int, snapshot_date date",
    )
    newest = modelling_table(labels, feats)
    assert sorted((r["loan_id"], r["x"]) for r in newest.collect()) == [("2", 3.0)]
    known = modelling_table(labels, feats, mode="asof")
    assert sorted((r["loan_id"], r["x"]) for r in known.collect()) == [("1", 1.0), ("2", 3.0)]


def test_prepared_columns(spark):
    df = spark.createDataFrame(
        [("a", "200", "0", "NA", None, "_")],
        "Customer_ID string, Age string, Monthly_Inhand_Salary string, Credit_History_Age string, Type_of_Loan string, Credit_Mix string",
    ).selectExpr("*", "'10' AS Total_EMI_per_month")
    ready = prepare_features(df)
    row = ready.first()
    assert (row["Age"], row["emi_to_salary"], row["num_loan_types"], row["Credit_Mix"]) == (100.0, None, 0, "Unknown")
    assert "Credit_History_Age" not in ready.columns and row["credit_history_months"] is None
    numeric, categorical = feature_columns(ready)
    assert categorical == ["Credit_Mix"] and "Type_of_Loan" not in numeric and "emi_to_salary" in numeric
    aligned = feature_align(ready, ["Age", "Interest_Rate"], ["Occupation"])
    assert aligned.first()["Interest_Rate"] is None and aligned.schema["Occupation"].dataType.simpleString() == "string"
