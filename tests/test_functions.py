"""Cleaning and month expressions on literal values."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from loanloom.functions import cleaning as C
from loanloom.functions import dates as D
from loanloom.functions.scoring import psi_band


def evaluate(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").selectExpr(f"{expr} AS r").first()["r"]


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("12_", 12.0), ("_3.5_", 3.5), ("__-333333333333333333333333333__", -333333333333333333333333333.0),
        ("NM", None), ("!@9#%8", None), ("", None), ("nan", None), (None, None), (" 5 ", 5.0), ("1d", None),
        ("1f", None), ("inf", None), ("-inf", None), ("infinity", None), ("1,000", None), ("1e3", 1000.0),
        (".5", 0.5), ("5.", 5.0), ("+7", 7.0), ("abc", None), ("0x1A", None), ("1_000", 1000.0),
        ("None", None), ("NaN", None), ("\t6\n", 6.0), ("-", None), ("1 2", None),
    ],
)
def test_clean_numeric(spark, text, wanted):
    assert evaluate(spark, C.clean_numeric("v"), text) == wanted


def test_clean_numeric_keeps_numbers(spark):
    assert evaluate(spark, C.clean_numeric("v", T.DoubleType()), float("nan"), "double") is None
    assert evaluate(spark, C.clean_numeric("v", T.DoubleType()), 1.5, "double") == 1.5
    assert evaluate(spark, C.clean_numeric("v", T.IntegerType()), 3, "int") == 3.0
    # A float stands for its shortest decimal text.
    assert evaluate(spark, C.clean_numeric("v", T.FloatType()), 52312.68, "float") == 52312.68


@pytest.mark.parametrize("text, wanted", [("28", 28), ("28.5", 28), ("28_", None), (None, None), ("x", None)])
def test_to_int(spark, text, wanted):
    assert evaluate(spark, C.to_int("v"), text) == wanted


@pytest.mark.parametrize(
    "text, wanted",
    [("22 Years and 1 Months", 265), ("3 Years", 36), ("7 Months", 7), ("NA", None), (None, None), ("", None), ("0 Years and 0 Months", 0)],
)
def test_credit_history(spark, text, wanted):
    assert evaluate(spark, C.credit_history_months("v"), text) == wanted


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("Auto Loan, Personal Loan, and Student Loan", 3), (None, 0), ("", 0), (" , ", 0), ("NaN, Auto", 1),
        ("x", 1), ("a,,b", 2), ("a,a", 2), ("nan", 0), (" nan ,nano", 1), ("a, NAN ,", 1),
    ],
)
def test_count_list_items(spark, text, wanted):
    assert evaluate(spark, C.count_list_items("v"), text) == wanted


@pytest.mark.parametrize("value, wanted", [(5.0, 5.0), (-100.0, 0.0), (1e9, 20.0), (None, None)])
def test_clip(spark, value, wanted):
    assert evaluate(spark, C.clip("v", 0, 20), value, "double") == wanted


@pytest.mark.parametrize(
    "text, wanted",
    [(" Good ", "Good"), ("_", "Unknown"), ("", "Unknown"), ("nan", "Unknown"), ("!@9#%8", "Unknown"), (" NM", "Unknown"), (None, "Unknown"), ("_______", "_______")],
)
def test_clean_category(spark, text, wanted):
    assert evaluate(spark, C.clean_category("v"), text) == wanted


def test_null_category_label(spark):
    assert evaluate(spark, C.clean_category("v", "None"), None) == "None"


def test_ratio_of_zero(spark):
    assert evaluate(spark, C.ratio("v", "0D"), 3.0, "double") is None


def test_windows_of_a_training_month(spark):
    bounds = D.window_bounds("v")
    row = spark.createDataFrame([("2024-06-15",)], "v string").selectExpr(*[f"CAST({e} AS STRING) AS {k}" for k, e in bounds.items()]).first()
    assert row.asDict() == {
        "train_start": "2023-01-01", "train_end": "2023-06-01", "test_start": "2023-07-01",
        "test_end": "2023-09-01", "oot_start": "2023-10-01", "oot_end": "2023-12-01",
    }


def test_months(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 31), dt.date(2024, 3, 1))], "a date, b date")
    row = df.selectExpr(f"{D.months_diff('a', 'b')} AS d", f"{D.month_start('a')} AS m").first()
    assert (row["d"], row["m"]) == (14, dt.date(2023, 1, 1))


def test_splits_leave_gaps_out(spark):
    bounds = D.window_bounds("DATE '2024-06-01'")
    months = ["2022-12-01", "2023-01-01", "2023-06-01", "2023-07-01", "2023-12-01", "2024-01-01"]
    got = [evaluate(spark, D.split_name("CAST(v AS DATE)", bounds), m) for m in months]
    assert got == [None, "train", "train", "test", "oot", None]


@pytest.mark.parametrize(
    "path, wanted",
    [
        ("/m/gold_label_store_2023_04_01.parquet", dt.date(2023, 4, 1)),
        ("/m/gold_label_store_2023_04_01.parquet/part-00000-1f.snappy.parquet", dt.date(2023, 4, 1)),
        ("/m_2020_01_01/store.parquet", None),
        ("/m/store.parquet", None),
    ],
)
def test_partition_date(spark, path, wanted):
    assert evaluate(spark, D.partition_date("v"), path) == wanted


@pytest.mark.parametrize("v, band", [(0.05, "green"), (0.1, "amber"), (0.25, "red"), (None, None)])
def test_psi_band(spark, v, band):
    assert evaluate(spark, psi_band("v"), v, "double") == band
