import datetime as dt

import pytest

from loanloom.config import Settings
from loanloom.operators import governance as G

MONITORING = "month date, model_version string, auc double, psi double"


def table(spark, rows):
    data = [(dt.date.fromisoformat(m), "v", a, p) for m, a, p in rows]
    return spark.createDataFrame(data, MONITORING)


@pytest.mark.parametrize(
    "month, trained, rows, wanted",
    [
        ("2023-05-01", None, [], (None, "before_anchor")),
        ("2024-06-01", None, [], ("bootstrap", "bootstrap_initial")),
        ("2024-09-01", "2024-06-01", [], (None, "within_sla")),
        ("2024-12-01", "2024-06-01", [], ("refresh", "scheduled_cadence")),
        ("2024-09-01", "2024-06-01", [("2024-08-01", 0.66, 0.08), ("2024-07-01", 0.81, 0.05)], ("refresh", "trigger_auc_below_floor")),
        ("2024-09-01", "2024-06-01", [("2024-07-01", 0.81, 0.05), ("2024-08-01", 0.80, 0.31)], ("refresh", "trigger_psi_breach")),
        ("2024-09-01", "2024-06-01", [("2024-07-01", 0.66, 0.31), ("2024-08-01", 0.80, 0.05)], (None, "within_sla")),
        ("2024-09-01", "2024-06-01", [("2024-07-01", 0.66, 0.01), ("2024-08-01", None, None)], ("refresh", "trigger_auc_below_floor")),
        ("2024-09-01", "2024-06-01", [("2024-08-01", 0.70, 0.2499)], (None, "within_sla")),
    ],
)
def test_decisions(spark, month, trained, rows, wanted):
    row = G.decide_training_action(table(spark, rows), month, trained).first()
    assert (row["action"], row["reason"]) == wanted


def test_decisions_over_time_look_back_only(spark):
    monitoring = table(spark, [("2024-07-01", 0.8, 0.01), ("2024-08-01", 0.6, 0.01), ("2024-09-01", 0.9, 0.01)])
    months = spark.sql("SELECT explode(sequence(DATE '2024-07-01', DATE '2024-10-01', INTERVAL 1 MONTH)) AS month, DATE '2024-06-01' AS train_date")
    got = [r["reason"] for r in G.governance_decisions(months, monitoring).orderBy("month").collect()]
    assert got == ["within_sla", "within_sla", "trigger_auc_below_floor", "within_sla"]


def test_upsert_keeps_the_last(spark):
    old = spark.createDataFrame([("a", 1, 10), ("b", 1, 20)], "model_version string, seq int, n int")
    new = spark.createDataFrame([("a", 2)], "model_version string, seq int")
    assert sorted((r["model_version"], r["n"]) for r in G.registry_upsert(old, new).collect()) == [("a", None), ("b", 20)]


def board(spark, rows):
    return spark.createDataFrame(rows, "model string, ordinal int, split string, auc double")


@pytest.mark.parametrize(
    "rows, wanted",
    [
        ([("a", 0, "oot", 0.7), ("b", 1, "oot", 0.8)], ("b", 0.8, True)),
        ([("a", 0, "oot", 0.7), ("b", 1, "oot", 0.7)], ("a", 0.7, True)),
        ([("a", 0, "test", 0.75), ("b", 1, "oot", 0.7)], ("a", 0.75, True)),
        ([("a", 0, "oot", None), ("b", 1, "oot", None)], ("a", 0.0, False)),
        ([("a", 0, "oot", 0.55), ("a", 0, "test", 0.9)], ("a", 0.55, False)),
    ],
)
def test_selection(spark, rows, wanted):
    assert tuple(G.champion_select(board(spark, rows)).first()) == wanted
    first = [r["model"] for r in G.leaderboard(board(spark, rows)).collect() if r["selected"]]
    assert first == [wanted[0]]


def test_gate_is_a_setting(spark):
    rows = [("a", 0, "oot", 0.55)]
    assert G.champion_select(board(spark, rows), settings=Settings(promotion_gate_auc=0.5)).first()["promoted"]
