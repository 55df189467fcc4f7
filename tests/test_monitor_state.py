"""The monitoring state against full recomputation, and what a batch reads."""

import datetime as dt
import random

import pytest

from loanloom import schemas as S
from loanloom.config import Settings
from loanloom.operators import model, monitor, monitor_state as state_of
from loanloom.plans import monitoring as plans
from loanloom.sources.mart import Mart
from loanloom.sources.sinks import write_partitions
from loanloom.sources.stores import read_store

MONTHS = [dt.date(2024, m, 1) for m in range(1, 7)]
LABELS = "loan_id string, label int, snapshot_date date, orig_month date"
SCORED = "loan_id string, orig_month date, model_version string, score double, prediction int"


def scored_rows(rng, months=MONTHS, per=80):
    return [
        (f"{m.month}-{i}", m, f"v{m.month % 2}", rng.choice([round(rng.random(), 2), rng.random(), None]), rng.randrange(2))
        for m in months for i in range(per)
    ]


def later(month, months):
    return dt.date(month.year + (month.month + months - 1) // 12, (month.month + months - 1) % 12 + 1, 1)


def expected(spark, predictions, labels, baseline):
    return {tuple(r) for r in monitor.cohort_monitor(predictions, labels, baseline, "v0", digits=9).collect()}


def measured(state, baseline, months=None):
    return {tuple(r) for r in state_of.monitoring(state, baseline, "v0", months, digits=9).collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_order_of_batches_equals_the_whole(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = scored_rows(rng)
    predictions = spark.createDataFrame(rows, SCORED)
    # Up to three labels a loan, out of order, corrected, repeated, and for loans never scored.
    labels = [
        (loan, rng.choice([0, 1, 1, None]), later(m, rng.randrange(4, 8)), m)
        for loan, m, *_ in rng.choices(rows, k=700) + [("absent", MONTHS[0])] * 2
    ]
    labels += [(None, 1, MONTHS[0], MONTHS[0]), labels[0], labels[1]]
    baseline = model.baseline_counts(predictions.where("model_version = 'v0'"))
    state = state_of.monitor_state(spark, str(tmp_path / "s"))
    steps = [("p", [r for r in rows if r[1] in MONTHS[:3]]), ("p", [r for r in rows if r[1] in MONTHS[3:]])]
    steps += [("l", labels[i::4]) for i in range(4)]
    rng.shuffle(steps)
    for i, (kind, some) in enumerate(steps):
        for again in (True, False):
            if kind == "p":
                done = state_of.add_predictions(state, f"b{i}", spark.createDataFrame(some, SCORED))
            else:
                arrived = [r for k, part in steps[: i + 1] if k == "p" for r in part]
                done = state_of.add_labels(state, f"b{i}", spark.createDataFrame(some, LABELS), spark.createDataFrame(arrived, SCORED))
            assert done == again
        if i == 3:
            state_of.compact(state)
    want = expected(spark, predictions, spark.createDataFrame(labels, LABELS), baseline)
    assert len(want) == len(MONTHS) and measured(state, baseline) == want
    state_of.compact(state)
    assert len(state.manifest().parts) == 1 and measured(state, baseline) == want
    some = measured(state, baseline, MONTHS[:2])
    assert some == {r for r in want if r[0] in MONTHS[:2]}


def test_empty_state_and_empty_batches(spark, tmp_path):
    state = state_of.monitor_state(spark, str(tmp_path / "s"))
    nothing = spark.createDataFrame([], "model_version string, micro bigint, n bigint")
    assert measured(state, nothing) == set()
    empty = spark.createDataFrame([], SCORED)
    assert state_of.add_predictions(state, "p", empty)
    assert state_of.add_labels(state, "l", spark.createDataFrame([], LABELS), empty)
    assert measured(state, nothing) == set() and state.manifest().batches == ("p", "l")


@pytest.fixture
def mart(spark, tmp_path):
    """Predictions of six cohorts; labels of the first four."""
    rng = random.Random(5)
    mart = Mart(str(tmp_path / "mart"))
    rows = scored_rows(rng)
    predictions = spark.createDataFrame(rows, SCORED).selectExpr(
        "loan_id", "'c' AS Customer_ID", "score", "prediction", "'m' AS model_name", "model_version",
        "TIMESTAMP '2024-01-01' AS scored_at", "orig_month",
    )
    write_partitions(predictions, mart.gold("model_predictions"), "orig_month")
    write_labels(spark, mart, rng, rows, MONTHS[:4])
    write_partitions(model.baseline_counts(predictions), mart.bank("baselines"), "model_version")
    return mart, rows, rng


def write_labels(spark, mart, rng, rows, months):
    labels = [(loan, "c", rng.randrange(2), "d", later(m, 6)) for loan, m, *_ in rows if m in months]
    write_partitions(spark.createDataFrame(labels, S.LABEL_STORE), mart.gold("label_store"), "snapshot_date")


def table(spark, mart):
    return {tuple(r) for r in read_store(spark, mart.gold("model_monitoring"), S.MONITORING).collect()}


def test_update_equals_the_full_run(spark, mart, tmp_path):
    mart, rows, rng = mart
    assert plans.update_monitoring(spark, mart)["cohorts"] == 6
    first = table(spark, mart)
    assert plans.run_monitoring(spark, mart)["cohorts"] == 6 and table(spark, mart) == first
    assert plans.update_monitoring(spark, mart) == {"cohorts": 0, "batches": [], "status": "ok"}

    # The fifth cohort matures: only its files are read. The others' are no Parquet any more.
    write_labels(spark, mart, rng, rows, [MONTHS[4]])
    broken = []
    for month in MONTHS:
        if month != MONTHS[4]:
            for file in (tmp_path / "mart/gold/model_predictions" / f"orig_month={month}").glob("*.parquet"):
                broken.append((file, file.read_bytes()))
                file.write_bytes(b"damaged")
                (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    assert broken
    updated = plans.update_monitoring(spark, mart)
    assert updated == {"cohorts": 1, "batches": [f"labels {later(MONTHS[4], 6)}"], "status": "ok"}
    for file, content in broken:
        file.write_bytes(content)
    second = table(spark, mart)
    assert len(second) == 6 and len(first & second) == 5
    plans.run_monitoring(spark, mart)
    assert table(spark, mart) == second


def test_update_reads_the_partitions_it_touches(spark, mart):
    mart, _, _ = mart
    plans.update_monitoring(spark, mart)
    state = state_of.monitor_state(spark, mart.gold("monitor_state"))
    plan = state_of.monitoring(state, spark.createDataFrame([], S.BASELINES), None, MONTHS[:1], Settings())
    text = plan._jdf.queryExecution().executedPlan().toString()
    pruned = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "kind" in pruned and "(orig_month" in pruned
