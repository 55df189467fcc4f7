"""The as-of state against whole-history lookups, month by month."""

import datetime as dt
import random

import pytest

from loanloom.operators import asof_state as state_of
from loanloom.operators.features import asof_features
from loanloom.plans import catalog

MONTHS = [dt.date(2024, m, 1) for m in range(1, 9)]
SNAPS = "Customer_ID string, snapshot_date date, a double, b string"
APPS = "loan_id string, Customer_ID string, orig_month date"


def rows_of(rng):
    """Snapshots with the month they arrive in: some late, some repeated, some of equal date."""
    snaps = []
    for c in range(30):
        for m in MONTHS:
            if rng.random() < 0.4:
                for _ in range(rng.choice([1, 1, 2])):
                    row = (f"c{c}", m, rng.choice([None, 1.0, rng.random()]), rng.choice([None, "x", "y"]))
                    late = rng.choice([0, 0, 0, 1, 3])
                    snaps += [(row, MONTHS[min(MONTHS.index(m) + late, 7)])] * rng.choice([1, 1, 2])
    snaps.append(((None, MONTHS[0], 1.0, "n"), MONTHS[0]))
    apps = [(f"l{m.month}-{i}", rng.choice([f"c{rng.randrange(34)}", None]), m) for m in MONTHS for i in range(15)]
    return snaps, apps


def frames(spark, snaps, apps):
    return spark.createDataFrame([r for r, _ in snaps], SNAPS), spark.createDataFrame(apps, APPS)


def told(df):
    return sorted((tuple(r) for r in df.select("loan_id", "Customer_ID", "orig_month", "feat_snapshot", "a", "b").collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_each_month_equals_the_whole_history(spark, tmp_path, seed):
    snaps, apps = rows_of(random.Random(seed))
    schema = frames(spark, snaps[:1], apps)[0].schema
    state = state_of.asof_state(spark, str(tmp_path), schema, buckets=3)
    for month in MONTHS:
        arrived, mine = frames(spark, [s for s in snaps if s[1] == month], [a for a in apps if a[2] == month])
        so_far, _ = frames(spark, [s for s in snaps if s[1] <= month], apps)
        want = told(asof_features(mine, so_far))
        assert told(state_of.lookup(state, mine, arrived)) == want
        assert state_of.advance(state, month.isoformat(), arrived)
        assert not state_of.advance(state, month.isoformat(), arrived)
        assert told(state_of.lookup(state, mine)) == want
    assert state.read().groupBy("Customer_ID").count().where("count > 1").count() == 0


def test_late_wave_and_wrong_order(spark, tmp_path):
    snaps, apps = frames(spark, [(("c1", MONTHS[2], 3.0, "x"), None)], [("l", "c1", MONTHS[4]), ("m", "c2", MONTHS[4])])
    state = state_of.asof_state(spark, str(tmp_path), snaps.schema, buckets=2)
    empty = state_of.lookup(state, apps)
    assert [r["feat_snapshot"] for r in empty.collect()] == [None, None]
    assert state_of.advance(state, "2024-05-01", snaps)
    older, newer = (spark.createDataFrame([("c1", MONTHS[m], 9.0, "z")], SNAPS) for m in (1, 3))
    ahead = spark.createDataFrame([("c1", MONTHS[5], 9.0, "z")], SNAPS)
    assert state_of.advance(state, "2024-05-01", older.union(ahead), "late 1")
    assert told(state_of.lookup(state, apps))[0][3:] == (MONTHS[2], 3.0, "x")
    assert state_of.advance(state, "2024-05-01", newer, "late 2")
    assert told(state_of.lookup(state, apps))[0][3:] == (MONTHS[3], 9.0, "z")
    with pytest.raises(ValueError, match="already"):
        state_of.advance(state, "2024-04-01", newer)
    early = spark.createDataFrame([("l", "c1", MONTHS[3])], APPS)
    with pytest.raises(ValueError, match="older state"):
        state_of.lookup(state, early)


def test_the_state_is_not_shuffled(spark, tmp_path):
    snaps = spark.range(2000).selectExpr(
        "CAST(id AS STRING) AS Customer_ID", "DATE '2024-01-01' AS snapshot_date", "CAST(id AS DOUBLE) AS a", "'x' AS b"
    )
    state = state_of.asof_state(spark, str(tmp_path), snaps.schema, buckets=4)
    state_of.advance(state, "2024-01-01", snaps)
    apps = spark.range(3000).selectExpr(
        "CAST(id AS STRING) AS loan_id", "CAST(id % 2500 AS STRING) AS Customer_ID", "DATE '2024-01-01' AS orig_month"
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = state_of.lookup(state, apps)
        text = found._jdf.queryExecution().executedPlan().toString()
        assert found.where("feat_snapshot IS NULL").count() == 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text
    assert text.index("Exchange hashpartitioning") < text.index("Bucketed: true")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("loanloom_")]


def test_periods_read_what_arrived_in_them(spark, tmp_path):
    orders = spark.range(300).selectExpr(
        "id AS o_orderkey", "id % 40 AS o_custkey", "add_months(TIMESTAMP_NTZ '1995-01-01', CAST(id % 80 AS INT)) AS d"
    ).selectExpr("o_orderkey", "o_custkey", "CAST(d AS TIMESTAMP_NTZ) AS o_orderdate")
    lines = orders.selectExpr(
        "o_orderkey AS l_orderkey", "CAST(add_months(o_orderdate, 1) AS TIMESTAMP_NTZ) AS l_shipdate",
        "0.05D AS l_discount", "CAST(o_orderkey AS DOUBLE) AS l_quantity",
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    found = catalog.asof_incremental(spark, str(tmp_path))
    assert not [f for f in found.inputFiles() if "lineitem" in f]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, catalog.asof_features(spark, str(tmp_path)).select(found.columns).collect()), key=repr)
