"""Skew-safe joins against the plain ones, with and without hot keys."""

import datetime as dt
import random

import pandas as pd
import pytest

from loanloom.operators.asof import asof_join
from loanloom.operators.skew import keyed_join, latest_per
from loanloom.streaming.incremental import unseen_cohorts


def rows(df):
    return sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(3)
    left = [(rng.choice(["hot"] * 5 + [None] + [f"k{i}" for i in range(40)]), i) for i in range(600)]
    left += [("hot", 1)] * 50
    right = [("hot", "H")] + [(f"k{i}", str(i)) for i in range(30)] + [(None, "n")]
    many = right + [("k1", "again")] * 60 + [("absent", "x")] * 60
    return (
        spark.createDataFrame(left, "k string, v int").repartition(3),
        spark.createDataFrame(right, "k string, r string"),
        spark.createDataFrame(many, "k string, r string"),
    )


@pytest.mark.parametrize("how", ["left", "inner"])
def test_keyed_join_equals_join(sides, how, spark):
    left, right, many = sides
    third = spark.createDataFrame([("hot", 1.5), ("k2", 2.5)], "k string, z double")
    got = keyed_join(left, right, ["k"], how)
    assert got.columns == ["k", "v", "r"]
    assert rows(got) == rows(left.join(right, "k", how))
    got = keyed_join(left, many, ["k"], how, third)
    assert rows(got) == rows(left.join(many, "k", how).join(third, "k", how))


def test_keyed_join_reads_once(sides):
    left, right, _ = sides
    with pytest.raises(ValueError):
        keyed_join(left, right, ["k"], "full")
    plan = keyed_join(left, right, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") + plan.count("Repartition") <= 4


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_asof_equals_pandas(spark):
    rng = random.Random(5)
    left = [(rng.choice("abcdX"), day(rng.randint(0, 60)), i) for i in range(300)]
    right = {(rng.choice("abcd"), day(rng.randint(5, 55))): rng.random() for _ in range(60)}
    lp = pd.DataFrame(left, columns=["k", "t", "i"]).assign(t=lambda d: pd.to_datetime(d.t))
    rp = pd.DataFrame([(*k, v) for k, v in right.items()], columns=["k", "ft", "x"]).assign(ft=lambda d: pd.to_datetime(d.ft))
    want = pd.merge_asof(lp.sort_values("t"), rp.sort_values("ft"), by="k", left_on="t", right_on="ft")
    want = sorted((r.i, None if pd.isna(r.x) else r.x) for r in want.itertuples())
    got = asof_join(
        spark.createDataFrame(left, "k string, t date, i int"),
        spark.createDataFrame([(*k, v) for k, v in right.items()], "k string, ft date, x double"),
        "k", "t", "ft",
    )
    assert sorted((r["i"], r["x"]) for r in got.collect()) == want
    assert got.where("ft > t").count() == 0


def test_asof_keeps_rows_without_key(spark):
    left = spark.createDataFrame([(None, day(1)), ("a", None), ("a", day(3))], "k string, t date")
    right = spark.createDataFrame([("a", day(3), 1), (None, day(0), 2)], "k string, ft date, x int")
    assert sorted((r["x"] or 0) for r in asof_join(left, right, "k", "t", "ft").collect()) == [0, 0, 1]


def test_asof_reads_the_right_side_once(spark):
    left = spark.range(50).selectExpr("CAST(id % 9 AS STRING) AS k", "date_add(DATE '2024-01-01', CAST(id AS INT)) AS t")
    right = spark.range(77).selectExpr(
        "CAST(id % 7 AS STRING) AS k", "date_add(DATE '2024-01-01', CAST(id AS INT)) AS ft", "id AS x", "CAST(NULL AS STRING) AS y"
    )
    got = asof_join(left, right, "k", "t", "ft")
    assert got._jdf.queryExecution().executedPlan().toString().count("Range (0, 77,") == 1
    assert got.count() == 50 and got.where("x IS NULL").count() == got.where("ft IS NULL").count() < 50


def test_latest_per_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    out = latest_per(df, ["k"], ["v"])
    assert rows(out) == rows(df.groupBy("k").agg({"v": "max"}).toDF("k", "v"))
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_unseen_cohorts(spark):
    scored = spark.createDataFrame([(1, day(0)), (2, day(31)), (3, None)], "id int, orig_month date")
    done = spark.createDataFrame([(day(0),), (None,)], "orig_month date")
    assert [r["id"] for r in unseen_cohorts(scored, done).collect()] == [2]
    assert unseen_cohorts(scored, scored).count() == 0
