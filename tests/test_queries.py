"""Every registered query against its checking SQL, and the plans behind the big ones."""

import pytest

from conftest import TESTDATA
from tools.run_queries import compare, connect, type_gaps
from __spark_entry__ import entry, oracle_sql, queries
from loanloom.plans.catalog import QUERIES as CORE

SF = str(TESTDATA / "sf0.001")
SLOW = {"boosted_trees"}

pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) & set(CORE)))
def test_query_matches_sql(spark, duck, name):
    frame = queries()[name](spark, SF)
    relation = duck.sql(oracle_sql()[name])
    assert compare(frame.toPandas(), relation.df()) == "ok"
    assert type_gaps(frame, relation) == ""


@pytest.mark.parametrize("name", sorted(SLOW))
def test_model_queries_run(spark, name):
    assert queries()[name](spark, SF).count() > 0


def test_all_but_the_trees_have_sql():
    assert set(CORE) <= set(queries()) and set(CORE) - set(oracle_sql()) == SLOW


def test_entry(spark):
    assert entry(spark).count() > 0


def plan(spark, name):
    return queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(CORE) - SLOW - {"model_matrix", "train_baseline_model", "score_cohorts"}))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(spark, name)
    for node in ("PythonUDF", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_scan_reads_only_what_is_used(spark):
    """Unused columns are not read, and the maturity filter runs below the join."""
    text = plan(spark, "label_store")
    assert "l_tax" not in text and "l_comment" not in text
    assert text.index("Join") < text.index("(coalesce((l_linenumber")


def test_one_month_reaches_the_scan(spark, capsys):
    queries()["snapshot_slice"](spark, SF).explain("formatted")
    text = capsys.readouterr().out
    assert "GreaterThanOrEqual(l_shipdate,1998-03-01" in text
    assert "LessThan(l_shipdate,1998-04-01" in text
    assert "l_comment" not in text and "l_returnflag" not in text
