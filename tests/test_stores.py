import datetime as dt

import pytest

from loanloom.session import use_checkpoint_dir
from loanloom.operators.calendar import run_months
from loanloom.operators.ledger import snapshot_counts, snapshot_slice
from loanloom.sources.sinks import export_csv, export_json, write_partitions
from loanloom.sources.stores import (
    CORRUPT, raw_months, read_csv_table, read_dated_files, read_json_table, read_raw, read_store, store_exists, union_stores,
)


def test_missing_stores_read_empty(spark, tmp_path):
    path = str(tmp_path / "none")
    for reader in (read_store, read_csv_table, read_json_table):
        df = reader(spark, path, "a int, d date")
        assert df.columns == ["a", "d"] and df.count() == 0
    assert not store_exists(spark, path)


def test_overwrite_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(spark.sql("SELECT * FROM VALUES (1, DATE '2024-01-01'), (2, DATE '2024-02-01') AS t(v, d)"), path, "d")
    write_partitions(spark.sql("SELECT 9 AS v, DATE '2024-02-01' AS d"), path, "d")
    assert sorted(r["v"] for r in read_store(spark, path, "v int, d date").collect()) == [1, 9]
    assert store_exists(spark, path)


def test_rows_are_counted_on_their_way(spark, tmp_path):
    """The write's own count equals the audit query, and costs no job of its own."""
    book = spark.sql("SELECT id, add_months(DATE '2024-01-01', CAST(id % 3 AS INT)) AS snapshot_date FROM range(1000)")
    for laid_out in (False, True):
        path = str(tmp_path / f"t{laid_out}")
        spark.sparkContext.setJobGroup(f"counted {laid_out}", "")
        assert write_partitions(book, path, "snapshot_date", laid_out) == 1000
        spark.sparkContext.setJobGroup(f"plain {laid_out}", "")
        rows = book if laid_out else book.hint("rebalance", "snapshot_date")
        rows.write.partitionBy("snapshot_date").parquet(f"{path}-plain")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs = [len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"{g} {laid_out}")) for g in ("counted", "plain")]
        assert jobs[0] == jobs[1] > 0
        audit = snapshot_counts(read_store(spark, path, book.schema))
        assert audit.selectExpr("sum(row_count)").first()[0] == 1000
    assert write_partitions(book.where("id % 3 = 1"), path, "snapshot_date") == 333
    assert write_partitions(book.where("id < 0"), path, "snapshot_date") == 0
    assert write_partitions(book.where("false"), path, "snapshot_date", laid_out=True) == 0
    assert read_store(spark, path, book.schema).count() == 1000


def test_slice_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(spark.sql("SELECT id AS v, add_months(DATE '2024-01-01', CAST(id % 3 AS INT)) AS snapshot_date FROM range(9)"), path, "snapshot_date")
    part = snapshot_slice(read_store(spark, path), "2024-02-01")
    assert part.count() == 3
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_schema_drift(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT 1 AS a").write.parquet(f"{path}/g=1")
    spark.sql("SELECT 2 AS a, 'x' AS b").write.parquet(f"{path}/g=2")
    assert sorted((r["a"], r["b"]) for r in read_store(spark, path).collect()) == [(1, None), (2, "x")]
    frames = [spark.sql("SELECT 1 AS a"), spark.sql("SELECT 'x' AS b, 2 AS a")]
    assert sorted((r["a"], r["b"]) for r in union_stores(frames).collect()) == [(1, None), (2, "x")]


def test_dated_files(spark, tmp_path):
    spark.sql("SELECT 1 AS a").write.parquet(str(tmp_path / "gold_2023_04_01.parquet"))
    spark.sql("SELECT 2 AS a").write.parquet(str(tmp_path / "gold_other.parquet"))
    got = {r["a"]: r["day"] for r in read_dated_files(spark, str(tmp_path / "*.parquet"), "day").collect()}
    assert got == {1: dt.date(2023, 4, 1), 2: None}


def test_raw_csv_keeps_bad_lines(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text("Customer_ID,Name,Age,SSN,Occupation,snapshot_date\n007,Ann,28_,1,Lawyer,2023-02-01\nbroken,line\n")
    raw = read_raw(spark, str(file), "attributes")
    rows = {r["Customer_ID"]: r for r in raw.collect()}
    assert rows["007"]["Age"] == "28_" and rows["007"][CORRUPT] is None
    assert rows["broken"][CORRUPT] == "broken,line"
    assert raw_months(raw, "2023-02-01").count() == 1 and raw_months(raw, "2023-03-01").count() == 0
    assert raw_months(raw).first()["snapshot_date"] == dt.date(2023, 2, 1)


def test_raw_csv_goes_by_header_names(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text("snapshot_date,Extra,SSN,Age,Name,Occupation,Customer_ID\n2023-02-01,7,1,28_,Ann,Lawyer,007\n")
    raw = read_raw(spark, str(file), "attributes")
    row = raw.first()
    assert (row["Customer_ID"], row["Age"], row["Extra"], row["snapshot_date"]) == ("007", "28_", "7", "2023-02-01")
    assert raw_months(raw, "2023-02-01").count() == 1
    file.write_text("Customer_ID,Name\n007,Ann\n")
    with pytest.raises(ValueError, match="lacks Age"):
        read_raw(spark, str(file), "attributes")


def test_exports(spark, tmp_path):
    df = spark.sql("SELECT * FROM VALUES (2, 'b'), (1, 'a') AS t(n, s)")
    export_csv(df, str(tmp_path / "c"), "n")
    assert [r["n"] for r in read_csv_table(spark, str(tmp_path / "c"), "n int, s string").collect()] == [1, 2]
    export_json(df, str(tmp_path / "j"))
    assert len(read_json_table(spark, str(tmp_path / "j"), "n int, s string").collect()) == 2
    (tmp_path / "meta.json").write_text('{\n  "version": "v",\n  "windows": {"a": "b"}\n}')
    meta = read_json_table(spark, str(tmp_path / "meta.json"), "version string, windows map<string,string>", True)
    assert [tuple(r) for r in meta.collect()] == [("v", {"a": "b"})]


@pytest.mark.parametrize("run_date, n", [(None, 24), ("2024-02-15", 1), ("2022-12-01", 0), ("2025-01-01", 0)])
def test_run_months(spark, run_date, n):
    assert run_months(spark, run_date).count() == n


def test_checkpoint_dir_falls_back_only_when_unset(spark, tmp_path):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert use_checkpoint_dir(spark, str(tmp_path)) == (named or str(tmp_path))
