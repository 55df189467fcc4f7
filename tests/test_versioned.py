"""Versioned tables: writers in turn, writers that die, old versions, and clearing up."""

import json
import threading

import pytest

from loanloom.sources import versioned
from loanloom.sources.files import names
from loanloom.sources.versioned import Manifest, VersionedTable
from loanloom.operators import governance

SCHEMA = "model_version string, n int, seq int"


def rows(spark, *values):
    return spark.createDataFrame(values, SCHEMA)


def held(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"), SCHEMA)


def test_empty_and_appended(spark, table):
    assert table.manifest() == Manifest() and held(table.read()) == []
    assert table.append(rows(spark, ("a", 1, 1)), "one") and not table.append(rows(spark, ("a", 9, 9)), "one")
    assert table.append(rows(spark).limit(0), "none")
    assert table.append(rows(spark, ("b", 2, 1)), "007")
    assert held(table.read()) == [("a", 1, 1), ("b", 2, 1)]
    assert table.manifest().batches == ("one", "none", "007")


def test_upserts_keep_one_part_and_old_versions_stay_readable(spark, table):
    seen = []
    for seq in range(1, 4):
        new = rows(spark, ("a", seq * 10, seq), (f"v{seq}", seq, seq))
        table.replace(lambda old, new=new: governance.registry_upsert(old, new))
        seen.append(table.manifest())
    assert held(table.read()) == [("a", 30, 3), ("v1", 1, 1), ("v2", 2, 2), ("v3", 3, 3)]
    assert [len(m.parts) for m in seen] == [1, 1, 1] and [m.version for m in seen] == [1, 2, 3]
    assert held(table.read(seen[0])) == [("a", 10, 1), ("v1", 1, 1)]


def test_a_writer_that_dies_leaves_the_old_version(spark, table, monkeypatch):
    table.append(rows(spark, ("a", 1, 1)), "one")

    def died(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(VersionedTable, "_put", died)
    for step in (lambda: table.append(rows(spark, ("b", 2, 2)), "two"), lambda: table.replace(lambda old: old.where("false"))):
        with pytest.raises(KeyboardInterrupt):
            step()
    monkeypatch.undo()
    assert held(table.read()) == [("a", 1, 1)] and table.manifest().batches == ("one",)
    # Its batch counts once when it is sent again.
    assert table.append(rows(spark, ("b", 2, 2)), "two") and held(table.read()) == [("a", 1, 1), ("b", 2, 2)]


def test_the_slower_of_two_writers_starts_again(spark, table):
    table.append(rows(spark, ("a", 1, 1)), "one")
    calls = []

    def change(old):
        calls.append(held(old))
        if len(calls) == 1:
            # Another writer comes in between.
            VersionedTable(spark, table.root, SCHEMA).append(rows(spark, ("b", 2, 1)), "other")
        return governance.registry_upsert(old, rows(spark, ("c", 3, 1)))

    table.replace(change)
    assert calls == [[("a", 1, 1)], [("a", 1, 1), ("b", 2, 1)]]
    assert held(table.read()) == [("a", 1, 1), ("b", 2, 1), ("c", 3, 1)]
    assert not table._put(Manifest(2, ("x",), ()))


def test_writers_at_the_same_time_lose_nothing(spark, table):
    errors = []

    def work(k):
        try:
            table.append(rows(spark, (f"w{k}", k, k)), f"batch {k}")
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=work, args=(k,)) for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and held(table.read()) == [(f"w{k}", k, k) for k in range(4)]
    assert table.manifest().version == 4


def test_a_part_is_gone_only_when_no_kept_version_has_it(spark, table):
    table.append(rows(spark, ("a", 1, 1)), "one")
    table.replace(lambda old: old.selectExpr("model_version", "n + 1 AS n", "seq"))
    table.replace(lambda old: old.selectExpr("model_version", "n + 1 AS n", "seq"))
    assert table.vacuum(keep=2) == []
    gone = table.vacuum(keep=2, older_than_hours=-1)
    assert len(gone) == 1 and len(names(spark, f"{table.root}/parts")) == 2
    assert table.vacuum(keep=1, older_than_hours=-1) and held(table.read()) == [("a", 3, 1)]
    assert len(names(spark, f"{table.root}/manifests")) == 1


def test_drafts_are_no_versions(spark, table, tmp_path):
    table.append(rows(spark, ("a", 1, 1)), "one")
    (tmp_path / "t/manifests/.abc").write_text(json.dumps({"version": 9})[:5])
    assert table.manifest().version == 1 and held(table.read()) == [("a", 1, 1)]
    assert versioned.TRIES > 1
