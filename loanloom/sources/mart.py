"""Where the mart keeps its stores, and the readers of its small tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession

from loanloom import schemas as S
from loanloom.sources.stores import read_store
from loanloom.sources.versioned import VersionedTable


@dataclass(frozen=True)
class Mart:
    """Folder layout under one root, on storage every executor reaches."""

    root: str

    def bronze(self, table: str) -> str:
        return f"{self.root}/bronze/{table}"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    def bank(self, name: str) -> str:
        return f"{self.root}/model_bank/{name}"

    def report(self, name: str) -> str:
        return f"{self.root}/reports/{name}"


def registry_table(spark: SparkSession, mart: Mart) -> VersionedTable:
    """One row per model version, the last one written."""
    return VersionedTable(spark, mart.bank("registry"), S.REGISTRY)


def leaderboard_table(spark: SparkSession, mart: Mart) -> VersionedTable:
    """Rows of the last bake-off of every training month."""
    return VersionedTable(spark, mart.bank("leaderboard"), S.LEADERBOARD)


def champion_table(spark: SparkSession, mart: Mart) -> VersionedTable:
    """Metadata of every model version that went into production."""
    return VersionedTable(spark, mart.bank("champions"), S.CHAMPION)


def read_registry(spark: SparkSession, mart: Mart) -> DataFrame:
    return registry_table(spark, mart).read()


def read_leaderboard(spark: SparkSession, mart: Mart) -> DataFrame:
    """Rows of the last bake-off."""
    rows = leaderboard_table(spark, mart).read()
    return rows.join(rows.selectExpr("max(trained_at) AS trained_at"), "trained_at")


def read_monitoring(spark: SparkSession, mart: Mart) -> DataFrame:
    return read_store(spark, mart.gold("model_monitoring"), S.MONITORING)


def read_baselines(spark: SparkSession, mart: Mart) -> DataFrame:
    return read_store(spark, mart.bank("baselines"), S.BASELINES)


def champion(spark: SparkSession, mart: Mart) -> Row | None:
    """Metadata of the model in production, the last one trained; None before the first."""
    rows = champion_table(spark, mart).read()
    return rows.orderBy("trained_at", ascending=False).limit(1).first()
