"""Raw CSV to bronze, silver and gold stores, all months in one job per store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanloom import schemas as S
from loanloom.config import DEFAULTS, Settings
from loanloom.functions.cleaning import quoted
from loanloom.functions.dates import date_literal
from loanloom.operators import ledger
from loanloom.operators.calendar import run_months
from loanloom.operators.features import feature_store
from loanloom.sources.bucketed import read_bucketed, write_bucketed
from loanloom.sources.mart import Mart
from loanloom.sources.sinks import counted, observed, write_partitions
from loanloom.sources.stores import CORRUPT, raw_months, read_raw, read_store

# Raw file per source.
RAW_FILES = {
    "attributes": "features_attributes.csv",
    "financials": "features_financials.csv",
    "clickstream": "feature_clickstream.csv",
    "loans": "lms_loan_daily.csv",
}


def build_datamart(
    spark: SparkSession,
    raw_dir: str,
    mart: Mart,
    run_date: str | None = None,
    settings: Settings = DEFAULTS,
    strict_parity: bool = False,
) -> dict[str, int]:
    """Build the stores for the month of ``run_date``, or for every configured month.

    Returns the rows per store in those months; nothing is done for a month outside the span.
    """
    month = None
    if run_date is not None:
        first = run_months(spark, run_date, settings).first()
        if first is None:
            return {}
        month = first["month"].isoformat()
    written = {}

    def write(df: DataFrame, store: str, path: str, laid_out: bool = True) -> None:
        written[store] = write_partitions(df, path, "snapshot_date", laid_out)

    for source, file in RAW_FILES.items():
        raw = raw_months(read_raw(spark, f"{raw_dir}/{file}", source), month, settings)
        # Raw files mix the months.
        write(raw, f"bronze/{source}", mart.bronze(source), laid_out=month is not None)

    def bronze(source: str) -> DataFrame:
        return _month(spark.read.parquet(mart.bronze(source)), month).drop(CORRUPT)

    silver = {
        "loans": ledger.delinquency(ledger.typed_loans(bronze("loans"))),
        "attributes": ledger.typed_attributes(bronze("attributes"), strict_parity),
        "financials": ledger.typed_financials(bronze("financials"), strict_parity),
        "clickstream": ledger.typed_clickstream(bronze("clickstream")),
    }
    bucketed = month is not None and settings.store_buckets > 0
    joined = {}
    for name, df in silver.items():
        if bucketed and name != "loans":
            joined[name], written[f"silver/{name}"] = _bucketed_month(df, mart.silver(name), month, settings.store_buckets)
        else:
            write(df, f"silver/{name}", mart.silver(name))

    loans = _month(read_store(spark, mart.silver("loans"), S.SILVER_LOANS), month)
    write(ledger.label_store(loans, settings), "gold/label_store", mart.gold("label_store"))
    names = ("attributes", "financials", "clickstream")
    stores = [joined[n] if bucketed else _month(spark.read.parquet(mart.silver(n)), month) for n in names]
    # A month joined in place is one value already.
    write(feature_store(*stores), "gold/feature_store", mart.gold("feature_store"), laid_out=bucketed)
    return written


def _bucketed_month(df: DataFrame, path: str, month: str, buckets: int) -> tuple[DataFrame, int]:
    """One month of a customer store, written bucketed by customer into its partition, and read from there."""
    folder = f"{path}/snapshot_date={month}"
    rows, seen = observed(df.drop("snapshot_date"))
    write_bucketed(rows, folder, "Customer_ID", buckets)
    stored = read_bucketed(df.sparkSession, folder, _ddl(rows), "Customer_ID", buckets)
    return stored.selectExpr(*map(quoted, rows.columns), f"{date_literal(month)} AS snapshot_date"), counted(seen)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)


def _month(df: DataFrame, month: str | None) -> DataFrame:
    return df if month is None else ledger.snapshot_slice(df, month)
