"""Exact column statistics that stay distributed on unbounded values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.functions.cleaning import quoted

# Order-preserving buckets of a double: 4,096 per unit of asinh, at most 5.8 million,
# each cut into equal parts between its own smallest and largest value.
BUCKETS_PER_UNIT = 4_096
PARTS = 1_048_576
# asinh of the magnitude: for negative numbers the engine's own cancels digits. Capped, as
# the square inside overflows above 1e154; the second step tells the values apart.
BUCKET = f"CAST(floor(signum(value) * asinh(least(abs(value), 1e150D)) * {BUCKETS_PER_UNIT}) AS BIGINT)"


def rank_pair(n: str, p: float) -> tuple[str, str, str]:
    """Lower rank, upper rank (from zero) and weight of a linear quantile of ``n`` values.

    Whole-number arithmetic, so a quantile that falls on a value is that value.
    """
    q = Fraction(p).limit_denominator(10_000)
    position = f"(({n} - 1) * {q.numerator})"
    low = f"({position} div {q.denominator})"
    high = f"(({position} + {q.denominator - 1}) div {q.denominator})"
    return low, high, f"(({position} % {q.denominator}) / {float(q.denominator)!r}D)"


def interpolate(low: str, high: str, weight: str) -> str:
    """Between the two values; the value itself where they are equal or the weight is 0."""
    return f"CASE WHEN {weight} = 0 OR {low} = {high} THEN {low} ELSE {low} + ({high} - {low}) * {weight} END"


def melt(df: DataFrame, columns: Sequence[str], kind: str = "DOUBLE") -> DataFrame:
    """Long form (``column``, ``value``) of the values; NULL and NaN are none."""
    return (
        df.selectExpr(*[f"CAST({quoted(c)} AS {kind}) AS {quoted(c)}" for c in columns])
        .unpivot([], list(columns), "column", "value")
        .where("value IS NOT NULL" + (" AND NOT isnan(value)" if kind == "DOUBLE" else ""))
    )


def value_counts(df: DataFrame, columns: Sequence[str], kind: str = "DOUBLE") -> DataFrame:
    """Distinct values of each column with their rows (``column``, ``value``, ``n``)."""
    return melt(df, columns, kind).groupBy("column", "value").agg(F.expr("count(*) AS n"))


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    """Exact linear quantiles of many columns: one row per column, one field per prob.

    Values are counted first, then bucketed in value order. Cumulative bucket counts
    find the bucket that holds each wanted rank; those buckets are cut into parts, the
    same step finds the part, and only its values are ranked. No task sees a whole
    column, also when most values lie close together. Columns without values give no
    row.
    """
    # The filter is the one the join below implies; stated here, all uses of the counts
    # have the same plan and share one shuffle.
    bucketed = (
        value_counts(df, columns)
        .selectExpr("*", f"{BUCKET} AS bucket")
        .where("column IS NOT NULL AND bucket IS NOT NULL")
    )
    ranks = {name: rank_pair("total", p) for name, p in probs.items()}
    wanted = ", ".join(f"{low}, {high}" for low, high, _ in ranks.values())
    # At most two ranks per column and prob remain after the explode.
    held = (
        bucketed.groupBy("column", "bucket")
        .agg(F.expr("sum(n) AS bn"), F.expr("min(value) AS low"), F.expr("max(value) AS high"))
        .selectExpr(
            "*",
            "sum(bn) OVER (PARTITION BY column ORDER BY bucket) AS upto",
            "sum(bn) OVER (PARTITION BY column) AS total",
        )
        .selectExpr(
            "*",
            f"filter(array_distinct(array({wanted})), r -> r >= upto - bn AND r < upto) AS held",
        )
        .where("size(held) > 0")
        .selectExpr(
            "column", "bucket", "upto - bn AS before", "total", "low", "high",
            "explode(held) AS wanted",
        )
    )
    # Halves, so that the width does not overflow; infinite ends have parts of their own.
    width = f"(value / 2 - low / 2) / (high / 2 - low / 2) * {PARTS}"
    part = (
        "CAST(CASE WHEN value = DOUBLE('-Infinity') THEN -1 "
        f"WHEN value = DOUBLE('Infinity') THEN {PARTS + 1} "
        f"WHEN high > low AND abs(low) + abs(high) < DOUBLE('Infinity') THEN floor({width}) ELSE 0 END AS BIGINT)"
    )
    parted = bucketed.join(F.broadcast(held), ["column", "bucket"]).selectExpr(
        "column", "wanted", "before", "total", "value", "n", f"{part} AS part"
    )
    # One part per wanted rank.
    found = (
        parted.groupBy("column", "wanted", "before", "part")
        .agg(F.expr("sum(n) AS bn"))
        .selectExpr(
            "column",
            "wanted",
            "part",
            "bn",
            "before + sum(bn) OVER (PARTITION BY column, wanted ORDER BY part) AS upto",
        )
        .where("wanted >= upto - bn AND wanted < upto")
        .selectExpr("column", "wanted", "part", "upto - bn AS part_before")
    )
    at_rank = (
        parted.join(F.broadcast(found), ["column", "wanted", "part"])
        .selectExpr(
            "column",
            "total",
            "wanted",
            "value",
            "n",
            "part_before + sum(n) OVER (PARTITION BY column, wanted ORDER BY value) AS upto",
        )
        .where("wanted >= upto - n AND wanted < upto")
    )
    by_rank = at_rank.groupBy("column").agg(
        F.expr("max(total) AS total"),
        F.expr("map_from_entries(collect_list(struct(wanted, value))) AS at"),
    )
    out = [
        f"{interpolate(f'at[{low}]', f'at[{high}]', weight)} AS {name}"
        for name, (low, high, weight) in ranks.items()
    ]
    return by_rank.selectExpr("column", "total AS n", *out)


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent text of each column; the smallest text on ties."""
    best = "row_number() OVER (PARTITION BY column ORDER BY n DESC, value) AS _rn"
    return (
        value_counts(df, columns, "STRING")
        .selectExpr("*", best)
        .where("_rn = 1")
        .selectExpr("column", "value AS mode")
    )


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count, value count, mean and population deviation per column.

    One aggregate row, unpivoted; columns without values give no row.
    """
    one = df.agg(
        *[
            F.expr(
                f"named_struct('column', '{c}', 'n_rows', count(*), 'n_present', count({quoted(c)}), "
                f"'mean', avg({quoted(c)}), 'std', stddev_pop({quoted(c)})) AS {quoted(c)}"
            )
            for c in columns
        ]
    )
    listed = ", ".join(quoted(c) for c in columns)
    return one.selectExpr(f"inline(array({listed}))").where("n_present > 0")


def impute_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fit statistics of the numeric branch: median, then mean and deviation after filling.

    The moments of the filled column follow from those of its two parts, so the
    data is not read a third time.
    """
    numbers = df.selectExpr(*[f"CAST({quoted(c)} AS DOUBLE) AS {quoted(c)}" for c in columns])
    medians = exact_quantiles(numbers, columns, {"median": 0.5}).select("column", "median")
    filled = "(mean * n_present + median * (n_rows - n_present)) / n_rows AS filled_mean"
    variance = (
        "(n_present * (pow(std, 2) + pow(mean - filled_mean, 2)) "
        "+ (n_rows - n_present) * pow(median - filled_mean, 2)) / n_rows"
    )
    # Both sides have one row per column.
    return (
        moments(numbers, columns)
        .join(medians, "column")
        .selectExpr("*", filled)
        .selectExpr(
            "column",
            "n_present",
            "n_rows - n_present AS n_missing",
            "median",
            "filled_mean AS mean",
            f"sqrt({variance}) AS std",
        )
    )


def top_categories(df: DataFrame, columns: Sequence[str], limit: int = 20) -> DataFrame:
    """Categories that keep their own indicator: (column, value, n, position).

    All of them up to ``limit - 1``, else the ``limit - 1`` most frequent, later
    texts first on ties; the rest share one ``infrequent`` indicator.
    """
    place = "row_number() OVER (PARTITION BY column ORDER BY n DESC, value DESC) AS position"
    return (
        value_counts(df, columns, "STRING").selectExpr("*", place).where(f"position <= {limit - 1}")
    )
