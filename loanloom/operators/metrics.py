"""Exact ranking and drift metrics from score histograms.

Rows are first counted per group and distinct score (millionths), combined
map-side. Everything after that works on at most 1,000,001 rows per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.functions.scoring import MICRO, from_micro, psi_of_shares, to_micro
from loanloom.operators.stats import interpolate, rank_pair

BINS = 10


def exprs(*texts: str) -> list:
    return [F.expr(t) for t in texts]


def score_counts(
    df: DataFrame,
    by: Sequence[str],
    score: str = "score",
    label: str | None = "label",
    prediction: str | None = None,
) -> DataFrame:
    """Histogram (by..., micro, n, bad, good[, positive]).

    ``bad`` and ``good`` count labelled rows only; ``n`` counts all rows.
    """
    aggs = ["count(*) AS n"]
    if label:
        aggs += [
            f"count_if(CAST({label} AS INT) = 1) AS bad",
            f"count_if(CAST({label} AS INT) = 0) AS good",
        ]
    if prediction:
        aggs.append(f"sum(CAST({prediction} AS BIGINT)) AS positive")
    return df.groupBy(*by, F.expr(f"{to_micro(score)} AS micro")).agg(*exprs(*aggs))


def cumulate(hist: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add ``cum_bad`` and ``cum_good`` from the highest score down, and the totals.

    Rows without a score keep their counts ``bad`` and ``good`` and rank nowhere:
    ``ranked_bad`` and ``ranked_good`` are 0 there.
    """
    group = f"PARTITION BY {', '.join(by)}"
    down = f"({group} ORDER BY micro DESC)"
    ranked = hist.selectExpr(
        "*", *[f"CASE WHEN micro IS NULL THEN 0 ELSE {c} END AS ranked_{c}" for c in ("bad", "good")]
    )
    return ranked.selectExpr(
        "*",
        f"sum(ranked_bad) OVER {down} AS cum_bad",
        f"sum(ranked_good) OVER {down} AS cum_good",
        f"sum(ranked_bad) OVER ({group}) AS all_bad",
        f"sum(ranked_good) OVER ({group}) AS all_good",
    )


def ranking_aggs() -> dict[str, str]:
    """AUC, average precision and KS as aggregates over ``cumulate`` rows.

    Area: a bad row beats every good row scored lower and half of those scored
    equal. Average precision is the step-wise sum of precision over recall gains.
    KS compares the two distributions at distinct scores.
    """
    both = "max(all_bad) > 0 AND max(all_good) > 0"
    not_beaten = "sum(CAST(ranked_bad AS DOUBLE) * (cum_good - ranked_good / 2D))"
    pairs = "(CAST(max(all_bad) AS DOUBLE) * max(all_good))"
    precision = "sum(CASE WHEN ranked_bad > 0 THEN ranked_bad * (cum_bad / (cum_bad + cum_good)) END)"
    gap = "abs(cum_bad / greatest(all_bad, 1) - cum_good / greatest(all_good, 1))"
    return {
        "auc": f"CASE WHEN {both} THEN 1 - {not_beaten} / {pairs} END",
        "auc_pr": f"CASE WHEN {both} THEN {precision} / max(all_bad) END",
        "ks": f"CASE WHEN {both} THEN max({gap}) END",
    }


def ranking_metrics(hist: DataFrame, by: Sequence[str], digits: int | None = 4) -> DataFrame:
    """Metric bundle per group: auc, auc_pr, gini, ks, bad_rate, n.

    Groups with one class keep their bad rate and count; the rest is NULL.
    """
    bundle = [f"{e} AS {name}" for name, e in ranking_aggs().items()]
    counts = ["sum(bad) AS bad", "sum(bad) + sum(good) AS n"]
    out = cumulate(hist, by).groupBy(*by).agg(*exprs(*bundle, *counts))
    values = {
        "auc": "auc",
        "auc_pr": "auc_pr",
        "gini": "2 * auc - 1",
        "ks": "ks",
        "bad_rate": "try_divide(bad, n)",
    }
    return out.selectExpr(*by, *[f"{round_to(e, digits)} AS {c}" for c, e in values.items()], "n")


def round_to(expr: str, digits: int | None) -> str:
    return expr if digits is None else f"round({expr}, {digits})"


def recall_threshold(
    hist: DataFrame, by: Sequence[str], target: float = 0.75, digits: int | None = 4
) -> DataFrame:
    """Per group the threshold with the best precision among those reaching the recall.

    The lowest threshold wins ties; 0.5 when the group has one class only.
    """
    reached = (
        "all_bad > 0 AND all_good > 0 AND ranked_bad + ranked_good > 0 "
        f"AND cum_bad / all_bad >= {float(target)!r}D"
    )
    candidate = "struct(cum_bad / (cum_bad + cum_good) AS precision, -micro AS neg)"
    picked = cumulate(hist, by).groupBy(*by).agg(
        F.expr(f"max(CASE WHEN {reached} THEN {candidate} END) AS pick")
    )
    threshold = f"coalesce({from_micro('-pick.neg')}, 0.5D)"
    return picked.selectExpr(*by, f"{round_to(threshold, digits)} AS threshold")


def baseline_shape(baseline: DataFrame, by: str = "model_version", bins: int = BINS) -> DataFrame:
    """Inner quantile edges (in millionths) and bin shares of each baseline histogram.

    One row per version: ``edges`` has ``bins - 1`` entries, ``expected`` has ``bins``.
    An edge lies on the value at its rank or between it and the next one, so the rows
    below it are known from the cumulative count there; no second pass bins the rows.
    """
    cum = (
        baseline.groupBy(by, "micro")
        .agg(F.expr("sum(n) AS n"))
        .selectExpr(
            by,
            "micro",
            "n",
            f"sum(n) OVER (PARTITION BY {by} ORDER BY micro) AS upto",
            f"sum(n) OVER (PARTITION BY {by}) AS total",
        )
    )
    found, edges, below = ["max(total) AS total"], [], []
    for i in range(1, bins):
        low, high, weight = rank_pair("total", i / bins)
        point = "named_struct('v', CAST(micro AS DOUBLE), 'before', upto - n, 'upto', upto)"
        found += [
            f"min(CASE WHEN upto > {low} THEN {point} END) AS lo{i}",
            f"min(CASE WHEN upto > {high} THEN CAST(micro AS DOUBLE) END) AS hi{i}",
        ]
        edges.append(interpolate(f"lo{i}.v", f"hi{i}", weight))
        below.append(f"CASE WHEN {weight} > 0 AND hi{i} > lo{i}.v THEN lo{i}.upto ELSE lo{i}.before END")
    steps = zip([*below, "total"], ["CAST(0 AS BIGINT)", *below])
    shares = [f"(({upper}) - ({lower})) / total" for upper, lower in steps]
    return (
        cum.groupBy(by)
        .agg(*exprs(*found))
        .selectExpr(
            by, f"array({', '.join(edges)}) AS edges", f"array({', '.join(shares)}) AS expected"
        )
    )


def bin_of(micro: str, edges: str, bins: int = BINS) -> str:
    """Bin number from zero: how many edges are at or below the score; NULL without edges."""
    return " + ".join(f"CAST({micro} >= {edges}[{i}] AS INT)" for i in range(bins - 1))


def bin_sums(n: str = "n", bin_id: str = "bin", bins: int = BINS) -> list[str]:
    """Aggregates ``b0`` and on: rows per bin. Plain sums keep empty bins at zero, so no
    list of bins has to be joined in."""
    return [f"coalesce(sum(CASE WHEN {bin_id} = {i} THEN {n} END), 0) AS b{i}" for i in range(bins)]


def with_baseline(
    rows: DataFrame, shape: DataFrame, what: str, production_version: str | None = None
) -> DataFrame:
    """Attach ``what`` of the baseline (``edges`` or ``expected``) of the row's own version, else of production's.

    A shape is one row of a few numbers per model version, so it goes to the rows by broadcast:
    a shuffle by version would put all rows of a version, or of all versions without a
    baseline of their own, into one task.
    """
    own = shape.select("model_version", what)
    joined = rows.join(F.broadcast(own), "model_version", "left")
    if production_version is None:
        return joined.selectExpr(*rows.columns, what)
    fallback = own.where(F.col("model_version") == production_version).selectExpr(
        "model_version AS _fallback", f"{what} AS _{what}"
    )
    missing = F.when(F.col(what).isNull(), F.lit(production_version))
    return (
        joined.withColumn("_fallback", missing)
        .join(F.broadcast(fallback), "_fallback", "left")
        .selectExpr(*rows.columns, f"coalesce({what}, _{what}) AS {what}")
    )


def with_bin(
    hist: DataFrame, shape: DataFrame, production_version: str | None = None, bins: int = BINS
) -> DataFrame:
    """Attach ``bin``, the score's place among the edges; the shares follow once rows are counted."""
    placed = with_baseline(hist, shape, "edges", production_version)
    return placed.selectExpr(*hist.columns, f"{bin_of('micro', 'edges', bins)} AS bin")


def psi_value(binned: str, total: str, expected: str) -> str:
    """PSI from an array of rows per bin; NULL without a baseline."""
    return psi_of_shares(f"transform({binned}, b -> b / {total})", expected)


def psi_by_group(
    hist: DataFrame,
    baseline: DataFrame,
    by: Sequence[str],
    production_version: str | None = None,
    digits: int | None = 4,
    bins: int = BINS,
) -> DataFrame:
    """Population stability of each group's scores against its version's baseline."""
    known = hist.where("micro IS NOT NULL")
    shape = baseline_shape(baseline, bins=bins)
    # Bins are counted per version before the shares join, so no row carries an array.
    versions = dict.fromkeys([*by, "model_version"])
    counted = with_bin(known, shape, production_version, bins).groupBy(*versions).agg(
        *exprs("sum(n) AS n", *bin_sums(bins=bins))
    )
    listed = [f"b{i}" for i in range(bins)]
    binned = with_baseline(counted, shape, "expected", production_version).groupBy(*by).agg(
        *exprs("sum(n) AS n", "max(expected) AS expected", *[f"sum({b}) AS {b}" for b in listed])
    ).selectExpr(*by, "n", "expected", f"array({', '.join(listed)}) AS binned")
    psi = round_to(psi_value("binned", "n", "expected"), digits)
    return binned.selectExpr(*by, "n", f"{psi} AS psi")


def score_histogram(hist: DataFrame, by: Sequence[str], bins: int = 25) -> DataFrame:
    """Density over equal bins on [0, 1], the last one closed; other scores are left out.

    Only bins with rows are listed.
    """
    bin_id = f"CAST(least((micro * {bins}) div {MICRO} + 1, {bins}) AS INT) AS bin"
    binned = (
        hist.where(f"micro BETWEEN 0 AND {MICRO}")
        .groupBy(*by, F.expr(bin_id))
        .agg(F.expr("sum(n) AS n"))
    )
    density = f"n * {bins} / sum(n) OVER (PARTITION BY {', '.join(by)}) AS density"
    return binned.selectExpr(*by, "bin", "n", density)


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Per class its rows, balanced weight n / (classes * rows) and the negative-to-positive ratio."""
    counts = (
        df.where(f"{label} IS NOT NULL")
        .groupBy(F.expr(f"CAST({label} AS INT) AS label"))
        .agg(F.expr("count(*) AS n"))
    )
    # The window covers one row per class.
    return counts.selectExpr(
        "label",
        "n",
        "sum(n) OVER () / (count(*) OVER () * n) AS balanced_weight",
        "sum(CASE WHEN label = 0 THEN n ELSE 0 END) OVER () "
        "/ greatest(sum(CASE WHEN label = 1 THEN n ELSE 0 END) OVER (), 1) AS scale_pos_weight",
    )
