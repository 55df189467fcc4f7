"""Model operators: preparation, candidates, scoring, baselines; fitted models are Spark ML pipelines."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.config import DEFAULTS, Settings
from loanloom.functions.cleaning import quoted
from loanloom.functions.scoring import decide, to_micro
from loanloom.operators.boosting import Boosting, fit_boosted
from loanloom.operators.logistic import PROBABILITY, fit_logistic
from loanloom.operators.metrics import class_weights, ranking_metrics, recall_threshold, score_counts
from loanloom.operators.skew import keyed_join
from loanloom.operators.stats import impute_stats, melt, modes, top_categories
from loanloom.session import scratch_dir
from loanloom.sources.stores import store_exists

T = TypeVar("T")

# In bake-off order: the first one wins ties.
CANDIDATES = ("logistic_regression", "gbt_shallow", "gbt_deep")
MAX_CATEGORIES = 20
INFREQUENT = "infrequent"

PREDICTION_COLUMNS = (
    "loan_id",
    "Customer_ID",
    "orig_month",
    "score",
    "prediction",
    "model_name",
    "model_version",
    "scored_at",
)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _number(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def _flag(column: str) -> str:
    return f"_rare_{column}"


def mark_rare(df: DataFrame, rare: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add a flag per column: its text is among the rare ones seen in training.

    ``rare`` is a table (column, value) of any size; each column is one equi-join with it.
    """
    for c in columns:
        mine = rare.where(F.col("column") == c).select(F.col("value").alias(c), F.lit(True).alias(_flag(c)))
        df = keyed_join(df, mine, [c], "left")
    return df


@dataclass(frozen=True)
class Category:
    """Fitted categorical column: its mode, the categories with an indicator of their own,
    and whether others share the infrequent one. A category never seen gets no indicator."""

    mode: str
    kept: tuple[str, ...]
    others: bool = False


@dataclass(frozen=True)
class Preparation:
    """Fitted preparation: median, mean and deviation per number, indicators per category.

    Holds a few values per column, never data. The categories that share the infrequent
    indicator are rows of the table ``rare``, however many they are: ``flagged`` joins it,
    the rest is one SQL projection, which saves and loads inside a Spark ML pipeline.
    """

    numeric: Mapping[str, tuple[float, float, float]]
    categorical: Mapping[str, Category] = field(default_factory=dict)
    rare: DataFrame | None = None

    def rare_columns(self) -> tuple[str, ...]:
        return tuple(c for c, cat in self.categorical.items() if cat.others)

    def flagged(self, df: DataFrame) -> DataFrame:
        """``df`` with what the expressions need besides its own columns."""
        return mark_rare(df, self.rare, self.rare_columns())

    def stored(self, path: str) -> Preparation:
        """The same with the rare categories written to ``path`` and read from there."""
        if not self.rare_columns():
            return self
        self.rare.write.mode("overwrite").parquet(path)
        return replace(self, rare=self.rare.sparkSession.read.schema(self.rare.schema).parquet(path))

    def expressions(self) -> dict[str, str]:
        out = {}
        for c, (median, mean, std) in self.numeric.items():
            scale = std if std > 0 else 1.0
            value = f"coalesce(CAST({quoted(c)} AS DOUBLE), {_number(median)})"
            out[f"num_{c}"] = f"({value} - {_number(mean)}) / {_number(scale)}"
        for c, cat in self.categorical.items():
            value = f"coalesce({quoted(c)}, {_text(cat.mode)})"
            for i, v in enumerate(cat.kept):
                out[f"cat_{c}_{i}"] = f"CAST({value} = {_text(v)} AS DOUBLE)"
            if cat.others:
                missing = str(cat.mode not in cat.kept).lower()
                test = f"CASE WHEN {quoted(c)} IS NULL THEN {missing} ELSE coalesce({quoted(_flag(c))}, false) END"
                out[f"cat_{c}_{INFREQUENT}"] = f"CAST({test} AS DOUBLE)"
        return out

    def columns(self) -> list[str]:
        return [f"{e} AS {quoted(name)}" for name, e in self.expressions().items()]

    def stages(self) -> list:
        return [
            SQLTransformer(statement=f"SELECT *, {', '.join(self.columns())} FROM __THIS__"),
            VectorAssembler(inputCols=list(self.expressions()), outputCol="features"),
        ]


@dataclass(frozen=True)
class Fitted:
    """A fitted candidate: its pipeline and the rare categories it flags first."""

    pipeline: PipelineModel
    rare: DataFrame | None = None
    rare_columns: tuple[str, ...] = ()

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(mark_rare(df, self.rare, self.rare_columns))

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        if self.rare_columns:
            for c in self.rare_columns:
                self.rare.where(F.col("column") == c).write.mode("overwrite").parquet(f"{path}/rare/{c}")


def load_fitted(spark: SparkSession, path: str, categorical: Sequence[str]) -> Fitted:
    """What ``Fitted.save`` wrote, for a model with these categorical inputs."""
    columns = tuple(c for c in categorical if store_exists(spark, f"{path}/rare/{c}"))
    tables = [spark.read.parquet(f"{path}/rare/{c}") for c in columns]
    rare = reduce(DataFrame.union, tables) if tables else None
    return Fitted(PipelineModel.load(f"{path}/pipeline"), rare, columns)


def fit_preparation(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    max_categories: int = MAX_CATEGORIES,
) -> Preparation:
    """Fit the preparation; columns without any value are left out.

    Reads back one row per numeric column, and per categorical one its mode and at most
    ``max_categories - 1`` kept categories.
    """
    numbers = {}
    if numeric:
        rows = {r["column"]: r for r in impute_stats(df, numeric).collect()}
        numbers = {
            c: (rows[c]["median"], rows[c]["mean"], rows[c]["std"]) for c in numeric if c in rows
        }
    cats, rare = {}, None
    if categorical:
        kept: dict[str, list[str]] = {}
        for r in top_categories(df, categorical, max_categories).collect():
            kept.setdefault(r["column"], []).append(r["value"])
        first = {r["column"]: r["mode"] for r in modes(df, categorical).collect()}
        full = [c for c in categorical if len(kept.get(c, ())) == max_categories - 1]
        others = set()
        if full:
            rare = _rare(df, {c: kept[c] for c in full})
            others = {r["column"] for r in rare.select("column").distinct().collect()}
        cats = {c: Category(first[c], tuple(sorted(kept[c])), c in others) for c in categorical if c in kept}
    return Preparation(numbers, cats, rare)


def _rare(df: DataFrame, kept: Mapping[str, Sequence[str]]) -> DataFrame:
    """(column, value) of the categories without an indicator of their own."""
    mine = " OR ".join(
        f"(column = {_text(c)} AND value IN ({', '.join(map(_text, values))}))" for c, values in kept.items()
    )
    return melt(df, list(kept), "STRING").where(f"NOT ({mine})").distinct()


def boosting(name: str, settings: Settings = DEFAULTS, max_iter: int | None = None) -> Boosting:
    """Parameters of a boosted candidate. ``max_iter`` shortens the run."""
    common = {"rate": 0.05, "reg_lambda": 1.0, "columns": 0.8, "seed": settings.seed}
    if name == "gbt_shallow":
        return Boosting(trees=max_iter or 300, depth=3, gamma=0.1, min_weight=5.0, subsample=0.8, **common)
    if name == "gbt_deep":
        return Boosting(trees=max_iter or 400, depth=4, min_rows=40, **common)
    raise ValueError(f"unknown candidate {name!r}")


def fit_candidate(
    name: str,
    train: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    settings: Settings = DEFAULTS,
    preparation: Preparation | None = None,
    max_iter: int | None = None,
    folder: str | None = None,
) -> Fitted:
    """Fit one candidate on labelled rows, classes weighted against their imbalance.

    Boosted candidates keep tables in ``folder``, by default a new one beside the checkpoints.
    """
    prepared = preparation or fit_preparation(train, numeric, categorical)
    per_class = {r["label"]: r for r in class_weights(train).collect()}
    if set(per_class) != {0, 1}:
        raise ValueError("training needs both classes")
    if name == "logistic_regression":
        weights = {k: r["balanced_weight"] for k, r in per_class.items()}
    else:
        weights = {0: 1.0, 1: per_class[1]["scale_pos_weight"]}
    weight = f"CASE WHEN label = 1 THEN {_number(weights[1])} ELSE {_number(weights[0])} END"
    key = "loan_id" if "loan_id" in train.columns else None
    ready = prepared.flagged(train).selectExpr(*prepared.columns(), "label", *([key] if key else []))
    inputs = list(prepared.expressions())
    if name == "logistic_regression":
        # The penalty of one is on the summed loss.
        fitted = fit_logistic(ready, inputs, weight=weight)
    else:
        params = boosting(name, settings, max_iter)
        where = folder or scratch_dir(train.sparkSession, name)
        fitted = fit_boosted(ready, inputs, where, params, weight=weight, key=key)
    stages = [*prepared.stages(), fitted.stage()]
    return Fitted(PipelineModel(stages), prepared.rare, prepared.rare_columns())


def bake_off(spark: SparkSession, names: Sequence[str], fit: Callable[[str], T], parallel: bool = True) -> dict[str, T]:
    """What ``fit`` makes of each candidate, in the order of the names.

    Side by side, each in a scheduler pool of its own, as the jobs of a fit are many and short: in a session with
    fair scheduling they share the executors, and all are done when the slowest is. The first
    failure is raised once all have ended.
    """
    if not parallel or len(names) < 2:
        return {name: fit(name) for name in names}

    def pooled(name: str) -> T:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return fit(name)

    with ThreadPoolExecutor(len(names)) as pool:
        done = [pool.submit(inheritable_thread_target(spark)(pooled), name) for name in names]
    return {name: d.result() for name, d in zip(names, done)}


def score(model: Fitted, df: DataFrame) -> DataFrame:
    """``df`` with ``score``, the probability of default to six decimals.

    Models saved by earlier versions of this library end in a Spark ML classifier.
    """
    out = model.transform(df)
    chance = F.col(PROBABILITY) if PROBABILITY in out.columns else vector_to_array("probability")[1]
    return out.select(*df.columns, F.round(chance, 6).alias("score"))


def predictions(scored: DataFrame, model_name: str, version: str, threshold: float) -> DataFrame:
    """Scored applications as prediction rows with their provenance."""
    return scored.selectExpr(
        "*",
        f"{decide('score', threshold)} AS prediction",
        f"{_text(model_name)} AS model_name",
        f"{_text(version)} AS model_version",
        "current_timestamp() AS scored_at",
    ).select(*PREDICTION_COLUMNS)


def split_metrics(model: Fitted, rows: DataFrame, digits: int | None = 4) -> DataFrame:
    """Metric bundle per ``split`` of labelled rows."""
    return ranking_metrics(score_counts(score(model, rows), ["split"]), ["split"], digits)


def split_threshold(
    model: Fitted, rows: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    counts = score_counts(score(model, rows), ["split"])
    return recall_threshold(counts, ["split"], settings.target_recall)


def baseline_counts(scored: DataFrame) -> DataFrame:
    """Training score baseline per version, kept as a histogram."""
    return (
        scored.where("score IS NOT NULL")
        .groupBy("model_version", F.expr(f"{to_micro('score')} AS micro"))
        .agg(F.expr("count(*) AS n"))
    )
