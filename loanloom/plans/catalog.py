"""Registered queries: every operator run over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.config import CATEGORICAL, CLIP_BOUNDS, DIRTY_NUMERIC, Settings
from loanloom.functions import cleaning, dates
from loanloom.functions.cleaning import quoted
from loanloom.functions.scoring import from_micro
from loanloom.operators import asof_state, boosting, calendar, features, governance, ledger, metrics, model, monitor, monitor_state, stats
from loanloom.plans import adapters as A
from loanloom.session import scratch_dir
from loanloom.sources.sinks import stored, write_partitions
from loanloom.sources.stores import union_stores
from loanloom.streaming import catchup
from loanloom.streaming.incremental import unseen_cohorts

Query = Callable[[SparkSession, str], DataFrame]

# Governance dates moved to the years the given tables cover.
SETTINGS = Settings(snapshot_start="1995-01-01", snapshot_end="2001-12-01", anchor="1996-06-01")
TRAIN_MONTH = "2001-06-01"
DIGITS = 6
MODEL_INPUTS = ["avg_discount", "avg_quantity", "n_lines"]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    kept = [f"round({c}, {DIGITS}) AS {c}" if c in columns else quoted(c) for c in df.columns]
    return df.selectExpr(*kept)


# --- scans, types, ledger ---------------------------------------------------------


@query
def snapshot_slice(spark, sf_dir):
    month = "1998-03-01"
    return ledger.snapshot_slice(A.ledger(spark, sf_dir, month), month)


@query
def snapshot_counts(spark, sf_dir):
    return ledger.snapshot_counts(A.ledger(spark, sf_dir))


@query
def typed_loans(spark, sf_dir):
    return ledger.typed_loans(A.raw_ledger(spark, sf_dir))


@query
def store_scan(spark, sf_dir):
    """Two generations of a store; the older one lacks two columns."""
    book = A.ledger(spark, sf_dir)
    older = book.where("snapshot_date < DATE '1998-01-01'").drop("balance", "tenure")
    newer = book.where("snapshot_date >= DATE '1998-01-01'")
    return union_stores([older, newer]).select(sorted(book.columns))


@query
def typed_financials(spark, sf_dir):
    return ledger.typed_financials(A.financials(spark, sf_dir)).select(
        "Customer_ID", "Annual_Income", "Monthly_Inhand_Salary", "Outstanding_Debt", "snapshot_date"
    )


@query
def typed_financials_strict(spark, sf_dir):
    return ledger.typed_financials(A.financials(spark, sf_dir), strict_parity=True).select(
        "Customer_ID", "Annual_Income", "Monthly_Inhand_Salary", "Outstanding_Debt", "snapshot_date"
    )


@query
def pii_drop(spark, sf_dir):
    return ledger.typed_attributes(A.attributes(spark, sf_dir))


@query
def delinquency(spark, sf_dir):
    return ledger.delinquency(A.ledger(spark, sf_dir))


@query
def label_store(spark, sf_dir):
    return ledger.label_store(ledger.delinquency(A.ledger(spark, sf_dir)))


@query
def applications(spark, sf_dir):
    return ledger.applications(ledger.delinquency(A.ledger(spark, sf_dir)))


@query
def ledger_issues(spark, sf_dir):
    return ledger.ledger_issues(A.ledger(spark, sf_dir))


# --- cleaning ---------------------------------------------------------------------


@query
def clean_numeric(spark, sf_dir):
    both = A.customers(spark, sf_dir)
    return both.selectExpr(
        "Customer_ID", *[f"{cleaning.clean_numeric(c)} AS {c}" for c in DIRTY_NUMERIC]
    )


@query
def clean_category(spark, sf_dir):
    return A.customers(spark, sf_dir).selectExpr(
        "Customer_ID", *[f"{cleaning.clean_category(c)} AS {c}" for c in CATEGORICAL]
    )


@query
def credit_history_months(spark, sf_dir):
    months = cleaning.credit_history_months("Credit_History_Age")
    return A.financials(spark, sf_dir).selectExpr(
        "Customer_ID", f"{months} AS credit_history_months"
    )


@query
def count_loan_types(spark, sf_dir):
    items = cleaning.count_list_items("Type_of_Loan")
    return A.financials(spark, sf_dir).selectExpr("Customer_ID", f"{items} AS num_loan_types")


@query
def sentinel_clip(spark, sf_dir):
    numbers = A.customers(spark, sf_dir).selectExpr(
        "Customer_ID", *[f"{cleaning.clean_numeric(c)} AS {c}" for c in CLIP_BOUNDS]
    )
    return numbers.selectExpr(
        "Customer_ID", *[f"{cleaning.clip(c, *b)} AS {c}" for c, b in CLIP_BOUNDS.items()]
    )


@query
def affordability_ratios(spark, sf_dir):
    ready = features.prepare_features(A.financials(spark, sf_dir))
    return rounded(
        ready.select("Customer_ID", "emi_to_salary", "debt_to_income"),
        "emi_to_salary",
        "debt_to_income",
    )


@query
def prepare_features(spark, sf_dir):
    ready = features.prepare_features(A.customers(spark, sf_dir).drop("Name", "SSN"))
    return rounded(ready, "emi_to_salary", "debt_to_income")


# --- feature store ----------------------------------------------------------------


@query
def clickstream_agg(spark, sf_dir):
    return features.clickstream_agg(A.clicks(spark, sf_dir))


def _feature_store(spark, sf_dir):
    attrs = ledger.typed_attributes(A.attributes(spark, sf_dir))
    fins = ledger.typed_financials(A.financials(spark, sf_dir)).where("Num_of_Loan IS NOT NULL")
    return features.feature_store(attrs, fins, A.clicks(spark, sf_dir))


@query
def feature_store(spark, sf_dir):
    return _feature_store(spark, sf_dir)


@query
def latest_features(spark, sf_dir):
    return features.latest_features(A.snapshots(spark, sf_dir))


@query
def dedupe_snapshots(spark, sf_dir):
    return features.dedupe_snapshots(A.snapshot_rows(spark, sf_dir))


def _labels(spark, sf_dir):
    return ledger.label_store(ledger.delinquency(A.ledger(spark, sf_dir)))


def _customer_features(spark, sf_dir):
    return A.customers(spark, sf_dir).select(
        "Customer_ID", "snapshot_date", "Annual_Income", "Outstanding_Debt", "Occupation",
        "Credit_History_Age",
    )


@query
def modelling_table(spark, sf_dir):
    table = features.modelling_table(
        _labels(spark, sf_dir), _customer_features(spark, sf_dir), SETTINGS
    )
    return rounded(table, "debt_to_income")


@query
def modelling_table_asof(spark, sf_dir):
    return features.modelling_table(
        _labels(spark, sf_dir), A.snapshots(spark, sf_dir), SETTINGS, mode="asof"
    )


@query
def asof_features(spark, sf_dir):
    return features.asof_features(A.applications(spark, sf_dir), A.snapshots(spark, sf_dir))


def _arrivals(spark, sf_dir):
    """The snapshots with the period they arrive in, one partition per period."""
    late = "CAST(Customer_ID AS BIGINT) % 7 = 0"
    snaps = A.snapshots(spark, sf_dir)
    dated = snaps.selectExpr(
        "*", f"CASE WHEN {late} THEN add_months(snapshot_date, 1) ELSE snapshot_date END AS arrived"
    ).where("arrived > DATE '0001-01-01' AND arrived <= DATE '9999-12-01'")
    period = " + ".join(f"CAST(arrived > DATE '{until}' AS INT)" for until in A.PERIODS)
    folder = scratch_dir(spark, "arrivals")
    write_partitions(dated.selectExpr(*snaps.columns, f"{period} AS period"), folder, "period", laid_out=True)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in snaps.schema.fields)
    return spark.read.schema(f"{columns}, period int").parquet(folder)


@query
def asof_incremental(spark, sf_dir):
    """The same lookups period by period, from the state of the period before.

    The snapshots of every seventh customer arrive a month late, so those of a period's last
    month come with the next one.
    """
    # Each period reads its own arrivals, written once, and not what they are made from.
    snaps = _arrivals(spark, sf_dir)
    apps = A.applications(spark, sf_dir)
    known = snaps.drop("period")
    state = asof_state.asof_state(spark, scratch_dir(spark, "asof_state"), known.schema, buckets=8)
    out = []
    for i, (after, until) in enumerate(zip(("0001-01-01", *A.PERIODS), (*A.PERIODS, "9999-12-01"))):
        new = snaps.where(f"period = {i}").drop("period")
        mine = apps.where(f"orig_month > DATE '{after}' AND orig_month <= DATE '{until}'")
        out.append(asof_state.lookup(state, mine, new))
        asof_state.advance(state, until, new)
    return union_stores(out)


@query
def asof_stream(spark, sf_dir):
    """The same lookups for applications that come as a stream of files, run until all are read."""
    schema = A.table(spark, sf_dir, "orders").schema
    # A pattern, as a stream takes a folder or a pattern and the table may be one file.
    orders = spark.readStream.schema(schema).parquet(f"{sf_dir}/orders.parque[t]")
    apps = orders.selectExpr(*A.select_list(A.APPLICATIONS))
    return catchup.run_stream(catchup.asof_stream(apps, A.snapshots(spark, sf_dir)), scratch_dir(spark, "asof_stream"))


@query
def feature_align(spark, sf_dir):
    aligned = features.feature_align(
        A.snapshots(spark, sf_dir), ["avg_discount", "Annual_Income"], ["Occupation"]
    )
    return aligned.select(
        "Customer_ID", "snapshot_date", "avg_discount", "Annual_Income", "Occupation"
    )


# --- calendar ---------------------------------------------------------------------


@query
def month_calendar(spark, sf_dir):
    """Every month of the application history with its applications."""
    apps = A.applications(spark, sf_dir)
    counted = apps.groupBy(F.col("orig_month").alias("month")).agg(F.expr("count(*) AS n"))
    span = counted.agg(F.expr("min(month) AS first"), F.expr("max(month) AS last"))
    months = calendar.month_calendar(span, "first", "last")
    in_span = "month BETWEEN DATE '1996-01-01' AND DATE '2000-12-01' AS in_span"
    return months.join(counted, "month", "left").selectExpr("month", "coalesce(n, 0) AS n", in_span)


@query
def months_diff(spark, sf_dir):
    return A.lines_with_orders(spark, sf_dir).selectExpr(
        "l_orderkey",
        "l_linenumber",
        f"{dates.month_start('l_shipdate')} AS ship_month",
        f"{dates.months_diff('o_orderdate', 'l_shipdate')} AS months",
    )


@query
def rolling_windows(spark, sf_dir):
    months = A.applications(spark, sf_dir).select("orig_month").distinct()
    bounds = dates.window_bounds("orig_month", SETTINGS)
    return months.selectExpr("orig_month", *[f"{e} AS {name}" for name, e in bounds.items()])


@query
def window_split(spark, sf_dir):
    return features.window_split(
        A.applications(spark, sf_dir), month=TRAIN_MONTH, settings=SETTINGS
    )


# --- metrics ----------------------------------------------------------------------


def _cohort_counts(spark, sf_dir):
    return metrics.score_counts(A.scored(spark, sf_dir), ["orig_month"])


def _cohort_metrics(spark, sf_dir, *names):
    out = metrics.ranking_metrics(_cohort_counts(spark, sf_dir), ["orig_month"], DIGITS)
    return out.select("orig_month", *names)


@query
def cohort_auc(spark, sf_dir):
    return _cohort_metrics(spark, sf_dir, "auc", "gini", "bad_rate", "n")


@query
def cohort_auc_pr(spark, sf_dir):
    return _cohort_metrics(spark, sf_dir, "auc_pr")


@query
def cohort_ks(spark, sf_dir):
    return _cohort_metrics(spark, sf_dir, "ks")


def _baseline(spark, sf_dir):
    """Training scores of each yearly model up to 1998; later models have none of their own."""
    trained = A.scored(spark, sf_dir).where(f"orig_month < DATE '{A.BASELINE_YEARS}-01-01'")
    return model.baseline_counts(trained)


def _psi(spark, sf_dir, digits):
    scored = A.scored(spark, sf_dir)
    hist = metrics.score_counts(scored, monitor.COHORT, label=None)
    return metrics.psi_by_group(
        hist, _baseline(spark, sf_dir), monitor.COHORT, A.PRODUCTION_VERSION, digits
    )


@query
def psi_by_cohort(spark, sf_dir):
    return _psi(spark, sf_dir, DIGITS)


@query
def psi_band(spark, sf_dir):
    series = _psi(spark, sf_dir, DIGITS).withColumnRenamed("orig_month", "month")
    return governance.psi_series(series, SETTINGS)


def _split(spark, sf_dir):
    named = features.window_split(A.scored(spark, sf_dir), month=TRAIN_MONTH, settings=SETTINGS)
    return named.where("split IS NOT NULL AND label IS NOT NULL")


@query
def split_metrics(spark, sf_dir):
    hist = metrics.score_counts(_split(spark, sf_dir), ["split"])
    return metrics.ranking_metrics(hist, ["split"], DIGITS)


@query
def recall_threshold(spark, sf_dir):
    hist = metrics.score_counts(_split(spark, sf_dir), ["split"])
    return metrics.recall_threshold(hist, ["split"], 0.75, DIGITS)


@query
def score_histogram(spark, sf_dir):
    """Production baseline against the newest cohort."""
    base = _baseline(spark, sf_dir).where(F.col("model_version") == A.PRODUCTION_VERSION)
    hist = _cohort_counts(spark, sf_dir)
    newest = hist.agg(F.expr("max(orig_month) AS orig_month"))
    latest = hist.join(F.broadcast(newest), "orig_month")  # one row
    both = base.select(F.lit("baseline").alias("series"), "micro", "n").unionByName(
        latest.select(F.lit("latest").alias("series"), "micro", "n")
    )
    return rounded(metrics.score_histogram(both, ["series"]), "density")


@query
def class_weights(spark, sf_dir):
    return rounded(
        metrics.class_weights(A.scored(spark, sf_dir)), "balanced_weight", "scale_pos_weight"
    )


@query
def impute_stats(spark, sf_dir):
    ready = features.prepare_features(A.customers(spark, sf_dir))
    numeric = [c for c in features.feature_columns(ready)[0] if c != "Monthly_Balance"]
    return rounded(stats.impute_stats(ready, numeric), "median", "mean", "std")


@query
def score_quantiles(spark, sf_dir):
    """Exact deciles of unbounded numeric columns."""
    orders = A.table(spark, sf_dir, "lineitem")
    probs = {f"p{i}": i / 10 for i in range(1, 10)}
    cols = ["l_extendedprice", "l_quantity", "l_discount"]
    return rounded(stats.exact_quantiles(orders, cols, probs), *probs)


# --- monitoring -------------------------------------------------------------------


def _cohort_monitor(spark, sf_dir):
    return monitor.cohort_monitor(
        A.scored(spark, sf_dir),
        _labels(spark, sf_dir),
        _baseline(spark, sf_dir),
        A.PRODUCTION_VERSION,
        SETTINGS,
        DIGITS,
    )


@query
def cohort_monitor(spark, sf_dir):
    return _cohort_monitor(spark, sf_dir).orderBy("month", "model_version")


@query
def monitor_two_waves(spark, sf_dir):
    """The same rows from the monitoring state, predictions and labels coming in waves.

    The first labels come before half of the predictions, and every fifth is wrong and corrected
    by the second wave, which holds all labels; one batch is sent again.
    """
    state = monitor_state.monitor_state(spark, scratch_dir(spark, "monitor_state"))
    scored = A.scored(spark, sf_dir).drop("label")
    # A loan is scored in the month it starts.
    book = ledger.delinquency(A.ledger(spark, sf_dir))
    matured = ledger.label_store(book, keep=["loan_start_date"]).selectExpr(
        "loan_id", "label", "snapshot_date", f"{dates.month_start('loan_start_date')} AS orig_month"
    )
    wrong = "CAST(loan_id AS BIGINT) % 5 = 0"
    early = matured.where("snapshot_date < DATE '1998-07-01'").selectExpr(
        "loan_id", "orig_month", f"CASE WHEN {wrong} THEN 1 - label ELSE label END AS label",
        f"CASE WHEN {wrong} THEN add_months(snapshot_date, -1) ELSE snapshot_date END AS snapshot_date",
    )
    old, new = (scored.where(f"orig_month {op} DATE '1998-01-01'") for op in ("<", ">="))
    monitor_state.add_predictions(state, "scored-1", old)
    monitor_state.add_labels(state, "labels-1", early, old)
    monitor_state.add_predictions(state, "scored-2", new)
    monitor_state.add_labels(state, "labels-2", matured, scored)
    monitor_state.add_labels(state, "labels-1", early, old)
    return monitor_state.monitoring(
        state, _baseline(spark, sf_dir), A.PRODUCTION_VERSION, settings=SETTINGS, digits=DIGITS
    )


@query
def performance_series(spark, sf_dir):
    return monitor.performance_series(_cohort_monitor(spark, sf_dir), SETTINGS)


@query
def pred_vs_actual(spark, sf_dir):
    return monitor.pred_vs_actual(_cohort_monitor(spark, sf_dir))


@query
def incremental_cohorts(spark, sf_dir):
    scored = A.scored(spark, sf_dir).drop("label")
    done = scored.where("orig_month < DATE '1999-07-01'")
    return unseen_cohorts(scored, done)


# --- governance -------------------------------------------------------------------


def _inline_monitor(spark, sf_dir):
    """Monitoring rows from the labels carried by the scored loans themselves."""
    scored = A.scored(spark, sf_dir)
    labels = scored.where("label IS NOT NULL").select(
        "loan_id", "label", F.col("orig_month").alias("snapshot_date")
    )
    return monitor.cohort_monitor(
        scored, labels, _baseline(spark, sf_dir), A.PRODUCTION_VERSION, SETTINGS, DIGITS
    )


@query
def governance_decision(spark, sf_dir):
    """Decision of every month, with a champion trained each January from 1997."""
    monitoring = _inline_monitor(spark, sf_dir)
    trained = "CASE WHEN year(orig_month) >= 1997 THEN trunc(orig_month, 'year') END AS train_date"
    months = (
        A.applications(spark, sf_dir)
        .select("orig_month")
        .distinct()
        .selectExpr("orig_month AS month", trained)
    )
    return governance.governance_decisions(months, monitoring, SETTINGS)


def _registry(spark, sf_dir):
    """Yearly training runs, then a rerun of each with the volumes of its own year."""
    scored = A.scored(spark, sf_dir)
    yearly = scored.groupBy("model_version").agg(
        F.expr("min(orig_month) AS train_date"),
        F.expr("count(*) AS n_train"),
        F.expr("count(label) AS n_test"),
    )
    names = ", ".join(f"'{name}'" for name, _, _ in A.CANDIDATES)
    candidates = (
        f"CASE WHEN year(train_date) = 1995 THEN array({names})[0] "
        f"ELSE concat_ws('|', array_sort(array({names}))) END AS candidates"
    )
    rows = yearly.selectExpr(
        "train_date",
        f"{dates.version_name("trunc(train_date, 'year')")} AS model_version",
        "CASE WHEN year(train_date) = 1995 THEN 'bootstrap' ELSE 'refresh' END AS action",
        candidates,
        "n_train",
        "n_test",
    )
    early = rows.withColumn("n_train", F.lit(0).cast("bigint")).withColumn("seq", F.lit(1))
    late = rows.where("year(train_date) < 2001").withColumn("seq", F.lit(2))
    return early, late


@query
def registry_upsert(spark, sf_dir):
    early, late = _registry(spark, sf_dir)
    return governance.registry_upsert(early, late)


@query
def training_events(spark, sf_dir):
    return governance.training_events(governance.registry_upsert(*_registry(spark, sf_dir)))


def _candidate_metrics(spark, sf_dir):
    """Split metrics of three candidate scores per yearly training month."""
    orders = A.table(spark, sf_dir, "orders")
    labelled = orders.selectExpr(
        *A.select_list({k: A.SCORED[k] for k in ("orig_month", "label")}),
        *[f"{micro} AS {name}" for name, _, micro in A.CANDIDATES],
    )
    split = features.window_split(labelled, month=TRAIN_MONTH, settings=SETTINGS).where(
        "split IS NOT NULL AND label IS NOT NULL"
    )
    names = [name for name, _, _ in A.CANDIDATES]
    long = split.unpivot(["split", "label"], names, "model", "micro").selectExpr(
        "*", f"{from_micro('micro')} AS score"
    )
    hist = metrics.score_counts(long, ["model", "split"])
    places = " ".join(f"WHEN '{name}' THEN {i}" for name, i, _ in A.CANDIDATES)
    return metrics.ranking_metrics(hist, ["model", "split"], DIGITS).selectExpr(
        "*", f"CASE model {places} END AS ordinal"
    )


@query
def leaderboard(spark, sf_dir):
    return governance.leaderboard(_candidate_metrics(spark, sf_dir), settings=SETTINGS)


@query
def champion_select(spark, sf_dir):
    return governance.champion_select(_candidate_metrics(spark, sf_dir), settings=SETTINGS)


@query
def model_eras(spark, sf_dir):
    cohorts = A.scored(spark, sf_dir).select(F.col("orig_month").alias("month"), "model_version")
    return governance.model_eras(cohorts)


# --- model ------------------------------------------------------------------------


@query
def topk_category(spark, sf_dir):
    """Customers per nation once rare nations are folded together."""
    nations = A.table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").cast("string").alias("nation")
    )
    plan = model.fit_preparation(nations, [], ["nation"])
    rare = f"{plan.expressions()['cat_nation_infrequent']} = 1"
    folded = plan.flagged(nations).selectExpr(f"CASE WHEN {rare} THEN '{model.INFREQUENT}' ELSE nation END AS nation")
    return folded.groupBy("nation").agg(F.expr("count(*) AS n"))


@query
def model_matrix(spark, sf_dir):
    """Imputed and standardised numbers and category indicators of every customer."""
    ready = features.prepare_features(
        A.customers(spark, sf_dir).select(
            "Customer_ID", "Age", "Outstanding_Debt", "Num_of_Loan", "Credit_Mix"
        )
    )
    numeric, categorical = features.feature_columns(ready)
    plan = model.fit_preparation(ready, numeric, categorical)
    matrix = plan.flagged(ready).selectExpr("Customer_ID", *plan.columns())
    return rounded(matrix, *[c for c in matrix.columns if c.startswith("num_")])


def _training_frame(spark, sf_dir):
    """Scored loans with the features known at origination and their split, written once."""
    scored = A.scored(spark, sf_dir).select("loan_id", "Customer_ID", "orig_month", "label")
    known = features.asof_features(scored, A.snapshots(spark, sf_dir))
    split = features.window_split(known, month=TRAIN_MONTH, settings=SETTINGS)
    return stored(split, scratch_dir(spark, "training_frame"))


def _fitted(frame, name="logistic_regression", max_iter=None):
    train = frame.where("split = 'train' AND label IS NOT NULL").select("loan_id", "label", *MODEL_INPUTS)
    return model.fit_candidate(name, train, MODEL_INPUTS, [], SETTINGS, max_iter=max_iter)


@query
def prediction_rows(spark, sf_dir):
    """Given scores as prediction rows; the time of scoring is left out."""
    scored = A.scored(spark, sf_dir).select("loan_id", "Customer_ID", "orig_month", "score")
    rows = model.predictions(scored, "logistic_regression", "credit_model_2001_06_01", 0.35)
    return rows.drop("scored_at")


@query
def train_baseline_model(spark, sf_dir):
    """Metrics of a logistic regression on the three windows."""
    frame = _training_frame(spark, sf_dir)
    rows = frame.where("split IS NOT NULL AND label IS NOT NULL")
    return model.split_metrics(_fitted(frame), rows)


@query
def score_cohorts(spark, sf_dir):
    """Every application scored by that model; the time of scoring is left out."""
    frame = _training_frame(spark, sf_dir)
    scored = model.score(_fitted(frame), frame)
    return model.predictions(scored, "logistic_regression", "credit_model_2001_06_01", 0.5).drop("scored_at")


@query
def boosting_gains(spark, sf_dir):
    """What each first split of a boosted tree would gain: histograms of both derivatives."""
    train = _training_frame(spark, sf_dir).where("split = 'train' AND label IS NOT NULL")
    balance = metrics.class_weights(train).where("label = 1").first()["scale_pos_weight"]
    params = model.boosting("gbt_shallow", SETTINGS)
    edges = boosting.bin_edges(train, MODEL_INPUTS, params.bins)
    weight = f"CASE WHEN label = 1 THEN {boosting.number(balance)} ELSE 1D END AS w"
    rows = boosting.binned(train, MODEL_INPUTS, edges, "CAST(label AS DOUBLE) AS y", weight, "0D AS margin")
    unit = boosting.unit_for(rows.selectExpr("sum(w)").first()[0] or 0.0)
    bins = [f"b{i}" for i in range(len(MODEL_INPUTS))]
    known = boosting.derivatives(rows, unit, *bins).withColumn("node", F.lit(1))
    gains = boosting.split_gains(boosting.histograms(known, range(len(MODEL_INPUTS))), unit, params)
    names = ", ".join(f"'{c}'" for c in MODEL_INPUTS)
    # Plus zero, so that a sum that cancels is no negative zero.
    return gains.selectExpr(
        f"array({names})[feature] AS input", "CAST(bin AS BIGINT) AS bin", "ln AS n_left",
        *[f"round({e}, {DIGITS}) + 0D AS {c}" for c, e in {"g_left": "lg", "h_left": "lh", "gain": "gain"}.items()],
    )


@query
def boosted_trees(spark, sf_dir):
    """Metrics of ten boosted trees on the three windows."""
    frame = _training_frame(spark, sf_dir)
    rows = frame.where("split IS NOT NULL AND label IS NOT NULL")
    return model.split_metrics(_fitted(frame, "gbt_shallow", 10), rows)
