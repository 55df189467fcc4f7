"""Checking SQL for the registered queries, in the DuckDB dialect.

Each text states its query independently of the Spark code; only the input views
(``adapters``) are shared.
"""

from __future__ import annotations

from loanloom.config import CATEGORICAL, CLIP_BOUNDS, DIRTY_NUMERIC
from loanloom.plans import adapters as A

ORACLES: dict[str, str] = {}


def view(name: str, columns: dict[str, str], source: str) -> str:
    return f"{name} AS (SELECT {', '.join(A.select_list(columns))} FROM {source})"


LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"
LEDGER = view("ledger", A.LEDGER, LINES)
RAW_LEDGER = view("raw_ledger", A.RAW_LEDGER, LINES)
APPS = view("apps", A.APPLICATIONS, "orders")
SNAP_ROWS = view("snap_rows", A.SNAPSHOT_ROWS, LINES)
SNAPS = (
    f"{SNAP_ROWS}, snaps AS (SELECT Customer_ID, snapshot_date, avg(discount_cents) AS avg_discount, "
    "avg(quantity) AS avg_quantity, CAST(count(*) AS BIGINT) AS n_lines "
    "FROM snap_rows GROUP BY ALL)"
)
CLICKS = view("clicks", A.CLICKS, "events")
SCORED = view("scored", A.SCORED, "orders")
ATTRS = view("attrs", A.ATTRIBUTES, "customer")
FINS = view("fins", A.FINANCIALS, "customer")
CUSTOMERS = view(
    "customers", {**A.ATTRIBUTES, **A.FINANCIALS, "snapshot_date": A.SPREAD_MONTH}, "customer"
)

# --- scans, types, ledger ---------------------------------------------------------

ORACLES["snapshot_slice"] = (
    f"WITH {LEDGER} SELECT * FROM ledger WHERE snapshot_date = DATE '1998-03-01'"
)
ORACLES["snapshot_counts"] = (
    f"WITH {LEDGER} SELECT snapshot_date, CAST(count(*) AS BIGINT) AS row_count "
    "FROM ledger GROUP BY 1"
)
ORACLES["typed_loans"] = f"""
WITH {RAW_LEDGER}
SELECT loan_id, Customer_ID, TRY_CAST(loan_start_date AS DATE) AS loan_start_date,
  CAST(trunc(TRY_CAST(tenure AS DOUBLE)) AS INTEGER) AS tenure,
  CAST(trunc(TRY_CAST(CASE WHEN contains(installment_num, '_') THEN NULL ELSE installment_num END
    AS DOUBLE)) AS INTEGER) AS installment_num,
  TRY_CAST(loan_amt AS FLOAT) AS loan_amt, TRY_CAST(due_amt AS FLOAT) AS due_amt,
  TRY_CAST(paid_amt AS FLOAT) AS paid_amt, TRY_CAST(overdue_amt AS FLOAT) AS overdue_amt,
  TRY_CAST(balance AS FLOAT) AS balance, TRY_CAST(snapshot_date AS DATE) AS snapshot_date
FROM raw_ledger"""
ORACLES["store_scan"] = f"""
WITH {LEDGER}
SELECT * REPLACE (CASE WHEN snapshot_date >= DATE '1998-01-01' THEN balance END AS balance,
                  CASE WHEN snapshot_date >= DATE '1998-01-01' THEN tenure END AS tenure)
FROM ledger"""


def number(column: str) -> str:
    text = f"trim(replace({column}, '_', ''))"
    pattern = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
    return f"CASE WHEN regexp_full_match({text}, '{pattern}') THEN TRY_CAST({text} AS DOUBLE) END"


MONEY = ("Annual_Income", "Monthly_Inhand_Salary", "Outstanding_Debt")
ORACLES["typed_financials"] = f"""
WITH {FINS}
SELECT Customer_ID, snapshot_date,
  {', '.join(f'CAST({number(c)} AS FLOAT) AS {c}' for c in MONEY)} FROM fins"""


def strict(column: str) -> str:
    return f"TRY_CAST(CASE WHEN contains({column}, '_') THEN NULL ELSE {column} END AS FLOAT)"


ORACLES["typed_financials_strict"] = f"""
WITH {FINS}
SELECT Customer_ID, snapshot_date,
  {', '.join(f'{strict(c)} AS {c}' for c in MONEY)} FROM fins"""
ORACLES["pii_drop"] = f"""
WITH {ATTRS}
SELECT Customer_ID, CAST(trunc({number('Age')}) AS INTEGER) AS Age, Occupation, snapshot_date
FROM attrs"""

SILVER = f"""{LEDGER},
missed AS (
  SELECT *, COALESCE(CAST(ceil(CAST(overdue_amt AS DOUBLE) / NULLIF(CAST(due_amt AS DOUBLE), 0))
    AS INTEGER), 0) AS installments_missed
  FROM ledger),
dated AS (
  SELECT loan_id, Customer_ID, loan_start_date, COALESCE(tenure, 0) AS tenure, installment_num,
    loan_amt, COALESCE(due_amt, 0) AS due_amt, paid_amt, overdue_amt, balance, snapshot_date,
    installment_num AS mob, installments_missed,
    CASE WHEN installments_missed > 0 THEN
      CAST(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed_date
  FROM missed),
silver AS (
  SELECT *, CASE WHEN overdue_amt > 0 THEN date_diff('day', first_missed_date, snapshot_date)
    ELSE 0 END AS dpd
  FROM dated)"""
LABELS = f"""{SILVER},
labels AS (
  SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label,
    '30dpd_6mob' AS label_def, snapshot_date
  FROM silver WHERE mob = 6)"""
ORACLES["delinquency"] = f"WITH {SILVER} SELECT * REPLACE (CAST(dpd AS INTEGER) AS dpd) FROM silver"
ORACLES["label_store"] = f"WITH {LABELS} SELECT * FROM labels"
ORACLES["applications"] = (
    f"WITH {SILVER} SELECT loan_id, Customer_ID, snapshot_date AS orig_month FROM silver WHERE mob = 0"
)
ORACLES["ledger_issues"] = f"""
WITH {LEDGER}
SELECT snapshot_date, CAST(count(*) AS BIGINT) AS row_count,
  CAST(count(*) FILTER (WHERE overdue_amt > 0 AND (due_amt IS NULL OR due_amt = 0)) AS BIGINT)
    AS overdue_without_due
FROM ledger GROUP BY 1"""

# --- cleaning ---------------------------------------------------------------------


def category(column: str) -> str:
    return (
        f"CASE WHEN {column} IS NULL OR trim({column}) IN ('_', '', 'nan', '!@9#%8', 'NM') "
        f"THEN 'Unknown' ELSE trim({column}) END"
    )


def clipped(expr: str, low: float, high: float) -> str:
    return f"CASE WHEN ({expr}) < {low} THEN {low} WHEN ({expr}) > {high} THEN {high} ELSE ({expr}) END"


def ready(column: str) -> str:
    expr = number(column)
    if column in CLIP_BOUNDS:
        expr = f"CAST({clipped(expr, *CLIP_BOUNDS[column])} AS DOUBLE)"
    return expr


def ratio(top: str, bottom: str) -> str:
    expr = f"({number(top)}) / NULLIF({number(bottom)}, 0)"
    return f"round({clipped(expr, 0, 5)}, 6)"


HISTORY = """CASE WHEN regexp_matches(Credit_History_Age, '\\d+\\s*(Year|Month)') THEN
  COALESCE(TRY_CAST(regexp_extract(Credit_History_Age, '(\\d+)\\s*Year', 1) AS BIGINT), 0) * 12
  + COALESCE(TRY_CAST(regexp_extract(Credit_History_Age, '(\\d+)\\s*Month', 1) AS BIGINT), 0) END"""
ITEMS = """CAST(COALESCE(len(list_filter(string_split(Type_of_Loan, ','),
  lambda x: trim(x) <> '' AND lower(trim(x)) <> 'nan')), 0) AS INTEGER)"""

ORACLES["clean_numeric"] = (
    f"WITH {CUSTOMERS} SELECT Customer_ID, "
    + ", ".join(f"{number(c)} AS {c}" for c in DIRTY_NUMERIC)
    + " FROM customers"
)
ORACLES["clean_category"] = (
    f"WITH {CUSTOMERS} SELECT Customer_ID, "
    + ", ".join(f"{category(c)} AS {c}" for c in CATEGORICAL)
    + " FROM customers"
)
ORACLES["credit_history_months"] = (
    f"WITH {FINS} SELECT Customer_ID, {HISTORY} AS credit_history_months FROM fins"
)
ORACLES["count_loan_types"] = (
    f"WITH {FINS} SELECT Customer_ID, {ITEMS} AS num_loan_types FROM fins"
)
ORACLES["sentinel_clip"] = (
    f"WITH {CUSTOMERS} SELECT Customer_ID, "
    + ", ".join(f"{ready(c)} AS {c}" for c in CLIP_BOUNDS)
    + " FROM customers"
)
EMI = ratio("Total_EMI_per_month", "Monthly_Inhand_Salary")
DTI = ratio("Outstanding_Debt", "Annual_Income")
ORACLES["affordability_ratios"] = (
    f"WITH {FINS} SELECT Customer_ID, {EMI} AS emi_to_salary, {DTI} AS debt_to_income FROM fins"
)
PREPARED = ", ".join(
    [f"{ready(c)} AS {c}" for c in DIRTY_NUMERIC]
    + [f"{category(c)} AS {c}" for c in CATEGORICAL]
    + [f"{HISTORY} AS credit_history_months", f"{ITEMS} AS num_loan_types"]
)
ORACLES["prepare_features"] = f"""
WITH {CUSTOMERS}
SELECT Customer_ID, snapshot_date, Type_of_Loan, {PREPARED}, {EMI} AS emi_to_salary,
  {DTI} AS debt_to_income
FROM customers"""

# --- feature store ----------------------------------------------------------------

CLICK_AGG = "SELECT Customer_ID, snapshot_date, " + ", ".join(
    f"avg(fe_{i}) AS fe_{i}_mean" for i in range(1, 21)
)
ORACLES["clickstream_agg"] = f"WITH {CLICKS} {CLICK_AGG} FROM clicks GROUP BY ALL"
FIN_TYPED = ", ".join(f"CAST({number(c)} AS FLOAT) AS {c}" for c in MONEY)
ORACLES["feature_store"] = f"""
WITH {ATTRS}, {FINS}, {CLICKS},
agg AS ({CLICK_AGG} FROM clicks GROUP BY ALL),
f AS (SELECT * REPLACE ({FIN_TYPED}) FROM fins WHERE Num_of_Loan IS NOT NULL),
a AS (SELECT Customer_ID, CAST(trunc({number('Age')}) AS INTEGER) AS Age, Occupation, snapshot_date
      FROM attrs)
SELECT * FROM a LEFT JOIN f USING (Customer_ID, snapshot_date)
  LEFT JOIN agg USING (Customer_ID, snapshot_date)"""
ORACLES["latest_features"] = f"""
WITH {SNAPS}
SELECT * RENAME (snapshot_date AS feat_snapshot) FROM snaps
QUALIFY row_number() OVER (PARTITION BY Customer_ID ORDER BY snapshot_date DESC) = 1"""
ORACLES["dedupe_snapshots"] = f"""
WITH {SNAP_ROWS}
SELECT * RENAME (snapshot_date AS feat_snapshot) FROM snap_rows
QUALIFY row_number() OVER (PARTITION BY Customer_ID, snapshot_date
  ORDER BY discount_cents DESC, loan_id DESC, quantity DESC) = 1"""
MATURED = "CAST(l.snapshot_date - INTERVAL 6 MONTH AS DATE)"
ORACLES["modelling_table"] = f"""
WITH {LABELS}, {CUSTOMERS},
f AS (
  SELECT Customer_ID, snapshot_date AS feat_snapshot, {number('Annual_Income')} AS Annual_Income,
    {number('Outstanding_Debt')} AS Outstanding_Debt, {category('Occupation')} AS Occupation,
    {HISTORY} AS credit_history_months, {DTI} AS debt_to_income
  FROM customers)
SELECT l.*, {MATURED} AS orig_month, f.* EXCLUDE (Customer_ID)
FROM labels l JOIN f USING (Customer_ID) WHERE feat_snapshot <= {MATURED}"""
ORACLES["modelling_table_asof"] = f"""
WITH {LABELS}, {SNAPS},
f AS (SELECT * RENAME (snapshot_date AS feat_snapshot) FROM snaps),
d AS (SELECT l.*, {MATURED} AS orig_month FROM labels l)
SELECT d.*, f.* EXCLUDE (Customer_ID)
FROM d ASOF JOIN f ON d.Customer_ID = f.Customer_ID AND d.orig_month >= f.feat_snapshot"""
ORACLES["asof_features"] = f"""
WITH {APPS}, {SNAPS},
f AS (SELECT * RENAME (snapshot_date AS feat_snapshot) FROM snaps)
SELECT apps.*, f.* EXCLUDE (Customer_ID)
FROM apps ASOF LEFT JOIN f ON apps.Customer_ID = f.Customer_ID AND apps.orig_month >= f.feat_snapshot"""
ORACLES["asof_stream"] = ORACLES["asof_features"]
PERIOD_ENDS = ("0001-01-01", *A.PERIODS, "9999-12-01")
ORACLES["asof_incremental"] = f"""
WITH {APPS}, {SNAPS},
f AS (SELECT * RENAME (snapshot_date AS feat_snapshot),
  CASE WHEN CAST(Customer_ID AS BIGINT) % 7 = 0 THEN CAST(snapshot_date + INTERVAL 1 MONTH AS DATE) ELSE snapshot_date END AS arrived
  FROM snaps)
""" + " UNION ALL ".join(
    f"""SELECT a.*, s.* EXCLUDE (Customer_ID, arrived)
FROM (SELECT * FROM apps WHERE orig_month > DATE '{after}' AND orig_month <= DATE '{until}') a
  ASOF LEFT JOIN (SELECT * FROM f WHERE arrived <= DATE '{until}') s
  ON a.Customer_ID = s.Customer_ID AND a.orig_month >= s.feat_snapshot"""
    for after, until in zip(PERIOD_ENDS, PERIOD_ENDS[1:])
)
ORACLES["feature_align"] = f"""
WITH {SNAPS}
SELECT Customer_ID, snapshot_date, avg_discount, CAST(NULL AS DOUBLE) AS Annual_Income,
  CAST(NULL AS VARCHAR) AS Occupation FROM snaps"""

# --- calendar ---------------------------------------------------------------------

ORACLES["month_calendar"] = f"""
WITH {APPS},
months AS (
  SELECT CAST(unnest(generate_series(min(orig_month), max(orig_month), INTERVAL 1 MONTH)) AS DATE)
    AS month FROM apps),
n AS (SELECT orig_month AS month, count(*) AS n FROM apps GROUP BY 1)
SELECT month, CAST(COALESCE(n, 0) AS BIGINT) AS n,
  month >= DATE '1996-01-01' AND month <= DATE '2000-12-01' AS in_span
FROM months LEFT JOIN n USING (month)"""
ORACLES["months_diff"] = f"""
SELECT l_orderkey, l_linenumber, {A.MONTH_SHIP} AS ship_month,
  CAST(date_diff('month', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS months
FROM {LINES}"""


def back(months: int) -> str:
    return f"CAST(orig_month - INTERVAL {months} MONTH AS DATE)"


ORACLES["rolling_windows"] = f"""
WITH {APPS}
SELECT DISTINCT orig_month, DATE '1995-01-01' AS train_start, {back(12)} AS train_end,
  {back(11)} AS test_start, {back(9)} AS test_end, {back(8)} AS oot_start, {back(6)} AS oot_end
FROM apps"""
SPLIT = """CASE WHEN orig_month BETWEEN DATE '1995-01-01' AND DATE '2000-06-01' THEN 'train'
  WHEN orig_month BETWEEN DATE '2000-07-01' AND DATE '2000-09-01' THEN 'test'
  WHEN orig_month BETWEEN DATE '2000-10-01' AND DATE '2000-12-01' THEN 'oot' END"""
ORACLES["window_split"] = f"WITH {APPS} SELECT *, {SPLIT} AS split FROM apps"

# --- metrics ----------------------------------------------------------------------


def ranked(source: str, by: str) -> str:
    """Views ``h`` (rows per score) and ``c`` (with cumulative counts) over ``source``."""
    return f"""
h AS (
  SELECT {by}, score, CAST(COALESCE(sum(label), 0) AS DOUBLE) AS b,
    CAST(COALESCE(sum(1 - label), 0) AS DOUBLE) AS g
  FROM {source} GROUP BY ALL),
c AS (
  SELECT *, sum(b) OVER up AS bu, sum(g) OVER up AS gu, sum(b) OVER down AS bd,
    sum(g) OVER down AS gd, sum(b) OVER (PARTITION BY {by}) AS tb,
    sum(g) OVER (PARTITION BY {by}) AS tg
  FROM h
  WINDOW up AS (PARTITION BY {by} ORDER BY score), down AS (PARTITION BY {by} ORDER BY score DESC))"""


AUC = "sum(b * (gu - g + g / 2)) / NULLIF(max(tb) * max(tg), 0)"
BOTH = "max(tb) > 0 AND max(tg) > 0"
AP = f"CASE WHEN {BOTH} THEN sum(b / tb * bd / NULLIF(bd + gd, 0)) END"
KS = f"CASE WHEN {BOTH} THEN max(abs(bu / tb - gu / tg)) END"
RATE = "sum(b) / NULLIF(sum(b) + sum(g), 0)"
COUNT = "CAST(sum(b) + sum(g) AS BIGINT)"


def cohort(columns: str) -> str:
    return f"WITH {SCORED}, {ranked('scored', 'orig_month')} SELECT orig_month, {columns} FROM c GROUP BY 1"


ORACLES["cohort_auc"] = cohort(
    f"round({AUC}, 6) AS auc, round(2 * {AUC} - 1, 6) AS gini, round({RATE}, 6) AS bad_rate, {COUNT} AS n"
)
ORACLES["cohort_auc_pr"] = cohort(f"round({AP}, 6) AS auc_pr")
ORACLES["cohort_ks"] = cohort(f"round({KS}, 6) AS ks")

SPLIT_ROWS = f"{SCORED}, split_rows AS (SELECT *, {SPLIT} AS split FROM scored WHERE label IS NOT NULL AND {SPLIT} IS NOT NULL)"
BUNDLE = (
    f"round({AUC}, 6) AS auc, round({AP}, 6) AS auc_pr, round(2 * {AUC} - 1, 6) AS gini, "
    f"round({KS}, 6) AS ks, round({RATE}, 6) AS bad_rate, {COUNT} AS n"
)
ORACLES["split_metrics"] = (
    f"WITH {SPLIT_ROWS}, {ranked('split_rows', 'split')} SELECT split, {BUNDLE} FROM c GROUP BY 1"
)
ORACLES["recall_threshold"] = f"""
WITH {SPLIT_ROWS}, {ranked('split_rows', 'split')},
best AS (
  SELECT split, score FROM c WHERE bd / tb >= 0.75 AND tg > 0
  QUALIFY row_number() OVER (PARTITION BY split ORDER BY bd / (bd + gd) DESC, score) = 1)
SELECT split, round(COALESCE(score, 0.5), 6) AS threshold
FROM (SELECT DISTINCT split FROM c) LEFT JOIN best USING (split)"""

VERSIONS_WITH_BASELINE = f"orig_month < DATE '{A.BASELINE_YEARS}-01-01'"
# Linear quantiles by rank in whole numbers: position i * (n - 1) / 10.
PSI_VIEWS = f"""
base AS (
  SELECT model_version, score, row_number() OVER (PARTITION BY model_version ORDER BY score) - 1 AS r,
    count(*) OVER (PARTITION BY model_version) AS n
  FROM scored WHERE {VERSIONS_WITH_BASELINE}),
points AS (
  SELECT model_version, i, max(n) AS n,
    max(CASE WHEN r = (i * (n - 1)) // 10 THEN score END) AS lo,
    max(CASE WHEN r = (i * (n - 1) + 9) // 10 THEN score END) AS hi,
    max(((i * (n - 1)) % 10) / 10) AS w
  FROM base, range(1, 10) t(i) GROUP BY ALL),
edges AS (SELECT model_version, i, lo + (hi - lo) * w AS edge FROM points),
versions AS (SELECT DISTINCT model_version FROM edges),
resolved AS (
  SELECT s.orig_month, s.model_version, s.score,
    COALESCE(v.model_version, '{A.PRODUCTION_VERSION}') AS shape
  FROM scored s LEFT JOIN versions v USING (model_version)),
bins AS (
  SELECT i AS bin, model_version AS shape,
    COALESCE(lag(edge) OVER (PARTITION BY model_version ORDER BY i), -1e300) AS lo, edge AS hi
  FROM (SELECT * FROM edges UNION ALL SELECT model_version, 10, 1e300 FROM versions)),
expected AS (
  SELECT bins.shape, bin, count(b.score) / max(t.n) AS e
  FROM bins JOIN (SELECT model_version AS shape, max(n) AS n FROM base GROUP BY 1) t USING (shape)
  LEFT JOIN base b ON b.model_version = bins.shape AND b.score >= bins.lo AND b.score < bins.hi
  GROUP BY ALL),
cohorts AS (
  SELECT orig_month, model_version, shape, count(*) AS n FROM resolved GROUP BY ALL),
actual AS (
  SELECT c.orig_month, c.model_version, max(c.n) AS n, bins.shape, bins.bin,
    count(r.score) / max(c.n) AS a
  FROM cohorts c JOIN bins USING (shape)
  LEFT JOIN resolved r ON r.orig_month = c.orig_month AND r.model_version = c.model_version
    AND r.score >= bins.lo AND r.score < bins.hi
  GROUP BY ALL),
psi AS (
  SELECT orig_month, model_version, CAST(max(n) AS BIGINT) AS n,
    round(sum((greatest(a, 1e-6) - greatest(e, 1e-6)) * ln(greatest(a, 1e-6) / greatest(e, 1e-6))), 6)
      AS psi
  FROM actual JOIN expected USING (shape, bin) GROUP BY ALL)"""
ORACLES["psi_by_cohort"] = f"WITH {SCORED}, {PSI_VIEWS} SELECT * FROM psi"
ORACLES["psi_band"] = f"""
WITH {SCORED}, {PSI_VIEWS}
SELECT orig_month AS month, model_version, psi,
  CASE WHEN psi < 0.1 THEN 'green' WHEN psi < 0.25 THEN 'amber' ELSE 'red' END AS band FROM psi"""
ORACLES["score_histogram"] = f"""
WITH {SCORED},
s AS (
  SELECT 'baseline' AS series, score FROM scored
  WHERE model_version = '{A.PRODUCTION_VERSION}'
  UNION ALL
  SELECT 'latest', score FROM scored WHERE orig_month = (SELECT max(orig_month) FROM scored)),
m AS (SELECT series, CAST(round(score * 1000000) AS BIGINT) AS m FROM s WHERE score BETWEEN 0 AND 1),
b AS (SELECT series, CAST(least((m * 25) // 1000000 + 1, 25) AS INTEGER) AS bin, count(*) AS n FROM m GROUP BY ALL)
SELECT series, bin, CAST(n AS BIGINT) AS n,
  round(n * 25 / sum(n) OVER (PARTITION BY series), 6) AS density FROM b"""
ORACLES["class_weights"] = f"""
WITH {SCORED},
k AS (SELECT label, CAST(count(*) AS BIGINT) AS n FROM scored WHERE label IS NOT NULL GROUP BY 1),
t AS (SELECT sum(n) AS n, count(*) AS k, sum(n) FILTER (WHERE label = 0) AS n0,
        sum(n) FILTER (WHERE label = 1) AS n1 FROM k)
SELECT label, k.n, round(t.n / (t.k * k.n), 6) AS balanced_weight,
  round(n0 / greatest(n1, 1), 6) AS scale_pos_weight
FROM k, t"""

NUMERIC = [c for c in DIRTY_NUMERIC if c != "Monthly_Balance"]


def filled(column: str, expr: str) -> str:
    return f"""
SELECT '{column}' AS "column", CAST(count(v) AS BIGINT) AS n_present,
  CAST(count(*) - count(v) AS BIGINT) AS n_missing, round(max(med), 6) AS median,
  round(avg(COALESCE(v, med)), 6) AS mean, round(stddev_pop(COALESCE(v, med)), 6) AS std
FROM (SELECT v, quantile_cont(v, 0.5) OVER () AS med FROM (SELECT {expr} AS v FROM customers))"""


RATIOS = {
    "emi_to_salary": clipped(
        f"({number('Total_EMI_per_month')}) / NULLIF({number('Monthly_Inhand_Salary')}, 0)", 0, 5
    ),
    "debt_to_income": clipped(
        f"({number('Outstanding_Debt')}) / NULLIF({number('Annual_Income')}, 0)", 0, 5
    ),
}
ORACLES["impute_stats"] = f"WITH {CUSTOMERS} " + " UNION ALL ".join(
    [filled(c, ready(c)) for c in NUMERIC]
    + [filled("credit_history_months", HISTORY), filled("num_loan_types", ITEMS)]
    + [filled(name, expr) for name, expr in RATIOS.items()]
)
DECILES = ", ".join(
    f"round(quantile_cont(v, {i / 10}), 6) AS p{i}" for i in range(1, 10)
)
ORACLES["score_quantiles"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS n, {DECILES.replace('(v,', f'({c},')} FROM lineitem"
    for c in ("l_extendedprice", "l_quantity", "l_discount")
)

# --- monitoring -------------------------------------------------------------------


def monitoring(labels: str) -> str:
    """View ``monitoring`` from scored loans and the newest label per loan in ``labels``."""
    return f"""
one_label AS (
  SELECT loan_id, label FROM {labels}
  QUALIFY row_number() OVER (PARTITION BY loan_id ORDER BY snapshot_date DESC, label DESC) = 1),
merged AS (
  SELECT s.* EXCLUDE (label), o.label FROM scored s LEFT JOIN one_label o USING (loan_id)),
{ranked('merged', 'orig_month, model_version')},
rank_metrics AS (
  SELECT orig_month, model_version, {AUC} AS auc, {AP} AS auc_pr, {KS} AS ks, {RATE} AS bad_rate
  FROM c GROUP BY ALL),
volume AS (
  SELECT orig_month, model_version, CAST(count(*) AS BIGINT) AS n_scored,
    CAST(count(label) AS BIGINT) AS n_labelled,
    avg(CAST(round(score * 1000000) AS BIGINT)) / 1000000 AS avg_score,
    avg(prediction) AS pred_positive_rate, min(label) < max(label) AS two_classes
  FROM merged GROUP BY ALL),
monitoring AS (
  SELECT orig_month AS month, model_version,
    CASE WHEN n_labelled >= 30 THEN 'labelled' ELSE 'unlabelled' END AS cohort_type,
    n_scored, n_labelled, round(avg_score, 6) AS avg_score,
    round(pred_positive_rate, 6) AS pred_positive_rate, psi,
    CASE WHEN n_labelled >= 30 AND two_classes THEN round(auc, 6) END AS auc,
    CASE WHEN n_labelled >= 30 AND two_classes THEN round(auc_pr, 6) END AS auc_pr,
    CASE WHEN n_labelled >= 30 AND two_classes THEN round(ks, 6) END AS ks,
    CASE WHEN n_labelled >= 30 AND two_classes THEN round(bad_rate, 6) END AS actual_bad_rate
  FROM volume JOIN psi USING (orig_month, model_version)
    LEFT JOIN rank_metrics USING (orig_month, model_version))"""


MONITORING = f"WITH {LABELS}, {SCORED}, {PSI_VIEWS}, {monitoring('labels')}"
ORACLES["cohort_monitor"] = f"{MONITORING} SELECT * FROM monitoring"
# However labels come in, the state must end where a full recomputation does.
ORACLES["monitor_two_waves"] = ORACLES["cohort_monitor"]
ORACLES["performance_series"] = (
    f"{MONITORING} SELECT month, model_version, auc, auc < 0.7 AS below_floor "
    "FROM monitoring WHERE auc IS NOT NULL"
)
ORACLES["pred_vs_actual"] = (
    f"{MONITORING} SELECT month, model_version, pred_positive_rate, actual_bad_rate FROM monitoring"
)
ORACLES["incremental_cohorts"] = f"""
WITH {SCORED}
SELECT * EXCLUDE (label) FROM scored WHERE orig_month NOT IN (
  SELECT DISTINCT orig_month FROM scored WHERE orig_month < DATE '1999-07-01')"""

# --- governance -------------------------------------------------------------------

INLINE_MONITORING = (
    f"WITH {SCORED}, own_labels AS (SELECT loan_id, label, orig_month AS snapshot_date "
    f"FROM scored WHERE label IS NOT NULL), {PSI_VIEWS}, {monitoring('own_labels')}"
)
ORACLES["governance_decision"] = f"""
{INLINE_MONITORING}, {APPS},
months AS (
  SELECT DISTINCT orig_month AS month,
    CASE WHEN year(orig_month) >= 1997 THEN CAST(date_trunc('year', orig_month) AS DATE) END AS train_date
  FROM apps),
known AS (
  SELECT m.month, m.train_date,
    (SELECT max_by(x.auc, x.month) FROM monitoring x WHERE x.month < m.month AND x.auc IS NOT NULL) AS auc,
    (SELECT max_by(x.psi, x.month) FROM monitoring x WHERE x.month < m.month AND x.psi IS NOT NULL) AS psi
  FROM months m),
decided AS (
  SELECT *, CASE WHEN month < DATE '1996-06-01' THEN 'before_anchor'
    WHEN train_date IS NULL THEN 'bootstrap_initial'
    WHEN date_diff('month', train_date, month) >= 6 THEN 'scheduled_cadence'
    WHEN auc < 0.7 THEN 'trigger_auc_below_floor'
    WHEN psi >= 0.25 THEN 'trigger_psi_breach' ELSE 'within_sla' END AS reason
  FROM known)
SELECT *, CASE WHEN reason = 'bootstrap_initial' THEN 'bootstrap'
  WHEN reason IN ('before_anchor', 'within_sla') THEN NULL ELSE 'refresh' END AS action
FROM decided"""
REGISTRY = f"""{SCORED},
yearly AS (
  SELECT model_version, min(orig_month) AS train_date, CAST(count(*) AS BIGINT) AS n_train,
    CAST(count(label) AS BIGINT) AS n_test FROM scored GROUP BY 1),
registry AS (
  SELECT train_date, model_version,
    CASE WHEN year(train_date) = 1995 THEN 'bootstrap' ELSE 'refresh' END AS action,
    CASE WHEN year(train_date) = 1995 THEN 'logistic_regression'
      ELSE 'gbt_deep|gbt_shallow|logistic_regression' END AS candidates,
    CASE WHEN year(train_date) < 2001 THEN n_train ELSE 0 END AS n_train, n_test,
    CASE WHEN year(train_date) < 2001 THEN 2 ELSE 1 END AS seq
  FROM yearly)"""
ORACLES["registry_upsert"] = f"WITH {REGISTRY} SELECT * FROM registry"
ORACLES["training_events"] = (
    f"WITH {REGISTRY} SELECT train_date, model_version, action AS event FROM registry"
)
BOARD = f"""
{view('o', {**{k: A.SCORED[k] for k in ('orig_month', 'label')},
            **{name: micro for name, _, micro in A.CANDIDATES}}, 'orders')},
long AS ({' UNION ALL '.join(
    f"SELECT '{name}' AS model, {i} AS ordinal, {SPLIT} AS split, label, {name} AS score FROM o"
    for name, i, _ in A.CANDIDATES)}),
kept AS (SELECT * FROM long WHERE split IS NOT NULL AND label IS NOT NULL),
{ranked('kept', 'model, ordinal, split')},
m AS (SELECT model, ordinal, split, round({AUC}, 6) AS auc FROM c GROUP BY ALL),
board AS (
  SELECT model, ordinal,
    COALESCE(max(auc) FILTER (WHERE split = 'oot'), max(auc) FILTER (WHERE split = 'test'), 0.0) AS auc
  FROM m GROUP BY ALL)"""
ORACLES["leaderboard"] = f"""
WITH {BOARD}
SELECT model, ordinal, auc, row_number() OVER (ORDER BY auc DESC, ordinal) = 1 AS selected,
  auc >= 0.6 AS passes_gate FROM board"""
ORACLES["champion_select"] = f"""
WITH {BOARD}
SELECT model, auc AS ranking_auc, auc >= 0.6 AS promoted FROM board ORDER BY auc DESC, ordinal LIMIT 1"""
ORACLES["model_eras"] = f"""
WITH {SCORED}
SELECT model_version, min(orig_month) AS first_month, max(orig_month) AS last_month
FROM scored GROUP BY 1"""

# --- model ------------------------------------------------------------------------

ORACLES["topk_category"] = """
WITH k AS (SELECT CAST(c_nationkey AS VARCHAR) AS nation, count(*) AS n FROM customer GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY n DESC, nation DESC) AS p FROM k)
SELECT CASE WHEN p <= 19 THEN nation ELSE 'infrequent' END AS nation, CAST(sum(n) AS BIGINT) AS n
FROM r GROUP BY 1"""
MATRIX = ("Age", "Outstanding_Debt", "Num_of_Loan")
MIX = ("Bad", "Good", "Standard", "Unknown")
ORACLES["model_matrix"] = f"""
WITH {CUSTOMERS},
v AS (SELECT Customer_ID, {category('Credit_Mix')} AS mix,
  {', '.join(f'{ready(c)} AS {c}' for c in MATRIX)} FROM customers),
f AS (SELECT Customer_ID, mix,
  {', '.join(f'COALESCE({c}, quantile_cont({c}, 0.5) OVER ()) AS {c}' for c in MATRIX)} FROM v)
SELECT Customer_ID,
  {', '.join(f'round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS num_{c}' for c in MATRIX)},
  {', '.join(f"CAST(mix = '{m}' AS DOUBLE) AS cat_Credit_Mix_{i}" for i, m in enumerate(MIX))}
FROM f"""
ORACLES["prediction_rows"] = f"""
WITH {SCORED}
SELECT loan_id, Customer_ID, orig_month, score, CAST(score >= 0.35 AS INTEGER) AS prediction,
  'logistic_regression' AS model_name, 'credit_model_2001_06_01' AS model_version FROM scored"""

INPUTS = ("avg_discount", "avg_quantity", "n_lines")


def each(text: str, start: int = 0, separator: str = ", ") -> str:
    """``text`` once per model input, with its name for @ and its number for #."""
    return separator.join(text.replace("@", c).replace("#", str(i)) for i, c in enumerate(INPUTS, start))


# Scored loans with the features known at origination.
FRAME = f"""{SCORED}, {SNAPS},
f AS (SELECT * RENAME (snapshot_date AS feat_snapshot) FROM snaps),
frame AS MATERIALIZED (
  SELECT s.loan_id, s.Customer_ID, s.orig_month, s.label, {SPLIT.replace('orig_month', 's.orig_month')} AS split,
    {each('CAST(f.@ AS DOUBLE) AS @')}
  FROM scored s ASOF LEFT JOIN f ON s.Customer_ID = f.Customer_ID AND s.orig_month >= f.feat_snapshot),
train AS MATERIALIZED (SELECT * FROM frame WHERE split = 'train' AND label IS NOT NULL)"""

# Newton's method for the penalised log loss, twelve steps from zero: sums over the rows, then the
# four equations solved by a Cholesky factor.
STEPS = 12
TERMS = ("1", "z1", "z2", "z3")
NEWTON = f"""
medians AS (SELECT {each('quantile_cont(@, 0.5) AS m#')} FROM train),
moments AS (SELECT {each('avg(COALESCE(@, m#)) AS a#')}, {each('stddev_pop(COALESCE(@, m#)) AS s#')} FROM train, medians),
balance AS (SELECT count(*) / (2 * sum(label)) AS w1, count(*) / (2 * sum(1 - label)) AS w0 FROM train),
ready AS MATERIALIZED (
  SELECT frame.*, {', '.join(f'(COALESCE({c}, m{i}) - a{i}) / s{i} AS z{i + 1}' for i, c in enumerate(INPUTS))}
  FROM frame, medians, moments),
points AS MATERIALIZED (
  SELECT z1, z2, z3, label AS y, CASE WHEN label = 1 THEN w1 ELSE w0 END AS w
  FROM ready, balance WHERE split = 'train' AND label IS NOT NULL),
newton AS (
  SELECT 0 AS step, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2, 0.0::DOUBLE AS b3
  UNION ALL
  SELECT step + 1, b0 - d0, b1 - d1, b2 - d2, b3 - d3 FROM (
    SELECT *, sqrt(h00) AS l00, h01 / l00 AS l10, h02 / l00 AS l20, h03 / l00 AS l30, sqrt(h11 - l10 * l10) AS l11,
      (h12 - l20 * l10) / l11 AS l21, (h13 - l30 * l10) / l11 AS l31, sqrt(h22 - l20 * l20 - l21 * l21) AS l22,
      (h23 - l30 * l20 - l31 * l21) / l22 AS l32, sqrt(h33 - l30 * l30 - l31 * l31 - l32 * l32) AS l33,
      g0 / l00 AS y0, (g1 - l10 * y0) / l11 AS y1, (g2 - l20 * y0 - l21 * y1) / l22 AS y2,
      (g3 - l30 * y0 - l31 * y1 - l32 * y2) / l33 AS y3,
      y3 / l33 AS d3, (y2 - l32 * d3) / l22 AS d2, (y1 - l21 * d2 - l31 * d3) / l11 AS d1,
      (y0 - l10 * d1 - l20 * d2 - l30 * d3) / l00 AS d0
    FROM (
      SELECT step, b0, b1, b2, b3, {', '.join(f'sum(w * (p - y) * {t}) + {f"b{i}" if i else 0} AS g{i}' for i, t in enumerate(TERMS))},
        {', '.join(f'sum(w * p * (1 - p) * {t} * {u}) + {int(i == j > 0)} AS h{i}{j}' for i, t in enumerate(TERMS) for j, u in enumerate(TERMS) if i <= j)}
      FROM (SELECT newton.*, points.*, 1 / (1 + exp(-(b0 + b1 * z1 + b2 * z2 + b3 * z3))) AS p
        FROM newton, points WHERE step < {STEPS})
      GROUP BY step, b0, b1, b2, b3))),
fit AS (SELECT * FROM newton WHERE step = {STEPS}),
judged AS (
  SELECT ready.*, round(1 / (1 + exp(-(b0 + b1 * z1 + b2 * z2 + b3 * z3))), 6) AS score FROM ready, fit)"""
ORACLES["train_baseline_model"] = f"""
WITH RECURSIVE {FRAME}, {NEWTON},
rated AS (SELECT * FROM judged WHERE split IS NOT NULL AND label IS NOT NULL),
{ranked('rated', 'split')}
SELECT split, {BUNDLE.replace(', 6)', ', 4)')} FROM c GROUP BY 1"""
ORACLES["score_cohorts"] = f"""
WITH RECURSIVE {FRAME}, {NEWTON}
SELECT loan_id, Customer_ID, orig_month, score, CAST(score >= 0.5 AS INTEGER) AS prediction,
  'logistic_regression' AS model_name, 'credit_model_2001_06_01' AS model_version FROM judged"""

BINS = 64
ORACLES["boosting_gains"] = f"""
WITH {FRAME},
long AS ({' UNION ALL '.join(f"SELECT '{c}' AS input, {c} AS x, label AS y FROM train" for c in INPUTS)}),
buckets AS (
  SELECT input, floor(sign(x) * asinh(abs(x)) * 4096) AS bucket, count(*) AS n, max(x) AS edge
  FROM long WHERE x IS NOT NULL GROUP BY ALL),
counted AS (
  SELECT *, sum(n) OVER (PARTITION BY input ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY input) AS total FROM buckets),
edges AS (
  SELECT input, list(edge) FILTER (WHERE upto < total AND upto * {BINS} // total > (upto - n) * {BINS} // total) AS edges
  FROM counted GROUP BY input),
balance AS (SELECT sum(1 - label) / sum(label) AS pos, sum(label) * pos + sum(1 - label) AS total,
  pow(2, least(40, 61 - greatest(0, ceil(log2(total))))) AS unit FROM train),
drawn AS (
  SELECT input, CASE WHEN x IS NULL THEN len(edges) ELSE len(list_filter(edges, lambda e: e < x)) END AS bin,
    floor((CASE WHEN y = 1 THEN pos ELSE 1 END) * (0.5 - y) * unit + 0.5) / unit AS g,
    floor((CASE WHEN y = 1 THEN pos ELSE 1 END) * 0.25 * unit + 0.5) / unit AS h
  FROM long JOIN edges USING (input), balance),
bins AS (SELECT input, bin, sum(g) AS g, sum(h) AS h, count(*) AS n FROM drawn GROUP BY ALL),
sides AS (
  SELECT input, bin, sum(g) OVER upto AS lg, sum(h) OVER upto AS lh, sum(n) OVER upto AS ln,
    sum(g) OVER whole AS tg, sum(h) OVER whole AS th, sum(n) OVER whole AS tn
  FROM bins WINDOW upto AS (PARTITION BY input ORDER BY bin), whole AS (PARTITION BY input))
SELECT input, CAST(bin AS BIGINT) AS bin, CAST(ln AS BIGINT) AS n_left, round(lg, 6) + 0 AS g_left, round(lh, 6) + 0 AS h_left,
  CASE WHEN lh >= 5 AND th - lh >= 5 AND tn > ln
    THEN round(lg * lg / (lh + 1) + (tg - lg) * (tg - lg) / (th - lh + 1) - tg * tg / (th + 1), 6) + 0 END AS gain
FROM sides"""
