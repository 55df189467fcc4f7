"""Newton's logistic regression and boosted trees against brute force."""

import bisect
import random
import threading

import numpy as np
import pytest

from loanloom.operators import boosting, model
from loanloom.operators.boosting import Boosting
from loanloom.operators.logistic import BLOCK, fit_logistic
from loanloom.plans import catalog
from conftest import TESTDATA


def sample(n, width, seed):
    rng = np.random.default_rng(seed)
    x = np.c_[rng.normal(size=(n, width - 2)).round(1), rng.integers(0, 2, n), np.ones(n)]
    chance = x[:, 0] - x[:, 1] * x[:, width - 2] + rng.logistic(size=n)
    return x, (chance > 0.7).astype(int)


def frame(spark, x, y, parts=3):
    names = [f"c{j}" for j in range(x.shape[1])]
    rows = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    schema = ", ".join(["loan_id long", *[f"{c} double" for c in names], "label int"])
    return spark.createDataFrame(rows, schema).repartition(parts), names


def newton(x, y, w, penalty):
    z = np.c_[x, np.ones(len(y))]
    beta, ridge = np.zeros(z.shape[1]), np.diag([*[penalty] * x.shape[1], 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-z @ beta))
        beta -= np.linalg.solve((z.T * (w * p * (1 - p))) @ z + ridge, z.T @ (w * (p - y)) + ridge @ beta)
    return beta


@pytest.mark.parametrize("width, penalty", [(3, 1.0), (BLOCK, 0.01), (2 * BLOCK + 3, 5.0)])
def test_logistic_equals_newton_in_memory(spark, width, penalty):
    x, y = sample(300, width, width)
    df, names = frame(spark, x[:, :-1], y)
    fit = fit_logistic(df, names, weight="if(label = 1, 2.5D, 1D)", penalty=penalty)
    want = newton(x[:, :-1], y, np.where(y == 1, 2.5, 1.0), penalty)
    assert [*fit.coefficients, fit.intercept] == pytest.approx(list(want), abs=1e-9)
    assert fit.gradient < 1e-10 and 3 <= fit.steps < 20
    got = fit.stage().transform(df).orderBy("loan_id").select("p_default").collect()
    chances = 1 / (1 + np.exp(-(np.c_[x[:, :-1], np.ones(300)] @ want)))
    assert [r[0] for r in got] == pytest.approx(list(chances), abs=1e-9)


def test_logistic_on_separable_rows(spark):
    """A steep start overshoots; the penalty keeps the optimum finite."""
    df, names = frame(spark, np.array([[v] for v in (-900.0, -800.0, 1.0, 800.0, 950.0)]), [0, 0, 1, 1, 1])
    fit = fit_logistic(df, names, penalty=1e-3)
    assert fit.gradient < 1e-9 and np.isfinite(fit.coefficients[0]) and fit.coefficients[0] > 0


def grow_in_memory(x, y, w, params, drawn_rows=None, drawn_inputs=None):
    """The same trees from the definition: every node tries every edge of every input."""
    n, width = x.shape
    edges = []
    for j in range(width):
        counts = {}
        for v in x[:, j]:
            counts.setdefault(np.floor(np.sign(v) * np.arcsinh(abs(v)) * 4096), []).append(v)
        seen, own = 0, []
        for bucket in sorted(counts):
            before, seen = seen, seen + len(counts[bucket])
            if seen < n and seen * params.bins // n > before * params.bins // n:
                own.append(float(max(counts[bucket])))
        edges.append(own)
    bins = np.array([[bisect.bisect_left(edges[j], v) for j, v in enumerate(r)] for r in x])
    unit = boosting.unit_for(w.sum())
    margin, trees = np.zeros(n), []
    for t in range(params.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = (np.floor(d * unit + 0.5) / unit for d in (w * (p - y), w * p * (1 - p)))
        inputs = drawn_inputs[t] if drawn_inputs else [j for j in range(width) if edges[j]]
        tree = {}

        def grow(at, rows, depth):
            sums, best = (g[rows].sum(), h[rows].sum()), None
            for j in inputs if depth < params.depth else ():
                for c in sorted(set(bins[rows, j])):
                    left, right = rows & (bins[:, j] <= c), rows & (bins[:, j] > c)
                    sides = [(g[s].sum(), h[s].sum(), s.sum()) for s in (left, right)]
                    if not right.any() or any(b < params.min_weight or m < params.min_rows for _, b, m in sides):
                        continue
                    score = [a * a / (b + params.reg_lambda) for a, b in (*[s[:2] for s in sides], sums)]
                    gain = score[0] + score[1] - score[2]
                    if gain > boosting.LEAST_GAIN and (best is None or gain > best[0]):
                        best = (gain, j, edges[j][c], left, right)
            tree[at] = -sums[0] / (sums[1] + params.reg_lambda) * params.rate
            if best is None:
                return True
            leaves = [grow(2 * at, best[3], depth + 1), grow(2 * at + 1, best[4], depth + 1)]
            if best[0] < params.gamma and all(leaves):
                del tree[2 * at], tree[2 * at + 1]
                return True
            tree[at] = best[1:3]
            return False

        grow(1, np.ones(n, bool) if drawn_rows is None else drawn_rows[t], 0)
        trees.append(tree)
        for i in range(n):
            at = 1
            while isinstance(tree[at], tuple):
                at = 2 * at + (x[i, tree[at][0]] > tree[at][1])
            margin[i] += tree[at]
    return trees, 1 / (1 + np.exp(-margin))


def nodes(fit):
    trees = [{} for _ in fit.trees]
    for t, at, name, edge, _, value in boosting.tree_rows(fit):
        trees[t][at] = (fit.inputs.index(name), edge) if name else value
    return trees


def same(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert set(a) == set(b)
        assert {k: v for k, v in a.items() if isinstance(v, tuple)} == {k: v for k, v in b.items() if isinstance(v, tuple)}
        leaves = [k for k, v in a.items() if not isinstance(v, tuple)]
        assert [a[k] for k in leaves] == pytest.approx([b[k] for k in leaves], rel=1e-9, abs=1e-15)


@pytest.mark.parametrize(
    "params",
    [
        Boosting(trees=12, depth=3, rate=0.3, gamma=1.0, min_weight=5.0, bins=16),
        Boosting(trees=3, depth=4, rate=0.1, min_rows=40, reg_lambda=0.0, bins=64),
        Boosting(trees=2, depth=2, gamma=1e9),
    ],
)
def test_trees_equal_the_definition(spark, tmp_path, params):
    x, y = sample(400, 4, params.depth)
    df, names = frame(spark, x, y)
    fit = boosting.fit_boosted(df, names, str(tmp_path / "a"), params, weight="if(label = 1, 2.5D, 1D)")
    trees, chances = grow_in_memory(x, y, np.where(y == 1, 2.5, 1.0), params)
    same(nodes(fit), trees)
    got = fit.stage().transform(df).orderBy("loan_id").select("p_default").collect()
    assert [r[0] for r in got] == pytest.approx(list(chances), abs=1e-12)
    # However the rows lie, to the last bit.
    again = boosting.fit_boosted(df.repartition(7, "c0"), names, str(tmp_path / "b"), params, weight="if(label = 1, 2.5D, 1D)")
    assert nodes(again) == nodes(fit)


def test_sampled_rows_and_inputs(spark, tmp_path):
    params = Boosting(trees=4, depth=2, rate=0.5, subsample=0.6, columns=0.5, bins=8)
    x, y = sample(500, 6, 3)
    df, names = frame(spark, x, y)
    fit = boosting.fit_boosted(df, names, str(tmp_path), params, key="loan_id")
    draws = [f"pmod(xxhash64(xxhash64(loan_id), {t}, {params.seed}), 1000000) < 600000 AS d{t}" for t in range(4)]
    flags = np.array([tuple(r) for r in df.orderBy("loan_id").selectExpr(*draws).collect()])
    assert 0.5 < flags.mean() < 0.7 and len({tuple(f) for f in flags.T}) == 4
    usable = [j for j, e in enumerate(fit.edges) if e]
    assert usable == [0, 1, 2, 3, 4]
    inputs = [sorted(random.Random(f"{params.seed}-{t}").sample(usable, 2)) for t in range(4)]
    trees, _ = grow_in_memory(x, y, np.ones(500), params, list(flags.T), inputs)
    same(nodes(fit), trees)


def test_missing_constant_and_empty_inputs(spark, tmp_path):
    df = spark.createDataFrame(
        [(None, 1.0, 1), (float("nan"), 1.0, 1), (0.0, 1.0, 0), (1.0, 1.0, 0)] * 30, "a double, b double, label int"
    )
    fit = boosting.fit_boosted(df, ["a", "b"], str(tmp_path / "a"), Boosting(trees=1, depth=3, rate=1.0))
    tree = nodes(fit)[0]
    # Missing values lie beyond every edge, before the fit and after it.
    assert fit.edges == ((0.0,), ()) and set(tree) == {1, 2, 3}
    got = {r["a"]: r["p_default"] for r in fit.stage().transform(df.where("a IS NULL OR a = 0")).collect()}
    assert got[None] > got[0.0]
    flat = boosting.fit_boosted(df, ["b"], str(tmp_path / "b"), Boosting(trees=2))
    assert [set(t) for t in nodes(flat)] == [{1}, {1}]
    none = boosting.fit_boosted(df.limit(0), ["a"], str(tmp_path / "c"), Boosting(trees=1))
    assert nodes(none) == [{1: 0.0}]


def test_boosted_model_is_saved_and_read(spark, tmp_path):
    x, y = sample(300, 4, 8)
    df, names = frame(spark, x, y)
    fitted = model.fit_candidate("gbt_shallow", df, names, [], max_iter=3, folder=str(tmp_path / "fit"))
    fitted.save(str(tmp_path / "model"))
    again = model.load_fitted(spark, str(tmp_path / "model"), [])
    rows = [m.transform(df).orderBy("loan_id").select("p_default").collect() for m in (fitted, again)]
    assert rows[0] == rows[1] and len({r[0] for r in rows[0]}) > 3


@pytest.mark.skipif(not TESTDATA.exists(), reason="test tables not present")
def test_boosted_query_equals_the_definition(spark):
    """The first trees of the registered query, on the rows it is fitted on."""
    df = catalog._training_frame(spark, str(TESTDATA / "sf0.001"))
    train = df.where("split = 'train' AND label IS NOT NULL").select("loan_id", "label", *catalog.MODEL_INPUTS)
    plan = model.fit_preparation(train, catalog.MODEL_INPUTS)
    ready = train.selectExpr("loan_id", "label", *plan.columns()).orderBy("loan_id").collect()
    inputs = list(plan.expressions())
    x, y = np.array([[r[c] for c in inputs] for r in ready]), np.array([r["label"] for r in ready])
    params = model.boosting("gbt_shallow", catalog.SETTINGS, 3)
    weight = (y == 0).sum() / max((y == 1).sum(), 1)
    ids = spark.createDataFrame([(r["loan_id"],) for r in ready], "loan_id string").coalesce(1)
    draws = [f"pmod(xxhash64(xxhash64(loan_id), {t}, {params.seed}), 1000000) < 800000 AS d{t}" for t in range(3)]
    flags = np.array([tuple(r) for r in ids.orderBy("loan_id").selectExpr(*draws).collect()])
    usable = list(range(len(inputs)))
    chosen = [sorted(random.Random(f"{params.seed}-{t}").sample(usable, 2)) for t in range(3)]
    _, chances = grow_in_memory(x, y, np.where(y == 1, weight, 1.0), params, list(flags.T), chosen)
    fitted = catalog._fitted(df, "gbt_shallow", 3)
    got = fitted.transform(train).orderBy("loan_id").select("p_default").collect()
    assert [r[0] for r in got] == pytest.approx(list(chances), abs=1e-9)


def test_bake_off_side_by_side_equals_in_turn(spark, tmp_path):
    x, y = sample(300, 4, 11)
    df, names = frame(spark, x, y)
    df.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    plan = model.fit_preparation(rows, names)

    def fit(way):
        def one(name):
            made = model.fit_candidate(name, rows, names, [], preparation=plan, max_iter=2, folder=str(tmp_path / way / name))
            return model.split_metrics(made, rows.selectExpr("*", "'train' AS split"), None).collect()

        return one

    both = [model.bake_off(spark, model.CANDIDATES, fit(str(parallel)), parallel) for parallel in (True, False)]
    assert both[0] == both[1] and list(both[0]) == list(model.CANDIDATES)


def test_bake_off_runs_at_once_and_raises_failures(spark):
    meet = threading.Barrier(3, timeout=60)
    pools = {}

    def fit(name):
        # All three have to be under way at the same time.
        meet.wait()
        pools[name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        return name.upper()

    assert model.bake_off(spark, ["a", "b", "c"], fit) == {"a": "A", "b": "B", "c": "C"}
    assert pools == {"a": "a", "b": "b", "c": "c"}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None

    def fails(name):
        if name == "b":
            raise ValueError(name)

    with pytest.raises(ValueError, match="b"):
        model.bake_off(spark, ["a", "b"], fails)


def test_bins_are_searched_not_listed(spark):
    inf, nan = float("inf"), float("nan")
    values = [-inf, -1e300, -2.5, -1.0, -0.0, 0.0, 0.3, 1.0, 7.0, 1e300, inf, nan, None]
    edges = ((-1.0, 0.0, 1.0), (-inf, -0.0, 7.0), (), (-inf,))
    df = spark.createDataFrame([(v,) * 4 for v in values], "a double, b double, c double, d double")
    got = boosting.binned(df, list("abcd"), edges, "a")
    for row, v in zip(got.collect(), values):
        for i, e in enumerate(edges):
            missing = v is None or v != v
            assert row[f"b{i}"] == (len(e) if missing else sum(x < v for x in e))
    assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()
