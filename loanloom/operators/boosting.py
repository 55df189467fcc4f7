"""Second-order boosted trees on gradient histograms, one aggregation per level of a tree.

Inputs are cut into bins of about equal rows once. For every level the rows of each open node are
summed by input and bin: first and second derivative of the log loss, and rows, combined map-side,
so what is shuffled and what reaches the driver is as large as the tree, whatever the rows. A split's
gain is the penalised one, GL^2 / (HL + lambda) + GR^2 / (HR + lambda) - G^2 / (H + lambda), a leaf's
value the Newton step -G / (H + lambda). A grown tree loses the splits, from the leaves up,
whose gain is below ``gamma``.

Derivatives are whole multiples of a power of two that leaves room for the sum over all rows. Sums
are therefore exact, and a fit does not depend on partitions, retries or lost executors: the same rows
give the same trees. Every STRIDE trees the margins so far are written beside the bins, so no plan
grows with the number of trees.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.functions.cleaning import quoted
from loanloom.operators.logistic import ScoringStage, number
from loanloom.operators.metrics import exprs
from loanloom.operators.stats import BUCKET, melt
from loanloom.sources.sinks import stored

STRIDE = 10
#: A split has to gain more than this to be tried at all.
LEAST_GAIN = 1e-6
SAMPLES = 1_000_000


@dataclass(frozen=True)
class Boosting:
    """Parameters of a fit."""

    trees: int = 300
    depth: int = 3
    rate: float = 0.05
    reg_lambda: float = 1.0
    gamma: float = 0.0
    min_weight: float = 1e-3
    min_rows: int = 1
    subsample: float = 1.0
    columns: float = 1.0
    bins: int = 64
    seed: int = 42


@dataclass
class Node:
    """A node of a tree; a leaf as long as it has no feature."""

    value: float = 0.0
    feature: int | None = None
    bin: int = 0
    gain: float = 0.0


#: Node 1 is the root, the children of node k are 2 k and 2 k + 1.
Tree = dict[int, Node]


@dataclass(frozen=True)
class BoostedTrees:
    inputs: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]
    trees: list[Tree] = field(default_factory=list)

    def margin(self, binned: bool = False, trees: Sequence[Tree] | None = None) -> str:
        """SQL sum of the trees over the inputs, or over the bin columns ``b0`` and on."""
        leaves = [self._below(t, 1, binned) for t in (self.trees if trees is None else trees)]
        # An array's elements are compiled into methods of their own, a long sum is not.
        return f"aggregate(array({', '.join(leaves)}), 0D, (s, x) -> s + x)" if leaves else "0D"

    def _below(self, tree: Tree, at: int, binned: bool) -> str:
        node = tree[at]
        if node.feature is None:
            return number(node.value)
        return f"if({self.goes_left(node, binned)}, {self._below(tree, 2 * at, binned)}, {self._below(tree, 2 * at + 1, binned)})"

    def goes_left(self, node: Node, binned: bool) -> str:
        """Missing numbers go right: they are beyond the last edge."""
        if binned:
            return f"b{node.feature} <= {node.bin}"
        return f"{quoted(self.inputs[node.feature])} <= {number(self.edges[node.feature][node.bin])}"

    def stage(self) -> ScoringStage:
        return ScoringStage(f"1D / (1D + exp(-({self.margin()})))")


def bin_edges(rows: DataFrame, inputs: Sequence[str], bins: int) -> tuple[tuple[float, ...], ...]:
    """Values at which each input is cut into about ``bins`` parts of equal rows; none for a constant.

    Values are counted in fine buckets in value order (4,096 per unit of asinh); where the rows so
    far pass a multiple of their ``bins``-th part, the bucket's largest value is an edge. Counts do not
    depend on the order of rows, and a window holds buckets, not rows.
    """
    upto = "sum(n) OVER (PARTITION BY column ORDER BY bucket)"
    cut = (
        melt(rows, inputs)
        .groupBy("column", F.expr(f"{BUCKET} AS bucket"))
        .agg(*exprs("count(*) AS n", "max(value) AS edge"))
        .selectExpr("column", "edge", "n", f"{upto} AS upto", "sum(n) OVER (PARTITION BY column) AS total")
        .where(f"upto < total AND upto * {bins} div total > (upto - n) * {bins} div total")
    )
    found: dict[str, list[float]] = {}
    for r in cut.select("column", "edge").collect():  # fewer than ``bins`` per input
        found.setdefault(r["column"], []).append(r["edge"])
    return tuple(tuple(sorted(found.get(c, ()))) for c in inputs)


def binned(rows: DataFrame, inputs: Sequence[str], edges: Sequence[Sequence[float]], *more: str) -> DataFrame:
    """Bin numbers ``b0`` and on: how many edges lie below a value. NULL and NaN are in the last bin.

    A bin is found by binary search. Bucketizer's parts are open above, bins open below: it sees
    values and edges with the sign turned. An edge of minus infinity, which cannot be turned into an inner
    one, has the other values beyond it.
    """
    placed, columns = rows, []
    for i, (c, e) in enumerate(zip(inputs, edges)):
        inner = [v for v in e if v > -math.inf]
        first, last = len(e) - len(inner), len(e)
        value = f"coalesce(CAST({quoted(c)} AS DOUBLE), DOUBLE('NaN'))"
        inside = f"{first}" + (f" + {len(inner)} - CAST(_part{i} AS INT)" if inner else "")
        if inner:
            # Nought minus a value is no negative zero, which the search tells from zero.
            placed = placed.withColumn(f"_turned{i}", F.expr(f"0D - {value}"))
            splits = [-math.inf, *sorted(0.0 - v for v in inner), math.inf]
            placed = Bucketizer(splits=splits, inputCol=f"_turned{i}", outputCol=f"_part{i}", handleInvalid="keep").transform(placed)
        least = f"WHEN {value} = DOUBLE('-Infinity') THEN 0 " if first else ""
        columns.append(f"CAST(CASE WHEN isnan({value}) THEN {last} {least}ELSE {inside} END AS SMALLINT) AS b{i}")
    return placed.selectExpr(*columns, *more)


def derivatives(rows: DataFrame, unit: float, *kept: str) -> DataFrame:
    """Kept columns with ``g`` and ``h``, derivatives of the log loss at ``margin`` in multiples of 1 / unit."""
    chance = rows.selectExpr(*kept, "y", "w", "1D / (1D + exp(-margin)) AS p")
    return chance.selectExpr(
        *kept,
        f"CAST(floor(w * (p - y) * {number(unit)} + 0.5D) AS BIGINT) AS g",
        f"CAST(floor(w * p * (1D - p) * {number(unit)} + 0.5D) AS BIGINT) AS h",
    )


def unit_for(total_weight: float) -> float:
    """The largest power of two at which the sum over all rows stays within 64 bits."""
    return float(2 ** min(40, 61 - max(0, math.ceil(math.log2(max(total_weight, 1.0))))))


def histograms(rows: DataFrame, features: Sequence[int]) -> DataFrame:
    """(node, feature, bin, g, h, n): sums of rows that have node, g, h and the bin columns."""
    each = ", ".join(f"named_struct('feature', {f}, 'bin', b{f})" for f in features)
    long = rows.selectExpr("node", "g", "h", f"inline(array({each}))")
    return long.groupBy("node", "feature", "bin").agg(*exprs("sum(g) AS g", "sum(h) AS h", "count(*) AS n"))


def split_gains(sums: DataFrame, unit: float, params: Boosting) -> DataFrame:
    """Each split 'bin and below go left' of each node and input, with its gain.

    The gain is NULL where a side is too small. The windows run over the bins of one input.
    """
    upto = "PARTITION BY node, feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    whole = "PARTITION BY node, feature"
    lam = number(params.reg_lambda)
    sides = sums.selectExpr(
        "node", "feature", "bin",
        *[f"sum({c}) OVER ({upto}) AS l{c}" for c in "ghn"], *[f"sum({c}) OVER ({whole}) AS t{c}" for c in "ghn"],
    ).selectExpr(
        "node", "feature", "bin", "ln", "tn", "tn - ln AS rn",
        *[f"l{c} / {number(unit)} AS l{c}" for c in "gh"], *[f"(t{c} - l{c}) / {number(unit)} AS r{c}" for c in "gh"],
        *[f"t{c} / {number(unit)} AS t{c}" for c in "gh"],
    )
    enough = " AND ".join(
        [f"{s}h >= {number(params.min_weight)} AND {s}n >= {params.min_rows}" for s in "lr"] + ["rn > 0"]
    )
    gain = f"lg * lg / (lh + {lam}) + rg * rg / (rh + {lam}) - tg * tg / (th + {lam})"
    return sides.selectExpr("*", f"CASE WHEN {enough} THEN {gain} END AS gain")


def fit_boosted(
    rows: DataFrame,
    inputs: Sequence[str],
    folder: str,
    params: Boosting = Boosting(),
    label: str = "label",
    weight: str = "1D",
    key: str | None = None,
) -> BoostedTrees:
    """Fit labels 0 and 1 on numeric columns; tables of the fit go to ``folder``, which all executors share.

    ``key`` names the rows for sampling (``subsample``): a row's draw per tree hangs on it alone;
    without a key on the row's inputs. Splits of equal gain: the first input, then the lowest bin.
    """
    edges = bin_edges(rows, inputs, params.bins)
    model = BoostedTrees(tuple(inputs), edges)
    name = quoted(key) if key else ", ".join(map(quoted, inputs))
    start = binned(
        rows, inputs, edges, f"CAST({label} AS DOUBLE) AS y", f"CAST({weight} AS DOUBLE) AS w",
        f"xxhash64({name}) AS id", "0D AS margin",
    )
    table = stored(start, f"{folder}/margins-0")
    unit = unit_for(table.selectExpr("sum(w)").first()[0] or 0.0)
    splittable = [i for i, e in enumerate(edges) if e]
    for tree_id in range(params.trees):
        recent = model.trees[tree_id // STRIDE * STRIDE :]
        if tree_id and not recent:
            margin = f"margin + {model.margin(True, model.trees[-STRIDE:])} AS margin"
            kept = [c for c in table.columns if c != "margin"]
            table = stored(table.selectExpr(*kept, margin), f"{folder}/margins-{tree_id}")
        draw = random.Random(f"{params.seed}-{tree_id}")
        chosen = sorted(draw.sample(splittable, max(1, int(params.columns * len(splittable))))) if splittable else []
        sampled = table
        if params.subsample < 1:
            limit = round(params.subsample * SAMPLES)
            sampled = table.where(f"pmod(xxhash64(id, {tree_id}, {params.seed}), {SAMPLES}) < {limit}")
        now = f"margin + {model.margin(True, recent)} AS margin" if recent else "margin"
        columns = [f"b{f}" for f in chosen]
        # Recent trees look at inputs this one may not have drawn.
        known = derivatives(sampled.selectExpr(*columns, "y", "w", now), unit, *columns)
        model.trees.append(_grown(model, known, unit, chosen, params))
    return model


def _grown(model: BoostedTrees, rows: DataFrame, unit: float, features: Sequence[int], params: Boosting) -> Tree:
    tree: Tree = {1: Node()}
    if not features:
        sums = rows.selectExpr("sum(g) AS g", "sum(h) AS h").first()
        tree[1].value = _leaf(sums["g"] or 0, sums["h"] or 0, unit, params)
        return tree
    open_ = {1}
    for level in range(params.depth):
        at = _place(model, tree, 1)
        nodes = rows.selectExpr("*", f"{at} AS node").where(f"node IN ({', '.join(map(str, sorted(open_)))})")
        gains = split_gains(histograms(nodes, features), unit, params)
        best = gains.groupBy("node").agg(
            *exprs(
                "max(CASE WHEN gain IS NOT NULL THEN struct(gain, -feature AS feature, -bin AS bin, lg, lh, rg, rh) END) AS best",
                "max(tg) AS tg", "max(th) AS th",
            )
        ).collect()  # one row per open node
        open_ = set()
        for r in best:
            if level == 0:
                tree[1].value = _leaf(r["tg"], r["th"], 1.0, params)
            pick = r["best"]
            if pick is None or not pick["gain"] > LEAST_GAIN:
                continue
            node = tree[r["node"]]
            node.feature, node.bin, node.gain = -pick["feature"], -pick["bin"], pick["gain"]
            for child, side in ((2 * r["node"], "l"), (2 * r["node"] + 1, "r")):
                tree[child] = Node(_leaf(pick[side + "g"], pick[side + "h"], 1.0, params))
                open_.add(child)
        if not open_:
            break
    _prune(tree, 1, params.gamma)
    return tree


def _leaf(g: float, h: float, unit: float, params: Boosting) -> float:
    return -(g / unit) / (h / unit + params.reg_lambda) * params.rate


def _place(model: BoostedTrees, tree: Tree, at: int) -> str:
    """SQL number of the node a row is in."""
    node = tree[at]
    if node.feature is None:
        return str(at)
    return f"if({model.goes_left(node, True)}, {_place(model, tree, 2 * at)}, {_place(model, tree, 2 * at + 1)})"


def _prune(tree: Tree, at: int, gamma: float) -> None:
    """Take back splits that gain less than ``gamma`` and whose children are leaves, from the bottom."""
    node = tree[at]
    if node.feature is None:
        return
    left, right = 2 * at, 2 * at + 1
    _prune(tree, left, gamma)
    _prune(tree, right, gamma)
    if node.gain < gamma and tree[left].feature is None and tree[right].feature is None:
        node.feature = None
        del tree[left], tree[right]


def tree_rows(model: BoostedTrees) -> Iterator[tuple[int, int, str | None, float | None, float, float]]:
    """(tree, node, input, edge, gain, value) of every node."""
    for t, tree in enumerate(model.trees):
        for at, node in sorted(tree.items()):
            if node.feature is None:
                yield t, at, None, None, 0.0, node.value
            else:
                yield t, at, model.inputs[node.feature], model.edges[node.feature][node.bin], node.gain, node.value
