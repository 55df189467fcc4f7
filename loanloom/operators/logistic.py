"""Penalised logistic regression by Newton steps, with sums as SQL aggregates.

Each step is one job: residuals and weights of all rows under the current coefficients, and from them
the gradient X'r and the Hessian X'WX. A row meets every pair of column blocks, and the
products within a pair are plain sums, combined map-side; what reaches the driver is as large as
the model. The fit ends when the gradient is zero to within the tolerance, so the result does
not depend on where a line search stopped, and two fits of the same rows agree.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame

from loanloom.functions.cleaning import quoted
from loanloom.operators.metrics import exprs

#: Columns of a block: a step adds this number squared of products per pair and row.
BLOCK = 8
MAX_STEPS = 100
HALVINGS = 30
#: Column a scoring stage adds: the probability of default.
PROBABILITY = "p_default"


def number(value: float) -> str:
    """A double as SQL, to the last bit."""
    return f"CAST('{float(value)!r}' AS DOUBLE)"


class ScoringStage(SQLTransformer):
    """A pipeline stage that adds the probability; saved and loaded as the projection it is."""

    def __init__(self, probability: str):
        super().__init__(statement=f"SELECT *, {probability} AS {PROBABILITY} FROM __THIS__")


@dataclass(frozen=True)
class LogisticFit:
    """Coefficients in the order of the inputs, and how far the fit got."""

    inputs: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    steps: int
    gradient: float

    def margin(self) -> str:
        terms = [number(self.intercept), *(f"{number(c)} * {quoted(x)}" for c, x in zip(self.coefficients, self.inputs))]
        return " + ".join(terms)

    def stage(self) -> ScoringStage:
        stage = ScoringStage(f"1D / (1D + exp(-({self.margin()})))")
        stage.coefficients, stage.intercept = list(self.coefficients), self.intercept
        return stage


def fit_logistic(
    rows: DataFrame,
    inputs: Sequence[str],
    label: str = "label",
    weight: str = "1D",
    penalty: float = 1.0,
    tolerance: float = 1e-12,
) -> LogisticFit:
    """Fit labels 0 and 1 on numeric columns without NULLs.

    Minimises the weighted log loss plus half ``penalty`` times the squared coefficients; the
    intercept is free. ``tolerance`` bounds the largest part of the gradient per unit of
    weight. Rows are read once a step: pass a table that is cheap to read.
    """
    beta = np.zeros(len(inputs) + 1)
    ridge = np.append(np.full(len(inputs), float(penalty)), 0.0)
    step, steps = np.zeros_like(beta), 0
    gradient, hessian, loss, total = _sums(rows, inputs, label, weight, beta, ridge)
    while steps < MAX_STEPS:
        size = float(np.abs(gradient).max())
        if size <= tolerance * total:
            break
        step = np.linalg.solve(hessian, gradient)
        for _ in range(HALVINGS):
            found = _sums(rows, inputs, label, weight, beta - step, ridge)
            # At the end of a fit the loss no longer moves by more than its own rounding.
            if found[2] <= loss + 1e-12 * abs(loss):
                break
            step = step / 2
        steps += 1
        beta = beta - step
        smaller = float(np.abs(found[0]).max()) < size
        gradient, hessian, loss, total = found
        if not smaller and size <= 1e-6 * total:
            # The rounding of the sums is reached.
            break
    size = float(np.abs(gradient).max())
    return LogisticFit(tuple(inputs), tuple(map(float, beta[:-1])), float(beta[-1]), steps, size / total if total else 0.0)


def _sums(rows, inputs, label, weight, beta, ridge):
    """Gradient, Hessian, loss and total weight at ``beta``."""
    width = len(inputs) + 1
    blocks = math.ceil(width / BLOCK)
    columns = [*(f"CAST({quoted(c)} AS DOUBLE)" for c in inputs), "1D", *["0D"] * (blocks * BLOCK - width)]
    margin = " + ".join([number(beta[-1]), *(f"{number(b)} * x[{i}]" for i, b in enumerate(beta[:-1]))])
    seen = (
        rows.selectExpr(f"array({', '.join(columns)}) AS x", f"CAST({label} AS DOUBLE) AS y", f"CAST({weight} AS DOUBLE) AS w")
        .selectExpr("x", "y", "w", f"{margin} AS m")
        .selectExpr("x", "y", "w", "m", "1D / (1D + exp(-m)) AS p")
        .selectExpr(
            "x", "w", "w * (p - y) AS r", "w * p * (1D - p) AS h",
            "w * (greatest(m, 0D) - y * m + log1p(exp(-abs(m)))) AS loss",
        )
    )
    pairs = ", ".join(f"named_struct('a', {a}, 'b', {b})" for a in range(blocks) for b in range(a, blocks))
    paired = seen.selectExpr(f"inline(array({pairs}))", "*").selectExpr(
        "a", "b", "r", "h", "w", "loss", f"slice(x, a * {BLOCK} + 1, {BLOCK}) AS xa", f"slice(x, b * {BLOCK} + 1, {BLOCK}) AS xb"
    )
    products = [f"sum(h * xa[{i}] * xb[{j}]) AS h{i}_{j}" for i in range(BLOCK) for j in range(BLOCK)]
    sums = paired.groupBy("a", "b").agg(
        *exprs(*products, *[f"sum(r * xa[{i}]) AS g{i}" for i in range(BLOCK)], "sum(loss) AS loss", "sum(w) AS w")
    )
    gradient, hessian = np.zeros(blocks * BLOCK), np.zeros((blocks * BLOCK,) * 2)
    loss = total = 0.0
    for r in sums.collect():  # one row per pair of blocks
        a, b = r["a"] * BLOCK, r["b"] * BLOCK
        part = np.array([[r[f"h{i}_{j}"] for j in range(BLOCK)] for i in range(BLOCK)])
        hessian[a : a + BLOCK, b : b + BLOCK] = part
        hessian[b : b + BLOCK, a : a + BLOCK] = part.T
        if a == b:
            gradient[a : a + BLOCK] = [r[f"g{i}"] for i in range(BLOCK)]
        if (a, b) == (0, 0):
            loss, total = r["loss"], r["w"]
    free = np.append(beta[:-1], 0.0)
    gradient = gradient[:width] + ridge * free
    return gradient, hessian[:width, :width] + np.diag(ridge), loss + float(ridge @ free**2) / 2, total
