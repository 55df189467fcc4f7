"""SQL expressions on scores and metrics.

Scores are probabilities kept to six decimals, so a score is also an integer
number of millionths. Histograms use that integer: it groups exactly, and a group
has at most 1,000,001 distinct scores however many rows it has.
"""

from __future__ import annotations

from loanloom.config import DEFAULTS, Settings

MICRO = 1_000_000


def to_micro(score: str) -> str:
    """Millionths; NULL for a score that is missing or not a number."""
    return f"floor(nullif({score}, DOUBLE('NaN')) * {MICRO}D + 0.5D)"


def from_micro(micro: str) -> str:
    return f"({micro} / {float(MICRO)!r}D)"


def decide(score: str, threshold: float | str) -> str:
    cut = threshold if isinstance(threshold, str) else f"{float(threshold)!r}D"
    return f"CAST({score} >= {cut} AS INT)"


def psi_band(psi: str, settings: Settings = DEFAULTS) -> str:
    return (
        f"CASE WHEN {psi} < {settings.psi_watch!r}D THEN 'green' "
        f"WHEN {psi} < {settings.psi_retrain!r}D THEN 'amber' "
        f"WHEN {psi} IS NOT NULL THEN 'red' END"
    )


def psi_of_shares(actual: str, expected: str, floor: str = "1e-6D") -> str:
    """Population stability index of two arrays of bin shares, empty bins floored."""
    a, e = f"greatest(a, {floor})", f"greatest(e, {floor})"
    terms = f"zip_with({actual}, {expected}, (a, e) -> ({a} - {e}) * ln({a} / {e}))"
    return f"aggregate({terms}, 0D, (s, x) -> s + x)"
