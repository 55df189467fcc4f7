"""Periodic runs of words: stretches that repeat with one period, and texts without the repeats.

A run is a stretch of consecutive words with smallest period q, at least ``exponent`` periods and
``min_length`` words long, that no neighbouring word extends. All runs are found, with periods up
to a third of the text, by block convolution at dyadic scales:

* A text is cut into blocks of L words, L a power of two. A run with a period d from L to 2 L - 1
  is so long that it holds one whole block and the block's copy at distance d. (The smallest
  scale also takes the distances below L; it is chosen so that ``min_length`` leaves room.)
* Each block is compared with the window that follows it at all these distances at once. The sum
  of squared differences of word numbers, a^2 + c^2 - 2 a c over the block, is zero where the block
  occurs again; the products come from one cyclic convolution of length 2 L, by a
  number-theoretic transform modulo a prime. Whole-number arithmetic misses no occurrence; one
  that is zero only modulo the prime is refused by comparing the words.
* Each distance is a seed: the stretch of words equal to those d further on is extended to both
  sides. It is a run if it is long enough and no smaller period was found on the same stretch, which
  smaller scales come first for.

A block with a word that does not recur within the scale's largest distance cannot be part of such
a run, so no transform is spent on it. Words are numbered per text, texts are handled one at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loanloom.llm.common import map_rows

MIN_LENGTH = 24
EXPONENT = 3

#: 15 * 2^27 + 1, a prime with roots of unity for lengths up to 2^27; 31 generates its group.
PRIME = 15 * 2**27 + 1
ROOT = 31
#: Numbers transformed at a time.
CHUNK = 2**17

WORD = re.compile("[^ \t-\r]+")


def _mod(x: np.ndarray) -> np.ndarray:
    """Residues; dividing by a constant is faster than taking the remainder."""
    return x - (x // np.uint64(PRIME)) * np.uint64(PRIME)


@cache
def _twiddles(size: int) -> tuple[list[np.ndarray], list[np.ndarray], int]:
    """Powers of the roots of unity per level, their inverses, and 1 / size."""
    forward, backward = [], []
    half = size // 2
    while half:
        root = pow(ROOT, (PRIME - 1) // (2 * half), PRIME)
        for out, w in ((forward, root), (backward, pow(root, -1, PRIME))):
            powers = np.ones(1, dtype=np.uint64)
            while len(powers) < half:
                powers = np.concatenate([powers, _mod(powers * np.uint64(pow(w, len(powers), PRIME)))])
            out.append(powers)
        half //= 2
    return forward, backward, pow(size, -1, PRIME)


def ntt(rows: np.ndarray) -> np.ndarray:
    """Transform of each row (residues, a power of two of them), in bit-reversed order."""
    count, size = rows.shape
    for powers in _twiddles(size)[0]:
        half = len(powers)
        pair = rows.reshape(count, -1, 2, half)
        low, high = pair[:, :, 0, :], pair[:, :, 1, :]
        out = np.empty_like(pair)
        out[:, :, 0, :] = _mod(low + high)
        out[:, :, 1, :] = _mod((low + np.uint64(PRIME) - high) * powers)
        rows = out.reshape(count, size)
    return rows


def inverse_ntt(rows: np.ndarray) -> np.ndarray:
    """Rows from their transforms in bit-reversed order."""
    count, size = rows.shape
    _, levels, scale = _twiddles(size)
    for powers in reversed(levels):
        half = len(powers)
        pair = rows.reshape(count, -1, 2, half)
        low, high = pair[:, :, 0, :], _mod(pair[:, :, 1, :] * powers)
        out = np.empty_like(pair)
        out[:, :, 0, :] = _mod(low + high)
        out[:, :, 1, :] = _mod(low + np.uint64(PRIME) - high)
        rows = out.reshape(count, size)
    return _mod(rows * np.uint64(scale))


def mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sum of squared differences of each block to its window at each shift, modulo the prime.

    Blocks have L numbers, windows up to 2 L - 1; with a cyclic length of 2 L no shift at which
    the block lies within the window wraps around.
    """
    count, length = blocks.shape
    shifts = windows.shape[1] - length + 1
    size = 2 * length
    a = np.zeros((count, size), dtype=np.uint64)
    # Turned round, so that the convolution multiplies equal places.
    a[:, 0] = blocks[:, 0]
    a[:, size - length + 1 :] = blocks[:, :0:-1]
    c = np.zeros((count, size), dtype=np.uint64)
    c[:, : windows.shape[1]] = windows
    products = inverse_ntt(_mod(ntt(a) * ntt(c)))[:, :shifts]
    own = _mod(_mod(blocks * blocks).sum(axis=1, keepdims=True))
    squares = np.zeros((count, windows.shape[1] + 1), dtype=np.uint64)
    np.cumsum(_mod(windows * windows), axis=1, out=squares[:, 1:])
    theirs = _mod(squares[:, length : length + shifts] - squares[:, :shifts])
    return _mod(own + theirs + np.uint64(2) * (np.uint64(PRIME) - products))


def _next_same(codes: np.ndarray) -> np.ndarray:
    """Distance to the next equal number; the length of the array where there is none."""
    order = np.argsort(codes, kind="stable")
    gap = np.full(len(codes), len(codes), dtype=np.int64)
    again = codes[order[1:]] == codes[order[:-1]]
    gap[order[:-1][again]] = (order[1:] - order[:-1])[again]
    return gap


def _stretch(codes: np.ndarray, first: int, last: int, d: int) -> tuple[int, int]:
    """The widest [lo, hi) around [first, last) in which each word equals the one d further on."""
    hi, end, step = last, len(codes) - d, 64
    while hi < end:
        upto = min(hi + step, end)
        differs = codes[hi:upto] != codes[hi + d : upto + d]
        if differs.any():
            hi += int(differs.argmax())
            break
        hi, step = upto, 2 * step
    lo, step = first, 64
    while lo > 0:
        low = max(lo - step, 0)
        differs = (codes[low:lo] != codes[low + d : lo + d])[::-1]
        if differs.any():
            lo -= int(differs.argmax())
            break
        lo, step = low, 2 * step
    return lo, hi


def runs_of(codes: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence of numbers from 0, by start, then period."""
    if min_length < 1 or exponent < 3:
        raise ValueError("runs have at least one word and three periods")
    n = len(codes)
    if n < max(min_length, exponent):
        return []
    codes = codes.astype(np.int64)
    padded = np.append(codes, 0)
    padded[n] = codes.max() + 1
    gap = _next_same(codes)
    scale = 1
    while 3 * (2 * scale) - 2 <= min_length:
        scale *= 2
    # The largest gap of each block; blocks of the next scale are made of two.
    widest = gap[: n // scale * scale].reshape(-1, scale).max(axis=1)
    runs: list[tuple[int, int, int]] = []
    known: set[tuple[int, int]] = set()
    first = 1
    while exponent * first <= n and len(widest):
        last = min(2 * scale - 1, n // exponent)
        found = np.flatnonzero(widest <= last) * scale
        if len(found):
            _scan(codes, padded, found, scale, first, last, min_length, exponent, runs, known)
        first = 2 * scale
        scale *= 2
        even = len(widest) // 2 * 2
        widest = widest[:even].reshape(-1, 2).max(axis=1)
    return sorted((s, e - s, q) for s, e, q in runs)


def _scan(codes, padded, starts, scale, first, last, min_length, exponent, runs, known) -> None:
    """Add the runs with periods ``first`` to ``last`` that the blocks at ``starts`` seed."""
    n = len(codes)
    ordered = sorted(runs)
    active: list[tuple[int, int, int]] = []
    taken = 0
    done: dict[int, int] = {}
    per = max(1, CHUNK // (2 * scale))
    for at in range(0, len(starts), per):
        some = starts[at : at + per]
        blocks = codes[some[:, None] + np.arange(scale)].astype(np.uint64)
        # Beyond the text stands a number that no word has. Distances above scale come
        # in a second window of the smallest scale, which also has those below it.
        for low in range(first, last + 1, scale):
            high = min(low + scale - 1, last)
            places = some[:, None] + np.arange(low, high + scale)
            windows = padded[np.minimum(places, n)].astype(np.uint64)
            zero = mismatches(blocks, windows) == 0
            for row in np.flatnonzero(zero.any(axis=1)):
                b = int(some[row])
                while taken < len(ordered) and ordered[taken][0] <= b:
                    active.append(ordered[taken])
                    taken += 1
                active = [r for r in active if r[1] > b]
                distances = np.flatnonzero(zero[row]) + low
                for run in active:
                    distances = _not_within(distances, b, scale, run)
                while len(distances):
                    d = int(distances[0])
                    distances = distances[1:]
                    if b < done.get(d, 0) or not np.array_equal(codes[b : b + scale], codes[b + d : b + d + scale]):
                        continue
                    lo, hi = _stretch(codes, b, b + scale, d)
                    done[d] = hi
                    if hi + d - lo < max(min_length, exponent * d):
                        continue
                    # A smaller period of the stretch divides d and was found before.
                    if any(d % q == 0 for q in _periods(known, runs, lo, hi + d)):
                        continue
                    run = (lo, hi + d, d)
                    runs.append(run)
                    known.add((lo, hi + d))
                    active.append(run)
                    distances = _not_within(distances, b, scale, run)


def _periods(known, runs, start, end) -> list[int]:
    return [q for s, e, q in runs if (s, e) == (start, end)] if (start, end) in known else []


def _not_within(distances: np.ndarray, block: int, scale: int, run: tuple[int, int, int]) -> np.ndarray:
    """Distances but those at which block and copy lie in the run, whole periods apart."""
    start, end, period = run
    if start > block or block + scale > end:
        return distances
    return distances[(distances % period != 0) | (distances + block + scale > end)]


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words without those that a run repeats: of each run its first period stays."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(drop[:-1]) == 0)
    return [words[i] for i in kept]


def split_words(text: str) -> list[str]:
    """Words between blanks and U+0009 to U+000D."""
    return WORD.findall(text)


def word_runs(words: list[str], min_length: int = MIN_LENGTH, exponent: int = EXPONENT):
    """(runs, text without repeats) of a list of words."""
    numbers: dict[str, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words))
    # As many different words as words: nothing repeats.
    runs = runs_of(codes, min_length, exponent) if len(numbers) < len(words) else []
    return runs, " ".join(collapsed(words, runs))


def periodic_runs(
    documents: DataFrame,
    min_length: int = MIN_LENGTH,
    exponent: int = EXPONENT,
    key: str = "doc_id",
    text: str = "text",
    split: Callable[..., list[str]] = split_words,
    more: Sequence[str] = (),
) -> DataFrame:
    """(key, n_words, runs, collapsed) per row: all runs of the whole text, and it without them.

    ``runs`` is an array of (start, length, period) by start, then period. ``collapsed`` has the
    words a run holds beyond its first period removed, the others joined by one blank. A null
    or blank text has no words, no runs and an empty ``collapsed``. Rows are handled one by one
    where they lie, without a shuffle: repeated rows and null keys give a row each, an empty
    table gives none, other columns (of whatever name) are left out.
    """
    kind = documents.schema[key].dataType.simpleString()
    out = f"`{key}` {kind}, n_words long, runs array<struct<start long, length long, period long>>, collapsed string"
    numbers = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
    columns = {"n_words": pa.int64(), "runs": pa.list_(numbers), "collapsed": pa.string()}

    def work(whole: str, *values) -> tuple[tuple, int]:
        words = split(whole, *values)
        found, rest = word_runs(words, min_length, exponent)
        runs = [{"start": s, "length": m, "period": q} for s, m, q in found]
        return (len(words), runs, rest), len(rest) + 24 * len(runs)

    rows = documents.selectExpr(f"`{key}`", f"coalesce(`{text}`, '') AS _text", *[f"{e} AS _{i}" for i, e in enumerate(more)])
    return rows.mapInArrow(lambda batches: map_rows(batches, work, columns), out)


def run_digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row of ``periodic_runs``: how many runs, the run with most periods, and digests.

    Exponents are compared as fractions; the smallest start, then period, wins ties.
    """
    order = (
        "CASE WHEN a.length * b.period > b.length * a.period THEN -1 WHEN a.length * b.period < b.length * a.period THEN 1 "
        "WHEN a.start < b.start THEN -1 WHEN a.start > b.start THEN 1 WHEN a.period < b.period THEN -1 ELSE 1 END"
    )
    told = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return found.selectExpr(
        f"`{key}`", "CAST(size(runs) AS BIGINT) AS n_runs", f"get(array_sort(runs, (a, b) -> {order}), 0) AS top",
        f"sha2({told}, 256) AS runs_sha256", "sha2(collapsed, 256) AS collapsed_sha256",
    ).selectExpr(
        f"`{key}`", "n_runs", "top.start AS start", "top.length AS length", "top.period AS period",
        "1000 * top.length div top.period AS exponent_milli", "runs_sha256", "collapsed_sha256",
    )
