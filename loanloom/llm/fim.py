"""Fill-in-middle: texts cut into prefix, middle and suffix at unit boundaries, and put back.

A text is a sequence of character classes, one per code point: inside a word, last of a word, white
space, and the white space that ends the text. They are held as a wavelet matrix, one bit vector
per bit of the class with counts per 64 positions, so ``rank`` tells how many characters of a class
stand before a position in constant time. A unit of kind ``word`` is a word with the white space
before it, or white space at the end of the text: it ends at the last character of a word or at
the end of the text, so the boundaries before a position are the sum of two ranks. A cut after k units is
found by bisection on that sum, and never looks at the characters again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loanloom.llm.common import map_rows

#: Marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Character classes.
INNER, WORD_END, SPACE, TEXT_END = range(4)
#: Classes that end a unit of each kind.
UNITS = {"word": (WORD_END, TEXT_END), "char": (INNER, WORD_END, SPACE, TEXT_END)}

#: Characters classified at a time.
CHUNK = 2**20


def classes(text: str) -> np.ndarray:
    """One class per code point; white space is the blank and U+0009 to U+000D."""
    out = np.empty(len(text), dtype=np.uint8)
    for at in range(0, len(text), CHUNK):
        # One more character tells whether a word ends with this chunk.
        points = np.frombuffer(text[at : at + CHUNK + 1].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        space = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
        after = np.append(space[1:], True)
        some = np.where(space, SPACE, np.where(after, WORD_END, INNER))
        out[at : at + CHUNK] = some[: min(CHUNK, len(text) - at)]
    if len(out) and out[-1] == SPACE:
        out[-1] = TEXT_END
    return out


class Bits:
    """Bits with the number of ones before each block of 64."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.blocks = np.concatenate([packed, np.zeros(8 + -len(packed) % 8, dtype=np.uint8)]).view(np.uint64)
        self.before = np.zeros(len(self.blocks) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.blocks), out=self.before[1:])
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, upto: int) -> int:
        """Ones among the first ``upto`` bits."""
        block, rest = divmod(upto, 64)
        return int(self.before[block]) + (int(self.blocks[block]) & ((1 << rest) - 1)).bit_count()


class WaveletMatrix:
    """Symbols below 2^bits with rank in a step per bit; each level sorts by the next lower bit."""

    def __init__(self, symbols: np.ndarray, bits: int = 2):
        self.size, self.levels = len(symbols), []
        for bit in range(bits - 1, -1, -1):
            ones = (symbols >> bit & 1).astype(bool)
            self.levels.append((bit, Bits(ones)))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: int, upto: int) -> int:
        """How often ``symbol`` is among the first ``upto``."""
        low, high = 0, upto
        for bit, level in self.levels:
            if symbol >> bit & 1:
                low, high = level.zeros + level.ones(low), level.zeros + level.ones(high)
            else:
                low, high = low - level.ones(low), high - level.ones(high)
        return high - low


class Boundaries:
    """Unit boundaries of a text: how many there are, and where the k-th one is."""

    def __init__(self, text: str, unit: str = "word"):
        self.matrix, self.ending = WaveletMatrix(classes(text)), UNITS[unit]
        self.units = self.count(self.matrix.size)

    def count(self, upto: int) -> int:
        """Units that end within the first ``upto`` characters."""
        return sum(self.matrix.rank(c, upto) for c in self.ending)

    def after(self, units: int) -> int:
        """Characters that the first ``units`` units have."""
        low, high = 0, self.matrix.size
        while low < high:
            middle = (low + high) // 2
            if self.count(middle) < units:
                low = middle + 1
            else:
                high = middle
        return low


def fill_in_middle(
    documents: DataFrame,
    seed: int = 42,
    percent: int = 50,
    spm_percent: int = 80,
    unit: str = "word",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) per row, over whole texts.

    The sha256 of seed and key gives four numbers: the first two choose the cuts among the n + 1
    unit boundaries, the third whether the text is transformed (``percent``), the fourth the
    order: suffix, prefix, middle (``spm``) or prefix, suffix, middle (``psm``). A text that is
    empty, null or holds one of the marks stays as it is (``plain``, lengths null); so any output
    can be taken apart again. Equal keys are cut alike; a null key counts as an empty one. Rows
    are handled where they lie, one by one; an empty table gives none; other columns are left out.
    """
    kind = documents.schema[key].dataType.simpleString()
    out = f"`{key}` {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    columns = {
        "n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "output": pa.string()
    }

    def work(whole: str, h1: int, h2: int, h3: int, h4: int) -> tuple[tuple, int]:
        marks = Boundaries(whole, unit)
        n = marks.units
        if not whole or any(m in whole for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= percent:
            return (n, "plain", None, None, whole), len(whole)
        first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = marks.after(first), marks.after(second)
        prefix, middle, suffix = whole[:a], whole[a:b], whole[b:]
        if h4 % 100 < spm_percent:
            return (n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"), len(whole)
        return (n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"), len(whole)

    digest = f"sha2(concat('{int(seed)}:', coalesce(CAST(`{key}` AS STRING), '')), 256)"
    draws = [f"CAST(conv(substr(_h, {1 + 8 * i}, 8), 16, 10) AS BIGINT) AS _h{i}" for i in range(4)]
    rows = documents.selectExpr(f"`{key}`", f"coalesce(`{text}`, '') AS _text", f"{digest} AS _h")
    return rows.selectExpr(f"`{key}`", "_text", *draws).mapInArrow(lambda batches: map_rows(batches, work, columns), out)


def restored(output: str = "output", form: str = "form") -> str:
    """SQL expression: the text again, from output and form alone.

    The text had no mark, and no mark can arise where a piece meets one, so the three marks
    part the pieces.
    """
    return (
        f"CASE WHEN {form} = 'plain' THEN {output} ELSE aggregate(array(split({output}, '{PREFIX}|{SUFFIX}|{MIDDLE}')), '', "
        f"(none, p) -> CASE {form} WHEN 'psm' THEN concat(p[1], p[3], p[2]) ELSE concat(p[2], p[3], p[1]) END) END"
    )
