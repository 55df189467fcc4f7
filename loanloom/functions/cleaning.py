"""SQL expressions that turn dirty text into typed values.

Each function takes SQL text (a column name or an expression) and returns SQL text
for ``selectExpr``, ``F.expr`` or ``spark.sql``. All use Spark's own functions, so
they stay in generated code and never raise under ANSI mode: a value that cannot be
read becomes NULL. Arguments are used once where possible, which keeps composed
expressions short.
"""

from __future__ import annotations

from pyspark.sql import types as T

from loanloom.config import UNKNOWN_CATEGORIES

WHITESPACE = r"' \t\n\r\u000B\u000C'"

# Plain decimal notation only. It keeps out suffixed literals (1d, 1f), hex,
# infinities and the texts that stand for "missing" (nan, NM, !@9#%8).
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def strip(c: str) -> str:
    return f"btrim({c}, {WHITESPACE})"


def clean_numeric(c: str, source_type: T.DataType | None = None) -> str:
    """Dirty text to double; underscores anywhere are noise.

    Columns that are already double or integral skip the text detour; floats keep
    it, because their shortest decimal text is the value meant.
    """
    if isinstance(source_type, T.DoubleType):
        return f"nullif({c}, double('NaN'))"
    if isinstance(source_type, T.IntegralType):
        return f"CAST({c} AS DOUBLE)"
    text = strip(f"translate(CAST({c} AS STRING), '_', '')")
    # No match extracts '', which does not cast.
    return f"try_cast(regexp_extract({text}, r'{NUMBER}', 0) AS DOUBLE)"


def to_int(c: str) -> str:
    """Text to int by truncation: '28.5' is 28, anything unreadable is NULL."""
    return f"try_cast(try_cast({c} AS DOUBLE) AS INT)"


def credit_history_months(c: str) -> str:
    """'22 Years and 1 Months' to 265; NULL when neither part is present."""
    years = rf"try_cast(regexp_extract({c}, r'(\d+)\s*Year', 1) AS BIGINT)"
    months = rf"try_cast(regexp_extract({c}, r'(\d+)\s*Month', 1) AS BIGINT)"
    return f"coalesce({years} * 12 + coalesce({months}, 0), {months})"


def count_list_items(c: str) -> str:
    """Number of items in a comma list that are neither blank nor 'nan'; NULL counts 0.

    One match per item that starts with a visible character, which stays cheaper
    than splitting into an array and filtering it.
    """
    return rf"coalesce(regexp_count(lower({c}), r'(?:^|,)\s*(?!nan\s*(?:,|$))[^,\s]'), 0)"


def clip(c: str, low: float, high: float) -> str:
    """Bound a value; NULL stays NULL (``least``/``greatest`` alone would skip it)."""
    bounded = f"greatest({float(low)!r}D, least({float(high)!r}D, {c}))"
    return f"CASE WHEN {c} IS NOT NULL THEN {bounded} END"


def ratio(numerator: str, denominator: str) -> str:
    """Ratio in double; a zero denominator gives NULL."""
    return f"try_divide({numerator}, {denominator})"


def clean_category(c: str, null_label: str = "Unknown") -> str:
    """Trim a category and fold its placeholder texts into 'Unknown'."""
    listed = ", ".join(f"'{u}'" for u in UNKNOWN_CATEGORIES)
    text = strip(c)
    return (
        f"CASE WHEN {c} IS NULL THEN '{null_label}' "
        f"WHEN {text} IN ({listed}) THEN 'Unknown' ELSE {text} END"
    )
