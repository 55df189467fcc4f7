"""Month arithmetic as SQL expressions."""

from __future__ import annotations

from collections.abc import Mapping

from loanloom.config import DEFAULTS, Settings


def date_literal(iso: str | None) -> str:
    return "CAST(NULL AS DATE)" if iso is None else f"DATE '{iso[:10]}'"


def month_start(c: str) -> str:
    """First day of the month of a date, timestamp or ISO text."""
    return f"trunc(try_cast({c} AS DATE), 'MM')"


def months_diff(a: str, b: str) -> str:
    """Whole calendar months from ``a`` to ``b``; the day of month plays no part."""
    return f"((year({b}) - year({a})) * 12 + month({b}) - month({a}))"


def origination_month(snapshot: str, mob: int) -> str:
    return f"add_months({snapshot}, {-mob})"


def window_bounds(month: str, settings: Settings = DEFAULTS) -> Mapping[str, str]:
    """Train, test and out-of-time bounds for a model trained in ``month``.

    The windows end ``mob_label`` months before the training month, where labels
    have matured, and follow each other without overlap.
    """
    first = month_start(month)
    oot_end = -settings.mob_label
    oot_start = oot_end + 1 - settings.oot_months
    test_end = oot_start - 1
    test_start = test_end + 1 - settings.test_months
    shifts = {
        "train_end": test_start - 1,
        "test_start": test_start,
        "test_end": test_end,
        "oot_start": oot_start,
        "oot_end": oot_end,
    }
    return {
        "train_start": date_literal(settings.snapshot_start),
        **{name: f"add_months({first}, {shift})" for name, shift in shifts.items()},
    }


def split_name(orig_month: str, bounds: Mapping[str, str]) -> str:
    """Name of the window a month falls in; NULL outside all three."""
    cases = " ".join(
        f"WHEN {orig_month} BETWEEN {bounds[f'{s}_start']} AND {bounds[f'{s}_end']} THEN '{s}'"
        for s in ("train", "test", "oot")
    )
    return f"CASE {cases} END"


def partition_date(path: str) -> str:
    """Date written as YYYY_MM_DD in the last part of a file path; NULL without one."""
    pattern = r"(\d{4}_\d{2}_\d{2})[^/]*(?:/part-[^/]*)?$"
    return f"CAST(try_to_timestamp(regexp_extract({path}, r'{pattern}', 1), 'yyyy_MM_dd') AS DATE)"


def version_name(month: str) -> str:
    return f"concat('credit_model_', date_format({month}, 'yyyy_MM_dd'))"
