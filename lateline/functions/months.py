"""Month arguments: validation, ranges, bounds and the default month of a run."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date, datetime, timezone

from lateline.contract import NS_PER_SECOND

_MONTH = re.compile(r"\d{4}-(0[1-9]|1[0-2])")
_RANGE = re.compile(r"(\d{4})-(0[1-9]|1[0-2])-(0[1-9]|1[0-2])")


def check_month(month: str) -> str:
    if not _MONTH.fullmatch(month):
        raise ValueError(f"not a yyyy-MM month: {month!r}")
    return month


def expand_months(specs: str | Iterable[str]) -> list[str]:
    """``yyyy-MM`` months and ``yyyy-MM-MM`` ranges as one list, repeats dropped, order kept."""
    months: dict[str, None] = {}
    for spec in [specs] if isinstance(specs, str) else specs:
        if span := _RANGE.fullmatch(spec):
            year, first, last = span[1], int(span[2]), int(span[3])
            if first > last:
                raise ValueError(f"range runs backwards: {spec!r}")
            months.update((f"{year}-{n:02d}", None) for n in range(first, last + 1))
        else:
            months[check_month(spec)] = None
    return list(months)


def next_month(month: str) -> str:
    year, n = map(int, check_month(month).split("-"))
    return f"{year + n // 12}-{n % 12 + 1:02d}"


def previous_month(month: str) -> str:
    year, n = map(int, check_month(month).split("-"))
    return f"{year - (n == 1)}-{(n - 2) % 12 + 1:02d}"


def month_bounds_ns(month: str) -> tuple[int, int]:
    """First and last nanosecond of the month, both inclusive, in UTC."""

    def start(m: str) -> int:
        return int(datetime.strptime(m, "%Y-%m").replace(tzinfo=timezone.utc).timestamp()) * NS_PER_SECOND

    return start(check_month(month)), start(next_month(month)) - 1


def resolve_month(month: str | None, *, scheduled_on: date | None = None) -> str:
    """The month to process: the one asked for, else the month before a scheduled run; by hand it must be given."""
    if month:
        return check_month(month)
    if scheduled_on is None:
        raise ValueError("a run started by hand needs an explicit month")
    return previous_month(f"{scheduled_on:%Y-%m}")
