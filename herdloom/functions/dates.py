"""Calendar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

PRESETS = ("prev_workday", "prev_week", "prev_month", "yesterday_today")


def _day(value: Column | dt.date | str) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value)


def days_between(later: Column, earlier: Column) -> Column:
    return F.date_diff(later, earlier)


def months_apart(later: Column, earlier: Column) -> Column:
    """Calendar months between two dates; the day of the month plays no part."""
    return (F.year(later) * 12 + F.month(later)) - (F.year(earlier) * 12 + F.month(earlier))


def sunday_week(d: Column) -> Column:
    """Week 0-53 of the year where weeks start on Sunday and days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def day_label(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def month_label(d: Column) -> Column:
    return F.date_format(d, "MMMM yyyy")


def day_range(c: Column, start: Column | dt.date | str, end: Column | dt.date | str) -> Column:
    """Day of ``c`` within [start, end], both included.

    Written as a half-open range on the bare column, so that it reaches the Parquet scan for date
    and for timestamp columns alike (``to_date(c) BETWEEN ...`` would not).
    """
    return (c >= _day(start)) & (c < F.date_add(_day(end), 1))


def period(preset: str, today: Column | dt.date | str) -> tuple[Column, Column]:
    """First and last day of a report period, seen from ``today``.

    With a literal ``today`` both bounds fold to constants and are pushed to the scan.
    """
    today = _day(today)
    if preset == "prev_workday":
        back = F.when(F.dayofweek(today) == 2, 3).otherwise(1)
        return F.date_sub(today, back), F.date_sub(today, back)
    if preset == "prev_week":
        monday = F.date_trunc("week", today).cast("date")
        return F.date_sub(monday, 7), F.date_sub(monday, 1)
    if preset == "prev_month":
        first = F.date_trunc("month", today).cast("date")
        return F.add_months(first, -1), F.date_sub(first, 1)
    if preset == "yesterday_today":
        return F.date_sub(today, 1), today
    raise ValueError(f"unknown period {preset!r}, expected one of {PRESETS}")


def whole_weeks(start: dt.date | str, end: dt.date | str) -> tuple[dt.date, dt.date, list[tuple[int, int]]]:
    """A period widened to whole weeks of :func:`sunday_week`, and these as (year, week).

    A week ends with its year, so the first and the last of a year may be short.
    """
    start, end = (dt.date.fromisoformat(d) if isinstance(d, str) else d for d in (start, end))
    first = max(start - dt.timedelta(days=(start.weekday() + 1) % 7), dt.date(start.year, 1, 1))
    last = min(end + dt.timedelta(days=(5 - end.weekday()) % 7), dt.date(end.year, 12, 31))
    days = (first + dt.timedelta(days=i) for i in range((last - first).days + 1))
    return first, last, sorted({(day.year, int(day.strftime("%U"))) for day in days})
