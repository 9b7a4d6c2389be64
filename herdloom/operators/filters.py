"""Row filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdloom.functions import day_range, last_word, period

Day = dt.date | str


def events_of(
    events: DataFrame,
    event_type: int,
    country: int | None = None,
    start: Day | None = None,
    end: Day | None = None,
) -> DataFrame:
    """Events of one type, optionally of one country and of an inclusive range of event days."""
    df = events.filter(F.col("event_type") == event_type)
    if country is not None:
        df = df.filter(F.col("country_id") == country)
    if start is not None and end is not None:
        df = df.filter(day_range(F.col("event_date"), start, end))
    return df


def created_between(
    df: DataFrame, start: Day | Column, end: Day | Column, known: str | None = None, at: str = "created_at"
) -> DataFrame:
    """Rows created on the days from start to end; ``known`` names a column that must not be NULL."""
    df = df.filter(day_range(F.col(at), start, end))
    return df if known is None else df.filter(F.col(known).isNotNull())


def period_filter(df: DataFrame, preset: str, today: Day | Column, at: str = "created_at") -> DataFrame:
    """Rows of a report period (see :func:`herdloom.functions.period`)."""
    return created_between(df, *period(preset, today), at=at)


def exclude(df: DataFrame, column: str, *values) -> DataFrame:
    """Rows whose column holds none of the values; a NULL is not known to differ, so it goes too."""
    return df.filter(~F.col(column).isin(*values))


def keep(df: DataFrame, column: str, *values) -> DataFrame:
    return df.filter(F.col(column).isin(*values))


def fill_defaults(df: DataFrame, **fallbacks) -> DataFrame:
    """Replace NULLs: ``column=other`` takes a literal or a Column, tried in turn if a list."""
    filled = {}
    for name, others in fallbacks.items():
        others = others if isinstance(others, list | tuple) else [others]
        choices = [o if isinstance(o, Column) else F.lit(o) for o in others]
        filled[name] = F.coalesce(F.col(name), *choices)
    return df.withColumns(filled)


def latest_form_version(forms: DataFrame, at_least: str = "1.7") -> DataFrame:
    """Forms with a body whose version, compared as text, is not below the given one."""
    return forms.filter(
        F.col("form_data").isNotNull() & (last_word(F.col("form_version")) >= F.lit(at_least))
    )
