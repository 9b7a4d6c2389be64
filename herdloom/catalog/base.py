"""Registry of queries and of the SQL each is checked against."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from herdloom.catalog.bindings import Tables, with_views

# Parameters of the queries, the same on both sides.
COUNTRY = 2
COUNTRY_NAME = "Ásia"
START, END = "2024-01-08", "2024-01-14"
LONG_START, LONG_END = "2024-01-04", "2024-01-27"
AS_OF = dt.date(2024, 1, 25)
GAP = 3
MONITORED = ["Calving", "Insemination", "Milking", "Weight"]
STAMPED_AT = dt.datetime(2024, 1, 25, 6, 30, 0)
VERSION = "v1"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, views: str, body: str, ctes: str = ""):
    """Register a builder from tables under ``name`` with its SQL over the views it names."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        parts = [p for p in (with_views(*views.split()), ctes.strip().rstrip(",")) if p]
        head = "with " + ",\n".join(parts) + "\n" if parts else ""
        ORACLES[name] = head + body.strip()
        return build

    return register


def num_sql(text: str) -> str:
    """Number at the start of a text in SQL, 0 without one, NULL for NULL."""
    prefix = r"'^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)'"
    return f"case when {text} is not null then coalesce(try_cast(regexp_extract({text}, {prefix}, 1) as double), 0) end"


def attr_sql(column: str, attr_id: str) -> str:
    """Text of a JSON attribute in SQL: 'null' for a JSON null, NULL for a missing key."""
    path = f"""'$."{attr_id}"'"""
    return f"case when json_exists({column}, {path}) then coalesce(json_extract_string({column}, {path}), 'null') end"


def strict_sql(column: str, rounded: bool = True) -> str:
    parts = [num_sql(f"replace({attr_sql(column, a)}, 'null', '')") for a in ("61", "68", "59")]
    if rounded:
        parts = [f"round({p}, 2)" for p in parts]
    return " + ".join(f"({p})" for p in parts)


def lenient_sql(column: str) -> str:
    return " + ".join(f"coalesce({num_sql(attr_sql(column, a))}, 0)" for a in ("59", "68", "61"))


def week_sql(day: str) -> str:
    return f"cast(strftime({day}, '%U') as integer)"


def months_sql(later: str, earlier: str) -> str:
    return f"cast((year({later}) * 12 + month({later})) - (year({earlier}) * 12 + month({earlier})) as integer)"


def days_sql(later: str, earlier: str) -> str:
    return f"cast({later} - {earlier} as integer)"


def name_sql(table: str, key: str) -> str:
    """Name that a table of names has for a key; NULL without one."""
    return f"(select named.name from {table} named where named.id = {key})"


def label_sql(code_list: int, key: str, column: str = "label") -> str:
    """Label that a list of codes has for a code; NULL without one."""
    return f"(select listed.{column} from core_master_list listed where listed.list_type_id = {code_list} and listed.value = {key})"


def places_sql() -> str:
    """Names of the four levels of places."""
    return ", ".join(f"{name_sql('country_units', level + '_id')} as {level}" for level in ("region", "district", "ward", "village"))
