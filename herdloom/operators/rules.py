"""Data-quality rules.

A rule is a condition and a message. All rules of a set are evaluated in one projection; only marks that
need other rows (duplicates, membership) are joined beforehand.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: put before each message.
SEPARATOR = " | "


@dataclass(frozen=True)
class Rule:
    name: str
    fires: Column
    message: str
    channel: str = "comments"


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``status`` (1 clean, 0 not) and one text column per channel, NULL where no rule fired.

    Messages come in the order of the rules. A condition that is NULL does not fire.
    """
    channels = list(dict.fromkeys(r.channel for r in rules))
    texts, clean = {}, F.lit(True)
    for channel in channels:
        messages = [F.when(r.fires, F.lit(r.message)) for r in rules if r.channel == channel]
        texts[channel] = F.concat_ws(SEPARATOR, *messages)  # passes over NULLs
        clean = clean & (F.col(channel) == "")
    leading = {c: F.when(F.col(c) != "", F.concat(F.lit(SEPARATOR), F.col(c))) for c in channels}
    return df.withColumns(texts).withColumns({"status": F.when(clean, 1).otherwise(0), **leading})


def outside(value: Column, low: Column, high: Column) -> Column:
    """NOT BETWEEN: unknown, hence no violation, where the value or both bounds are."""
    return ~value.between(low, high)


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once; a key with a NULL part is never a duplicate.

    Counted before the shuffle, so a key that holds a third of all rows is one row per task.
    """
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def settings(table: DataFrame, values: Sequence[str], *keys: Mapping) -> list[Column]:
    """Values of several rows of a settings table, each as a struct, through one scalar lookup.

    A key names columns and the value each must have; of several rows the lowest id counts. A key without
    a row gives NULL and loses nothing. Spark runs the lookup once and puts the result into the plan.
    """
    found = []
    for i, key in enumerate(keys):
        matches = F.lit(True)
        for name, wanted in key.items():
            matches = matches & (F.col(name) == wanted)
        found.append(F.min_by(F.struct(*values), F.when(matches, F.col("id"))).alias(f"row_{i}"))
    rows = table.agg(F.struct(*found)).scalar()
    return [rows[f"row_{i}"] for i in range(len(keys))]


def limits(table: DataFrame, *keys: Mapping) -> list[tuple[Column, Column]]:
    """Lower and upper limit for each key (a category or an id)."""
    rows = settings(table, ["min_value", "max_value"], *keys)
    return [(row["min_value"], row["max_value"]) for row in rows]


def age_class(age_months: Column, calf_age: Column) -> Column:
    """``calf`` up to the age limit in months, ``mature`` beyond it, ``unknown`` without an age."""
    return (
        F.when(age_months <= calf_age, "calf")
        .when(age_months > calf_age, "mature")
        .otherwise("unknown")
    )


def error_rates(df: DataFrame, rules: Sequence[Rule], by: Sequence[str]) -> DataFrame:
    """Records, violations and violation rate in percent per group and rule, rules without any included.

    All rules are counted in one grouping of the unchecked rows; only its few results become rows per rule.
    """
    counts = [F.count_if(r.fires).alias(f"_{i}") for i, r in enumerate(rules)]
    grouped = df.groupBy(*by).agg(F.count(F.lit(1)).alias("total_records"), *counts)
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(r.name).alias("rule"), F.col(f"_{i}").alias("total_error_records"))
                for i, r in enumerate(rules)
            ]
        )
    ).alias("_row")
    rate = F.round(100.0 * F.col("total_error_records") / F.col("total_records"), 2)
    return (
        grouped.select(*by, "total_records", rows)
        .select(*by, "total_records", "_row.*")
        .withColumn("error_rate", rate)
    )


def quality_report(logged: DataFrame, checks: DataFrame, countries: DataFrame, year: int, week: int) -> DataFrame:
    """Logged error rates of one week with names of country and check, without deleted entries."""
    named = checks.select(F.col("id").alias("quality_check"), F.col("quality_check").alias("check"))
    return (
        logged.filter(
            (F.col("report_year") == year) & (F.col("report_week") == week) & (F.col("deleted") == 0)
        )
        .join(named, "quality_check", "inner")
        .join(countries.select(F.col("id").alias("country_id"), F.col("name").alias("country")), "country_id")
        .select(
            "country",
            F.col("check").alias("quality_check"),
            "total_records",
            "total_error_records",
            "error_rate",
        )
    )
