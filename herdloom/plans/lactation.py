"""Lactation extract: calvings with their history, checked."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdloom.operators.filters import events_of, exclude
from herdloom.operators.history import calving_columns, day_table
from herdloom.operators.lookups import ANIMAL_TYPES, BREEDS, SEXES, with_code, with_name, with_places
from herdloom.operators.reports import CALVING
from herdloom.operators.rules import Rule, apply_rules, limits, outside

# Columns of the report, rule messages, limit categories, default age limit, days per month.
COLUMNS = [
    "farm_name", "country", "region", "district", "ward", "village", "longitude", "latitude",
    "animal_id", "tag_id", "animal_registration_date", "main_breed", "birthdate", "animal_sex",
    "animal_type", "calving_date", "calving_age", "previous_calving_date",
    "subsequent_calving_date", "calving_interval", "parity",
]
DUPLICATE = "Duplicate Record"
BEFORE_BIRTH = "Calved Before Birth"
FUTURE = "Future Calving Date"
BAD_INTERVAL = "Invalid Calving Interval"
BAD_AGE = "Invalid Calving Age"
BAD_TYPE = "Invalid Animal Type"
INTERVAL = "calving_interval"
FIRST_AGE = "age_at_first_calving"
FIRST_AGE_MONTHS = 18
DAYS_PER_MONTH = 30
CALVING_TYPES = (1, 2)
SEMEN_STRAW = 6
UNKNOWN_BREED = "Unknown"


def lactation_rules(limit_table: DataFrame, as_of: dt.date) -> list[Rule]:
    # A minimum age that is NULL takes the default; no row at all leaves the rule silent.
    default = F.when(F.col("category") == FIRST_AGE, float(FIRST_AGE_MONTHS))
    defaulted = limit_table.withColumn("min_value", F.coalesce("min_value", default))
    (low, high), (first_age, _) = limits(defaulted, {"category": INTERVAL}, {"category": FIRST_AGE})
    day = F.col("calving_date")
    return [
        Rule("calving_duplicate", F.col("copies") > 1, DUPLICATE),
        Rule("calved_before_birth", F.col("birthdate") > day, BEFORE_BIRTH),
        Rule("future_calving", day > F.lit(as_of), FUTURE),
        Rule(
            "calving_interval",
            (F.col("parity") > 1) & outside(F.col("calving_interval"), low, high),
            BAD_INTERVAL,
        ),
        Rule("calving_age", F.col("calving_age") < first_age * DAYS_PER_MONTH, BAD_AGE),
        Rule("animal_type", ~F.col("animal_type_id").isin(*CALVING_TYPES), BAD_TYPE),
    ]


def animals_on(farms: DataFrame, animals: DataFrame, farm: str) -> DataFrame:
    """Ids of the animals on some farms, to leave out others' events before they are grouped."""
    return animals.join(farms.select(F.col("id").alias(farm)), farm, "left_semi").select("animal_id")


def lactation_staged(
    tables: Mapping[str, DataFrame],
    start: dt.date | str,
    end: dt.date | str,
    country: int | None = None,
) -> DataFrame:
    """Calvings of a period with places, codes and history, before the rules.

    Animal, farm and place columns are added to the days of an animal, which the history windows have
    already put together by animal; the events themselves are shuffled once, to meet their day.
    """
    calvings = events_of(tables["core_animal_event"], CALVING, start=start, end=end).select(
        "animal_id", F.col("id").alias("lactation_id"), F.col("event_date").alias("calving_date")
    )
    animals = exclude(tables["core_animal"], "animal_type", SEMEN_STRAW).select(
        F.col("id").alias("animal_id"),
        "farm_id",
        "tag_id",
        F.coalesce("reg_date", F.to_date("created_at")).alias("animal_registration_date"),
        F.col("main_breed").alias("breed_code"),
        "birthdate",
        "sex",
        F.col("animal_type").alias("animal_type_id"),
    )
    farms = tables["core_farm"]
    if country is not None:
        farms = farms.filter(F.col("country_id") == country)
        calvings = calvings.join(animals_on(farms, animals, "farm_id"), "animal_id", "left_semi")
    days = day_table(calvings, "animal_id", "calving_date", "lactation_id")
    farms = farms.select(
        F.col("id").alias("farm_id"),
        F.col("farmer_name").alias("farm_name"),
        "country_id", "region_id", "district_id", "ward_id", "village_id", "longitude", "latitude",
    )

    df = days.join(animals, "animal_id").join(farms, "farm_id")
    df = with_name(df, tables["core_country"], "country_id", "country")
    df = with_places(df, tables["country_units"])
    codes = tables["core_master_list"]
    df = with_code(df, codes, "sex", SEXES, "animal_sex")
    df = with_code(df, codes, "breed_code", BREEDS, "main_breed")
    df = with_code(df, codes, "animal_type_id", ANIMAL_TYPES, "animal_type")

    history = calving_columns(F.col("calving_date"), F.col("lactation_id"))
    return (
        calvings.join(df, ["animal_id", "calving_date"])
        .withColumns(history)
        .withColumns(
            {
                "main_breed": F.coalesce("main_breed", F.lit(UNKNOWN_BREED)),
                "calving_age": F.date_diff("calving_date", "birthdate"),
                "copies": F.col("n"),
            }
        )
        .select(*COLUMNS, "animal_type_id", "lactation_id", "country_id", "copies")
    )


def lactation_extract(
    tables: Mapping[str, DataFrame],
    start: dt.date | str,
    end: dt.date | str,
    as_of: dt.date,
    country: int | None = None,
) -> DataFrame:
    """Staged calvings with ``comments`` and ``status``."""
    staged = lactation_staged(tables, start, end, country)
    rules = lactation_rules(tables["interface_limit_parameters"], as_of)
    return apply_rules(staged, rules).drop("animal_type_id", "country_id", "copies")
