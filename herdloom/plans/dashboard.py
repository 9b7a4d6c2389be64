"""Dashboard tables: yields, herds, animals and inseminations, of one country or all, from a year on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdloom.functions import sunday_week
from herdloom.operators.filters import events_of
from herdloom.operators.lookups import BREEDS, FARM_TYPES, with_code, with_name
from herdloom.operators.reports import INSEMINATION, MILK, with_milk_total

# Fixed value: first year shown.
FIRST_YEAR = 2016


def _since(column: str, year: int) -> Column:
    """Year of a date not below ``year``, as a range the scan can use."""
    return F.col(column) >= F.lit(dt.date(year, 1, 1))


def _of_country(df: DataFrame, country: int | None) -> DataFrame:
    return df if country is None else df.filter(F.col("country_id") == country)


def yield_by_breed_region(tables: Mapping[str, DataFrame], country: int | None = None, first_year: int = FIRST_YEAR) -> DataFrame:
    """Mean over cows of the mean milk total of a cow, per region and breed.

    Records are averaged per cow before cows meet their region and breed.
    """
    milk = events_of(tables["core_animal_event"], MILK, country).filter(_since("event_date", first_year))
    cows = with_milk_total(milk, digits=None).groupBy("animal_id").agg(F.avg("total_milk").alias("cow_mean"))
    animals = tables["core_animal"].select(F.col("id").alias("animal_id"), "region_id", "main_breed")
    df = cows.join(animals, "animal_id")
    df = with_name(df, tables["country_units"], "region_id", "region", "inner")
    df = with_code(df, tables["core_master_list"], "main_breed", BREEDS, "breed", how="inner")
    return df.groupBy("region", "breed").agg(F.round(F.avg("cow_mean"), 2).alias("average_milk"))


def herds_by_year_type(tables: Mapping[str, DataFrame], country: int | None = None, first_year: int = FIRST_YEAR) -> DataFrame:
    farms = _of_country(tables["core_farm"], country).filter(_since("reg_date", first_year))
    counted = farms.groupBy(F.year("reg_date").alias("year"), F.col("farm_type").alias("type_code")).agg(
        F.count("id").alias("farms")
    )
    named = with_code(
        counted, tables["core_master_list"], "type_code", FARM_TYPES, "farm_type", text="description", how="inner"
    )
    return named.select("year", "farm_type", "farms").orderBy("year", "farm_type")


def animals_by_region(tables: Mapping[str, DataFrame], country: int | None = None, first_year: int = FIRST_YEAR) -> DataFrame:
    animals = _of_country(tables["core_animal"], country).filter(_since("reg_date", first_year))
    counted = animals.groupBy("region_id").agg(F.count("id").alias("animals"))
    named = with_name(counted, tables["country_units"], "region_id", "region", "inner")
    return named.groupBy("region").agg(F.sum("animals").alias("animals"))


def inseminations_by_week(tables: Mapping[str, DataFrame], country: int | None = None, first_year: int = FIRST_YEAR) -> DataFrame:
    """Inseminations per region, technician, year and Sunday-first week."""
    served = events_of(tables["core_animal_event"], INSEMINATION, country).filter(_since("event_date", first_year))
    by_ids = served.groupBy(
        "region_id",
        "field_agent_id",
        F.year("event_date").alias("year"),
        sunday_week(F.col("event_date")).alias("week"),
    ).agg(F.count("id").alias("n"))
    named = with_name(by_ids, tables["auth_users"], "field_agent_id", "technician", "inner")
    named = with_name(named, tables["country_units"], "region_id", "region", "inner")
    return named.groupBy("region", "technician", "year", "week").agg(F.sum("n").alias("inseminations"))
