"""Data-flow report: the record tables behind its statistics. Activity is in ``operators.reports``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdloom.functions import attr_text, strict_num, with_attributes
from herdloom.functions.attributes import BODY_WEIGHT
from herdloom.operators.filters import created_between, events_of
from herdloom.operators.lookups import with_name
from herdloom.operators.reports import MILK, WEIGHT, milk_positive


def event_farm_country(events: DataFrame, animals: DataFrame, farms: DataFrame, countries: DataFrame) -> DataFrame:
    """Events with the country of the farm their animal stands on."""
    places = animals.select(F.col("id").alias("animal_id"), "farm_id")
    lands = farms.select(F.col("id").alias("farm_id"), F.col("country_id").alias("farm_country_id"))
    df = events.join(places, "animal_id").join(lands, "farm_id")
    return with_name(df, countries, "farm_country_id", "country", "inner")


def milk_rows(tables: Mapping[str, DataFrame], start, end) -> DataFrame:
    """Milk records with a positive total, created by an agent in the period."""
    milk = events_of(tables["core_animal_event"], MILK)
    milk = created_between(milk, start, end, known="field_agent_id")
    milk = milk_positive(milk.select("id", "animal_id", "created_at", "additional_attributes"))
    df = event_farm_country(milk, tables["core_animal"], tables["core_farm"], tables["core_country"])
    return df.select("country", F.to_date("created_at").alias("milk_date"), F.col("total_milk").alias("total"))


def weight_rows(tables: Mapping[str, DataFrame], start, end) -> DataFrame:
    """Weights created by an agent in the period; a weight that is no number is NULL."""
    weights = events_of(tables["core_animal_event"], WEIGHT)
    weights = created_between(weights, start, end, known="field_agent_id")
    weights = weights.select("country_id", "created_at", "additional_attributes")
    total = strict_num(attr_text(F.col("attrs"), BODY_WEIGHT))
    return with_name(with_attributes(weights), tables["core_country"], "country_id", "country", "inner").select(
        "country", F.to_date("created_at").alias("weight_date"), total.alias("total")
    )
