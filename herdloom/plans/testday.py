"""Test-day report: milk records of a day, linked to the latest calving and to weights of that day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from herdloom.functions import attr_text, attributes, milk_total_lenient, with_attr_texts, with_attributes
from herdloom.functions.attributes import (
    BODY_LENGTH,
    BODY_SCORE,
    BODY_WEIGHT,
    CATTLE_OWNED,
    ESTIMATED_WEIGHT,
    HEART_GIRTH,
    MILK_CELL_COUNT,
    MILK_EVENING,
    MILK_FAT,
    MILK_MIDDAY,
    MILK_MORNING,
    MILK_PROTEIN,
)
from herdloom.operators.filters import events_of
from herdloom.operators.history import MIN_CALVING_GAP, asof_days, parity_days
from herdloom.operators.lookups import BREEDS, FARM_TYPES, SEXES, with_code, with_places
from herdloom.operators.reports import CALVING, MILK, WEIGHT
from herdloom.plans.lactation import animals_on
from herdloom.sources import stamp

# Columns of the report (the second farm id is farm_key, as names ignore case here) and
# the attributes reported as recorded.
COLUMNS = [
    "region", "district", "ward", "village", "Farm_id", "farmergender", "cattletotalowned", "tag_id",
    "reg_date", "main_breed", "animalid", "closest_calvdate", "milkdate", "MilkAM", "MilkMidDay",
    "MilkPM", "TotalMilk", "Days In Milk", "MilkFat", "MilkProt", "SCC", "Heartgirth", "BodyLength",
    "Weight", "EstimatedWt", "Bodyscore", "parity", "testdaynumber", "latitude", "longitude",
    "original_tag_id", "event_id", "farmer_name", "farm_key", "project", "birthdate", "farmtype",
    "Extract_Datetime_UTC", "Version",
]
MILK_TEXTS = {
    "MilkAM": MILK_MORNING,
    "MilkMidDay": MILK_MIDDAY,
    "MilkPM": MILK_EVENING,
    "MilkFat": MILK_FAT,
    "MilkProt": MILK_PROTEIN,
    "SCC": MILK_CELL_COUNT,
}
WEIGHT_TEXTS = {
    "Heartgirth": HEART_GIRTH,
    "BodyLength": BODY_LENGTH,
    "Weight": BODY_WEIGHT,
    "EstimatedWt": ESTIMATED_WEIGHT,
    "Bodyscore": BODY_SCORE,
}


def milk_days(events: DataFrame) -> DataFrame:
    """Days with milk per animal and country: number of records and the first of them."""
    milk = events_of(events, MILK).filter(F.col("event_date").isNotNull())
    return milk.groupBy("animal_id", "country_id", F.col("event_date").alias("milkdate")).agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("event_id")
    )


def with_day_values(days: DataFrame, events: DataFrame) -> DataFrame:
    """Days, one row per animal, country and day, with the first known milk and weight values of each.

    The records of other days are dropped by the join, before an attribute is parsed. The grouping is by the
    keys of the join, whose rows come together and in order: it neither shuffles nor sorts their texts again.
    """
    keys = ["animal_id", "country_id", "milkdate"]
    carried = [c for c in days.columns if c not in keys]
    rows = events.filter(F.col("event_type").isin(MILK, WEIGHT) & F.col("event_date").isNotNull())
    rows = rows.select("animal_id", "country_id", F.col("event_date").alias("milkdate"), "id", "event_type", "additional_attributes")
    rows = with_attributes(rows.join(days, keys))
    total = F.when(F.col("event_type") == MILK, milk_total_lenient(F.col("attrs")))
    rows = with_attr_texts(rows, "attrs", MILK_TEXTS | WEIGHT_TEXTS, TotalMilk=total)

    def first_of(name: str, event_type: int):
        known = (F.col("event_type") == event_type) & F.col(name).isNotNull()
        return F.min_by(name, F.when(known, F.col("id"))).alias(name)

    return rows.groupBy(*keys).agg(
        *[F.any_value(c).alias(c) for c in carried],
        *[first_of(name, MILK) for name in ("TotalMilk", *MILK_TEXTS)],
        *[first_of(name, WEIGHT) for name in WEIGHT_TEXTS],
    )


def testday_report(
    tables: Mapping[str, DataFrame],
    extracted_at: dt.datetime,
    version: str,
    country: int | None = None,
    min_gap: int = MIN_CALVING_GAP,
) -> DataFrame:
    """One row per animal, milk day and calving, for one country or for each country on its own.

    Calvings count by the country of the farm, milk and weights by that of the event, details by that of
    the animal; in the report of a country all three agree. Farm and animal hold or fail for all events
    of an animal, so they are checked once, on the days linked.
    """
    events, animals, farms = tables["core_animal_event"], tables["core_animal"], tables["core_farm"]
    calvings = events_of(events, CALVING)
    # Calvings are told apart by the farm, not by the country of the event.
    if country is not None:
        events, animals, farms = (df.filter(F.col("country_id") == country) for df in (events, animals, farms))
        ids = animals.select(F.col("id").alias("animal_id"), "farm_id")
        calvings = calvings.join(animals_on(farms, ids, "farm_id"), "animal_id", "left_semi")
    lactations = parity_days(calvings, min_gap).select("animal_id", F.col("event_date").alias("calvdate"), "parity")
    # Link and numbers need days only; values meet the linked days afterwards.
    linked = asof_days(milk_days(events), lactations, "animal_id", "milkdate", "calvdate").filter(
        F.col("closest_calvdate").isNotNull()
    )
    # Records of the day are numbered from the first one on; the report shows that first number.
    before = Window.partitionBy("animal_id", "country_id", "parity").orderBy("milkdate")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    linked = linked.withColumns(
        {
            "testdaynumber": (F.coalesce(F.sum("n").over(before), F.lit(0)) + 1).cast("int"),
            "Days In Milk": F.date_diff("milkdate", "closest_calvdate"),
        }
    )

    linked = with_day_values(linked, events)

    animals = animals.select(
        F.col("id").alias("animal_id"),
        F.col("farm_id").alias("Farm_id"),
        "country_id",
        "region_id", "district_id", "ward_id", "village_id", "tag_id", "original_tag_id", "reg_date",
        F.col("main_breed").alias("breed_code"),
        "birthdate",
    )
    farms = farms.select(
        F.col("id").alias("Farm_id"),
        "country_id",
        F.col("id").alias("farm_key"),
        F.col("name").alias("farmer_name"),
        "project", "latitude", "longitude", "gender_code",
        F.col("farm_type").alias("type_code"),
        attr_text(attributes(F.col("additional_attributes")), CATTLE_OWNED).alias("cattletotalowned"),
    )
    df = linked.join(animals, ["animal_id", "country_id"]).join(farms, ["Farm_id", "country_id"])
    df = with_places(df, tables["country_units"])
    codes = tables["core_master_list"]
    df = with_code(df, codes, "gender_code", SEXES, "farmergender")
    df = with_code(df, codes, "type_code", FARM_TYPES, "farmtype")
    df = with_code(df, codes, "breed_code", BREEDS, "main_breed")
    df = stamp(df.withColumnRenamed("animal_id", "animalid"), extracted_at, version)
    return df.select(*COLUMNS)
