"""Weight extract: weighings with age, girth and body weight, checked."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdloom.functions import lenient_num, months_apart, with_attr_texts, with_attributes
from herdloom.functions.attributes import BODY_WEIGHT, HEART_GIRTH
from herdloom.operators.filters import events_of
from herdloom.operators.lookups import (
    ANIMAL_TYPES,
    BREEDS,
    SEXES,
    flag_if_exists,
    with_code,
    with_name,
    with_places,
)
from herdloom.operators.reports import WEIGHT
from herdloom.operators.rules import (
    Rule,
    age_class,
    apply_rules,
    duplicate_keys,
    limits,
    outside,
    settings,
)

# Columns of the report, rule messages, ids of the limits, coordinate bound.
COLUMNS = [
    "country", "region", "district", "ward", "village", "registration_date", "animal_id", "tag_id",
    "birthdate", "main_breed", "sex", "animal_type", "longitude", "latitude", "weight_date",
    "age_at_weighing", "heart_girth", "body_weight",
]
DUPLICATE = "Duplicate Record"
BEFORE_BIRTH = "Weight Recorded Before Animal Was Born"
FUTURE = "Weight Date Is In The Future"
NOTHING_MEASURED = "Both Heart Girth & Weight are Null"
GIRTH_RANGE = "Heart Girth Out Of Range"
GIRTH_RANGE_FOR_AGE = "Heart Girth Out Of Range(Considered age at weighing)"
WEIGHT_RANGE = "Body Weight Out Of Range"
WEIGHT_RANGE_FOR_AGE = "Body Weight Out Of Range(Considered age at weighing)"
GPS_RANGE = "GPS Out Of Range"
NO_GPS = "No GPS Details"
MATURE_GIRTH = 5
MATURE_WEIGHT = 6
CALF_WEIGHT = 7
CALF_GIRTH = 8
CALF_AGE = 1
GPS_BOUND = 180.0
UNKNOWN_BREED = "Unknown"


def calf_age(table: DataFrame) -> Column:
    """Age in months up to which an animal is a calf."""
    (row,) = settings(table, ["graduation_value"], {"id": CALF_AGE})
    return row["graduation_value"]


def _range_rules(name: str, value: Column, calf: tuple, mature: tuple, any_age: str, for_age: str) -> list[Rule]:
    group = F.col("age_class")
    return [
        Rule(f"{name}_any_age", F.col("birthdate").isNull() & outside(value, calf[0], mature[1]), any_age),
        Rule(f"{name}_calf", (group == "calf") & outside(value, *calf), for_age),
        Rule(f"{name}_mature", (group == "mature") & outside(value, *mature), for_age),
    ]


def weight_rules(limit_table: DataFrame, as_of: dt.date, gps_bound: float = GPS_BOUND) -> list[Rule]:
    ids = (CALF_GIRTH, MATURE_GIRTH, CALF_WEIGHT, MATURE_WEIGHT)
    calf_girth, mature_girth, calf_weight, mature_weight = limits(limit_table, *[{"id": i} for i in ids])
    day = F.col("weight_date")
    girth, weight = F.col("girth_value"), F.col("weight_value")
    longitude, latitude = F.col("longitude"), F.col("latitude")
    bounds = F.lit(-gps_bound), F.lit(gps_bound)
    return [
        Rule("weight_duplicate", F.col("is_duplicate"), DUPLICATE),
        Rule("weighed_before_birth", F.col("birthdate") > day, BEFORE_BIRTH),
        Rule("future_weight", day > F.lit(as_of), FUTURE),
        Rule(
            "nothing_measured",
            F.col("heart_girth").isNull() & F.col("body_weight").isNull(),
            NOTHING_MEASURED,
        ),
        *_range_rules("girth", girth, calf_girth, mature_girth, GIRTH_RANGE, GIRTH_RANGE_FOR_AGE),
        *_range_rules("weight", weight, calf_weight, mature_weight, WEIGHT_RANGE, WEIGHT_RANGE_FOR_AGE),
        Rule(
            "gps_range",
            longitude.isNotNull()
            & latitude.isNotNull()
            & (outside(longitude, *bounds) | outside(latitude, *bounds)),
            GPS_RANGE,
        ),
        Rule("no_gps", longitude.isNull() | latitude.isNull(), NO_GPS),
    ]


def weight_staged(
    tables: Mapping[str, DataFrame],
    start: dt.date | str,
    end: dt.date | str,
    country: int | None = None,
) -> DataFrame:
    """Weighings of a period with places, codes, age and measures, before the rules.

    Girth and weight stay texts as recorded; ``girth_value`` and ``weight_value`` are their numbers.
    """
    animals = tables["core_animal"]
    if country is not None:
        animals = animals.filter(F.col("country_id") == country)
    animals = animals.select(
        F.col("id").alias("animal_id"),
        "tag_id", "country_id", "region_id", "district_id", "ward_id", "village_id",
        F.coalesce("reg_date", F.to_date("created_at")).alias("registration_date"),
        F.col("main_breed").alias("breed_code"),
        F.col("sex").alias("sex_code"),
        F.col("animal_type").alias("type_code"),
        "birthdate", "longitude", "latitude",
    )
    events = events_of(tables["core_animal_event"], WEIGHT, start=start, end=end)
    if country is not None:
        events = events.join(animals.select("animal_id"), "animal_id", "left_semi")
    weighings = with_attributes(events).select(
        "animal_id", F.col("id").alias("weight_id"), F.col("event_date").alias("weight_date"), "attrs"
    )
    weighings = with_attr_texts(weighings, "attrs", {"heart_girth": HEART_GIRTH, "body_weight": BODY_WEIGHT}).drop("attrs")
    df = weighings.join(animals, "animal_id")
    df = with_name(df, tables["core_country"], "country_id", "country")
    df = with_places(df, tables["country_units"])
    codes = tables["core_master_list"]
    df = with_code(df, codes, "sex_code", SEXES, "sex")
    df = with_code(df, codes, "breed_code", BREEDS, "main_breed")
    df = with_code(df, codes, "type_code", ANIMAL_TYPES, "animal_type")
    # Counted from the events, so that the attribute bag is read and parsed for the weighings only.
    days = events.select("animal_id", F.col("event_date").alias("weight_date"))
    copies = duplicate_keys(days, "animal_id", "weight_date").drop("copies")
    df = flag_if_exists(df, copies, "is_duplicate")
    age = months_apart(F.col("weight_date"), F.col("birthdate"))
    return (
        df.withColumns(
            {
                "main_breed": F.coalesce("main_breed", F.lit(UNKNOWN_BREED)),
                "age_at_weighing": age,
                "girth_value": lenient_num(F.col("heart_girth")),
                "weight_value": lenient_num(F.col("body_weight")),
            }
        )
        .withColumn("age_class", age_class(F.col("age_at_weighing"), calf_age(tables["interface_graduation_settings"])))
        .select(*COLUMNS, "country_id", "weight_id", "girth_value", "weight_value", "age_class", "is_duplicate")
    )


def weight_extract(
    tables: Mapping[str, DataFrame],
    start: dt.date | str,
    end: dt.date | str,
    as_of: dt.date,
    country: int | None = None,
) -> DataFrame:
    """Staged weighings with ``comments`` and ``status``."""
    staged = weight_staged(tables, start, end, country)
    rules = weight_rules(tables["interface_limit_parameters"], as_of)
    return apply_rules(staged, rules).drop(
        "country_id", "girth_value", "weight_value", "age_class", "is_duplicate"
    )
