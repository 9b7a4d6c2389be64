"""Pedigree extract: animals with parents, derived sex and parentage checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdloom.operators.lookups import (
    BREEDS,
    SEXES,
    flag_if_exists,
    in_country,
    parent_roles,
    with_code,
    with_name,
    with_parents,
    with_places,
)
from herdloom.operators.rules import Rule, apply_rules, duplicate_keys

# Columns of the report, rule messages, sex codes and labels, events only females have.
COLUMNS = [
    "country", "region", "district", "ward", "village", "farmer_name", "farm_id", "org_id",
    "organization_name", "project", "animal_id", "tag_id", "original_tag_id", "sire_tag_id",
    "sire_id", "dam_tag_id", "dam_id", "sex", "estimated_sex", "reg_date", "birthdate",
    "main_breed", "breed", "longitude", "latitude",
]
DUPLICATE = "Duplicate Record"
NO_SEX = "No or Estimated Sex Details"
BOTH_ROLES = "Bisexual(Used As Dam and Sire)"
REGISTERED_BEFORE_BIRTH = "Registered Before Birth"
OWN_GRANDSIRE = "Progeny Is Its Own Grand Sire"
OLDER_THAN_SIRE = "Animal Older Than Its Sire"
MALE_DAM = "Male Animal Used As A Dam"
FEMALE_SIRE = "Female Animal Used As A Sire"
NO_DAM = "Dam Details Not Found"
NO_SIRE = "Sire Details Not Found"
OWN_PARENT = "Own Parent"
MALE, FEMALE = 1, 2
MALE_LABEL, FEMALE_LABEL = "Male", "Female"
FEMALE_EVENTS = (1, 2, 3, 4, 5)


def pedigree_rules(parentage: bool = True) -> list[Rule]:
    """Rules in the order of the job; ``parentage`` adds those on the sex and presence of parents."""
    animal = F.col("animal_id")
    rules = [
        Rule("tag_duplicate", F.col("is_duplicate"), DUPLICATE, "error"),
        Rule("sex_missing", F.col("recorded_sex").isNull(), NO_SEX, "warning"),
        Rule("both_roles", F.col("as_sire") & F.col("as_dam"), BOTH_ROLES, "error"),
        Rule("registered_before_birth", F.col("birthdate") > F.col("reg_date"), REGISTERED_BEFORE_BIRTH, "warning"),
        Rule("own_grandsire", animal == F.col("grand_sire_id"), OWN_GRANDSIRE, "error"),
        Rule("older_than_sire", F.col("birthdate") < F.col("sire_birthdate"), OLDER_THAN_SIRE, "warning"),
    ]
    if parentage:
        rules += [
            Rule("male_dam", (F.col("sex_id") == MALE) & F.col("as_dam"), MALE_DAM, "error"),
            Rule("dam_missing", F.col("dam_tag_id").isNotNull() & F.col("dam_id").isNull(), NO_DAM, "warning"),
            Rule("female_sire", (F.col("sex_id") == FEMALE) & F.col("as_sire"), FEMALE_SIRE, "error"),
            Rule("sire_missing", F.col("sire_tag_id").isNotNull() & F.col("sire_id").isNull(), NO_SIRE, "warning"),
            Rule(
                "own_parent",
                F.coalesce(F.col("sire_id") == animal, F.lit(False))
                | F.coalesce(F.col("dam_id") == animal, F.lit(False)),
                OWN_PARENT,
                "error",
            ),
        ]
    return rules


def sex_evidence(parentage: DataFrame, events: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Per animal and country: has it events only females have, is it a sire, a dam of staged animals?

    ``wanted`` (animal_id, country_id) leaves out all others before anything is grouped.
    """
    no = F.lit(False)
    from_events = events.filter(F.col("event_type").isin(*FEMALE_EVENTS)).select(
        "animal_id", "country_id", F.lit(True).alias("ev_event"), no.alias("ev_sire"), no.alias("ev_dam")
    )
    roles = parent_roles(parentage, "country_id").select(
        F.col("id").alias("animal_id"),
        "country_id",
        no.alias("ev_event"),
        F.col("as_sire").alias("ev_sire"),
        F.col("as_dam").alias("ev_dam"),
    )
    evidence = from_events.unionByName(roles).dropna(subset=["animal_id", "country_id"])
    if wanted is not None:
        evidence = evidence.join(wanted, ["animal_id", "country_id"], "left_semi")
    return (
        evidence.groupBy("animal_id", "country_id")
        .agg(F.max("ev_event").alias("ev_event"), F.max("ev_sire").alias("ev_sire"), F.max("ev_dam").alias("ev_dam"))
    )


def derive_sex(
    staged: DataFrame, events: DataFrame, parentage: DataFrame | None = None, wanted: DataFrame | None = None
) -> DataFrame:
    """Fill a missing ``sex``: female by events, else male as a sire, else female as a dam.

    ``recorded_sex`` keeps what was there, ``estimated_sex`` holds the derived label. Never repeats a row.
    ``parentage`` (sire_id, dam_id, country_id of the same rows) spares computing ``staged`` twice;
    ``wanted`` (animal_id, country_id) holds at least the animals without a sex.
    """
    parentage = staged if parentage is None else parentage
    estimate = (
        F.when(F.col("ev_event"), FEMALE_LABEL).when(F.col("ev_sire"), MALE_LABEL).when(F.col("ev_dam"), FEMALE_LABEL)
    )
    return (
        staged.join(sex_evidence(parentage, events, wanted), ["animal_id", "country_id"], "left")
        .withColumn("recorded_sex", F.col("sex"))
        .withColumn("estimated_sex", F.when(F.col("sex").isNull(), estimate))
        .withColumn("sex", F.coalesce("sex", "estimated_sex"))
        .drop("ev_event", "ev_sire", "ev_dam")
    )


def pedigree_staged(tables: Mapping[str, DataFrame], country_name: str | None = None) -> DataFrame:
    """Animals (of a country, by name) with parents, farm, places, codes, derived sex and marks."""
    everything = tables["core_animal"]
    animals = everything
    if country_name is not None:
        animals = in_country(animals, tables["core_country"], country_name)
    animals = animals.select(
        F.col("id").alias("animal_id"),
        "farm_id", "tag_id", "original_tag_id", "sire_id", "sire_tag_id", "dam_id", "dam_tag_id",
        F.col("sex").alias("sex_id"),
        "reg_date", "birthdate", "main_breed",
    )
    farms = tables["core_farm"].select(
        F.col("id").alias("farm_id"),
        "country_id", "region_id", "district_id", "ward_id", "village_id", "farmer_name", "org_id",
        "project", "longitude", "latitude",
    )
    # Marks come from the few columns they need, not from the wide rows below.
    parentage = animals.select("farm_id", "sire_id", "dam_id").join(
        farms.select("farm_id", "country_id"), "farm_id", "left"
    )
    copies = duplicate_keys(animals.select("tag_id"), "tag_id").drop("copies")
    roles = parent_roles(everything).withColumnRenamed("id", "animal_id")

    df = with_parents(animals, everything).join(farms, "farm_id", "left")
    df = with_name(df, tables["core_country"], "country_id", "country")
    df = with_places(df, tables["country_units"])
    df = with_name(df, tables["core_organization"], "org_id", "organization_name")
    codes = tables["core_master_list"]
    df = with_code(df, codes, "main_breed", BREEDS, "breed")
    df = with_code(df, codes, "sex_id", SEXES, "sex")
    sexes = codes.filter((F.col("list_type_id") == SEXES) & F.col("label").isNotNull())
    unknown = animals.join(sexes.select(F.col("value").alias("sex_id")), "sex_id", "left_anti")
    wanted = unknown.join(farms.select("farm_id", "country_id"), "farm_id").select("animal_id", "country_id")
    df = derive_sex(df, tables["core_animal_event"], parentage, wanted)
    df = flag_if_exists(df, copies, "is_duplicate")
    return df.join(roles, "animal_id", "left")


def pedigree_extract(
    tables: Mapping[str, DataFrame],
    country_name: str | None = None,
    parentage: bool = True,
) -> DataFrame:
    """All animals with ``warning``, ``error`` and ``status``; none is left out."""
    df = apply_rules(pedigree_staged(tables, country_name), pedigree_rules(parentage))
    return df.select(*COLUMNS, "warning", "error", "status")
