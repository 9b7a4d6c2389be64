"""Joins to names, codes and relatives.

No join here carries a broadcast hint. A dimension below ``spark.sql.autoBroadcastJoinThreshold`` is
broadcast by the planner, or by adaptive execution once its real size is known; a larger one is joined
by shuffle, where adaptive execution splits hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdloom.functions import same_name

# List types in the code table.
FARM_TYPES = 2
SEXES = 3
BREEDS = 8
ANIMAL_TYPES = 62

LEVELS = ("region", "district", "ward", "village")


def with_name(df: DataFrame, names: DataFrame, key: str, name: str, how: str = "left") -> DataFrame:
    """Name of an id from an (id, name) table."""
    dim = names.select(F.col("id").alias(key), F.col("name").alias(name))
    return df.join(dim, key, how)


def with_places(df: DataFrame, units: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """Name of each place level from ``<level>_id``; one place table serves them all."""
    for level in levels:
        df = with_name(df, units, f"{level}_id", level)
    return df


def with_code(
    df: DataFrame,
    codes: DataFrame,
    column: str,
    list_type: int,
    name: str,
    text: str = "label",
    how: str = "left",
) -> DataFrame:
    """Label (or description) of a code; the list type belongs to the join, so rows are kept."""
    dim = codes.filter(F.col("list_type_id") == list_type).select(
        F.col("value").alias(column), F.col(text).alias(name)
    )
    return df.join(dim, column, how)


def with_parents(animals: DataFrame, parents: DataFrame | None = None) -> DataFrame:
    """Tag and birth date of sire and dam, the sire's sire and the dam's dam.

    The recorded parent tag stands in where the parent is not in the table. ``parents`` is the whole
    animal table when ``animals`` is a part of it.
    """
    parents = animals if parents is None else parents
    sires = parents.select(
        F.col("id").alias("sire_id"),
        F.col("tag_id").alias("_sire_tag"),
        F.col("birthdate").alias("sire_birthdate"),
        F.col("sire_id").alias("grand_sire_id"),
    )
    dams = parents.select(
        F.col("id").alias("dam_id"),
        F.col("tag_id").alias("_dam_tag"),
        F.col("birthdate").alias("dam_birthdate"),
        F.col("dam_id").alias("grand_dam_id"),
    )
    return (
        animals.join(sires, "sire_id", "left")
        .join(dams, "dam_id", "left")
        .withColumns(
            {
                "sire_tag_id": F.coalesce("_sire_tag", "sire_tag_id"),
                "dam_tag_id": F.coalesce("_dam_tag", "dam_tag_id"),
            }
        )
        .drop("_sire_tag", "_dam_tag")
    )


def in_country(df: DataFrame, countries: DataFrame, name: str) -> DataFrame:
    """Rows of the country with this name, whatever its case and accents."""
    ids = countries.filter(same_name(F.col("name"), name)).select(F.col("id").alias("country_id"))
    return df.join(ids, "country_id", "left_semi")


def join_grouped(df: DataFrame, grouped: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join to a grouping on its keys, none of which is NULL, such that hot keys can be split.

    A plain join would take over the partitioning of the grouping, and adaptive execution only splits a
    join of two shuffles of its own. The null-safe comparison has the (already reduced) grouping shuffled
    once more and keeps rows with a NULL key from matching anything.
    """
    hidden = {key: f"_{key}_of_group" for key in on}
    condition = F.lit(True)
    for key, other in hidden.items():
        condition = condition & F.col(key).eqNullSafe(F.col(other))
    return df.join(grouped.withColumnsRenamed(hidden), condition, "left").drop(*hidden.values())


def flag_if_exists(df: DataFrame, keys: DataFrame, flag: str) -> DataFrame:
    """Mark rows whose key is among ``keys`` (same column names); never repeats a row.

    Keys are made distinct before they are shuffled, so a key met many times costs one row.
    """
    on = keys.columns
    marks = keys.dropna(subset=on).distinct().withColumn(flag, F.lit(True))
    return join_grouped(df, marks, on).withColumn(flag, F.coalesce(flag, F.lit(False)))


def parent_roles(animals: DataFrame, *by: str) -> DataFrame:
    """One row per parent id (and ``by``): is it recorded as a sire, as a dam?

    One scan and one grouping for both roles; a sire of a third of all animals is one row per task
    before the shuffle.
    """
    role = F.explode(
        F.array(
            F.struct(F.col("sire_id").alias("id"), F.lit(True).alias("as_sire"), F.lit(False).alias("as_dam")),
            F.struct(F.col("dam_id").alias("id"), F.lit(False).alias("as_sire"), F.lit(True).alias("as_dam")),
        )
    ).alias("role")
    return (
        animals.select(*by, role)
        .select(*by, "role.*")
        .filter(F.col("id").isNotNull())
        .groupBy("id", *by)
        .agg(F.max("as_sire").alias("as_sire"), F.max("as_dam").alias("as_dam"))
    )


def used_in_both_roles(animals: DataFrame) -> DataFrame:
    """Ids recorded as the sire of one animal and as the dam of another."""
    roles = parent_roles(animals)
    return roles.filter(F.col("as_sire") & F.col("as_dam")).select(F.col("id").alias("animal_id"))
