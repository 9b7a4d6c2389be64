"""Activity counts, pivots, summary statistics and rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from herdloom.functions import attributes, capitalise, milk_total_strict, with_attributes
from herdloom.operators.filters import created_between, exclude
from herdloom.operators.lookups import ANIMAL_TYPES, FARM_TYPES, with_code, with_name

# Event type codes (100 and 101 stand for registrations) and names of the registrations.
CALVING = 1
MILK = 2
INSEMINATION = 3
WEIGHT = 6
NOT_COUNTED = 18
ANIMAL_REG = 100
FARM_REG = 101
REGISTRATIONS = ("Animal-Reg", "Farmer-Reg")
OTHER = "Other"


def with_milk_total(events: DataFrame, digits: int | None = 2) -> DataFrame:
    """Strict milk total from the attribute bag, parsed once."""
    return (
        with_attributes(events, "_attrs")
        .withColumn("total_milk", milk_total_strict(F.col("_attrs"), digits))
        .drop("_attrs")
    )


def milk_positive(milk: DataFrame) -> DataFrame:
    """Milk records with a positive strict total."""
    return with_milk_total(milk).filter(F.col("total_milk") > 0)


def activity_union(events: DataFrame, animals: DataFrame, farms: DataFrame, start, end) -> DataFrame:
    """Distinct (id, country, user, type) over events, milk with a total, animals and farms created in a period.

    Events are scanned once; the total is worked out for milk only.
    """
    recorder = F.coalesce("field_agent_id", "created_by").alias("user_id")
    created = exclude(created_between(events, start, end), "event_type", NOT_COUNTED)
    total = milk_total_strict(attributes(F.col("additional_attributes")), 2)
    counted = F.when(F.col("event_type") == MILK, total > 0).otherwise(True)
    event_rows = created.filter(counted).select("id", "country_id", recorder, "event_type")
    animal_rows = (
        created_between(animals, start, end, known="created_by")
        .filter(F.col("country_id").isNotNull())
        .select("id", "country_id", F.col("created_by").alias("user_id"), F.lit(ANIMAL_REG).alias("event_type"))
    )
    farm_rows = (
        created_between(farms, start, end)
        .filter(F.col("country_id").isNotNull())
        .select("id", "country_id", recorder, F.lit(FARM_REG).alias("event_type"))
    )
    return event_rows.unionByName(animal_rows).unionByName(farm_rows).distinct()


def activity_counts(
    union: DataFrame, event_types: DataFrame, users: DataFrame, countries: DataFrame
) -> DataFrame:
    """Records per country, recorder and event; grouped by ids, names added to the few groups."""
    counted = union.groupBy("country_id", "user_id", "event_type").agg(F.count("id").alias("total"))
    named = event_types.select(F.col("event_id").alias("event_type"), F.col("description").alias("event"))
    counted = counted.join(named, "event_type", "inner")
    counted = with_name(counted, users, "user_id", "enumerator", "inner")
    counted = with_name(counted, countries, "country_id", "country", "inner")
    return counted.select("country", "enumerator", "event", "total")


def animal_registrations(animals: DataFrame, countries: DataFrame, codes: DataFrame, start, end) -> DataFrame:
    """Animals created in a period per country and animal type."""
    counted = (
        created_between(animals, start, end, known="created_by")
        .groupBy("country_id", "animal_type")
        .agg(F.count("id").alias("total"))
    )
    counted = with_code(counted, codes, "animal_type", ANIMAL_TYPES, "type_label", how="inner")
    counted = with_name(counted, countries, "country_id", "country", "inner")
    return counted.select("country", F.col("type_label").alias("animal_type"), "total")


def farm_registrations(farms: DataFrame, countries: DataFrame, codes: DataFrame, start, end) -> DataFrame:
    """Farms created in a period by a known agent per country and farm type."""
    counted = (
        created_between(farms, start, end, known="field_agent_id")
        .groupBy("country_id", "farm_type")
        .agg(F.count("id").alias("total"))
    )
    counted = with_code(counted, codes, "farm_type", FARM_TYPES, "type_label", how="inner")
    counted = with_name(counted, countries, "country_id", "country", "inner")
    return counted.select("country", F.col("type_label").alias("farm_type"), "total")


def with_enumerator(activity: DataFrame) -> DataFrame:
    """Recorder names written alike, so that spellings of one name fall together."""
    return activity.withColumn("enumerator", capitalise(F.col("enumerator")))


def _pivot(df: DataFrame, by: Sequence[str], column: str, values: Sequence[str], how: str) -> DataFrame:
    """A column per value and one for all others, so that a row adds up to the long form."""
    cells = df.groupBy(*by, column).agg(getattr(F, how)("total").alias("total"))
    named = F.when(F.col(column).isin(*values), F.col(column)).otherwise(OTHER)
    wide = cells.withColumn(column, named).groupBy(*by).pivot(column, [*values, OTHER]).sum("total")
    return wide.na.fill(0, subset=[*values, OTHER])


def registration_pivot(activity: DataFrame) -> DataFrame:
    """Country by kind of registration, summed."""
    rows = activity.filter(F.col("event").isin(*REGISTRATIONS))
    return _pivot(rows, ["country"], "event", REGISTRATIONS, "sum").drop(OTHER)


def monitoring_pivot(activity: DataFrame, events: Sequence[str]) -> DataFrame:
    """Country by every other event, summed; events not named are added up under ``Other``."""
    return _pivot(exclude(activity, "event", *REGISTRATIONS), ["country"], "event", events, "sum")


def enumerator_pivot(activity: DataFrame, events: Sequence[str]) -> DataFrame:
    """Country and recorder by event. A mean: recorders with one name are averaged, not added.

    ``Other`` adds up the means of the events not named.
    """
    return _pivot(with_enumerator(activity), ["country", "enumerator"], "event", events, "avg")


def type_pivot(registrations: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Country by animal or farm type, averaged over countries of one name; other types under ``Other``."""
    return _pivot(registrations, ["country"], column, values, "avg")


def long_form(df: DataFrame, report: str, *keys: str) -> DataFrame:
    """A report as (report, country, detail, measure, value): a row per number; a second key is the detail."""
    values = [c for c in df.columns if c not in keys]
    detail = F.col(keys[1]) if len(keys) > 1 else F.lit(None).cast("string")
    wide = df.select("country", detail.alias("detail"), *[F.col(f"`{c}`").cast("double").alias(c) for c in values])
    rows = wide.unpivot(["country", "detail"], [f"`{c}`" for c in values], "measure", "value")
    return rows.select(F.lit(report).alias("report"), "country", "detail", "measure", "value")


def event_totals(activity: DataFrame) -> DataFrame:
    return activity.groupBy("event", "country").agg(F.sum("total").alias("total"))


#: Shares of the values between which the median is sought, and the accuracy of the sketch that finds
#: them: its error, 1/10000 of the values, is a twentieth of the way to either side.
AROUND_MEDIAN, ACCURACY = (0.498, 0.502), 10_000


def _medians(known: DataFrame, basic: DataFrame, key: str, value: str) -> DataFrame:
    """Mean of the two middle values of each key, out of the few values around them.

    Values below are only counted; what is put in order is some 0.4 % of the values of a key at most.
    """
    bounds = basic.select(F.col(key).alias("_key"), F.col("count").alias("_all"), "_around")
    placed = known.join(bounds, F.col(key) == F.col("_key")).filter(F.col(value) <= F.col("_around")[1])
    inside = F.when(F.col(value) >= F.col("_around")[0], F.col(value)).alias("_value")
    counts = placed.groupBy("_key", "_all", inside).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("_key").orderBy(F.col("_value").asc_nulls_first())
    counts = counts.withColumn("_last", F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding, 0)))

    def at(position):
        return F.max(F.when(position.between(F.col("_last") - F.col("n") + 1, F.col("_last")), F.col("_value")))

    low, high = F.floor((F.col("_all") + 1) / 2), F.floor((F.col("_all") + 2) / 2)
    return counts.groupBy("_key").agg(((at(low) + at(high)) / 2).alias("median"))


def describe_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """Count, maximum, minimum, exact median, mean and sample standard deviation of the numbers per key.

    One grouping gives all but the median, and from a mergeable sketch two values close around it; the
    exact one is then found among the values between those two. Whatever the spread of the values, no
    task holds all of a key. Rows are read twice: store them first where they are costly.
    """
    known = df.filter(F.col(key).isNotNull()).select(key, value)
    basic = known.groupBy(key).agg(
        F.count(value).alias("count"),
        F.max(value).alias("max"),
        F.min(value).alias("min"),
        F.avg(value).alias("avg"),
        F.stddev_samp(value).alias("std"),
        F.percentile_approx(value, list(AROUND_MEDIAN), ACCURACY).alias("_around"),
    )
    medians = _medians(known, basic, key, value).withColumnRenamed("_key", key)
    return basic.join(medians, key, "left").select(key, "count", "max", "min", "median", "avg", "std")


def _recorder_totals(activity: DataFrame) -> DataFrame:
    return with_enumerator(activity).groupBy("country", "enumerator").agg(F.sum("total").alias("records"))


def _ranked(picked: DataFrame) -> DataFrame:
    by_records = Window.partitionBy("country").orderBy(F.col("records").desc())
    return picked.withColumn("rank", F.dense_rank().over(by_records))


def top_n(activity: DataFrame, n: int = 5) -> DataFrame:
    """Recorders with the most records per country, ties by name, with dense rank."""
    w = Window.partitionBy("country").orderBy(F.col("records").desc(), "enumerator")
    picked = _recorder_totals(activity).withColumn("_place", F.row_number().over(w))
    return _ranked(picked.filter(F.col("_place") <= n).drop("_place"))


def bottom_n(activity: DataFrame, n: int = 5) -> DataFrame:
    """Recorders with the fewest records per country; the fewest get the largest rank among them."""
    w = Window.partitionBy("country").orderBy("records", "enumerator")
    picked = _recorder_totals(activity).withColumn("_place", F.row_number().over(w))
    return _ranked(picked.filter(F.col("_place") <= n).drop("_place"))
