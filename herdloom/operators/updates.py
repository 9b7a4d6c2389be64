"""Keyed updates and retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdloom.functions import first_gps, strict_num
from herdloom.operators.lookups import join_grouped


def form_gps(forms: DataFrame) -> DataFrame:
    """Forms that hold a location, with its first two parts as texts."""
    return (
        forms.withColumn("_gps", first_gps(F.col("form_data")))
        .filter(F.col("_gps").isNotNull())
        .withColumns({"gps_latitude": F.col("_gps.latitude"), "gps_longitude": F.col("_gps.longitude")})
        .drop("_gps")
    )


def fill_gps(farms: DataFrame, forms: DataFrame, order: Sequence[str] = ("form_version", "form_data")) -> DataFrame:
    """Coordinates from the form with the same uuid on farms without a latitude.

    Of several forms the lowest by ``order`` counts. A location that is not two numbers is passed over.
    """
    spots = form_gps(forms).withColumns(
        {
            "_latitude": strict_num(F.col("gps_latitude")),
            "_longitude": strict_num(F.col("gps_longitude")),
        }
    )
    one = (
        spots.dropna(subset=["form_uuid", "_latitude", "_longitude"])
        .groupBy(F.col("form_uuid").alias("odk_form_uuid"))
        .agg(F.min_by(F.struct("_latitude", "_longitude"), F.struct(*order)).alias("_gps"))
    )
    fill = F.col("latitude").isNull() & F.col("_gps").isNotNull()
    return (
        join_grouped(farms, one, ["odk_form_uuid"])
        .withColumns(
            {
                "latitude": F.when(fill, F.col("_gps._latitude")).otherwise(F.col("latitude")),
                "longitude": F.when(fill, F.col("_gps._longitude")).otherwise(F.col("longitude")),
                "gps_filled": fill,
            }
        )
        .drop("_gps")
    )


def flag_inactive(
    animals: DataFrame,
    events: DataFrame,
    as_of: dt.date | Column,
    max_age_years: int = 20,
    last_event_years: int = 5,
) -> DataFrame:
    """Mark animals past an age, or without an event (else registration) for some years."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    last = events.groupBy(F.col("animal_id").alias("id")).agg(F.max("event_date").alias("last_event_date"))
    seen = F.coalesce("last_event_date", "reg_date")
    old = F.col("birthdate") < F.add_months(as_of, -12 * max_age_years)
    quiet = seen < F.add_months(as_of, -12 * last_event_years)
    return animals.join(last, "id", "left").withColumn(
        "inactive", F.coalesce(old, F.lit(False)) | F.coalesce(quiet, F.lit(False))
    )


def _limit(as_of: dt.date | Column, days: int) -> Column:
    """First day that is kept."""
    return F.date_sub(as_of, days) if isinstance(as_of, Column) else F.lit(as_of - dt.timedelta(days=days))


def _is_old(at: str, as_of: dt.date | Column, days: int) -> Column:
    return F.coalesce(F.col(at) < _limit(as_of, days), F.lit(False))


def retention_split(df: DataFrame, at: str, as_of: dt.date | Column, days: int = 20) -> tuple[DataFrame, DataFrame]:
    """Rows to keep and rows to archive: those more than ``days`` days old. A NULL time is kept."""
    limit = _limit(as_of, days)
    return df.filter((F.col(at) >= limit) | F.col(at).isNull()), df.filter(F.col(at) < limit)


def retention_marked(df: DataFrame, at: str, as_of: dt.date | Column, days: int = 20) -> DataFrame:
    """Every row with ``archived``, to write both parts in one pass, partitioned by it."""
    return df.withColumn("archived", _is_old(at, as_of, days))


def retention_counts(df: DataFrame, at: str, as_of: dt.date | Column, days: int = 20) -> DataFrame:
    """Dry run of :func:`retention_split`: how many rows would be kept and archived."""
    old = _is_old(at, as_of, days)
    return df.agg(F.count_if(~old).alias("kept"), F.count_if(old).alias("archived"))
