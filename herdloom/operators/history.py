"""Event histories per animal.

Every operator works on a *day table* first: events are grouped by animal and day, and windows run over
the days of an animal. An animal has no more days than the calendar, so a window stays small even where
one animal holds a third of all events; the grouping combines such rows before they are shuffled. What
differs between events of one day follows from the lowest and highest event id of that day. Results go
back to the single events by a join on animal and day, which adaptive execution splits where one key is
hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herdloom.operators.lookups import join_grouped

# Calvings closer than this to the previous one are not counted as a new lactation (fixed value).
MIN_CALVING_GAP = 220

# Event ids per block when the events of one day are numbered: bounds what one task sorts at once.
ID_BLOCK = 1 << 22


def _days(by: Sequence[str], *order) -> Window:
    return Window.partitionBy(*by).orderBy(*order)


def day_table(events: DataFrame, animal: str, day: str, id: str) -> DataFrame:
    """Days with events: count, lowest and highest id, neighbouring days, count on earlier days."""
    days = events.groupBy(animal, day).agg(
        F.count(F.lit(1)).alias("n"), F.min(id).alias("first_id"), F.max(id).alias("last_id")
    )
    w = _days([animal], F.col(day).asc_nulls_first())
    return days.withColumns(
        {
            "previous_day": F.lag(day).over(w),
            "next_day": F.lead(day).over(w),
            "earlier": F.coalesce(
                F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        }
    )


def _back_to_events(events: DataFrame, days: DataFrame, animal: str, day: str) -> DataFrame:
    """Columns of the day table on each event; a NULL day meets the NULL day."""
    days = days.withColumnsRenamed({animal: "_animal", day: "_day"})
    same = (F.col(animal) == F.col("_animal")) & F.col(day).eqNullSafe(F.col("_day"))
    return events.join(days, same, "inner").drop("_animal", "_day")


def calving_columns(day: Column, id: Column) -> dict[str, Column]:
    """Previous and next calving, interval and parity of an event from its day table row."""
    previous = F.when(id == F.col("first_id"), F.col("previous_day")).otherwise(day)
    following = F.when(id == F.col("last_id"), F.col("next_day")).otherwise(day)
    return {
        "previous_calving_date": previous,
        "subsequent_calving_date": following,
        "calving_interval": F.date_diff(day, previous),
        "parity": (F.col("earlier") + 1).cast("int"),
    }


def calving_history(calvings: DataFrame, animal="animal_id", day="event_date", id="id") -> DataFrame:
    """Previous and next calving by (day, id), days since the previous one, parity (ties share it)."""
    days = day_table(calvings, animal, day, id)
    return (
        _back_to_events(calvings, days, animal, day)
        .withColumns(calving_columns(F.col(day), F.col(id)))
        .drop("n", "first_id", "last_id", "previous_day", "next_day", "earlier")
    )


def parity_days(
    calvings: DataFrame, min_gap: int = MIN_CALVING_GAP, animal="animal_id", day="event_date", id="id"
) -> DataFrame:
    """Days on which a lactation starts, with parity counted over the calvings kept.

    A calving is kept when nothing is known of an earlier one, or the gap to it is ``min_gap`` days or
    more. Both windows share one partitioning, so the day table is shuffled once.
    """
    gap = F.date_diff(F.col(day), F.col("previous_day"))
    starts = F.col(day).isNull() | gap.isNull() | (gap >= min_gap)
    # A second calving on one day is 0 days after the first.
    repeats = F.col("n") - 1 if min_gap <= 0 else F.when(F.col(day).isNull(), F.col("n") - 1).otherwise(0)
    w = _days([animal], F.col(day).asc_nulls_first())
    return (
        day_table(calvings, animal, day, id)
        .withColumn("starts", starts)
        .withColumn("kept", F.when(F.col("starts"), 1).otherwise(0) + repeats)
        .withColumn(
            "parity",
            (
                F.coalesce(F.sum("kept").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1
            ).cast("int"),
        )
        .filter(F.col("kept") > 0)
        .select(animal, day, "first_id", "starts", "kept", "parity")
    )


def reranked_parity(
    calvings: DataFrame, min_gap: int = MIN_CALVING_GAP, animal="animal_id", day="event_date", id="id"
) -> DataFrame:
    """Calvings that start a lactation and their parity among those."""
    days = parity_days(calvings, min_gap, animal, day, id)
    first = F.col(id) == F.col("first_id")
    kept = F.when(first, F.col("starts")).otherwise(F.col(day).isNull() | F.lit(min_gap <= 0))
    return (
        _back_to_events(calvings, days, animal, day)
        .filter(kept)
        .drop("first_id", "starts", "kept")
    )


def asof_days(
    milk_days: DataFrame, lactations: DataFrame, animal: str, milk_day: str, calving_day: str
) -> DataFrame:
    """Latest calving on or before each milk day, on day tables.

    Calvings and milk days of an animal are put on one time line, calvings first within a day, and the
    last calving seen is carried forward: one shuffle of days, no range join. A calving without a date
    comes before all others.
    """
    extra = [c for c in milk_days.columns if c not in (animal, milk_day)]
    calving = F.struct(F.col(calving_day).alias("closest_calvdate"), F.col("parity").alias("parity"))
    line = (
        lactations.select(animal, F.col(calving_day).alias("_day"), calving.alias("_calving"))
        .withColumn("_milk", F.lit(False))
        .unionByName(
            milk_days.select(animal, F.col(milk_day).alias("_day"), *extra).withColumn("_milk", F.lit(True)),
            allowMissingColumns=True,
        )
    )
    w = _days([animal], F.col("_day").asc_nulls_first(), "_milk").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    latest = F.when(F.col("_day").isNotNull(), F.last("_calving", ignorenulls=True).over(w))
    return (
        line.withColumn("_latest", latest)
        .filter("_milk")
        .select(
            animal,
            F.col("_day").alias(milk_day),
            *extra,
            F.col("_latest.closest_calvdate").alias("closest_calvdate"),
            F.col("_latest.parity").alias("parity"),
        )
    )


def asof_calving(
    milk: DataFrame, lactations: DataFrame, animal="animal_id", milk_day="milkdate", calving_day="calvdate"
) -> DataFrame:
    """Latest calving on or before the day of each milk record and its parity, NULL without one.

    ``lactations`` has one row per animal and calving day, with ``parity``.
    """
    days = milk.select(animal, milk_day).distinct()
    linked = asof_days(days, lactations, animal, milk_day, calving_day)
    # A record without a day meets no row and keeps its NULLs.
    return milk.join(linked, [animal, milk_day], "left")


def testday_number(
    milk: DataFrame,
    lactations: DataFrame,
    animal="animal_id",
    milk_day="milkdate",
    calving_day="calvdate",
    id="event_id",
) -> DataFrame:
    """:func:`asof_calving` and the running number of each record within animal and parity by (day, id).

    Records are counted per day and block of ids before the link, a block starts where the counts of the
    blocks before it end, and only the records of one block are sorted to be numbered: no task sorts all
    records of an animal. Without a calving there is no number.
    """
    block = [animal, milk_day, "_block"]
    blocks = milk.withColumn("_block", F.floor(F.col(id) / ID_BLOCK))
    counts = blocks.groupBy(*block).agg(F.count(F.lit(1)).alias("_n"))
    before = _days([animal, "parity"], F.col(milk_day).asc_nulls_first(), "_block")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    linked = (
        asof_days(counts, lactations, animal, milk_day, calving_day)
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    number = F.row_number().over(_days(block, id)) + F.col("_start")
    return (
        blocks.join(linked, block, "left")
        .withColumn("testdaynumber", F.when(F.col("parity").isNotNull(), number).cast("int"))
        .drop("_block", "_start")
    )


def testday_rows(milk: DataFrame, *keys: str, day: str = "event_date") -> DataFrame:
    """Distinct milk records with a known day."""
    return milk.filter(F.col(day).isNotNull()).dropDuplicates(list(keys))


def first_per_group(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """One row per group: in each column the first non-NULL value by ``order``.

    A grouping, not a window: each task keeps one value per group and column before the shuffle.
    """
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*firsts)


def link_by_day(milk: DataFrame, weights: DataFrame, animal: str, day: str, weight_day: str, order: str) -> DataFrame:
    """Milk records with the weights of the same animal and day.

    Several weighings of one day become one row first (first non-NULL per column by ``order``), so no
    milk record is repeated.
    """
    values = [c for c in weights.columns if c not in (animal, weight_day, order)]
    known = weights.dropna(subset=[animal, weight_day])
    one = first_per_group(known, [animal, weight_day], order, values).withColumnRenamed(weight_day, day)
    return join_grouped(milk, one, [animal, day])


def attach_events(linked: DataFrame, details: DataFrame, id: str = "event_id") -> DataFrame:
    """Inner join on the event id, read as a number on the side of the details."""
    return linked.join(details.withColumn(id, F.col(id).try_cast("bigint")), id, "inner")
