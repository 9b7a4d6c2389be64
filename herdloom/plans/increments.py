"""Extracts kept up to date: each run reads new events only and redoes the animals they touch.

What is kept: all events seen that an extract is made from, and the extract, both changed by animal, and how
far events were read. A run reads the days of an event table laid out by creation day since then, adds their
events to those of the animals they belong to, and computes the rows of these animals anew. Rows of other
animals are neither computed nor, but for those that share a file with a touched animal, written.

This holds for extracts whose rows depend on the events of one animal: histories of calvings, weighings with
their duplicates, and test days with the calvings and weights they are linked to. Names, places and codes of
an animal are those of the run that touched it last; a full run takes up later changes to farms and animals.
Events without a creation time are never new and so never read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herdloom.operators.history import MIN_CALVING_GAP
from herdloom.operators.reports import CALVING, MILK, WEIGHT
from herdloom.plans.lactation import lactation_extract
from herdloom.plans.testday import testday_report
from herdloom.plans.weight import weight_extract
from herdloom.sources import publish, read_current, read_daily, shared_path, stamp
from herdloom.sources.keyed import KeyedTable
from herdloom.sources.sinks import STAMP_TIME, STAMP_VERSION
from herdloom.sources.tables import schema_of

PROGRESS = "read_until timestamp_ntz, as_of date"


@dataclass(frozen=True)
class Increment:
    """What one run did."""

    since: dt.datetime | None
    until: dt.datetime
    animals: int
    files: int


class ExtractIncrements:
    """State and result below ``out``; ``events`` is an event table laid out by the day of ``created_at``."""

    #: Types of the events that the extract is made from, and what it needs of them.
    types: tuple[int, ...]
    needs = ("animal_id", "id", "event_type", "event_date")
    #: Column of the extract that holds the animal.
    key = "animal_id"
    #: Whether rows of events after the day of a run may differ on another day.
    looks_ahead = True

    def __init__(self, spark: SparkSession, events: str, out: str, event_schema: T.StructType | None = None, buckets: int = 64):
        self.spark, self.events, self.out, self.buckets = spark, events, out, buckets
        self.event_schema = event_schema or schema_of("core_animal_event")
        kept = T.StructType([self.event_schema[name] for name in self.needs])
        self.seen = KeyedTable(spark, f"{out}/seen", "animal_id", kept, buckets)

    def build(self, tables: Mapping[str, DataFrame], as_of: dt.date) -> DataFrame:
        """The extract over the events in ``tables``."""
        raise NotImplementedError

    def _extract(self, schema: T.StructType) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.out}/extract", self.key, schema, self.buckets)

    def progress(self) -> tuple[dt.datetime | None, dt.date | None]:
        """Time up to which events were read, and the day of that run."""
        try:
            row = read_current(self.spark, f"{self.out}/progress", PROGRESS).first()
        except LookupError:
            return None, None
        return row["read_until"], row["as_of"]

    def new_events(self, since: dt.datetime | None, until: dt.datetime) -> DataFrame:
        """Events created from ``since`` on and before ``until``, from the folders of these days alone."""
        rows = read_daily(self.spark, self.events, self.event_schema, since and since.date())
        time = lambda at: F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
        rows = rows.filter(F.col("event_type").isin(*self.types) & (F.col("created_at") < time(until)))
        rows = rows if since is None else rows.filter(F.col("created_at") >= time(since))
        return rows.select(*self.needs)

    def run(self, tables: Mapping[str, DataFrame], until: dt.datetime, as_of: dt.date) -> Increment:
        """Take up events created before ``until``.

        Animals with an event after the day of the run before are redone as well where that matters, as it may
        have been in the future then. A run that was stopped is repeated whole: all of its steps replace rows by key.
        """
        since, before = self.progress()
        new = self.new_events(since, until)
        touched = new.select("animal_id")
        if self.looks_ahead and before is not None and before != as_of:
            touched = touched.union(self.seen.read().filter(F.col("event_date") > F.lit(min(before, as_of))).select("animal_id"))
        # Written aside, as the table it comes from is about to change.
        aside = shared_path(self.spark, "touched")
        touched.distinct().write.parquet(aside)
        touched = self.spark.read.schema("animal_id bigint").parquet(aside)
        held = self.seen.read_keys(touched).join(new.select("id"), "id", "left_anti")
        self.seen.merge(held.select(*self.needs).unionByName(new), touched)
        # From here on the state is read, so that what is computed from it is computed once.
        extract = self.build({**tables, "core_animal_event": self.seen.read_keys(touched)}, as_of)
        files = self._extract(extract.schema).merge(extract, touched)
        animals = touched.count()
        publish(self.spark.createDataFrame([(until, as_of)], PROGRESS), f"{self.out}/progress")
        return Increment(since, until, animals, files)

    def read(self, schema: T.StructType) -> DataFrame:
        """The extract of all events read so far."""
        return self._extract(schema).read()


class LactationIncrements(ExtractIncrements):
    """Calvings with their histories, checked."""

    types = (CALVING,)

    def build(self, tables, as_of):
        return lactation_extract(tables, None, None, as_of)


class WeightIncrements(ExtractIncrements):
    """Weighings, checked; a second weighing of a day marks the first one too."""

    types = (WEIGHT,)
    needs = (*ExtractIncrements.needs, "additional_attributes")

    def build(self, tables, as_of):
        return weight_extract(tables, None, None, as_of)


class TestdayIncrements(ExtractIncrements):
    """Rows of the test-day report; they are stamped when they are read, so those of all runs have one stamp."""

    __test__ = False
    types = (CALVING, MILK, WEIGHT)
    needs = (*ExtractIncrements.needs, "country_id", "additional_attributes")
    key = "animalid"
    looks_ahead = False

    def __init__(self, *args, min_gap: int = MIN_CALVING_GAP, **options):
        super().__init__(*args, **options)
        self.min_gap = min_gap

    def build(self, tables, as_of):
        report = testday_report(tables, dt.datetime.combine(as_of, dt.time()), "", min_gap=self.min_gap)
        return report.drop(STAMP_TIME, STAMP_VERSION)

    def report(self, schema: T.StructType, extracted_at: dt.datetime, version: str) -> DataFrame:
        """The report of all events read so far, in the columns of ``schema``."""
        plain = T.StructType([field for field in schema if field.name not in (STAMP_TIME, STAMP_VERSION)])
        return stamp(self.read(plain), extracted_at, version).select(*schema.names)
