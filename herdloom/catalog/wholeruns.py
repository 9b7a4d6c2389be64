"""Whole runs: what they leave in tables and files."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from herdloom.catalog import basics, checks, histories  # noqa: F401  (whose queries are used here)
from herdloom.catalog.activity import ANIMAL_LABELS, FARM_LABELS
from herdloom.catalog.base import AS_OF, END, LONG_END, LONG_START, MONITORED, ORACLES, START, query
from herdloom.plans import lactation_extract, runs, testday_report, weight_extract
from herdloom.plans.increments import ExtractIncrements, LactationIncrements, TestdayIncrements, WeightIncrements
from herdloom.sources import read_current, read_daily, refresh, shared_path, write_daily
from herdloom.sources.buckets import store_bucketed
from herdloom.sources.keyed import KeyedTable


@query("refresh_failed", "core_farm", "select id, farmer_name, farm_type from core_farm")
def refresh_failed(t):
    """A table whose next version fails after some of its rows are written."""
    path, rows = shared_path(t.spark, "report"), t["core_farm"].select("id", "farmer_name", "farm_type")
    refresh(rows, path)
    broken = F.when(F.col("id") % 7 == 3, F.raise_error(F.lit("broken on purpose")).cast("string"))
    try:
        refresh(rows.withColumn("farmer_name", F.coalesce(broken, "farmer_name")), path)
    except PySparkException:
        pass
    return read_current(t.spark, path, "id bigint, farmer_name string, farm_type bigint")


#: Limits of two retention runs: at the start of a day, and within one.
LIMITS = (dt.date(2024, 1, 5), dt.datetime(2024, 1, 15, 6))
NOTED = "timestampadd(HOUR, cast(id % 24 as int), cast(created_at as timestamp_ntz))"


@query(
    "retention_moved",
    "core_animal_event",
    f"""
    select id, noted, coalesce(noted < timestamp '{LIMITS[1]}', false) as archived
    from (select id, cast(created_at as timestamp) + to_hours(cast(id % 24 as integer)) as noted from core_animal_event)""",
)
def retention_moved(t):
    path, schema = shared_path(t.spark, "daily"), "id bigint, noted timestamp_ntz"
    table, archive = f"{path}/table", f"{path}/archive"
    write_daily(t["core_animal_event"].select("id", F.expr(NOTED).alias("noted")), table, "noted")
    for limit in (*LIMITS, LIMITS[1]):  # a repeated run finds nothing left to do
        runs.retention_days_run(t.spark, table, archive, "noted", schema, limit, 0)
    kept, gone = (read_daily(t.spark, where, schema) for where in (table, archive))
    return kept.withColumn("archived", F.lit(False)).union(gone.withColumn("archived", F.lit(True)))


def _manifest_sql(job: str) -> str:
    return f"""select '{job}' as job, count(*) as staged, count(*) filter (where status = 1) as valid, count(*) filter (where status = 0) as error,
      count(*) filter (where status = 1) as written_valid, count(*) filter (where status = 0) as written_error
    from ({ORACLES[f"{job}_extract"]})"""


@query("run_manifest", "", f"{_manifest_sql('lactation')} union all {_manifest_sql('weight')}")
def run_manifest(t):
    """Rows that two runs counted while they staged and wrote them; a repeated run has one row."""
    out = shared_path(t.spark, "runs")
    for job in (runs.lactation_run, runs.weight_run, runs.weight_run):
        job(t, out, "r1", LONG_START, LONG_END, AS_OF)
    return runs.run_manifests(t.spark, out, "lactation", "weight").drop("run_id")


#: Report of a data-flow run -> the query of the same frame.
PARTS = {
    "registrations": "registration_pivot", "monitoring": "monitoring_pivot", "enumerators": "enumerator_pivot",
    "event_totals": "event_totals", "top": "top_enumerators", "bottom": "bottom_enumerators",
    "animal_types": "animal_type_pivot", "farm_types": "farm_type_pivot", "milk": "milk_stats", "weight": "weight_stats",
}


def _long_sql(report: str, name: str) -> str:
    detail = runs.DETAILS.get(report)
    return f"""select '{report}' as report, country, {detail or "cast(null as varchar)"} as detail, measure, round(cast(value as double), 4) as value
    from ({ORACLES[name]}) unpivot include nulls (value for measure in (columns(* exclude (country{", " + detail if detail else ""}))))"""


@query("dataflow_report", "", " union all ".join(_long_sql(*part) for part in PARTS.items()))
def dataflow_report(t):
    """The ten reports that one run makes from the record tables it has refilled."""
    made = runs.dataflow_run(t, shared_path(t.spark, "dataflow"), START, END, MONITORED, ANIMAL_LABELS, FARM_LABELS)
    return runs.dataflow_report(made).withColumn("value", F.round("value", 4))


def _keyed(t, df, key: str) -> KeyedTable:
    table = KeyedTable(t.spark, shared_path(t.spark, "keyed"), key, df.schema, 16)
    table.write(df)
    return table


@query("fill_gps_merged", "", ORACLES["fill_gps"])
def fill_gps_merged(t):
    """Coordinates filled in by a merge; a second one finds nothing to fill."""
    farms = _keyed(t, t["core_farm"].select("id", "latitude", "longitude", "odk_form_uuid"), "id")
    before = t["core_farm"].select("id", F.col("latitude").isNull().alias("missing"))
    for _ in range(2):
        runs.gps_merge_run(farms, t["core_odk_form"])
    filled = (F.col("missing") & F.col("latitude").isNotNull()).alias("gps_filled")
    rounded = [F.round(c, 4).alias(c) for c in ("latitude", "longitude")]
    return farms.read().join(before, "id").select("id", *rounded, filled)


@query("flag_inactive_merged", "", f"select id, inactive from ({ORACLES['flag_inactive']})")
def flag_inactive_merged(t):
    """Marks brought up to date twice, from a day on which hardly any animal was inactive."""
    columns = t["core_animal"].select("id", "birthdate", "reg_date").withColumn("inactive", F.lit(False))
    animals = _keyed(t, columns, "id")
    for as_of in (dt.date(2021, 1, 1), AS_OF):
        runs.inactive_merge_run(animals, t["core_animal_event"], as_of, 3, 1)
    return animals.read().select("id", "inactive")


#: Times up to which three runs of the incremental extract read events, and their days.
STEPS = [(dt.datetime(2024, 1, 9), dt.date(2024, 1, 9)), (dt.datetime(2024, 1, 16), dt.date(2024, 1, 16)), (dt.datetime(2025, 1, 1), AS_OF)]


def _incremental(t, kind: type[ExtractIncrements], **options) -> ExtractIncrements:
    """A first run and two increments, the last repeated."""
    path, events = shared_path(t.spark, "increments"), t["core_animal_event"]
    events = events.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
    write_daily(events, f"{path}/events", "created_at")
    extract = kind(t.spark, f"{path}/events", path, events.schema, 16, **options)
    for until, as_of in (*STEPS, STEPS[-1]):
        extract.run(t, until, as_of)
    return extract


def _rounded(df, *more: str):
    return df.withColumns({c: F.round(c, 4) for c in ("longitude", "latitude", *more)})


@query(
    "lactation_incremental",
    checks.LACTATION_VIEWS,
    f"select {checks.LACTATION_OUT}, lactation_id, comments, case when comments is null then 1 else 0 end as status from checked",
    checks.lactation_sql(None, "true"),
)
def lactation_incremental(t):
    """Increments as if extracted once over all events, as are the two that follow."""
    return _rounded(_incremental(t, LactationIncrements).read(lactation_extract(t, None, None, AS_OF).schema))


@query(
    "weight_incremental",
    checks.WEIGHT_VIEWS,
    f"select {checks.WEIGHT_OUT}, weight_id, comments, case when comments is null then 1 else 0 end as status from checked",
    checks.weight_sql(None, "true"),
)
def weight_incremental(t):
    return _rounded(_incremental(t, WeightIncrements).read(weight_extract(t, None, None, AS_OF).schema))


@query("testday_incremental", "", ORACLES["testday_report"])
def testday_incremental(t):
    schema = testday_report(t, histories.STAMPED_AT, histories.VERSION).schema
    extract = _incremental(t, TestdayIncrements, min_gap=histories.GAP)
    return _rounded(extract.report(schema, histories.STAMPED_AT, histories.VERSION), "TotalMilk")


#: Queries whose operators look at one animal at a time.
BY_ANIMAL = {"calving_history": histories.calving_history, "asof_calving": histories.asof_calving, "testday_number": histories.testday_number}


def _bucketed_query(name: str, build):
    @query(f"{name}_bucketed", "", ORACLES[name])
    def run(t):
        path = shared_path(t.spark, "bucketed")
        events = store_bucketed(t["core_animal_event"], f"events_{path[-32:]}", path, "animal_id", 8, ["event_date", "id"])
        return events.apply(lambda rows: build({"core_animal_event": rows}))


for _name, _build in BY_ANIMAL.items():
    _bucketed_query(_name, _build)
