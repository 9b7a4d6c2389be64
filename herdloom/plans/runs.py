"""Whole runs: extract, stage, check, report and write.

A run stages its checked rows once; the files and reports made from them read that table. So the rows
are computed once, and a lost executor costs no more than the stage at hand.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herdloom.functions import day_range, period, sunday_week, whole_weeks
from herdloom.operators import filters, reports, rules, updates
from herdloom.plans import dashboard, dataflow
from herdloom.plans.lactation import lactation_extract, lactation_rules, lactation_staged
from herdloom.plans.pedigree import pedigree_extract, pedigree_rules, pedigree_staged
from herdloom.plans.testday import testday_report
from herdloom.plans.weight import weight_extract, weight_rules, weight_staged
from herdloom.sources import (
    archive_days,
    refresh,
    replace_partitions,
    split_valid_error,
    stage,
    stamp,
    write_extract,
)
from herdloom.sources.keyed import KeyedTable

Tables = Mapping[str, DataFrame]


def staged_run(df: DataFrame, path: str, run_id: str) -> DataFrame:
    """Stage a run and read it back; only its partition is scanned."""
    stage(df, path, run_id)
    schema = T.StructType([*df.schema.fields, T.StructField("run_id", T.StringType())])
    return df.sparkSession.read.schema(schema).parquet(path).filter(F.col("run_id") == run_id).drop("run_id")


def _places(out: str, job: str, run_id: str) -> tuple[str, str]:
    """Staging table of a job and folder for the files of a run; jobs never share either."""
    return f"{out}/staged/{job}", f"{out}/files/{job}/{quote(run_id, safe='')}"


MANIFEST = "job string, run_id string, staged bigint, valid bigint, error bigint, written_valid bigint, written_error bigint"


def _counted(df: DataFrame, **counts) -> tuple[DataFrame, Observation]:
    """The frame, and an observation that counts its rows while a job writes them."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counts.items()]), seen


def _checked_files(extract: DataFrame, out: str, job: str, run_id: str, order: Sequence[str]) -> dict[str, str]:
    """Stage the extract, write its two files, and note the rows of each step in the manifest of the run.

    Rows are counted as they pass, which takes no job of its own. Where the files have other numbers of rows
    than were staged as valid and as error the run fails and has no manifest.
    """
    spark = extract.sparkSession
    staged, files = _places(out, job, run_id)
    status = F.col("status")
    extract, seen = _counted(extract, valid=F.count_if(status == 1), error=F.count_if(status == 0))
    parts = split_valid_error(staged_run(extract, staged, run_id))
    where = {"valid": f"{files}/valid", "error": f"{files}/error"}
    written = {name: write_extract(part, where[name], *order) for name, part in zip(where, parts)}
    counts = seen.get
    if any(written[name] != counts[name] for name in where):
        raise RuntimeError(f"run {run_id!r} staged {counts} but wrote {written}")
    row = (job, run_id, counts["rows"], counts["valid"], counts["error"], written["valid"], written["error"])
    stage(spark.createDataFrame([row], MANIFEST).drop("run_id"), f"{out}/manifest/{job}", run_id)
    return where


def run_manifests(spark: SparkSession, out: str, *jobs: str) -> DataFrame:
    """Rows staged and written by the runs of some jobs, one row per run."""
    schema = ", ".join([c for c in MANIFEST.split(", ") if not c.startswith("run_id")] + ["run_id string"])
    found = [spark.read.schema(schema).parquet(f"{out}/manifest/{job}") for job in jobs]
    return reduce(DataFrame.unionByName, found)


def lactation_run(tables: Tables, out: str, run_id: str, start, end, as_of: dt.date, country: int | None = None):
    """Stage the lactation extract and write its valid and its error file."""
    extract = lactation_extract(tables, start, end, as_of, country)
    return _checked_files(extract, out, "lactation", run_id, ["animal_id", "calving_date", "lactation_id"])


def weight_run(tables: Tables, out: str, run_id: str, start, end, as_of: dt.date, country: int | None = None):
    """Stage the weight extract and write its valid and its error file, in no order."""
    return _checked_files(weight_extract(tables, start, end, as_of, country), out, "weight", run_id, [])


def pedigree_run(
    tables: Tables, out: str, run_id: str, extracted_at: dt.datetime, version: str, country_name: str | None = None
) -> str:
    """Stage the pedigree extract and write all of it, stamped."""
    staged, files = _places(out, "pedigree", run_id)
    rows = staged_run(pedigree_extract(tables, country_name), staged, run_id).drop("status")
    write_extract(stamp(rows, extracted_at, version), files, "animal_id", "reg_date")
    return files


def testday_run(
    tables: Tables, out: str, run_id: str, extracted_at: dt.datetime, version: str, country: int | None = None
) -> str:
    path = _places(out, "testday", run_id)[1]
    write_extract(testday_report(tables, extracted_at, version, country), path)
    return path


def _refreshed(df: DataFrame, path: str) -> DataFrame:
    return df.sparkSession.read.schema(df.schema).parquet(refresh(df, path))


def dataflow_run(
    tables: Tables,
    out: str,
    start,
    end,
    events: Sequence[str],
    animal_types: Sequence[str],
    farm_types: Sequence[str],
    week: tuple[int, int] | None = None,
) -> dict[str, DataFrame]:
    """Refill the five record tables of a period and make every report from them.

    ``events`` and the types name the columns of the pivots; what is not among them is added up under
    ``Other``. ``week`` (year, week) adds the quality section from the logged error rates.
    """
    names = [tables[n] for n in ("core_events_type", "auth_users", "core_country")]
    union = reports.activity_union(tables["core_animal_event"], tables["core_animal"], tables["core_farm"], start, end)
    countries, codes = tables["core_country"], tables["core_master_list"]
    activity = _refreshed(reports.activity_counts(union, *names), f"{out}/activity")
    animals = _refreshed(
        reports.animal_registrations(tables["core_animal"], countries, codes, start, end), f"{out}/animal_reg"
    )
    farms = _refreshed(reports.farm_registrations(tables["core_farm"], countries, codes, start, end), f"{out}/farm_reg")
    milk = _refreshed(dataflow.milk_rows(tables, start, end), f"{out}/milk")
    weights = _refreshed(dataflow.weight_rows(tables, start, end), f"{out}/weight")
    made = {
        "registrations": reports.registration_pivot(activity),
        "monitoring": reports.monitoring_pivot(activity, events),
        "enumerators": reports.enumerator_pivot(activity, [*reports.REGISTRATIONS, *events]),
        "event_totals": reports.event_totals(activity),
        "top": reports.top_n(activity),
        "bottom": reports.bottom_n(activity),
        "animal_types": reports.type_pivot(animals, "animal_type", animal_types),
        "farm_types": reports.type_pivot(farms, "farm_type", farm_types),
        "milk": reports.describe_by(milk, "country", "total"),
        "weight": reports.describe_by(weights, "country", "total"),
    }
    if week is not None:
        logged, checks = tables["interface_data_quality_report_data_weekly"], tables["interface_data_quality_check"]
        made["quality"] = rules.quality_report(logged, checks, countries, *week)
    return made


#: Reports of a data-flow run that have a second key besides the country.
DETAILS = {"enumerators": "enumerator", "event_totals": "event", "top": "enumerator", "bottom": "enumerator"}


def dataflow_report(made: Mapping[str, DataFrame]) -> DataFrame:
    """All reports of :func:`dataflow_run` but the quality section as one frame, a row per number."""
    keys = {name: ["country", *([DETAILS[name]] if name in DETAILS else [])] for name in made if name != "quality"}
    return reduce(DataFrame.unionByName, [reports.long_form(made[name], name, *by) for name, by in keys.items()])


def dataflow_period(tables: Tables, out: str, preset: str, today: dt.date, *names: Sequence[str], **more):
    """:func:`dataflow_run` over the last day, week or month, as its preset says."""
    return dataflow_run(tables, out, *period(preset, today), *names, **more)


RULE_SETS = ("lactation", "weight", "pedigree")


def quality_rates(tables: Tables, start, end, as_of: dt.date) -> DataFrame:
    """Error rates of all rules of all three sets per country and week, numbered as ``quality_checks``.

    Calvings and weighings count in the week of the event, animals in that of their registration, on the
    days from start to end. The history of a calving takes in all calvings before and after, so that the
    rates of a week are the same whatever the period.
    """
    limits = tables["interface_limit_parameters"]
    parts = (
        ("lactation", lactation_staged(tables, None, None), lactation_rules(limits, as_of), "calving_date"),
        ("weight", weight_staged(tables, start, end), weight_rules(limits, as_of), "weight_date"),
        ("pedigree", pedigree_staged(tables), pedigree_rules(), "reg_date"),
    )
    by, union, first = ["country_id", "report_year", "report_week"], None, 0
    for name, staged, rule_set, day in parts:
        weeks = {"report_year": F.year(day), "report_week": sunday_week(F.col(day))}
        staged = staged.filter(day_range(F.col(day), start, end))
        rated = rules.error_rates(staged.withColumns(weeks), rule_set, by)
        number = F.array_position(F.array(*[F.lit(r.name) for r in rule_set]), F.col("rule"))
        rated = rated.select(
            "country_id", (number + first).cast("int").alias("quality_check"), "total_records",
            "total_error_records", "error_rate", "report_year", "report_week", F.lit(0).alias("deleted"),
            F.lit(name).alias("rule_set"),
        )
        union, first = rated if union is None else union.unionByName(rated), first + len(rule_set)
    return union


def quality_checks(tables: Tables, as_of: dt.date) -> DataFrame:
    """(id, quality_check): number and name of every rule."""
    limits = tables["interface_limit_parameters"]
    names = [r.name for r in (*lactation_rules(limits, as_of), *weight_rules(limits, as_of), *pedigree_rules())]
    return limits.sparkSession.createDataFrame(list(enumerate(names, 1)), "id int, quality_check string")


def quality_log_run(tables: Tables, out: str, start, end, as_of: dt.date) -> str:
    """Log the error rates of the weeks that a period touches, each over all of its days.

    The log has a partition per rule set, year and week. Those of the weeks touched are replaced, also by
    nothing where a week has no records any more; all others stay as they are.
    """
    path = f"{out}/interface_data_quality_report_data_weekly"
    first, last, weeks = whole_weeks(start, end)
    keys = [(name, year, week) for name in RULE_SETS for year, week in weeks]
    replace_partitions(quality_rates(tables, first, last, as_of), path, ["rule_set", "report_year", "report_week"], keys)
    return path


def dashboard_run(tables: Tables, out: str, country: int | None = None) -> dict[str, str]:
    """Refill the four dashboard tables; returns the folder of the new rows of each.

    Each is replaced as a whole once its rows are written, so a dashboard never reads a table half full.
    """
    made = {
        "milk_yield": dashboard.yield_by_breed_region(tables, country),
        "inseminations": dashboard.inseminations_by_week(tables, country),
        "herds": dashboard.herds_by_year_type(tables, country),
        "animals": dashboard.animals_by_region(tables, country),
    }
    return {name: refresh(df, f"{out}/{name}") for name, df in made.items()}


def gps_run(tables: Tables, out: str, at_least: str = "1.7") -> str:
    """Write the farm table with missing coordinates filled in from forms of recent versions."""
    forms = filters.latest_form_version(tables["core_odk_form"], at_least)
    return refresh(updates.fill_gps(tables["core_farm"], forms).drop("gps_filled"), f"{out}/core_farm")


def gps_merge_run(farms: KeyedTable, forms: DataFrame, at_least: str = "1.7") -> int:
    """Fill missing coordinates in a farm table changed by key; returns the files written anew.

    Only farms that gain a coordinate are merged, so files without any stay as they are.
    """
    filled = updates.fill_gps(farms.read(), filters.latest_form_version(forms, at_least))
    return farms.merge(filled.filter("gps_filled"))


def inactive_merge_run(
    animals: KeyedTable, events: DataFrame, as_of: dt.date, max_age_years: int = 20, last_event_years: int = 5
) -> int:
    """Bring the mark ``inactive`` of an animal table changed by key up to date; returns the files written anew."""
    held = animals.read().withColumnRenamed("inactive", "_held")
    marked = updates.flag_inactive(held, events, as_of, max_age_years, last_event_years)
    return animals.merge(marked.filter(~F.col("inactive").eqNullSafe(F.col("_held"))))


def retention_run(
    df: DataFrame, out: str, at: str, as_of: dt.date, days: int = 20, dry_run: bool = False
) -> DataFrame | dict[str, str]:
    """Write kept and archived rows in one pass, or count them only.

    Both parts carry the day of the run. Only the partitions of this run are written: what earlier runs
    archived stays, and a retry doubles nothing. A side without rows is written as an empty one, so both can
    be read. Returns where the kept rows of this run and the archive of all runs are; the next run takes the
    kept rows. A table laid out by day is better served by :func:`retention_days_run`.
    """
    if dry_run:
        return updates.retention_counts(df, at, as_of, days)
    marked, seen = _counted(updates.retention_marked(df, at, as_of, days), archived=F.count_if("archived"))
    marked = marked.withColumn("run_day", F.lit(as_of.isoformat()))
    writer = marked.write.partitionBy("archived", "run_day").option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite").parquet(out)
    counts = seen.get
    for side, rows in (("true", counts["archived"]), ("false", counts["rows"] - counts["archived"])):
        if not rows:
            nothing = df.sparkSession.createDataFrame([], df.schema)
            nothing.write.mode("overwrite").parquet(f"{out}/archived={side}/run_day={as_of}")
    return {"kept": f"{out}/archived=false/run_day={as_of}", "archive": f"{out}/archived=true"}


def retention_days_run(
    spark: SparkSession, path: str, archive: str, at: str, schema: str | T.StructType, as_of: dt.date | dt.datetime, days: int = 20
) -> dict[str, list[str]]:
    """Move rows more than ``days`` days old from a table laid out by day to its archive, by whole days.

    No row of a day that is kept, or moved, is read; see :func:`herdloom.sources.archive_days`.
    """
    return archive_days(spark, path, archive, at, as_of - dt.timedelta(days=days), schema)


def retention_all(
    tables: Tables, out: str, at: str, as_of: dt.date, days: int = 20, dry_run: bool = False
) -> dict[str, DataFrame | dict[str, str]]:
    """Retention of several tables, each into a folder of its own."""
    return {name: retention_run(df, f"{out}/{name}", at, as_of, days, dry_run) for name, df in tables.items()}


def inactive_run(tables: Tables, out: str, as_of: dt.date, max_age_years: int = 20, last_event_years: int = 5) -> str:
    """Write the animal table with animals that are too old or long without an event marked."""
    marked = updates.flag_inactive(
        tables["core_animal"], tables["core_animal_event"], as_of, max_age_years, last_event_years
    )
    return refresh(marked, f"{out}/core_animal")
