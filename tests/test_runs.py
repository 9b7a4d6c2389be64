"""Whole runs on the smallest test tables: files and tables hold what the extracts give."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from herdloom import plans
from herdloom.catalog.base import AS_OF, END, LONG_END, LONG_START, MONITORED, START
from herdloom.catalog.bindings import Tables
from herdloom.plans import runs
from herdloom.sources import read_extract

AT = dt.datetime(2024, 1, 25, 6, 30)


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, "/root/testdata/sf0.001")


def rows_of(df):
    columns = sorted(df.columns)
    return sorted(str(tuple(r[c] for c in columns)) for r in df.collect())


@pytest.mark.parametrize("kind", ["lactation", "weight"])
def test_checked_run(spark, tables, tmp_path, kind):
    out = str(tmp_path)
    run, extract = getattr(runs, f"{kind}_run"), getattr(plans, f"{kind}_extract")
    args = (LONG_START, LONG_END, AS_OF)
    where = run(tables, out, "r1", *args)
    assert run(tables, out, "r1", *args) == where
    expected = extract(tables, *args)
    valid = read_extract(spark, where["valid"], expected.drop("comments", "status").schema)
    error = read_extract(spark, where["error"], expected.drop("status").schema)
    assert valid.count() + error.count() == expected.count() > 0
    assert rows_of(error) == rows_of(expected.filter("status = 0").drop("status"))
    assert spark.read.parquet(f"{out}/staged/{kind}").count() == expected.count()


def test_jobs_with_one_folder_and_run_id_keep_their_results(spark, tables, tmp_path):
    args = (tables, str(tmp_path), "2024-01-25T06:00", LONG_START, LONG_END, AS_OF)
    first, second = runs.lactation_run(*args), runs.weight_run(*args)
    for where, extract in ((first, plans.lactation_extract), (second, plans.weight_extract)):
        expected = extract(tables, LONG_START, LONG_END, AS_OF)
        error = read_extract(spark, where["error"], expected.drop("status").schema)
        assert rows_of(error) == rows_of(expected.filter("status = 0").drop("status"))


def test_pedigree_and_testday_runs(spark, tables, tmp_path):
    path = runs.pedigree_run(tables, str(tmp_path), "r1", AT, "V1")
    rows = spark.read.option("header", True).csv(path)
    assert rows.count() == tables["core_animal"].count()
    assert {r.Version for r in rows.select("Version").distinct().collect()} == {"V1"}
    path = runs.testday_run(tables, str(tmp_path), "r1", AT, "V1")
    assert spark.read.option("header", True).csv(path).count() == plans.testday_report(tables, AT, "V1").count()


def test_dataflow_run(tables, tmp_path):
    events = MONITORED[:2]
    out = runs.dataflow_run(tables, str(tmp_path), START, END, events, ["Cow"], ["Small"])
    totals = out["event_totals"].agg(F.sum("total")).first()[0]
    wide = out["monitoring"].agg(*[F.sum(c) for c in (*events, "Other")]).first()
    registered = out["registrations"].agg(F.sum("Animal-Reg"), F.sum("Farmer-Reg")).first()
    assert totals == sum(wide) + sum(registered) > 0
    milk = plans.milk_rows(tables, START, END)
    assert out["milk"].agg(F.sum("count")).first()[0] == milk.count()
    for name in ("enumerators", "top", "bottom", "animal_types", "farm_types", "weight"):
        assert out[name].count() > 0


def test_dashboard_and_gps_runs(spark, tables, tmp_path):
    where = runs.dashboard_run(tables, str(tmp_path))
    assert sorted(where) == ["animals", "herds", "inseminations", "milk_yield"]
    assert rows_of(spark.read.parquet(where["animals"])) == rows_of(plans.animals_by_region(tables))
    farms = spark.read.parquet(runs.gps_run(tables, str(tmp_path)))
    assert farms.count() == tables["core_farm"].count() and sorted(farms.columns) == sorted(tables["core_farm"].columns)


def test_retention_run(spark, tables, tmp_path):
    events = tables["core_animal_event"]
    kept, archived = runs.retention_run(events, "", "created_at", AS_OF, dry_run=True).first()
    out = str(tmp_path / "r")
    where = runs.retention_run(events, out, "created_at", AS_OF)
    assert (spark.read.parquet(where["kept"]).count(), spark.read.parquet(where["archive"]).count()) == (kept, archived)
    later = AS_OF + dt.timedelta(days=10)
    for _ in range(2):  # a second run, and its retry, leave the first archive
        second = runs.retention_run(spark.read.parquet(where["kept"]), out, "created_at", later)
    left, gone = (spark.read.parquet(second[part]) for part in ("kept", "archive"))
    assert left.count() + gone.count() == kept + archived and gone.count() > archived
    assert rows_of(left.unionByName(gone.drop("run_day"))) == rows_of(events)


def test_inactive_and_retention_of_several_tables(spark, tables, tmp_path):
    marked = spark.read.parquet(runs.inactive_run(tables, str(tmp_path), AS_OF, 3, 1))
    assert marked.count() == tables["core_animal"].count() and marked.filter("inactive").count() > 0
    several = {n: tables[n] for n in ("core_animal", "core_animal_event", "core_farm")}
    where = runs.retention_all(several, str(tmp_path), "created_at", AS_OF)
    for name, df in several.items():
        assert sum(spark.read.parquet(path).count() for path in where[name].values()) == df.count()


def test_quality_log_is_the_same_however_it_is_run(spark, tables, tmp_path):
    """Adjacent weeks, a run within a week and a repeat leave what one run over all leaves."""
    whole = runs.quality_log_run(tables, str(tmp_path / "a"), "2024-01-01", "2024-01-20", AS_OF)
    for start, end in (("2024-01-07", "2024-01-13"), ("2024-01-14", "2024-01-20"), ("2024-01-01", "2024-01-03"), ("2024-01-11", "2024-01-17"), ("2024-01-07", "2024-01-13")):
        parts = runs.quality_log_run(tables, str(tmp_path / "b"), start, end, AS_OF)
    logged = spark.read.parquet(whole)
    assert rows_of(spark.read.parquet(parts)) == rows_of(logged)
    weeks = {tuple(r) for r in logged.select("rule_set", "report_week").distinct().collect()}
    assert {(name, week) for name in ("lactation", "weight") for week in range(3)} | {("pedigree", 1)} <= weeks


def test_a_week_without_records_any_more_leaves_the_log(spark, tables, tmp_path):
    path = runs.quality_log_run(tables, str(tmp_path), "2024-01-07", "2024-01-20", AS_OF)
    events = tables["core_animal_event"]
    fewer = {**{n: tables[n] for n in tables}, "core_animal_event": events.filter("event_type <> 1 or event_date < '2024-01-14'")}
    runs.quality_log_run(fewer, str(tmp_path), "2024-01-14", "2024-01-20", AS_OF)
    weeks = {tuple(r) for r in spark.read.parquet(path).select("rule_set", "report_week").distinct().collect()}
    assert ("lactation", 2) not in weeks and {("lactation", 1), ("weight", 1), ("weight", 2), ("pedigree", 1)} <= weeks


def test_retention_sides_without_rows(spark, tables, tmp_path):
    events, out = tables["core_animal_event"], str(tmp_path)
    where = runs.retention_run(events, out, "created_at", AS_OF)
    assert spark.read.parquet(where["archive"]).count() > 0
    where = runs.retention_run(events.filter("created_at >= '2024-01-20'"), out, "created_at", AS_OF)  # a retry
    assert spark.read.schema(events.schema).parquet(where["archive"]).count() == 0
    later = runs.retention_run(spark.read.parquet(where["kept"]), out, "created_at", dt.date(2030, 1, 1))
    assert spark.read.parquet(later["kept"]).count() == 0 < spark.read.schema(events.schema).parquet(later["archive"]).count()


def test_a_run_notes_what_it_staged_and_wrote(spark, tables, tmp_path):
    args = (tables, str(tmp_path), "r1", LONG_START, LONG_END, AS_OF)
    runs.lactation_run(*args)
    row = runs.run_manifests(spark, str(tmp_path), "lactation").first()
    staged = spark.read.parquet(f"{tmp_path}/staged/lactation")
    assert (row.staged, row.valid, row.error) == (staged.count(), staged.filter("status = 1").count(), staged.filter("status = 0").count())
    assert (row.written_valid, row.written_error) == (row.valid, row.error)


def test_quality_log_replaces_its_own_weeks(spark, tables, tmp_path):
    args = (tables, str(tmp_path), START, END, AS_OF)
    path = runs.quality_log_run(*args)
    before = rows_of(spark.read.parquet(path))
    assert runs.quality_log_run(*args) == path and rows_of(spark.read.parquet(path)) == before
    logged = {"interface_data_quality_report_data_weekly": spark.read.parquet(path)}
    checks = runs.quality_checks(tables, AS_OF)
    names = {r.quality_check for r in checks.collect()}
    assert {"calving_duplicate", "no_gps", "own_parent"} <= names
    out = runs.dataflow_period(
        _with(tables, logged, checks),
        str(tmp_path), "prev_month", dt.date(2024, 2, 10), MONITORED, ["Cow"], ["Small"], week=(2024, 1),
    )
    assert out["quality"].count() > 0


def _with(tables, logged, checks):
    names = ("core_events_type", "auth_users", "core_country", "core_animal_event", "core_animal", "core_farm", "core_master_list")
    return {n: tables[n] for n in names} | logged | {"interface_data_quality_check": checks}
