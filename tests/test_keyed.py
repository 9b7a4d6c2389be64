"""Tables changed by key and the incremental extract made with them."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from herdloom import plans
from herdloom.catalog.base import AS_OF, STAMPED_AT, VERSION
from herdloom.catalog.bindings import Tables
from herdloom.plans.increments import LactationIncrements, TestdayIncrements, WeightIncrements
from herdloom.sources import Folder, keyed, write_daily
from herdloom.sources.keyed import KeyedTable


def rows_of(df):
    columns = sorted(df.columns)
    return sorted(str(tuple(r[c] for c in columns)) for r in df.collect())


def files_of(path):
    found = Path(path).rglob("*.parquet")
    return {(p.parent.name, p.name): (p.stat().st_ino, p.stat().st_mtime_ns) for p in found if "_pending" not in str(p)}


@pytest.fixture
def table(spark, tmp_path):
    df = spark.createDataFrame([(i // 2, f"v{i}") for i in range(200)] + [(None, "none")], "id bigint, name string")
    out = KeyedTable(spark, str(tmp_path / "table"), "id", df.schema, 8)
    out.write(df)
    return out, df


def test_only_files_with_a_changed_key_are_written_again(spark, table):
    out, df = table
    before = files_of(out.path)
    changes = spark.createDataFrame([(7, "new"), (500, "more"), (None, "still none")], "id bigint, name string")
    assert out.merge(changes) == 2  # the file of 7 and that of the NULL key
    after = files_of(out.path)
    assert len(set(before) - set(after)) == 2 and all(after[f] == before[f] for f in set(after) & set(before))
    expected = df.filter("id <> 7").union(changes)
    assert rows_of(out.read()) == rows_of(expected)


def test_keys_without_a_change_lose_their_rows(spark, table):
    out, df = table
    keys = spark.createDataFrame([(3,), (4,), (900,)], "id bigint")
    out.merge(spark.createDataFrame([(4, "one"), (4, "two")], "id bigint, name string"), keys)
    kept = df.filter("id is null or id not in (3, 4)").union(spark.createDataFrame([(4, "one"), (4, "two")], df.schema))
    assert rows_of(out.read()) == rows_of(kept)
    assert rows_of(out.read_keys(keys)) == rows_of(kept.filter("id in (3, 4)"))


def test_a_merge_may_read_the_table_and_need_not_find_one(spark, tmp_path):
    df = spark.createDataFrame([(1, 1)], "id bigint, n int")
    out = KeyedTable(spark, str(tmp_path / "none"), "id", df.schema, 4)
    assert out.read().count() == 0 and out.merge(df.limit(0)) == 0 and out.merge(df) == 0
    for _ in range(3):
        out.merge(out.read().withColumn("n", F.col("n") + 1))
    assert [tuple(r) for r in out.read().collect()] == [(1, 4)]


@pytest.mark.parametrize("calls", range(10))
def test_a_stopped_merge_is_finished_or_undone(spark, table, monkeypatch, calls):
    out, df = table
    left = [calls]

    def counted(change):
        def run(self, *args):
            if left[0] == 0:
                raise KeyboardInterrupt
            left[0] -= 1
            return change(self, *args)

        return run

    changes = spark.createDataFrame([(i, "new") for i in range(0, 40, 13)], df.schema)
    with monkeypatch.context() as patched:
        for name in ("mark", "move", "delete"):
            patched.setattr(keyed.Folder, name, counted(getattr(Folder, name)))
        try:
            out.merge(changes)
        except KeyboardInterrupt:
            pass
    out.recover()
    done = rows_of(df.join(changes.select("id"), "id", "left_anti").select("id", "name").union(changes))
    assert rows_of(out.read()) in (done, rows_of(df)) and Folder(spark, f"{out.path}/_pending").names() == []
    out.merge(changes)
    assert rows_of(out.read()) == done


@pytest.fixture(scope="module")
def herd(spark, tmp_path_factory):
    tables = Tables(spark, "/root/testdata/sf0.001")
    events = tables["core_animal_event"].withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
    path = str(tmp_path_factory.mktemp("herd") / "events")
    write_daily(events, path, "created_at")
    return tables, events, path


def full(kind, tables, as_of):
    if kind is TestdayIncrements:
        return plans.testday_report(tables, STAMPED_AT, VERSION)
    return {LactationIncrements: plans.lactation_extract, WeightIncrements: plans.weight_extract}[kind](tables, None, None, as_of)


def read(extract, schema):
    return extract.report(schema, STAMPED_AT, VERSION) if isinstance(extract, TestdayIncrements) else extract.read(schema)


KINDS = pytest.mark.parametrize("kind", [LactationIncrements, WeightIncrements, TestdayIncrements])


@KINDS
def test_full_run_equals_run_and_increments(spark, herd, tmp_path, kind):
    """Also where an increment ends within a day, and where events lie in the future for some runs."""
    tables, events, path = herd
    schema = full(kind, tables, AS_OF).schema
    extract = kind(spark, path, str(tmp_path / "a"), events.schema, 8)
    done = []
    for until, as_of in ((dt.datetime(2024, 1, 8, 12), dt.date(2024, 1, 5)), (dt.datetime(2024, 1, 15), dt.date(2024, 1, 10)), (dt.datetime(2024, 2, 1), AS_OF)):
        done.append(extract.run(tables, until, as_of))
        seen = events.filter(F.col("created_at") < F.lit(str(until)).cast("timestamp_ntz"))
        assert rows_of(read(extract, schema)) == rows_of(full(kind, {**tables, "core_animal_event": seen}, as_of))
    assert [d.since for d in done] == [None, *[d.until for d in done[:-1]]] and all(d.animals for d in done)
    again = extract.run(tables, done[-1].until, AS_OF)
    assert (again.animals, again.files) == (0, 0)


@KINDS
def test_an_increment_reads_new_days_only_and_leaves_other_files(spark, herd, tmp_path, kind):
    tables, events, path = herd
    extract = kind(spark, path, str(tmp_path / "b"), events.schema, 64)
    extract.run(tables, dt.datetime(2024, 1, 20), AS_OF)
    plan = extract.new_events(dt.datetime(2024, 1, 20), dt.datetime(2024, 1, 21))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stored_day" in plan and "stored_day" in plan.split("PartitionFilters")[1].split("]")[0]
    before = files_of(f"{tmp_path}/b/extract")
    done = extract.run(tables, dt.datetime(2024, 1, 20, 1), AS_OF)
    after = files_of(f"{tmp_path}/b/extract")
    assert len(set(before) - set(after)) == done.files


def test_a_late_event_redoes_the_rows_before_it(spark, tmp_path):
    """A second weighing marks the first as a duplicate, an earlier calving moves the test days of its animal alone."""
    tables = Tables(spark, "/root/testdata/sf0.001")
    schema = "id bigint, animal_id bigint, country_id bigint, event_type int, event_date date, created_at timestamp_ntz, additional_attributes string"
    one, two = [r["id"] for r in tables["core_animal"].join(tables["core_farm"].select("id", "country_id"), F.col("farm_id") == tables["core_farm"]["id"]).select(tables["core_animal"]["id"]).orderBy("id").limit(2).collect()]
    country = tables["core_animal"].filter(F.col("id") == one).first()["country_id"]
    day, late = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    rows = [
        (1, one, country, 6, dt.date(2023, 5, 1), day, '{"136": "300"}'),
        (2, one, country, 2, dt.date(2023, 6, 1), day, '{"59": "4"}'),
        (3, two, country, 6, dt.date(2023, 5, 1), day, '{"136": "310"}'),
        (4, one, country, 6, dt.date(2023, 5, 1), late, None),
        (5, one, country, 1, dt.date(2023, 1, 1), late, None),
    ]
    events = spark.createDataFrame(rows, schema)
    write_daily(events, str(tmp_path / "events"), "created_at")
    for kind in (WeightIncrements, TestdayIncrements):
        out = full(kind, tables, AS_OF).schema
        extract = kind(spark, str(tmp_path / "events"), str(tmp_path / kind.__name__), events.schema, 4)
        for until, touched in ((late, 2), (dt.datetime(2024, 1, 3), 1)):
            assert extract.run(tables, until, AS_OF).animals == touched
            seen = events.filter(F.col("created_at") < F.lit(str(until)).cast("timestamp_ntz"))
            assert rows_of(read(extract, out)) == rows_of(full(kind, {**tables, "core_animal_event": seen}, AS_OF))
