"""Bucketed events: plans without shuffles of events, hot animals apart."""

import pytest
from pyspark.sql import functions as F

from herdloom.catalog import histories
from herdloom.catalog.bindings import Tables
from herdloom.sources.buckets import BUCKET_SETTINGS, store_bucketed

BUILDS = [histories.calving_history, histories.asof_calving, histories.testday_number]


def rows_of(df):
    columns = sorted(df.columns)
    return sorted(str(tuple(r[c] for c in columns)) for r in df.collect())


@pytest.fixture
def settings(spark):
    wanted = BUCKET_SETTINGS | {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    held = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    yield
    for key, value in held.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("build", BUILDS)
def test_no_event_is_shuffled(spark, settings, tmp_path, build):
    events = Tables(spark, "/root/testdata/sf0.001")["core_animal_event"]
    stored = store_bucketed(events, f"events_{build.__name__}", str(tmp_path), "animal_id", 4, ["event_date", "id"])
    df = build({"core_animal_event": stored.rows})
    assert rows_of(df) == rows_of(build({"core_animal_event": events}))
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # The time line of days is a union, which Spark shuffles; events are not below any exchange but that.
    timeline = build is not histories.calving_history
    assert plan.count("Exchange hashpartitioning") == timeline and "Bucketed: true" in plan
    assert not timeline or "Union" in plan.split("Exchange hashpartitioning")[1].splitlines()[1]
    spark.sql(f"drop table events_{build.__name__}")


@pytest.mark.parametrize("build", BUILDS)
def test_hot_animals_stand_apart(spark, tmp_path, build):
    events = Tables(spark, "/root/testdata/sf0.001")["core_animal_event"]
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("animal_id"))
    events = events.withColumn("animal_id", hot.cast("bigint"))
    stored = store_bucketed(events, f"hot_{build.__name__}", str(tmp_path), "animal_id", 4, ["event_date", "id"])
    assert {r[0] for r in stored.hot.select("animal_id").distinct().collect()} == {7, None}
    assert stored.rows.filter("animal_id is null or animal_id = 7").count() == 0
    assert stored.rows.count() + stored.hot.count() == events.count()
    assert rows_of(stored.apply(lambda rows: build({"core_animal_event": rows}))) == rows_of(build({"core_animal_event": events}))
    spark.sql(f"drop table hot_{build.__name__}")
