"""Activity reports, statistics and updates on hand-made frames."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from herdloom.operators import filters, lookups, reports, updates

ACTIVITY = "country string, enumerator string, event string, total bigint"


@pytest.fixture(scope="module")
def activity(spark):
    rows = [
        ("A", "ann lee", "Milking", 4), ("A", "Ann LEE", "Milking", 8), ("A", "ann lee", "Animal-Reg", 1),
        ("A", "bo", "Milking", 12), ("A", "cy", "Milking", 12), ("A", "di", "Weight", 3), ("A", "ed", "Weight", 2),
        ("A", "fi", "Weight", 2), ("A", "gu", "Weight", 2), ("B", "ann lee", "Farmer-Reg", 7),
    ]
    return spark.createDataFrame(rows, ACTIVITY)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_activity_union(table):
    def event(id, kind, attrs=None, **values):
        base = {"id": id, "country_id": 1, "event_type": kind, "created_at": "2024-01-08T23:59:59", "created_by": 5}
        return base | {"additional_attributes": attrs} | values

    full = '{"59":"1","61":"0","68":"0"}'
    events = table(
        "core_animal_event",
        event(1, 1), event(1, 1), event(2, 18), event(3, 6, field_agent_id=9), event(4, 2, full),
        event(5, 2, '{"59":"1","61":"0"}'), event(6, 2, '{"59":"","61":null,"68":"x"}'), event(7, None),
        event(8, 1, created_at="2024-01-09T00:00:00"), event(9, 1, created_at="2024-01-08T00:00:00", country_id=None),
        event(10, 100),
    )
    animals = table(
        "core_animal",
        {"id": 10, "country_id": 1, "created_by": 5, "created_at": "2024-01-08T12:00:00"},  # same row as event 10
        {"id": 11, "country_id": 1, "created_at": "2024-01-08T12:00:00"},
        {"id": 12, "created_by": 5, "created_at": "2024-01-08T12:00:00"},
    )
    farms = table("core_farm", {"id": 20, "country_id": 1, "created_by": 5, "field_agent_id": 6, "created_at": "2024-01-08T12:00:00"})
    out = reports.activity_union(events, animals, farms, "2024-01-08", "2024-01-08")
    rows = {tuple(r) for r in out.collect()}
    assert out.count() == len(rows)
    assert rows == {
        (1, 1, 5, 1), (3, 1, 9, 6), (4, 1, 5, 2), (9, None, 5, 1), (10, 1, 5, 100), (20, 1, 6, 101),
    }
    names = table("core_events_type", {"event_id": 1, "description": "Calving"}, {"event_id": 6, "description": "Weight"})
    users = table("auth_users", {"id": 5, "name": "ann"}, {"id": 9, "name": "ann"})
    countries = table("core_country", {"id": 1, "name": "A"})
    counts = reports.activity_counts(out, names, users, countries)
    # Two users of one name stay apart.
    assert rows_of(counts) == [("A", "ann", "Calving", 1), ("A", "ann", "Weight", 1)]


def test_pivots(activity):
    assert rows_of(reports.registration_pivot(activity)) == [("A", 1, 0), ("B", 0, 7)]
    assert rows_of(reports.monitoring_pivot(activity, ["Milking", "Weight"])) == [("A", 36, 9, 0)]
    # Events that are not named are not lost.
    assert rows_of(reports.monitoring_pivot(activity, ["Weight"])) == [("A", 9, 36)]
    people = reports.enumerator_pivot(activity, ["Milking", "Animal-Reg"]).filter("country = 'A'")
    # Two spellings of one name are averaged, not added.
    assert rows_of(people)[0] == ("A", "Ann lee", 6.0, 1.0, 0.0)


def test_pivots_start_no_job(spark, activity):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("pivots", "")
    reports.monitoring_pivot(activity, ["Milking"])
    reports.enumerator_pivot(activity, ["Milking"])
    assert tracker.getJobIdsForGroup("pivots") == []


def test_event_totals(activity):
    assert rows_of(reports.event_totals(activity))[0] == ("Animal-Reg", "A", 1)


def test_rankings(activity):
    top = reports.top_n(activity).filter("country = 'A'")
    assert rows_of(top) == [
        ("A", "Ann lee", 13, 1), ("A", "Bo", 12, 2), ("A", "Cy", 12, 2), ("A", "Di", 3, 3), ("A", "Ed", 2, 4),
    ]
    bottom = reports.bottom_n(activity).filter("country = 'A'")
    assert rows_of(bottom) == [
        ("A", "Bo", 12, 1), ("A", "Di", 3, 2), ("A", "Ed", 2, 3), ("A", "Fi", 2, 3), ("A", "Gu", 2, 3),
    ]


def test_statistics(spark):
    rng = random.Random(3)
    groups = {
        "hot": [round(rng.gauss(50, 200), 1) for _ in range(3000)],
        "odd": [float(rng.randrange(5)) for _ in range(31)],
        "even": [-3.5, 1.0, 2.0, 90.0],
        "one": [7.25],
        "same": [2.1] * 8,
        "far": [1e9 + x / 4 for x in range(40)],
        "within one unit": [50 + rng.random() for _ in range(20_001)],
        "nine decades": [10 ** rng.uniform(-4, 5) * rng.choice((-1, 1)) for _ in range(20_000)],
    }
    rows = [(k, v) for k, values in groups.items() for v in values] + [("odd", None), ("empty", None), (None, 1.0)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double")
    out = {r.k: r for r in reports.describe_by(df, "k", "v").collect()}
    assert sorted(out) == sorted([*groups, "empty"])
    assert {k: out[k].median for k in groups} == {k: pytest.approx(statistics.median(v)) for k, v in groups.items()}
    assert (out["empty"]["count"], out["empty"]["median"], out["empty"]["avg"]) == (0, None, None)
    for k, values in groups.items():
        r = out[k]
        assert (r["count"], r["max"], r["min"]) == (len(values), max(values), min(values))
        assert r["avg"] == pytest.approx(statistics.mean(values))
        assert r["std"] == (pytest.approx(statistics.stdev(values)) if len(values) > 1 else None)


def test_flags_and_lookups_never_repeat_rows(spark, table, codes):
    df = spark.createDataFrame([(1, 1), (2, 1), (3, None)], "id bigint, sex int")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "id bigint")
    assert rows_of(lookups.flag_if_exists(df, keys, "hit").select("id", "hit")) == [(1, True), (2, False), (3, False)]
    assert lookups.with_code(df, codes, "sex", lookups.SEXES, "label").count() == 3


def test_hot_parent(spark, table):
    """A third of all animals has one sire; parents and roles stay exact."""
    rows = [{"id": i, "sire_id": 1 if i % 3 == 0 else i % 50 + 1, "dam_id": i % 7 or None, "tag_id": f"T{i}"} for i in range(1, 601)]
    animals = table("core_animal", *rows)
    out = lookups.with_parents(animals)
    assert out.count() == 600 and out.filter(F.col("sire_tag_id") == "T1").count() >= 200
    by_id = {r["id"]: r for r in rows}
    assert {r.id: r.grand_sire_id for r in out.collect()} == {i: by_id[r["sire_id"]]["sire_id"] for i, r in by_id.items()}
    both = {r["sire_id"] for r in rows} & {r["dam_id"] for r in rows if r["dam_id"]}
    assert {r.animal_id for r in lookups.used_in_both_roles(animals).collect()} == both


def test_created_between_covers_whole_days(table):
    stamps = ["2024-01-07T23:59:59.999999", "2024-01-08T00:00:00", "2024-01-09T23:59:59.999999", "2024-01-10T00:00:00", None]
    df = table("core_animal", *[{"id": i, "created_at": s, "created_by": i} for i, s in enumerate(stamps)])
    assert [r.id for r in filters.created_between(df, "2024-01-08", "2024-01-09").collect()] == [1, 2]


def test_fill_gps(table):
    def form(uuid, version, spot):
        return {"form_uuid": uuid, "form_version": version, "form_data": f'{{"farmer_general":[{{"farmer_gpslocation":"{spot}"}}]}}'}

    forms = table(
        "core_odk_form",
        form("a", "v 1.8", "1.5 30.5"), form("a", "v 1.7", "2.5 31.5 9"), form("a", "v 1.10", "3 3"),
        form("b", "v 1.7", "x 31"), form("c", "v 1.7", "4 4"), form("d", "v 1.7", "5"),
        {"form_uuid": "e", "form_version": "v 1.9", "form_data": "broken"}, {"form_uuid": "e", "form_version": "v 1.9"},
        form("e", "v 1.9", "6 7"),
    )
    farms = table(
        "core_farm",
        *[{"id": i, "odk_form_uuid": u, "latitude": lat} for i, (u, lat) in enumerate(
            [("a", None), ("b", None), ("c", 8.0), ("d", None), ("e", None), (None, None), ("zz", None)])],
    )
    out = updates.fill_gps(farms, filters.latest_form_version(forms))
    assert rows_of(out.select("id", "latitude", "longitude", "gps_filled"), ) == [
        (0, 2.5, 31.5, True), (1, None, None, False), (2, 8.0, None, False), (3, None, None, False),
        (4, 6.0, 7.0, True), (5, None, None, False), (6, None, None, False),
    ]


def test_flag_inactive(table):
    animals = table(
        "core_animal",
        {"id": 1, "birthdate": "2004-01-24", "reg_date": "2023-01-01"},
        {"id": 2, "birthdate": "2004-01-25", "reg_date": "2010-01-01"},
        {"id": 3, "reg_date": "2010-01-01"},
        {"id": 4},
    )
    events = table("core_animal_event", {"animal_id": 2, "event_date": "2019-01-25"}, {"animal_id": 2, "event_date": "2001-01-01"})
    out = updates.flag_inactive(animals, events, dt.date(2024, 1, 25))
    assert rows_of(out.select("id", "inactive")) == [(1, True), (2, False), (3, True), (4, False)]


def test_retention(table):
    df = table("core_animal", *[{"id": i, "created_at": s} for i, s in enumerate(["2024-01-04T23:00:00", "2024-01-05T00:00:00", None])])
    keep, archive = updates.retention_split(df, "created_at", dt.date(2024, 1, 25))
    assert [r.id for r in keep.collect()] == [1, 2] and [r.id for r in archive.collect()] == [0]
    assert tuple(updates.retention_counts(df, "created_at", dt.date(2024, 1, 25)).first()) == (2, 1)
