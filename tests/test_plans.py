"""Physical plans over Parquet tables of the herd schema: what reaches the scan, what is shuffled."""

import datetime as dt
import re

import pytest

from herdloom import plans
from herdloom.operators import filters, history, lookups, reports, rules, updates
from herdloom.sources import TABLES, read_table


@pytest.fixture(scope="module")
def tables(spark, table, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("herd"))
    for name in TABLES:
        table(name).write.parquet(f"{root}/{name}")
    return {name: read_table(spark, root, name) for name in TABLES}


@pytest.fixture(scope="module", autouse=True)
def whole_metadata(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, column):
    return [line for line in plan(df).splitlines() if "FileScan" in line and column in line]


def test_event_filters_reach_the_scan(tables):
    df = filters.events_of(tables["core_animal_event"], 6, 1, "2024-01-01", "2024-01-31").select("id")
    (scan,) = scans(df, "event_date")
    pushed = re.search(r"PushedFilters: \[(.*?)\]", scan).group(1)
    for part in ("EqualTo(event_type,6)", "EqualTo(country_id,1)", "GreaterThanOrEqual(event_date,2024-01-01)", "LessThan(event_date,2024-02-01)"):
        assert part in pushed
    assert "additional_attributes" not in scan


def test_created_range_reaches_the_scan_of_a_timestamp(tables):
    for df in (
        filters.created_between(tables["core_animal"], "2024-01-01", "2024-01-31").select("id"),
        filters.period_filter(tables["core_animal"], "prev_month", "2024-02-10").select("id"),
    ):
        (scan,) = scans(df, "created_at")
        assert "GreaterThanOrEqual(created_at,2024-01-01T00:00" in scan and "LessThan(created_at,2024-02-01T00:00" in scan


def test_lactation_reads_only_the_columns_it_needs(tables):
    df = plans.lactation_extract(tables, "2020-01-01", "2024-12-31", dt.date(2024, 1, 1))
    for scan in scans(df, "event_type"):
        schema = re.search(r"ReadSchema: struct<(.*?)>", scan).group(1)
        assert {c.split(":")[0] for c in schema.split(",")} == {"id", "animal_id", "event_type", "event_date"}


@pytest.mark.parametrize(
    "build",
    [
        lambda t: plans.lactation_extract(t, "2020-01-01", "2024-12-31", dt.date(2024, 1, 1)),
        lambda t: plans.weight_extract(t, "2020-01-01", "2024-12-31", dt.date(2024, 1, 1)),
        lambda t: plans.pedigree_extract(t, "kenya"),
        lambda t: plans.testday_report(t, dt.datetime(2024, 1, 1), "V"),
        lambda t: reports.describe_by(plans.milk_rows(t, "2024-01-01", "2024-01-31"), "country", "total"),
    ],
)
def test_jobs_stay_in_the_engine_without_cross_joins(tables, build):
    text = plan(build(tables))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert word not in text


def test_windows_follow_a_grouping(tables):
    """Windows run over day tables, after a grouping that combines rows before the shuffle."""
    text = plan(history.calving_history(filters.events_of(tables["core_animal_event"], 1)))
    below = text[text.index("Window") :]
    assert below.index("HashAggregate") < below.index("FileScan")
    assert "partial_count" in below


def test_large_sides_are_joined_by_shuffle(spark, tables):
    """Nothing is broadcast by hint: above the threshold the same lookup is a sort-merge join."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(lookups.with_places(tables["core_farm"], tables["country_units"], ["region"]))
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_duplicates_are_counted_before_the_shuffle(tables):
    text = plan(rules.duplicate_keys(tables["core_animal"], "tag_id"))
    assert text.index("Exchange hashpartitioning") < text.index("partial_count")


def test_top_n_is_cut_before_the_shuffle(tables, spark):
    activity = spark.range(10).selectExpr("string(id % 3) country", "string(id) enumerator", "'Milking' event", "id total")
    assert "WindowGroupLimit" in plan(reports.top_n(activity))


@pytest.fixture
def split_skew(spark):
    """Thresholds at which a small hot partition counts as one that must be split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_sire_is_split(spark, split_skew):
    hot = spark.range(0, 60000, numPartitions=16).selectExpr(
        "id", "if(id % 3 = 0, 1, id * 7919 % 60000) sire_id", "id * 31 % 60000 dam_id", "concat('T', id) tag_id",
        "concat('S', id) sire_tag_id", "concat('D', id) dam_tag_id", "date '2020-01-01' birthdate",
    )
    out = lookups.with_parents(hot)
    assert len(out.collect()) == 60000
    assert "skew=true" in plan(out)


def test_hot_calving_day_is_split(spark, split_skew):
    hot = spark.range(0, 90000, numPartitions=16).selectExpr(
        "id", "if(id % 3 = 0, 1, id % 20000) animal_id", "date_add(date '2020-01-01', if(id % 3 = 0, 0, cast(id % 7 as int))) event_date"
    )
    out = history.calving_history(hot)
    assert len(out.collect()) == 90000
    assert "skew=true" in plan(out)


def test_hot_duplicate_is_split(spark, split_skew):
    hot = spark.range(0, 90000, numPartitions=16).selectExpr("id", "if(id % 3 = 0, 'T', concat('T', id % 40000)) tag_id", "id * 7 payload")
    copies = rules.duplicate_keys(hot, "tag_id").drop("copies")
    out = lookups.flag_if_exists(hot, copies, "is_duplicate")
    rows = out.collect()
    assert len(rows) == 90000 and sum(r.is_duplicate for r in rows if r.tag_id == "T") == 30000
    assert "skew=true" in plan(out)


def test_hot_animal_is_split_before_a_grouping(spark, split_skew):
    """A join by animal under a grouping by animal, as in the test views."""
    events = spark.range(0, 90000, numPartitions=16).selectExpr(
        "id", "if(id % 3 = 0, 1, id % 20000) animal_id", "date_add(date '2020-01-01', cast(id % 50 as int)) event_date"
    )
    animals = spark.range(0, 20000, numPartitions=4).selectExpr("id animal_id", "id % 5 country_id")
    out = history.day_table(events.join(animals, "animal_id"), "animal_id", "event_date", "id")
    assert sum(r.n for r in out.collect()) == 90000
    assert "skew=true" in plan(out)


def test_weighings_are_parsed_once(tables):
    df = plans.weight_extract(tables, "2020-01-01", "2024-12-31", dt.date(2024, 1, 1))
    reads = [scan for scan in scans(df, "event_type") if "additional_attributes" in scan]
    assert len(reads) == 1


def test_retention_reaches_the_scan(tables):
    kept, archived = updates.retention_split(tables["core_animal"].select("id", "created_at"), "created_at", dt.date(2024, 1, 25))
    for df, part in ((kept, "GreaterThanOrEqual(created_at,2024-01-05"), (archived, "LessThan(created_at,2024-01-05")):
        (scan,) = scans(df, "created_at")
        assert part in re.search(r"PushedFilters: \[(.*?)\],? ReadSchema", scan).group(1)


@pytest.mark.parametrize(
    "build",
    [
        lambda t: plans.lactation_extract(t, "2020-01-01", "2024-12-31", dt.date(2024, 1, 1), 1),
        lambda t: plans.weight_extract(t, "2020-01-01", "2024-12-31", dt.date(2024, 1, 1), 1),
        lambda t: plans.testday_report(t, dt.datetime(2024, 1, 1), "V", 1),
        lambda t: plans.pedigree_extract(t, "kenya"),
    ],
)
def test_country_runs_drop_other_events_before_they_are_grouped(tables, build):
    nodes = list(walk(build(tables)._jdf.queryExecution().executedPlan().inputPlan()))
    pruned = [
        below
        for depth, node in nodes
        if node.nodeName() == "HashAggregate" and "animal_id" in node.simpleString(500)
        for below in [[n.simpleString(2000) for _, n in walk(node)]]
        if any("LeftSemi" in text for text in below) and any("event_type" in text for text in below)
    ]
    assert pruned


def test_events_are_scanned_once_for_the_activity_union(tables):
    events, animals, farms = (tables[n] for n in ("core_animal_event", "core_animal", "core_farm"))
    assert len(scans(reports.activity_union(events, animals, farms, "2024-01-01", "2024-01-31"), "event_type")) == 1


def test_no_text_of_an_event_passes_a_window_of_the_testday_report(tables):
    df = plans.testday_report(tables, dt.datetime(2024, 1, 1), "V")
    for _, node in walk(df._jdf.queryExecution().executedPlan().inputPlan()):
        if "Window" in node.nodeName() or node.nodeName() == "Exchange" and "(animal_id#" in node.simpleString(500):
            by_day = "milkdate" in node.simpleString(500)
            assert by_day and "Window" not in node.nodeName() or "MilkAM" not in node.output().mkString(" ")


def test_texts_of_a_day_are_shuffled_once_and_parsed_after_other_days_are_dropped(tables):
    df = plans.testday_report(tables, dt.datetime(2024, 1, 1), "V")
    nodes = [node for _, node in walk(df._jdf.queryExecution().executedPlan().inputPlan())]
    groupings = [node for node in nodes if node.nodeName() == "SortAggregate" and "min_by(MilkAM" in node.toString().split("\n")[0]]
    assert groupings
    below = []
    node = groupings[0]
    while "Join" not in node.nodeName():
        below.append(node.nodeName())
        node = node.children().apply(0)
    assert "Exchange" not in below and "Generate" in below
    assert not any("from_json" in inner.toString().split("\n")[0] for _, inner in walk(node))


def walk(node, depth=0):
    yield depth, node
    children = node.children()
    for i in range(children.size()):
        yield from walk(children.apply(i), depth + 1)
