"""Histories on hand-made events, and against brute force where one animal holds most of them."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from herdloom.operators import history

CALVINGS = "id bigint, animal_id bigint, event_date date"
MILK = "event_id bigint, animal_id bigint, milkdate date"


def day(text):
    return None if text is None else dt.date.fromisoformat(text)


@pytest.fixture(scope="module")
def calvings(table):
    rows = [
        (1, 1, "2020-01-01"), (2, 1, "2020-01-01"),  # two on one day
        (3, 1, "2020-08-07"),  # 219 days later
        (4, 1, "2021-03-15"),  # 220 days after that one
        (5, 2, None), (6, 2, "2021-01-01"), (7, 2, None),
        (8, 3, "2022-05-05"),
    ]
    return table(CALVINGS, *[{"id": i, "animal_id": a, "event_date": d} for i, a, d in rows])


def test_calving_history(calvings):
    rows = {r.id: r for r in history.calving_history(calvings).collect()}
    assert len(rows) == 8
    assert [rows[i].parity for i in range(1, 9)] == [1, 1, 3, 4, 1, 3, 1, 1]
    assert rows[1].previous_calving_date is None and rows[1].calving_interval is None
    assert rows[2].previous_calving_date == day("2020-01-01") and rows[2].calving_interval == 0
    assert rows[1].subsequent_calving_date == day("2020-01-01")
    assert rows[2].subsequent_calving_date == day("2020-08-07")
    assert rows[3].calving_interval == 219 and rows[4].calving_interval == 220
    assert rows[4].subsequent_calving_date is None
    assert rows[6].previous_calving_date is None and rows[6].calving_interval is None


def test_reranked_parity(calvings):
    rows = {r.id: r.parity for r in history.reranked_parity(calvings).collect()}
    # 2 (same day) and 3 (219 days) start no lactation; undated calvings stay and share the first place.
    assert rows == {1: 1, 4: 2, 5: 1, 7: 1, 6: 3, 8: 1}


def test_asof_calving(table, calvings):
    milk = [
        (10, 1, "2019-12-31"), (11, 1, "2020-01-01"), (12, 1, "2020-12-01"), (13, 1, "2021-03-16"),
        (14, 2, "2020-06-01"), (15, 2, "2021-06-01"), (16, 9, "2021-06-01"), (17, 1, "2020-12-01"), (18, 1, None),
    ]
    frame = table(MILK, *[{"event_id": i, "animal_id": a, "milkdate": d} for i, a, d in milk])
    lactations = history.parity_days(calvings).withColumnRenamed("event_date", "calvdate")
    linked = history.asof_calving(frame, lactations)
    rows = {r.event_id: (r.closest_calvdate, r.parity) for r in linked.collect()}
    assert rows == {
        10: (None, None),
        11: (day("2020-01-01"), 1),
        12: (day("2020-01-01"), 1),
        13: (day("2021-03-15"), 2),
        14: (None, 1),  # only the undated calving lies before
        15: (day("2021-01-01"), 3),
        16: (None, None),
        17: (day("2020-01-01"), 1),
        18: (None, None),
    }
    numbers = {r.event_id: r.testdaynumber for r in history.testday_number(frame, lactations).collect()}
    assert numbers == {10: None, 11: 1, 12: 2, 17: 3, 13: 1, 14: 1, 15: 1, 16: None, 18: None}


def test_first_per_group_takes_first_known_value_per_column(spark):
    rows = [(1, 3, "c", None), (1, 1, None, "x"), (1, 2, "b", "y"), (2, 5, None, None)]
    df = spark.createDataFrame(rows, "k int, o int, p string, q string")
    out = {r.k: (r.p, r.q) for r in history.first_per_group(df, ["k"], "o", ["p", "q"]).collect()}
    assert out == {1: ("b", "x"), 2: (None, None)}


def test_link_by_day_never_repeats_a_milk_record(spark):
    milk = spark.createDataFrame([(1, 7, "a"), (2, 7, "a"), (3, 8, "a")], "event_id int, animal_id int, milkdate string")
    weights = spark.createDataFrame(
        [(1, 7, "a", None, "90"), (2, 7, "a", "300", "91"), (3, 7, None, "1", "1")],
        "id int, animal_id int, day string, weight string, girth string",
    )
    out = history.link_by_day(milk, weights, "animal_id", "milkdate", "day", "id").collect()
    assert sorted((r.event_id, r.weight, r.girth) for r in out) == [(1, "300", "90"), (2, "300", "90"), (3, None, None)]


def test_attach_events_reads_ids_as_numbers(spark):
    linked = spark.createDataFrame([(1,), (2,)], "event_id bigint")
    details = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c")], "event_id string, tag string")
    assert [(r.event_id, r.tag) for r in history.attach_events(linked, details).collect()] == [(1, "a")]


def brute_history(rows):
    """By plain definition: rows of one animal sorted by (day, id)."""
    by_animal = defaultdict(list)
    for i, a, d in rows:
        by_animal[a].append((d, i))
    out = {}
    for events in by_animal.values():
        events.sort()
        days = [d for d, _ in events]
        for k, (d, i) in enumerate(events):
            before = events[k - 1][0] if k else None
            after = events[k + 1][0] if k + 1 < len(events) else None
            out[i] = (before, after, None if before is None else (d - before).days, days.index(d) + 1)
    return out


def brute_parity(rows, gap):
    kept = [(i, d, a) for (i, a, d), (_, _, interval, _) in ((r, brute_history(rows)[r[0]]) for r in rows)
            if interval is None or interval >= gap]
    return {i: 1 + sum(1 for _, e, b in kept if b == a and e < d) for i, d, a in kept}


@pytest.fixture(scope="module")
def skewed():
    """Events of which one animal has a third, many of them on one day."""
    rng = random.Random(5)
    first = dt.date(2023, 1, 1)
    rows = []
    for i in range(1, 901):
        if i % 3 == 0:
            d = 7 if rng.random() < 0.5 else rng.randrange(60)
            rows.append((i, 1, first + dt.timedelta(d)))
        else:
            rows.append((i, rng.randrange(2, 40), first + dt.timedelta(rng.randrange(60))))
    rng.shuffle(rows)
    return rows


def test_history_of_a_hot_animal(spark, skewed):
    df = spark.createDataFrame(skewed, CALVINGS).repartition(5)
    out = {
        r.id: (r.previous_calving_date, r.subsequent_calving_date, r.calving_interval, r.parity)
        for r in history.calving_history(df).collect()
    }
    assert out == brute_history(skewed)


@pytest.mark.parametrize("gap", [5, 0])
def test_parity_of_a_hot_animal(spark, skewed, gap):
    df = spark.createDataFrame(skewed, CALVINGS)
    out = {r.id: r.parity for r in history.reranked_parity(df, gap).collect()}
    assert out == brute_parity(skewed, gap)


def test_asof_and_numbers_of_a_hot_animal(spark, skewed, monkeypatch):
    monkeypatch.setattr(history, "ID_BLOCK", 64)  # many blocks per day
    calvings = [r for r in skewed if r[0] % 4 == 0]
    milk = [r for r in skewed if r[0] % 4]
    parity = brute_parity(calvings, 3)
    starts = defaultdict(set)
    for i, a, d in calvings:
        if i in parity:
            starts[a].add((d, parity[i]))
    expected, counts = {}, defaultdict(int)
    for i, a, d in sorted(milk, key=lambda r: (r[1], r[2], r[0])):
        known = [s for s in starts[a] if s[0] <= d]
        if known:
            calving, p = max(known)
            counts[a, p] += 1
            expected[i] = (calving, p, counts[a, p])
        else:
            expected[i] = (None, None, None)
    lactations = history.parity_days(spark.createDataFrame(calvings, CALVINGS), 3).withColumnRenamed("event_date", "calvdate")
    frame = spark.createDataFrame(milk, MILK)
    rows = history.testday_number(frame, lactations).collect()
    assert {r.event_id: (r.closest_calvdate, r.parity, r.testdaynumber) for r in rows} == expected
    assert len(rows) == len(milk)
    linked = history.asof_calving(frame, lactations).collect()
    assert {r.event_id: (r.closest_calvdate, r.parity) for r in linked} == {i: v[:2] for i, v in expected.items()}
    assert all(r.closest_calvdate is None or r.closest_calvdate <= r.milkdate for r in rows)


def test_windows_see_days_not_events(spark, skewed):
    """The hot animal's rows are combined before any window: no window input is larger than its days."""
    df = spark.createDataFrame(skewed, CALVINGS)
    days = history.day_table(df, "animal_id", "event_date", "id")
    hot = days.filter(F.col("animal_id") == 1)
    assert hot.count() == len({d for _, a, d in skewed if a == 1}) < sum(a == 1 for _, a, _ in skewed) / 2
