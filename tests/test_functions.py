"""Scalar semantics that differ from plain Spark."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from herdloom import functions as H


def one(spark, column, **values):
    ddl = ", ".join(f"{n} {t}" for n, (t, _) in values.items())
    df = spark.createDataFrame([tuple(v for _, v in values.values())], ddl)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("3.5", 3.5), ("12abc", 12.0), ("", 0.0), ("null", 0.0), (None, None), (" 7 ", 7.0), ("-2.5e1x", -25.0),
        (".5", 0.5), ("5.", 5.0), ("abc", 0.0), ("+4", 4.0), ("1,5", 1.0), ("-", 0.0), ("12d", 12.0), ("NaN", 0.0),
    ],
)
def test_lenient_num(spark, text, number):
    assert one(spark, H.lenient_num(F.col("c")), c=("string", text)) == number


@pytest.mark.parametrize(("text", "number"), [(" 7.5 ", 7.5), ("12abc", None), ("", None), ("NaN", None), ("1d", None), (None, None)])
def test_strict_num(spark, text, number):
    assert one(spark, H.strict_num(F.col("c")), c=("string", text)) == number


@pytest.mark.parametrize(
    ("bag", "text"),
    [
        ('{"59":"3.5"}', "3.5"), ('{"59":null}', "null"), ("{}", None), ('{"59":""}', ""), ('{"59":4}', "4"),
        ('{"61":"1"}', None), (None, None), ("broken", None),
    ],
)
def test_attr_text(spark, bag, text):
    assert one(spark, H.attr_text(H.attributes(F.col("c")), "59"), c=("string", bag)) == text


@pytest.mark.parametrize(
    ("bag", "strict", "lenient"),
    [
        ('{"59":"5","61":"4.5","68":"2"}', 11.5, 11.5),
        ('{"59":"5","61":"4.5"}', None, 9.5),
        ('{"59":"5","61":null,"68":"2"}', 7.0, 7.0),
        ('{"59":"","61":"12abc","68":"0"}', 12.0, 12.0),
        ('{"59":"1.005","61":"0","68":0}', 1.01, 1.005),
        ("{}", None, 0.0),
        (None, None, 0.0),
    ],
)
def test_milk_totals(spark, bag, strict, lenient):
    attrs = H.attributes(F.col("c"))
    assert one(spark, H.milk_total_strict(attrs), c=("string", bag)) == strict
    assert one(spark, H.milk_total_lenient(attrs), c=("string", bag)) == lenient


def test_sunday_week_is_strftime_U(spark):
    first, n = dt.date(2015, 1, 1), 5844
    rows = (
        spark.range(n)
        .select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("d"))
        .select("d", H.sunday_week(F.col("d")).alias("w"))
        .collect()
    )
    assert [r.w for r in rows] == [int(r.d.strftime("%U")) for r in rows]
    known = {r.d: r.w for r in rows}
    assert known[dt.date(2023, 12, 31)] == 53 and known[dt.date(2024, 1, 1)] == 0
    assert known[dt.date(2024, 12, 31)] == 52 and known[dt.date(2027, 1, 2)] == 0


@pytest.mark.parametrize(
    ("later", "earlier", "months"),
    [("2024-03-01", "2024-02-29", 1), ("2024-01-31", "2023-12-01", 1), ("2024-01-01", "2024-01-31", 0),
     ("2023-12-31", "2024-01-01", -1)],
)
def test_months_apart(spark, later, earlier, months):
    days = {n: ("date", dt.date.fromisoformat(d)) for n, d in (("a", later), ("b", earlier))}
    assert one(spark, H.months_apart(F.col("a"), F.col("b")), **days) == months


@pytest.mark.parametrize(
    ("name", "same"),
    [("Tanzania", True), ("TANZÁNIA", True), ("tanzania  ", True), ("Tanzanie", False), (None, None)],
)
def test_same_name(spark, name, same):
    assert one(spark, H.same_name(F.col("c"), "tanzánia"), c=("string", name)) == same


@pytest.mark.parametrize(("text", "out"), [("BEN OKO", "Ben oko"), ("ann", "Ann"), ("", ""), (None, None)])
def test_capitalise(spark, text, out):
    assert one(spark, H.capitalise(F.col("c")), c=("string", text)) == out


@pytest.mark.parametrize(
    ("preset", "today", "start", "end"),
    [
        ("prev_workday", "2024-01-15", "2024-01-12", "2024-01-12"),  # Monday
        ("prev_workday", "2024-01-16", "2024-01-15", "2024-01-15"),
        ("prev_week", "2024-01-15", "2024-01-08", "2024-01-14"),
        ("prev_week", "2024-01-21", "2024-01-08", "2024-01-14"),  # Sunday
        ("prev_month", "2024-03-31", "2024-02-01", "2024-02-29"),
        ("prev_month", "2024-01-01", "2023-12-01", "2023-12-31"),
        ("yesterday_today", "2024-03-01", "2024-02-29", "2024-03-01"),
    ],
)
def test_period(spark, preset, today, start, end):
    bounds = H.period(preset, today)
    row = spark.range(1).select(*[b.cast("string") for b in bounds]).first()
    assert tuple(row) == (start, end)


def test_unknown_period():
    with pytest.raises(ValueError, match="unknown period"):
        H.period("last_year", F.lit(dt.date(2024, 1, 1)))


@pytest.mark.parametrize(
    ("form", "gps"),
    [
        ('{"farmer_general":[{"a":"x"},{"g/Farmer_GPSLocation":"1.5 36.2 0 0"}]}', ("1.5", "36.2")),
        # The first of two keys that has two parts.
        ('{"farmer_general":[{"farmer_gpslocation":"1.5"},{"b/FARMER_GPSLOCATION":"2 3","c/farmer_gpslocation":"4 5"}]}', ("2", "3")),
        ('{"farmer_general":[{"farmer_gpslocation":null,"z/farmer_gpslocation":"7 8"}]}', ("7", "8")),
        ('{"farmer_general":{"farmer_gpslocation":"1 2"}}', None),
        ('{"farmer_general":[]}', None),
        ('{"other":1}', None),
        ('{"farmer_general":[{"farmer_gpslocation_x":"1 2"}]}', None),
        ("{broken", None),
        (None, None),
    ],
)
def test_first_gps(spark, form, gps):
    found = one(spark, H.first_gps(F.col("c")), c=("string", form))
    assert (None if found is None else tuple(found)) == gps


@pytest.mark.parametrize(("version", "kept"), [("Ver 1.7", True), ("Ver 1.10", False), ("1.8", True), (None, None)])
def test_version_is_text(spark, version, kept):
    assert one(spark, H.last_word(F.col("c")) >= F.lit("1.7"), c=("string", version)) == kept
