"""Extract jobs and rules on hand-made herds: firing, quiet, limit and NULL rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from herdloom import plans
from herdloom.operators.rules import Rule, apply_rules, duplicate_keys, error_rates, limits, quality_report
from herdloom.plans import lactation_extract, pedigree_extract, weight_extract, yield_by_breed_region

AS_OF = dt.date(2024, 6, 30)


@pytest.fixture(scope="module")
def herd(table, codes, limit_table):
    """Tables with one farm in country 1 and one in country 2; tests add animals and events."""

    def make(animals, events, **other):
        tables = {
            "core_country": table("core_country", {"id": 1, "name": "Tanzánia"}, {"id": 2, "name": "Kenya"}),
            "country_units": table("country_units", *[{"id": i, "name": f"unit {i}"} for i in (1, 2, 3, 4)]),
            "core_organization": table("core_organization", {"id": 5, "name": "Org"}),
            "core_master_list": codes,
            "interface_limit_parameters": limit_table,
            "interface_graduation_settings": table("interface_graduation_settings", {"id": 1, "graduation_value": 12.0}),
            "core_farm": table(
                "core_farm",
                {"id": 1, "country_id": 1, "region_id": 1, "district_id": 2, "ward_id": 3, "village_id": 99, "org_id": 5,
                 "farmer_name": "Asha", "name": "Hill", "farm_type": 1, "gender_code": 2,
                 "additional_attributes": '{"49":"12"}'},
                {"id": 2, "country_id": 2},
            ),
            "core_animal": table("core_animal", *animals),
            "core_animal_event": table("core_animal_event", *events),
        }
        return tables | other

    return make


def animal(id, **values):
    return {"id": id, "farm_id": 1, "country_id": 1, "tag_id": f"T{id}", "animal_type": 2} | values


def event(id, animal_id, event_type, day, **values):
    return {"id": id, "animal_id": animal_id, "event_type": event_type, "event_date": day, "country_id": 1} | values


def comments(df, key):
    return {r[key]: r["comments"] for r in df.collect()}


def test_lactation_extract(herd):
    animals = [
        animal(1, birthdate="2018-01-01", sex=2, main_breed=1, reg_date="2020-02-02"),
        animal(2, animal_type=5, created_at="2021-05-05T10:00:00"),
        animal(3, animal_type=6),  # straw: left out
        animal(4, animal_type=None),  # not known to differ from straw: left out
        animal(5, farm_id=2, country_id=1),  # farm elsewhere
        animal(6, birthdate="2024-02-01"),
        animal(7, birthdate="2021-09-08", main_breed=77),  # 540 days: not below the limit
    ]
    events = [
        event(1, 1, 1, "2021-01-01"), event(2, 1, 1, "2021-08-09"),  # 220 days: at the limit
        event(3, 1, 1, "2022-03-16"),  # 219 days
        event(4, 1, 1, "2022-03-16"), event(5, 1, 1, "2019-12-31"), event(6, 1, 1, None),
        event(10, 2, 1, "2024-07-01"),
        event(20, 3, 1, "2022-01-01"), event(21, 4, 1, "2022-01-01"), event(22, 5, 1, "2022-01-01"),
        event(30, 6, 1, "2024-01-01"),
        event(40, 7, 1, "2023-03-02"), event(41, 7, 2, "2023-03-02"),
    ]
    out = lactation_extract(herd(animals, events), "2020-01-01", "2024-12-31", AS_OF, country=1)
    rows = {r.lactation_id: r for r in out.collect()}
    assert {i: r.comments for i, r in rows.items()} == {
        1: None,  # the calving of 2019 is before the period and not seen
        2: None,
        3: " | Duplicate Record | Invalid Calving Interval",
        4: " | Duplicate Record | Invalid Calving Interval",  # 0 days after the other one
        10: " | Future Calving Date | Invalid Animal Type",
        30: " | Calved Before Birth | Invalid Calving Age",
        40: None,
    }
    assert {i: r.status for i, r in rows.items()} == {1: 1, 2: 1, 3: 0, 4: 0, 10: 0, 30: 0, 40: 1}
    first = rows[1]
    assert (first.country, first.region, first.district, first.ward, first.village) == (
        "Tanzánia", "unit 1", "unit 2", "unit 3", None,
    )
    assert (first.farm_name, first.main_breed, first.animal_sex, first.animal_type) == ("Asha", "Ayrshire", "Female", "Cow")
    assert first.parity == 1 and first.subsequent_calving_date == dt.date(2021, 8, 9)
    assert first.animal_registration_date == dt.date(2020, 2, 2) and first.calving_age == 1096
    assert rows[10].animal_registration_date == dt.date(2021, 5, 5) and rows[10].calving_age is None
    assert rows[40].main_breed == "Unknown"


def test_lactation_limits_missing_or_null(herd, table):
    animals = [animal(1, birthdate="2020-01-01")]
    events = [event(1, 1, 1, "2021-01-01"), event(2, 1, 1, "2021-01-05")]

    def run(*rows):
        tables = herd(animals, events, interface_limit_parameters=table("interface_limit_parameters", *rows))
        return comments(lactation_extract(tables, "2020-01-01", "2024-12-31", AS_OF), "lactation_id")

    assert run() == {1: None, 2: None}
    # A NULL minimum age is 18 months; a NULL upper interval leaves a too short one known to be outside.
    nulls = [{"id": 1, "category": "calving_interval", "min_value": 220.0}, {"id": 2, "category": "age_at_first_calving"}]
    assert run(*nulls) == {1: " | Invalid Calving Age", 2: " | Invalid Calving Interval | Invalid Calving Age"}
    assert run({"id": 1, "category": "calving_interval", "max_value": 900.0}) == {1: None, 2: None}


def bag(girth="-", weight="-"):
    parts = [f'"{k}":{v}' for k, v in (("137", girth), ("136", weight)) if v != "-"]
    return "{" + ",".join(parts) + "}"


def test_weight_extract(herd):
    where = {"longitude": 36.0, "latitude": -1.0}
    animals = [
        animal(1, birthdate="2023-01-01", **where),
        animal(2, **where),
        animal(3, birthdate="2023-01-01", longitude=None, latitude=1.0),
        animal(4, birthdate="2023-01-01", longitude=180.5, latitude=0.0),
        animal(5, country_id=2),
    ]
    weighings = [
        (1, 1, "2024-01-31", bag('"50"', '"10"')),  # 12 months: calf, at the lower limits
        (2, 1, "2024-02-01", bag('"120"', '"150"')),  # mature
        (3, 1, "2023-06-01", bag('"49"', '"150.5"')),
        (4, 1, "2024-03-01", bag()),
        (5, 1, "2024-04-01", bag("null", "null")),  # recorded as null: reads as 0
        (6, 1, "2022-12-31", bag('"50"')),
        (7, 1, "2024-07-01", bag('"100"', '"700"')),
        (8, 2, "2024-01-01", bag('"50"', '"700"')),
        (9, 2, "2024-01-02", bag('"251"', '"9"')),
        (10, 2, "2024-01-02", bag('"200"')),
        (11, 3, "2024-05-01", bag('"150"')),
        (12, 4, "2024-05-01", bag('"150"')),
        (13, 5, "2024-05-01", bag('"150"')),
    ]
    events = [event(i, a, 6, d, additional_attributes=b) for i, a, d, b in weighings]
    out = weight_extract(herd(animals, events), "2022-01-01", "2024-12-31", AS_OF, country=1)
    age = "Out Of Range(Considered age at weighing)"
    assert comments(out, "weight_id") == {
        1: None,
        2: None,
        3: f" | Heart Girth {age} | Body Weight {age}",
        4: " | Both Heart Girth & Weight are Null",
        5: f" | Heart Girth {age} | Body Weight {age}",
        6: " | Weight Recorded Before Animal Was Born",
        7: " | Weight Date Is In The Future",
        8: None,
        9: " | Duplicate Record | Heart Girth Out Of Range | Body Weight Out Of Range",
        10: " | Duplicate Record",
        11: " | No GPS Details",
        12: " | GPS Out Of Range",
    }
    rows = {r.weight_id: r for r in out.collect()}
    assert rows[5].heart_girth == "null" and rows[4].heart_girth is None
    assert rows[1].age_at_weighing == 12 and rows[8].age_at_weighing is None


def test_pedigree_extract(herd):
    animals = [
        animal(1, sex=2, sire_id=2, dam_id=3, birthdate="2015-01-01", reg_date="2014-01-01"),
        animal(2, sex=1, sire_id=1, birthdate="2016-01-01", sire_tag_id="S", dam_tag_id="D"),
        animal(3, tag_id="T4"),  # used as a dam
        animal(4, sire_id=None, sire_tag_id="GONE"),  # has an event of a female
        animal(5, sire_id=5, sex=1),
        animal(6, sire_id=7, dam_id=7, tag_id=None),
        animal(7, tag_id=None),  # used as both
        animal(8, sex=9),  # code without label
        animal(9, farm_id=None, country_id=1, dam_id=2, sex=2),  # a male as dam; no farm
        animal(10, country_id=2, farm_id=2),
    ]
    events = [event(1, 4, 3, "2020-01-01"), event(2, 8, 6, "2020-01-01"), event(3, 7, 2, "2020-01-01", country_id=2)]
    out = pedigree_extract(herd(animals, events), "tanzania")
    rows = {r.animal_id: r for r in out.collect()}
    assert sorted(rows) == list(range(1, 10))
    errors = {i: r.error for i, r in rows.items()}
    assert errors == {
        1: " | Progeny Is Its Own Grand Sire",
        2: " | Bisexual(Used As Dam and Sire) | Progeny Is Its Own Grand Sire | Male Animal Used As A Dam",
        3: " | Duplicate Record",
        4: " | Duplicate Record",
        5: " | Progeny Is Its Own Grand Sire | Own Parent",
        6: None,  # two tags are NULL, which is no duplicate
        7: " | Bisexual(Used As Dam and Sire)",
        8: None,
        9: None,
    } | {1: " | Progeny Is Its Own Grand Sire | Female Animal Used As A Sire"}
    warnings = {i: r.warning for i, r in rows.items()}
    assert warnings == {
        1: " | Registered Before Birth | Animal Older Than Its Sire",
        2: " | Dam Details Not Found",
        3: " | No or Estimated Sex Details",
        4: " | No or Estimated Sex Details | Sire Details Not Found",
        5: None,
        6: " | No or Estimated Sex Details",
        7: " | No or Estimated Sex Details",
        8: " | No or Estimated Sex Details",
        9: None,
    }
    sexes = {i: (r.sex, r.estimated_sex) for i, r in rows.items() if r.estimated_sex}
    # 3 as a dam, 4 by its event, 7 as a sire before as a dam (its event is of another country).
    assert sexes == {3: ("Female", "Female"), 4: ("Female", "Female"), 7: ("Male", "Male")}
    assert rows[1].sire_tag_id == "T2" and rows[4].sire_tag_id == "GONE"
    assert rows[1].organization_name == "Org" and rows[9].country is None
    assert all((r.status == 1) == (r.warning is None and r.error is None) for r in rows.values())
    six = pedigree_extract(herd(animals, events), "tanzania", parentage=False)
    assert {r.animal_id: r.error for r in six.collect()}[5] == " | Progeny Is Its Own Grand Sire"


def test_testday_report(herd):
    animals = [animal(1, birthdate="2018-01-01", main_breed=1), animal(2, country_id=2), animal(3, farm_id=2)]
    events = [
        event(1, 1, 1, "2021-01-01", country_id=9),  # calvings go by the farm
        event(2, 1, 2, "2020-12-31"),  # before the first calving
        event(3, 1, 2, "2021-01-01", additional_attributes='{"59":null,"61":"3"}'),
        event(4, 1, 2, "2021-02-01", additional_attributes='{"61":"2.5","63":"4.1"}'),
        event(5, 1, 2, "2021-02-01", additional_attributes='{"59":"5","61":"9"}'),
        event(6, 1, 2, "2021-03-01", country_id=2),  # of another country: not counted
        event(7, 1, 2, "2021-04-01", additional_attributes='{"59":"1"}'),
        event(8, 1, 6, "2021-02-01", additional_attributes='{"136":"300"}'),
        event(9, 1, 6, "2021-02-01", additional_attributes='{"136":"310","137":"150"}'),
        event(10, 1, 2, None),
        event(11, 2, 1, "2021-01-01"), event(12, 2, 2, "2021-02-01"),
        event(13, 3, 1, "2021-01-01"), event(14, 3, 2, "2021-02-01"),
    ]
    tables = herd(animals, events)
    at = dt.datetime(2024, 1, 1, 9, 0, tzinfo=dt.timezone(dt.timedelta(hours=3)))
    df = plans.testday_report(tables, at, "V2", country=1)
    assert len(df.columns) == 39
    rows = sorted(df.collect(), key=lambda r: r.milkdate)
    assert [(r.event_id, r.testdaynumber, r["Days In Milk"], r.TotalMilk) for r in rows] == [
        (3, 1, 0, 3.0), (4, 2, 31, 2.5), (7, 4, 90, 1.0),
    ]
    day = rows[1]
    # First known value per column: morning milk only in the second record, girth only in the second weighing.
    assert (day.MilkAM, day.MilkPM, day.MilkFat, day.Weight, day.Heartgirth) == ("5", "2.5", "4.1", "300", "150")
    assert rows[0].MilkAM == "null" and rows[0].Weight is None
    assert (day.farmergender, day.farmtype, day.cattletotalowned, day.farmer_name) == ("Female", "Small", "12", "Hill")
    assert day.Extract_Datetime_UTC == "2024-01-01 06:00:00" and day.Version == "V2"
    every = plans.testday_report(tables, at, "V2")
    assert sorted(r.event_id for r in every.collect()) == [3, 4, 7]


def test_yield_is_a_mean_of_cow_means(herd):
    milk = '{{"61":"{}","68":"0","59":"0"}}'
    animals = [animal(1, main_breed=1, region_id=1), animal(2, main_breed=1, region_id=1), animal(3, main_breed=1, region_id=1)]
    events = [
        event(i, a, 2, d, additional_attributes=b)
        for i, (a, d, b) in enumerate(
            [
                (1, "2020-01-01", milk.format(10)), (1, "2020-01-02", milk.format(20)), (2, "2020-01-01", milk.format(30)),
                (2, "2015-12-31", milk.format(99)), (1, "2020-01-03", '{"61":"99"}'), (3, "2020-01-01", "{}"),
            ]
        )
    ]
    rows = yield_by_breed_region(herd(animals, events), country=1).collect()
    assert [(r.region, r.breed, r.average_milk) for r in rows] == [("unit 1", "Ayrshire", 22.5)]


def test_rule_order_changes_the_text_only(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 20)], "id int, x int")
    a, b = Rule("a", F.col("x") < 10, "small"), Rule("b", F.col("x") < 30, "below 30")
    one = {r.id: (r.comments, r.status) for r in apply_rules(df, [a, b]).collect()}
    two = {r.id: (r.comments, r.status) for r in apply_rules(df, [b, a]).collect()}
    assert one == {1: (" | small | below 30", 0), 2: (None, 1), 3: (" | below 30", 0)}
    assert two[1] == (" | below 30 | small", 0) and {k: v[1] for k, v in one.items()} == {k: v[1] for k, v in two.items()}


def test_null_keys_are_no_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (None, "a"), (None, "a"), (2, "b")], "k int, d string")
    assert [tuple(r) for r in duplicate_keys(df, "k", "d").collect()] == [(1, "a", 2)]


def test_settings(spark, table):
    rows = [
        {"id": 3, "category": "c", "min_value": 7.0},
        {"id": 2, "category": "c", "min_value": None, "max_value": 4.0},
        {"id": 9, "category": "d", "min_value": 1.0, "max_value": 2.0},
    ]
    (low, high), (gone, _) = limits(table("interface_limit_parameters", *rows), {"category": "c"}, {"category": "x"})
    out = spark.range(2).select("id", low.alias("low"), high.alias("high"), gone.alias("gone")).collect()
    # The lowest id counts, even with a NULL in it; no row at all gives NULL and loses no row.
    assert [(r.low, r.high, r.gone) for r in out] == [(None, 4.0, None)] * 2


def test_error_rates_and_report(spark, table):
    df = spark.createDataFrame([(1, 3), (1, 2), (1, None), (2, 0)], "country_id bigint, x int")
    rates = error_rates(df, [Rule("a", F.col("x") > 1, "A"), Rule("b", F.col("x") > 2, "B")], ["country_id"])
    rows = {(r.country_id, r.rule): (r.total_records, r.total_error_records, r.error_rate) for r in rates.collect()}
    assert rows == {(1, "a"): (3, 2, 66.67), (1, "b"): (3, 1, 33.33), (2, "a"): (1, 0, 0.0), (2, "b"): (1, 0, 0.0)}
    base = {"country_id": 1, "quality_check": 1, "total_records": 9, "report_year": 2024, "report_week": 2, "deleted": 0}
    logged = table(
        "interface_data_quality_report_data_weekly",
        base, base | {"deleted": 1}, base | {"report_week": 3}, base | {"quality_check": 7}, base | {"country_id": 8},
    )
    checks = table("interface_data_quality_check", {"id": 1, "quality_check": "Dates"})
    countries = table("core_country", {"id": 1, "name": "Kenya"})
    out = quality_report(logged, checks, countries, 2024, 2).collect()
    assert [(r.country, r.quality_check, r.total_records) for r in out] == [("Kenya", "Dates", 9)]
