"""Calving histories, as-of link, test days."""

from __future__ import annotations

from pyspark.sql import functions as F

from herdloom.catalog.base import (
    COUNTRY,
    GAP,
    STAMPED_AT,
    VERSION,
    attr_sql,
    days_sql,
    label_sql,
    lenient_sql,
    places_sql,
    query,
)
from herdloom.functions import attr_text, attributes, days_between, milk_total_lenient
from herdloom.functions.attributes import BODY_WEIGHT, HEART_GIRTH, MILK_EVENING, MILK_MIDDAY, MILK_MORNING
from herdloom.operators import filters, history
from herdloom.operators.reports import CALVING, MILK, WEIGHT
from herdloom.plans import testday

HISTORY_SQL = """h as (
  select c.id, c.animal_id, c.event_date, max(c.event_date) over earlier as previous_calving_date,
    min(c.event_date) over later as subsequent_calving_date, cast(c.event_date - max(c.event_date) over earlier as integer) as calving_interval,
    cast(1 + count(*) over before as integer) as parity
  from core_animal_event c where c.event_type = 1
  window earlier as (partition by c.animal_id order by c.event_date, c.id rows between unbounded preceding and 1 preceding),
    later as (partition by c.animal_id order by c.event_date, c.id rows between 1 following and unbounded following),
    before as (partition by c.animal_id order by c.event_date range between unbounded preceding and interval 1 day preceding))"""

PARITY_SQL = f"""{HISTORY_SQL},
kept as (select id, animal_id, event_date, cast(1 + count(*) over (partition by animal_id order by event_date
    range between unbounded preceding and interval 1 day preceding) as integer) as parity
  from h where coalesce(calving_interval, {GAP}) >= {GAP})"""

LINKED_SQL = f"""{PARITY_SQL},
lactations as (select distinct animal_id, event_date as calvdate, parity from kept),
milk as (select id as event_id, animal_id, event_date as milkdate, additional_attributes
  from core_animal_event where event_type = 2 and event_date is not null),
linked as (select m.*, l.calvdate as closest_calvdate, l.parity
  from milk m asof left join lactations l on m.animal_id = l.animal_id and m.milkdate >= l.calvdate)"""


def _milk(t):
    return filters.events_of(t["core_animal_event"], MILK).select(
        F.col("id").alias("event_id"), "animal_id", F.col("event_date").alias("milkdate"), "additional_attributes"
    )


def _lactations(t):
    days = history.parity_days(filters.events_of(t["core_animal_event"], CALVING), GAP)
    return days.select("animal_id", F.col("event_date").alias("calvdate"), "parity")


def _linked(t):
    return history.asof_calving(_milk(t), _lactations(t))


@query(
    "calving_history",
    "core_animal_event",
    "select * from h",
    HISTORY_SQL,
)
def calving_history(t):
    calvings = filters.events_of(t["core_animal_event"], CALVING).select("id", "animal_id", "event_date")
    return history.calving_history(calvings)


@query(
    "reranked_parity",
    "core_animal_event",
    "select id, animal_id, event_date, parity from kept",
    PARITY_SQL,
)
def reranked_parity(t):
    calvings = filters.events_of(t["core_animal_event"], CALVING).select("id", "animal_id", "event_date")
    return history.reranked_parity(calvings, GAP)


@query(
    "asof_calving",
    "core_animal_event",
    "select event_id, animal_id, milkdate, closest_calvdate, parity from linked",
    LINKED_SQL,
)
def asof_calving(t):
    return _linked(t).drop("additional_attributes")


@query(
    "testday_number",
    "core_animal_event",
    """
    select event_id, animal_id, parity, case when parity is not null then
      cast(row_number() over (partition by animal_id, parity order by milkdate, event_id) as integer) end as testdaynumber
    from linked""",
    LINKED_SQL,
)
def testday_number(t):
    milk = _milk(t).drop("additional_attributes")
    numbered = history.testday_number(milk, _lactations(t))
    return numbered.select("event_id", "animal_id", "parity", "testdaynumber")


@query(
    "days_in_milk",
    "core_animal_event",
    f"""
    select event_id, milkdate, {days_sql("milkdate", "closest_calvdate")} as days_in_milk
    from linked where milkdate >= closest_calvdate""",
    LINKED_SQL,
)
def days_in_milk(t):
    days = days_between(F.col("milkdate"), F.col("closest_calvdate"))
    return _linked(t).select("event_id", "milkdate", days.alias("days_in_milk")).filter(F.col("days_in_milk") >= 0)


@query(
    "testday_rows",
    "core_animal_event core_animal core_farm",
    """
    select e.animal_id, e.event_date, a.tag_id, a.farm_id, e.id from core_animal_event e
    join core_animal a on e.animal_id = a.id join core_farm f on a.farm_id = f.id
    where e.event_type = 2 group by all having count(distinct e.event_date) = 1""",
)
def testday_rows(t):
    animals = t["core_animal"].select(F.col("id").alias("animal_id"), "tag_id", "farm_id")
    farms = t["core_farm"].select(F.col("id").alias("farm_id"))
    milk = filters.events_of(t["core_animal_event"], MILK).select("id", "animal_id", "event_date")
    rows = milk.join(animals, "animal_id").join(farms, "farm_id")
    keys = ["farm_id", "animal_id", "tag_id", "event_date", "id"]
    return history.testday_rows(rows, *keys).select("animal_id", "event_date", "tag_id", "farm_id", "id")


def _first_sql(column: str, order: str, where: str) -> str:
    return f"min_by({column}, {order}) filter (where {column} is not null and {where})"


@query(
    "link_weight_day",
    "core_animal_event",
    "select m.event_id, m.animal_id, m.milkdate, w.weight, w.girth from milk m left join w on m.animal_id = w.animal_id and m.milkdate = w.day",
    f"""milk as (select id as event_id, animal_id, event_date as milkdate from core_animal_event where event_type = 2),
    parsed as (select id, animal_id, event_date as day, {attr_sql("additional_attributes", "136")} as weight,
      {attr_sql("additional_attributes", "137")} as girth from core_animal_event where event_type = 6),
    w as (select animal_id, day, {_first_sql("weight", "id", "true")} as weight, {_first_sql("girth", "id", "true")} as girth
      from parsed group by animal_id, day)""",
)
def link_weight_day(t):
    weighings = filters.events_of(t["core_animal_event"], WEIGHT).select(
        "id", "animal_id", F.col("event_date").alias("day"), attributes(F.col("additional_attributes")).alias("attrs")
    )
    weights = weighings.select(
        "id",
        "animal_id",
        "day",
        attr_text(F.col("attrs"), BODY_WEIGHT).alias("weight"),
        attr_text(F.col("attrs"), HEART_GIRTH).alias("girth"),
    )
    milk = _milk(t).drop("additional_attributes")
    return history.link_by_day(milk, weights, "animal_id", "milkdate", "day", "id").select(
        "event_id", "animal_id", "milkdate", "weight", "girth"
    )


@query(
    "attach_events",
    "core_animal_event core_animal",
    """
    select l.event_id, l.milkdate, l.parity, d.tag_id from linked l
    join (select cast(e.id as varchar) as event_id, a.tag_id from core_animal_event e join core_animal a on e.animal_id = a.id) d
      on l.event_id = try_cast(d.event_id as bigint)""",
    LINKED_SQL,
)
def attach_events(t):
    animals = t["core_animal"].select(F.col("id").alias("animal_id"), "tag_id")
    details = (
        t["core_animal_event"]
        .join(animals, "animal_id")
        .select(F.col("id").cast("string").alias("event_id"), "tag_id")
    )
    return history.attach_events(_linked(t), details).select("event_id", "milkdate", "parity", "tag_id")


@query(
    "first_per_group",
    "core_animal_event",
    f"""
    select animal_id, milkdate, closest_calvdate, min(event_id) as event_id,
      {_first_sql("am", "event_id", "true")} as am, {_first_sql("midday", "event_id", "true")} as midday,
      {_first_sql("pm", "event_id", "true")} as pm, round({_first_sql("total", "event_id", "true")}, 4) as total
    from parsed group by animal_id, milkdate, closest_calvdate""",
    f"""{LINKED_SQL},
    parsed as (select *, {attr_sql("additional_attributes", "59")} as am, {attr_sql("additional_attributes", "68")} as midday,
      {attr_sql("additional_attributes", "61")} as pm, {lenient_sql("additional_attributes")} as total
      from linked where closest_calvdate is not null)""",
)
def first_per_group(t):
    df = _linked(t).filter(F.col("closest_calvdate").isNotNull())
    df = df.withColumn("attrs", attributes(F.col("additional_attributes")))
    attrs = F.col("attrs")
    df = df.select(
        "animal_id",
        "milkdate",
        "closest_calvdate",
        "event_id",
        attr_text(attrs, MILK_MORNING).alias("am"),
        attr_text(attrs, MILK_MIDDAY).alias("midday"),
        attr_text(attrs, MILK_EVENING).alias("pm"),
        F.round(milk_total_lenient(attrs), 4).alias("total"),
    )
    keys = ["animal_id", "milkdate", "closest_calvdate"]
    rows = df.withColumn("order_id", F.col("event_id"))
    return history.first_per_group(rows, keys, "order_id", ["event_id", "am", "midday", "pm", "total"])


# Attribute ids behind the columns of the report, written out here on their own.
MILK_IDS = {"MilkAM": "59", "MilkMidDay": "68", "MilkPM": "61", "MilkFat": "63", "MilkProt": "64", "SCC": "66"}
WEIGHT_IDS = {"Heartgirth": "137", "BodyLength": "138", "Weight": "136", "EstimatedWt": "529", "Bodyscore": "139"}


def _report_sql(country: int | None) -> str:
    herds = "true" if country is None else f"country_id = {country}"
    milk = "event_type = 2"
    weight = "event_type = 6"
    texts = [(n, a, milk) for n, a in MILK_IDS.items()] + [(n, a, weight) for n, a in WEIGHT_IDS.items()]
    parsed = ", ".join(f"{attr_sql('additional_attributes', a)} as {n}" for n, a, _ in texts)
    milk_firsts = ", ".join(f"{_first_sql('m.' + n, 'm.event_id', 'true')} as {n}" for n, _, w in texts if w == milk)
    weight_firsts = ", ".join(f"{_first_sql('w.' + n, 'w.id', 'true')} as {n}" for n, _, w in texts if w == weight)
    milk_names, weight_names = (", ".join(n for n, _, w in texts if w == kind) for kind in (milk, weight))
    return f"""
    calved as (select animal_id, event_date, lag(event_date, 1, event_date - {GAP}) over (partition by animal_id order by event_date, id) as before
      from core_animal_event where event_type = 1 and animal_id in (select id from core_animal where farm_id in (select id from core_farm where {herds}))),
    starts as (select animal_id, event_date as calvdate, count(*) as n from calved where event_date - before >= {GAP} group by all),
    lactations as (select animal_id, calvdate, cast(1 + coalesce(sum(n) over (partition by animal_id order by calvdate
        rows between unbounded preceding and 1 preceding), 0) as integer) as parity from starts),
    parsed as (select id, animal_id, event_type, country_id, event_date, {parsed}, {lenient_sql("additional_attributes")} as TotalMilk
      from core_animal_event),
    milk as (select id as event_id, * from parsed where event_type = 2),
    linked as (select m.*, l.calvdate, l.parity from milk m
      asof left join lactations l on m.animal_id = l.animal_id and m.event_date >= l.calvdate),
    numbered as (select *, cast(row_number() over (partition by animal_id, country_id, parity order by event_date, event_id) as integer) as testdaynumber
      from linked where calvdate is not null),
    days as (select m.animal_id, m.country_id, m.event_date as milkdate, m.calvdate, min(m.event_id) as event_id, min(m.parity) as parity,
        min_by(m.testdaynumber, m.event_id) as testdaynumber, min_by(m.TotalMilk, m.event_id) as TotalMilk, {milk_firsts}
      from numbered m group by m.animal_id, m.country_id, m.event_date, m.calvdate),
    weights as (select w.animal_id, w.country_id, w.event_date, {weight_firsts} from parsed w
      where w.event_type = 6 group by w.animal_id, w.country_id, w.event_date),
    homes as (select id as farm_key, country_id, name as farmer_name, project, round(latitude, 4) as latitude, round(longitude, 4) as longitude,
        {label_sql(3, "gender_code")} as farmergender, {label_sql(2, "farm_type")} as farmtype,
        {attr_sql("additional_attributes", "49")} as cattletotalowned from core_farm where {herds}),
    beasts as (select id as animalid, farm_id as Farm_id, country_id, tag_id, original_tag_id, reg_date, birthdate,
        {label_sql(8, "main_breed")} as main_breed, {places_sql()} from core_animal),
    weighed as (select animal_id as animalid, country_id, event_date as milkdate, {weight_names} from weights),
    milked as (select animal_id as animalid, country_id, milkdate, calvdate as closest_calvdate, event_id, parity, testdaynumber,
        round(TotalMilk, 4) as TotalMilk, {milk_names}, {days_sql("milkdate", "calvdate")} as "Days In Milk" from days),
    report as (
      select * exclude (country_id), '{STAMPED_AT:%Y-%m-%d %H:%M:%S}' as Extract_Datetime_UTC, '{VERSION}' as Version
      from beasts join (select * rename (farm_key as Farm_id), farm_key from homes) using (Farm_id, country_id)
      join milked using (animalid, country_id) left join weighed using (animalid, country_id, milkdate))"""


def _report_query(name: str, country: int | None):
    @query(
        name,
        "core_animal_event core_animal core_farm country_units core_master_list",
        "select * from report",
        _report_sql(country),
    )
    def build(t):
        df = testday.testday_report(t, STAMPED_AT, VERSION, country, GAP)
        return df.withColumns({c: F.round(c, 4) for c in ("TotalMilk", "latitude", "longitude")})


_report_query("testday_report", None)
_report_query("testday_report_country", COUNTRY)
