"""Scans, sinks, filters, lookups and scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from herdloom.catalog.base import (
    AS_OF,
    COUNTRY,
    COUNTRY_NAME,
    END,
    STAMPED_AT,
    START,
    VERSION,
    attr_sql,
    days_sql,
    lenient_sql,
    months_sql,
    query,
    strict_sql,
    week_sql,
)
from herdloom.functions import (
    attr_text,
    attributes,
    capitalise,
    day_label,
    days_between,
    milk_total_lenient,
    milk_total_strict,
    month_label,
    months_apart,
    period,
    sunday_week,
)
from herdloom.functions.dates import PRESETS
from herdloom.operators import filters, lookups, reports, updates
from herdloom.operators.rules import limits
from herdloom.plans.dataflow import event_farm_country
from herdloom.plans.runs import retention_run
from herdloom.sources import (
    export_lists,
    purge_run,
    read_current,
    read_extract,
    read_extract_in_splits,
    refresh,
    shared_path,
    stage,
    stamp,
    write_extract,
)

ANIMAL_COLUMNS = "id, farm_id, country_id, region_id, tag_id, sex, animal_type, main_breed, birthdate, reg_date, sire_id, dam_id"


@query(
    "scan_animals",
    "core_animal",
    f"select {ANIMAL_COLUMNS}, round(latitude, 4) as latitude, round(longitude, 4) as longitude from core_animal",
)
def scan_animals(t):
    return t["core_animal"].select(
        *ANIMAL_COLUMNS.split(", "),
        F.round("latitude", 4).alias("latitude"),
        F.round("longitude", 4).alias("longitude"),
    )


@query(
    "stage_roundtrip",
    "core_animal",
    "select run_id, id, tag_id, country_id from core_animal, (values ('first'), ('second')) as r(run_id)",
)
def stage_roundtrip(t):
    path = shared_path(t.spark, "staged")
    rows = t["core_animal"].select("id", "tag_id", "country_id")
    for run in ("first", "second", "second"):  # a repeated run replaces itself
        stage(rows, path, run)
    return t.spark.read.schema("id bigint, tag_id string, country_id int, run_id string").parquet(path)


@query(
    "purge_run",
    "core_animal",
    "select 'second' as run_id, id, tag_id, country_id from core_animal",
)
def purged(t):
    path = shared_path(t.spark, "staged")
    rows = t["core_animal"].select("id", "tag_id", "country_id")
    for run in ("first", "second"):
        stage(rows, path, run)
    purge_run(t.spark, path, "first")
    return t.spark.read.schema("id bigint, tag_id string, country_id int, run_id string").parquet(path)


SPECIAL_RUN = "2024-01-25T06:00 b%c"


@query(
    "purge_special_run",
    "core_animal",
    f"select '{SPECIAL_RUN}/2' as run_id, id, tag_id from core_animal",
)
def purge_special_run(t):
    path = shared_path(t.spark, "staged")
    rows = t["core_animal"].select("id", "tag_id")
    for run in (SPECIAL_RUN, f"{SPECIAL_RUN}/2"):
        stage(rows, path, run)
    purge_run(t.spark, path, SPECIAL_RUN)
    return t.spark.read.schema("id bigint, tag_id string, run_id string").parquet(path)


@query(
    "refresh_roundtrip",
    "core_farm",
    "select id, farmer_name, farm_type from core_farm",
)
def refresh_roundtrip(t):
    path = shared_path(t.spark, "core_farm")
    rows = t["core_farm"].select("id", "farmer_name", "farm_type")
    refresh(rows.limit(0), path)
    refresh(rows, path)
    return read_current(t.spark, path, "id bigint, farmer_name string, farm_type bigint")


@query(
    "csv_roundtrip",
    "core_animal",
    "select id, tag_id, sex, birthdate from core_animal",
)
def csv_roundtrip(t):
    path = shared_path(t.spark, "extract")
    write_extract(t["core_animal"].select("id", "tag_id", "sex", "birthdate"), path, "id")
    return read_extract(t.spark, path, "id bigint, tag_id string, sex bigint, birthdate date")


@query(
    "csv_in_splits",
    "core_animal",
    """
    select id, birthdate, case when id % 5 > 0 then repeat('said "' || tag_id || '"' || chr(10), cast(id % 5 as integer)) || ', end' end as note
    from core_animal""",
)
def csv_in_splits(t):
    """One file with records of several lines, read in as many splits as the session makes of it."""
    path = shared_path(t.spark, "extract")
    said = F.expr("""repeat('said "' || tag_id || '"\n', cast(id % 5 as int)) || ', end'""")
    note = F.when(F.col("id") % 5 > 0, said).alias("note")
    write_extract(t["core_animal"].select("id", "birthdate", note), path, compression="none")
    return read_extract_in_splits(t.spark, path, "id bigint, birthdate date, note string")


@query(
    "ordered_extract",
    "core_animal",
    """
    select cast(row_number() over (order by birthdate nulls first, id) as integer) as position, id, birthdate from core_animal""",
)
def ordered_extract(t):
    path = shared_path(t.spark, "extract")
    write_extract(t["core_animal"].select("id", "birthdate").repartition(5), path, "birthdate", "id")
    rows = read_extract(t.spark, path, "id bigint, birthdate date").withColumns(
        {"file": F.input_file_name(), "line": F.monotonically_increasing_id()}
    )
    in_files = Window.orderBy("file", "line")
    return rows.select(F.row_number().over(in_files).alias("position"), "id", "birthdate")


@query(
    "stamp_extract",
    "core_farm",
    "select id, farmer_name, '2024-01-25 06:30:00' as Extract_Datetime_UTC, 'v1' as Version from core_farm",
)
def stamp_extract(t):
    return stamp(t["core_farm"].select("id", "farmer_name"), STAMPED_AT, VERSION)


@query(
    "export_lists",
    "core_farm core_animal country_units",
    """
    select 'animal_list' as list, id, tag_id as name from core_animal
    union all select 'farmer_list', id, farmer_name from core_farm
    union all select 'region_list', id, name from country_units""",
)
def exported(t):
    lists = {
        "animal_list": t["core_animal"].select("id", F.col("tag_id").alias("name")),
        "farmer_list": t["core_farm"].select("id", F.col("farmer_name").alias("name")),
        "region_list": t["country_units"].select("id", "name"),
    }
    where = export_lists(lists, shared_path(t.spark, "lists"))
    read = [
        t.spark.read.schema("id bigint, name string").csv(path).select(F.lit(name).alias("list"), "id", "name")
        for name, path in where.items()
    ]
    return read[0].unionByName(read[1]).unionByName(read[2])


@query(
    "events_of",
    "core_animal_event",
    f"""
    select id, animal_id, event_date from core_animal_event
    where event_type = 6 and country_id = {COUNTRY} and event_date between date '{START}' and date '{END}'""",
)
def events_of(t):
    df = filters.events_of(t["core_animal_event"], 6, COUNTRY, START, END)
    return df.select("id", "animal_id", "event_date")


@query(
    "created_between",
    "core_animal",
    f"""
    select id, created_by, created_at from core_animal
    where created_at between date '{START}' and date '{END}' and created_by is not null""",
)
def created_between(t):
    df = filters.created_between(t["core_animal"], START, END, known="created_by")
    return df.select("id", "created_by", "created_at")


@query(
    "fill_defaults",
    "core_animal core_master_list",
    """
    select a.id, coalesce(b.label, 'Unknown') as breed, coalesce(a.reg_date, a.created_at) as reg_date
    from core_animal a left join core_master_list b on a.main_breed = b.value and b.list_type_id = 8""",
)
def fill_defaults(t):
    df = lookups.with_code(t["core_animal"], t["core_master_list"], "main_breed", lookups.BREEDS, "breed")
    df = filters.fill_defaults(df, breed="Unknown", reg_date=F.to_date("created_at"))
    return df.select("id", "breed", "reg_date")


@query(
    "exclude_type",
    "core_animal",
    "select id, sex from core_animal where sex not in (2)",
)
def exclude_type(t):
    return filters.exclude(t["core_animal"], "sex", 2).select("id", "sex")


@query(
    "milk_positive",
    "core_animal_event",
    "select id, round(total_milk, 4) as total_milk from m where total_milk > 0",
    f"m as (select id, {strict_sql('additional_attributes')} as total_milk from core_animal_event where event_type = 2)",
)
def milk_positive(t):
    milk = filters.events_of(t["core_animal_event"], reports.MILK)
    return reports.milk_positive(milk).select("id", F.round("total_milk", 4).alias("total_milk"))


@query(
    "event_filter",
    "core_animal_event core_events_type",
    """
    select e.id, d.description as event, d.description in ('Weight', 'Calving') as wanted
    from core_animal_event e join core_events_type d on e.event_type = d.event_id
    where d.description in ('Weight', 'Calving') or d.description not in ('Weight', 'Calving', 'Milking')""",
)
def event_filter(t):
    names = t["core_events_type"].select(F.col("event_id").alias("event_type"), F.col("description").alias("event"))
    df = t["core_animal_event"].join(names, "event_type").select("id", "event")
    wanted = filters.keep(df, "event", "Weight", "Calving").withColumn("wanted", F.lit(True))
    others = filters.exclude(df, "event", "Weight", "Calving", "Milking").withColumn("wanted", F.lit(False))
    return wanted.unionByName(others)


def _period_query(name: str, preset: str, today: str, start: str, end: str):
    @query(
        name,
        "core_animal_event",
        f"select id, created_at from core_animal_event where created_at between date '{start}' and date '{end}'",
    )
    def build(t):
        return filters.period_filter(t["core_animal_event"], preset, today).select("id", "created_at")


_period_query("period_week", "prev_week", "2024-01-15", "2024-01-08", "2024-01-14")
_period_query("period_month", "prev_month", "2024-02-29", "2024-01-01", "2024-01-31")
_period_query("period_workday", "prev_workday", "2024-01-15", "2024-01-12", "2024-01-12")
_period_query("period_adhoc", "yesterday_today", "2024-01-25", "2024-01-24", "2024-01-25")


@query(
    "period_bounds",
    "",
    """
    select d as today,
      case when isodow(d) = 1 then d - 3 else d - 1 end as prev_workday_from,
      case when isodow(d) = 1 then d - 3 else d - 1 end as prev_workday_to,
      d - cast(isodow(d) as int) - 6 as prev_week_from, d - cast(isodow(d) as int) as prev_week_to,
      cast(date_trunc('month', d) - interval 1 month as date) as prev_month_from,
      cast(date_trunc('month', d) as date) - 1 as prev_month_to,
      d - 1 as yesterday_today_from, d as yesterday_today_to
    from (select distinct cast(o_orderdate as date) as d from orders)""",
)
def period_bounds(t):
    days = t.raw("orders").select(F.to_date("o_orderdate").alias("today")).distinct()
    bounds = {p: period(p, F.col("today")) for p in PRESETS}
    return days.select(
        "today",
        *[c.alias(f"{p}_{end}") for p, pair in bounds.items() for c, end in zip(pair, ("from", "to"), strict=True)],
    )


@query(
    "form_version",
    "core_odk_form",
    """
    select form_uuid, form_version from core_odk_form
    where form_data is not null and split_part(form_version, ' ', -1) >= '1.7'""",
)
def form_version(t):
    return filters.latest_form_version(t["core_odk_form"]).select("form_uuid", "form_version")


@query(
    "event_farm_country",
    "core_animal_event core_animal core_farm core_country",
    """
    select e.id, e.event_type, f.id as farm_id, c.name as country
    from core_animal_event e join core_animal a on e.animal_id = a.id
    join core_farm f on a.farm_id = f.id join core_country c on f.country_id = c.id""",
)
def events_with_country(t):
    events = t["core_animal_event"].select("id", "event_type", "animal_id")
    df = event_farm_country(events, t["core_animal"], t["core_farm"], t["core_country"])
    return df.select("id", "event_type", "farm_id", "country")


@query(
    "with_places",
    "core_farm country_units",
    """
    select f.id, r.name as region, d.name as district, w.name as ward, v.name as village from core_farm f
    left join country_units r on f.region_id = r.id left join country_units d on f.district_id = d.id
    left join country_units w on f.ward_id = w.id left join country_units v on f.village_id = v.id""",
)
def with_places(t):
    return lookups.with_places(t["core_farm"], t["country_units"]).select(
        "id", "region", "district", "ward", "village"
    )


@query(
    "with_code",
    "core_animal core_master_list",
    """
    select a.id, s.label as sex_label, b.label as breed, y.description as type_text from core_animal a
    left join core_master_list s on a.sex = s.value and s.list_type_id = 3
    left join core_master_list b on a.main_breed = b.value and b.list_type_id = 8
    left join core_master_list y on a.animal_type = y.value and y.list_type_id = 62""",
)
def with_code(t):
    codes = t["core_master_list"]
    df = lookups.with_code(t["core_animal"], codes, "sex", lookups.SEXES, "sex_label")
    df = lookups.with_code(df, codes, "main_breed", lookups.BREEDS, "breed")
    df = lookups.with_code(df, codes, "animal_type", lookups.ANIMAL_TYPES, "type_text", text="description")
    return df.select("id", "sex_label", "breed", "type_text")


@query(
    "with_parents",
    "core_animal",
    """
    select a.id, coalesce(s.tag_id, a.sire_tag_id) as sire_tag_id, coalesce(d.tag_id, a.dam_tag_id) as dam_tag_id,
      s.birthdate as sire_birthdate, d.birthdate as dam_birthdate, s.sire_id as grand_sire_id, d.dam_id as grand_dam_id
    from core_animal a left join core_animal s on a.sire_id = s.id left join core_animal d on a.dam_id = d.id""",
)
def with_parents(t):
    return lookups.with_parents(t["core_animal"]).select(
        "id", "sire_tag_id", "dam_tag_id", "sire_birthdate", "dam_birthdate", "grand_sire_id", "grand_dam_id"
    )


@query(
    "country_semi",
    "core_animal core_country",
    f"""
    select id, country_id from core_animal where country_id in
      (select id from core_country where strip_accents(lower(rtrim(name))) = strip_accents(lower(rtrim('{COUNTRY_NAME}'))))""",
)
def country_semi(t):
    return lookups.in_country(t["core_animal"], t["core_country"], COUNTRY_NAME).select("id", "country_id")


@query(
    "flag_exists",
    "core_animal core_animal_event",
    """
    select a.id, exists (select 1 from core_animal_event e where e.animal_id = a.id and e.event_type = 1) as calved
    from core_animal a""",
)
def flag_exists(t):
    calved = filters.events_of(t["core_animal_event"], reports.CALVING).select(F.col("animal_id").alias("id"))
    return lookups.flag_if_exists(t["core_animal"].select("id"), calved, "calved")


@query(
    "both_roles",
    "core_animal",
    """
    select sire_id as animal_id from core_animal where sire_id in (select dam_id from core_animal)
    union select dam_id from core_animal where dam_id in (select sire_id from core_animal)""",
)
def both_roles(t):
    return lookups.used_in_both_roles(t["core_animal"])


@query(
    "user_event_names",
    "core_animal_event core_events_type auth_users",
    """
    select e.id, u.name as technician, d.description as event from core_animal_event e
    join auth_users u on e.field_agent_id = u.id join core_events_type d on e.event_type = d.event_id""",
)
def user_event_names(t):
    names = t["core_events_type"].select(F.col("event_id").alias("event_type"), F.col("description").alias("event"))
    df = t["core_animal_event"].join(names, "event_type")
    df = lookups.with_name(df, t["auth_users"], "field_agent_id", "technician", "inner")
    return df.select("id", "technician", "event")


@query(
    "limit_lookup",
    "core_animal_event interface_limit_parameters",
    """
    select e.id,
      (select min_value from interface_limit_parameters where category = 'calving_interval')::double as low,
      (select max_value from interface_limit_parameters where category = 'calving_interval')::double as high,
      (select min_value from interface_limit_parameters where category = 'no such limit')::double as missing
    from core_animal_event e where e.event_type = 1""",
)
def limit_lookup(t):
    keys = [{"category": "calving_interval"}, {"category": "no such limit"}]
    (low, high), (missing, _) = limits(t["interface_limit_parameters"], *keys)
    calvings = filters.events_of(t["core_animal_event"], reports.CALVING)
    return calvings.select("id", low.alias("low"), high.alias("high"), missing.alias("missing"))


@query(
    "calving_age",
    "core_animal_event core_animal",
    f"""
    select e.id, {days_sql("e.event_date", "a.birthdate")} as calving_age
    from core_animal_event e join core_animal a on e.animal_id = a.id where e.event_type = 1""",
)
def calving_age(t):
    births = t["core_animal"].select(F.col("id").alias("animal_id"), "birthdate")
    df = filters.events_of(t["core_animal_event"], reports.CALVING).join(births, "animal_id")
    return df.select("id", days_between(F.col("event_date"), F.col("birthdate")).alias("calving_age"))


@query(
    "age_months",
    "core_animal_event core_animal",
    f"""
    select e.id, {months_sql("e.event_date", "a.birthdate")} as age_months
    from core_animal_event e join core_animal a on e.animal_id = a.id where e.event_type = 6""",
)
def age_in_months(t):
    births = t["core_animal"].select(F.col("id").alias("animal_id"), "birthdate")
    df = filters.events_of(t["core_animal_event"], reports.WEIGHT).join(births, "animal_id")
    return df.select("id", months_apart(F.col("event_date"), F.col("birthdate")).alias("age_months"))


@query(
    "week_of_year",
    "",
    f"""
    select o_orderkey, cast(year(o_orderdate) as integer) as "year", {week_sql("o_orderdate")} as "week" from orders""",
)
def week_of_year(t):
    day = F.to_date("o_orderdate")
    return t.raw("orders").select("o_orderkey", F.year(day).alias("year"), sunday_week(day).alias("week"))


@query(
    "date_parts",
    "",
    f"""
    select o_orderkey, cast(o_orderdate as date) as day, strftime(o_orderdate, '%Y-%m-%d') as text,
      cast(o_orderdate as date) > date '{AS_OF}' as later from orders""",
)
def date_parts(t):
    day = F.to_date("o_orderdate")
    return t.raw("orders").select(
        "o_orderkey", day.alias("day"), F.date_format(day, "yyyy-MM-dd").alias("text"), (day > F.lit(AS_OF)).alias("later")
    )


@query(
    "json_attrs",
    "core_animal_event",
    "select id, "
    + ", ".join(f"{attr_sql('additional_attributes', a)} as a{a}" for a in ("59", "61", "68", "136", "137", "139"))
    + " from core_animal_event",
)
def json_attrs(t):
    df = t["core_animal_event"].select("id", attributes(F.col("additional_attributes")).alias("attrs"))
    return df.select("id", *[attr_text(F.col("attrs"), a).alias(f"a{a}") for a in ("59", "61", "68", "136", "137", "139")])


@query(
    "milk_total_strict",
    "core_animal_event",
    f"""
    select id, round({strict_sql("additional_attributes")}, 4) as total from core_animal_event where event_type = 2""",
)
def strict_total(t):
    milk = filters.events_of(t["core_animal_event"], reports.MILK)
    total = milk_total_strict(attributes(F.col("additional_attributes")))
    return milk.select("id", F.round(total, 4).alias("total"))


@query(
    "milk_total_lenient",
    "core_animal_event",
    f"""
    select id, round({lenient_sql("additional_attributes")}, 4) as total from core_animal_event where event_type = 2""",
)
def lenient_total(t):
    milk = filters.events_of(t["core_animal_event"], reports.MILK)
    total = milk_total_lenient(attributes(F.col("additional_attributes")))
    return milk.select("id", F.round(total, 4).alias("total"))


@query(
    "capitalise",
    "",
    """
    select c_custkey, upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) as segment,
      upper(substr(c_name, 1, 1)) || lower(substr(c_name, 2)) as name from customer""",
)
def capitalised(t):
    return t.raw("customer").select(
        "c_custkey",
        capitalise(F.col("c_mktsegment")).alias("segment"),
        capitalise(F.col("c_name")).alias("name"),
    )


@query(
    "form_gps",
    "core_odk_form",
    "select form_uuid, split_part(spot, ' ', 1) as gps_latitude, split_part(spot, ' ', 2) as gps_longitude from s where spot is not null",
    """s as (select form_uuid, json_extract_string(form_data, '$.farmer_general[1]."g/Farmer_GPSLocation"') as spot
    from core_odk_form)""",
)
def form_gps(t):
    return updates.form_gps(t["core_odk_form"]).select("form_uuid", "gps_latitude", "gps_longitude")


@query(
    "period_label",
    "",
    """
    select distinct cast(o_orderdate as date) as day, strftime(o_orderdate, '%A') as day_name,
      strftime(o_orderdate, '%B %Y') as month_name from orders""",
)
def period_label(t):
    days = t.raw("orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select(
        "day", day_label(F.col("day")).alias("day_name"), month_label(F.col("day")).alias("month_name")
    )


@query(
    "fill_gps",
    "core_farm core_odk_form",
    """
    select f.id, round(case when f.latitude is null and s.latitude is not null then s.latitude else f.latitude end, 4) as latitude,
      round(case when f.latitude is null and s.latitude is not null then s.longitude else f.longitude end, 4) as longitude,
      f.latitude is null and s.latitude is not null as gps_filled
    from core_farm f left join s on f.odk_form_uuid = s.form_uuid""",
    """spots as (select form_uuid, form_version, form_data,
      json_extract_string(form_data, '$.farmer_general[1]."g/Farmer_GPSLocation"') as spot
      from core_odk_form where split_part(form_version, ' ', -1) >= '1.7'),
    s as (select form_uuid, split_part(spot, ' ', 1)::double as latitude, split_part(spot, ' ', 2)::double as longitude
      from spots where spot is not null qualify row_number() over (partition by form_uuid order by form_version, form_data) = 1)""",
)
def fill_gps(t):
    forms = filters.latest_form_version(t["core_odk_form"])
    df = updates.fill_gps(t["core_farm"], forms)
    return df.select("id", F.round("latitude", 4).alias("latitude"), F.round("longitude", 4).alias("longitude"), "gps_filled")


@query(
    "flag_inactive",
    "core_animal core_animal_event",
    f"""
    select a.id, l.last_event_date, coalesce(a.birthdate < date '{AS_OF}' - interval 3 year, false)
      or coalesce(coalesce(l.last_event_date, a.reg_date) < date '{AS_OF}' - interval 1 year, false) as inactive
    from core_animal a left join l on a.id = l.animal_id""",
    "l as (select animal_id, max(event_date) as last_event_date from core_animal_event group by animal_id)",
)
def flag_inactive(t):
    df = updates.flag_inactive(t["core_animal"], t["core_animal_event"], AS_OF, max_age_years=3, last_event_years=1)
    return df.select("id", "last_event_date", "inactive")


@query(
    "retention_keep",
    "core_animal_event",
    f"select id, created_at from core_animal_event where not coalesce(created_at < date '{AS_OF}' - 20, false)",
)
def retention_keep(t):
    keep, _ = updates.retention_split(t["core_animal_event"], "created_at", AS_OF)
    return keep.select("id", "created_at")


@query(
    "retention_archive",
    "core_animal_event",
    f"select id, created_at from core_animal_event where created_at < date '{AS_OF}' - 20",
)
def retention_archive(t):
    _, archive = updates.retention_split(t["core_animal_event"], "created_at", AS_OF)
    path = shared_path(t.spark, "archive")
    refresh(archive.select("id", "created_at"), path)
    return read_current(t.spark, path, "id bigint, created_at date")


@query(
    "retention_two_runs",
    "core_animal_event",
    f"""
    select id, created_at, created_at < date '{AS_OF}' - 10 as archived,
      case when created_at < date '{AS_OF}' - 20 then '{AS_OF}' else '{AS_OF + dt.timedelta(days=10)}' end as run_day
    from core_animal_event where created_at is not null""",
)
def retention_two_runs(t):
    out = shared_path(t.spark, "retention")
    rows = t["core_animal_event"].select("id", "created_at").filter(F.col("created_at").isNotNull())
    where = retention_run(rows, out, "created_at", AS_OF)
    later = AS_OF + dt.timedelta(days=10)
    for _ in range(2):  # a repeated run replaces itself
        rows = t.spark.read.schema("id bigint, created_at date").parquet(where["kept"])
        second = retention_run(rows, out, "created_at", later)
    archive = t.spark.read.schema("id bigint, created_at date, run_day string").parquet(second["archive"])
    kept = t.spark.read.schema("id bigint, created_at date").parquet(second["kept"]).withColumn("run_day", F.lit(str(later)))
    return kept.withColumn("archived", F.lit(False)).unionByName(archive.withColumn("archived", F.lit(True)))


@query(
    "retention_counts",
    "core_animal_event",
    f"""
    select count(*) filter (created_at >= date '{AS_OF}' - 20) as kept,
      count(*) filter (created_at < date '{AS_OF}' - 20) as archived from core_animal_event""",
)
def retention_counts(t):
    return updates.retention_counts(t["core_animal_event"], "created_at", AS_OF)
