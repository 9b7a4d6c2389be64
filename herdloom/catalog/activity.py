"""Activity reports and dashboard tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from herdloom import plans
from herdloom.catalog.base import END, MONITORED, START, attr_sql, label_sql, name_sql, query, strict_sql, week_sql
from herdloom.operators import reports
from herdloom.plans import dataflow

PERIOD_SQL = f"between date '{START}' and date '{END}'"
ACTIVITY_VIEWS = "core_animal_event core_animal core_farm core_events_type auth_users core_country"

UNION_SQL = f"""recorded as (
  select id, country_id, coalesce(field_agent_id, created_by) as user_id, event_type, created_at,
    case event_type when 18 then false when 2 then {strict_sql("additional_attributes")} > 0 else true end as counts from core_animal_event
  union all by name select id, country_id, created_by as user_id, 100 as event_type, created_at, created_by is not null as counts
    from core_animal where country_id is not null
  union all by name select id, country_id, coalesce(field_agent_id, created_by) as user_id, 101 as event_type, created_at, true as counts
    from core_farm where country_id is not null),
u as (select distinct id, country_id, user_id, event_type from recorded where counts and created_at {PERIOD_SQL})"""

ACTIVITY_SQL = f"""{UNION_SQL},
tally as (select country_id, user_id, event_type, count(id) as total from u group by all),
flow as (from (select {name_sql("core_country", "country_id")} as country, {name_sql("auth_users", "user_id")} as enumerator,
    (select kind.description from core_events_type kind where kind.event_id = event_type) as event, total from tally)
  where country is not null and enumerator is not null and event is not null)"""

PEOPLE_SQL = f"""{ACTIVITY_SQL},
named as (select country, upper(substr(enumerator, 1, 1)) || lower(substr(enumerator, 2)) as enumerator, event, total from flow),
sums as (select country, enumerator, cast(sum(total) as bigint) as records from named group by country, enumerator)"""


def _union(t):
    return reports.activity_union(t["core_animal_event"], t["core_animal"], t["core_farm"], START, END)


def _activity(t):
    return reports.activity_counts(_union(t), t["core_events_type"], t["auth_users"], t["core_country"])


def _pivot_sql(values, column: str = "event", type_: str = "bigint", other: bool = True) -> str:
    """A column per value from one row per cell, and the sum of all other cells."""
    cells = [(f"{column} = '{v}'", v) for v in values]
    if other:
        listed = ", ".join(f"'{v}'" for v in values)
        cells.append((f"{column} is null or {column} not in ({listed})", "Other"))
    return ", ".join(f"""coalesce(cast(sum(cell) filter (where {c}) as {type_}), 0) as "{v}\"""" for c, v in cells)


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 4) for c in columns})


@query(
    "activity_union",
    ACTIVITY_VIEWS,
    "select id, country_id, user_id, cast(event_type as integer) as event_type from u",
    UNION_SQL,
)
def activity_union(t):
    return _union(t)


@query("activity_counts", ACTIVITY_VIEWS, "select * from flow", ACTIVITY_SQL)
def activity_counts(t):
    return _activity(t)



def _registered_sql(table: str, kind: str, code_list: int, known: str) -> str:
    """Registrations of a period per country and kind: counted by ids, then named."""
    return f"""tally as (select country_id, {kind} as code, count(id) as total from {table}
  where created_at {PERIOD_SQL} and {known} is not null group by all),
reg as (from (select {name_sql("core_country", "country_id")} as country, {label_sql(code_list, "code")} as {kind}, total from tally)
  where country is not null and {kind} is not null)"""


ANIMAL_REG_SQL = _registered_sql("core_animal", "animal_type", 62, "created_by")
FARM_REG_SQL = _registered_sql("core_farm", "farm_type", 2, "field_agent_id")

ANIMAL_LABELS = ["Heifer", "Cow", "Male calf", "Female calf", "Bull", "Straw"]
FARM_LABELS = ["Small", "Medium", "Large"]


@query("animal_reg_by_type", "core_animal core_country core_master_list", "select * from reg", ANIMAL_REG_SQL)
def animal_reg_by_type(t):
    return reports.animal_registrations(t["core_animal"], t["core_country"], t["core_master_list"], START, END)


@query("farm_reg_by_type", "core_farm core_country core_master_list", "select * from reg", FARM_REG_SQL)
def farm_reg_by_type(t):
    return reports.farm_registrations(t["core_farm"], t["core_country"], t["core_master_list"], START, END)


@query(
    "animal_type_pivot",
    "core_animal core_country core_master_list",
    f"""select country, {_pivot_sql(ANIMAL_LABELS, 'animal_type', 'double')}
    from (select country, animal_type, avg(total) as cell from reg group by all) group by country""",
    ANIMAL_REG_SQL,
)
def animal_type_pivot(t):
    return reports.type_pivot(animal_reg_by_type(t), "animal_type", ANIMAL_LABELS)


@query(
    "farm_type_pivot",
    "core_farm core_country core_master_list",
    f"""select country, {_pivot_sql(FARM_LABELS, 'farm_type', 'double')}
    from (select country, farm_type, avg(total) as cell from reg group by all) group by country""",
    FARM_REG_SQL,
)
def farm_type_pivot(t):
    return reports.type_pivot(farm_reg_by_type(t), "farm_type", FARM_LABELS)


@query(
    "registration_pivot",
    ACTIVITY_VIEWS,
    f"""
    select country, {_pivot_sql(reports.REGISTRATIONS, other=False)} from (select country, event, total as cell from flow)
    where event in ('Animal-Reg', 'Farmer-Reg') group by country""",
    ACTIVITY_SQL,
)
def registration_pivot(t):
    return reports.registration_pivot(_activity(t))


@query(
    "monitoring_pivot",
    ACTIVITY_VIEWS,
    f"""
    select country, {_pivot_sql(MONITORED)} from (select country, event, total as cell from flow)
    where event not in ('Animal-Reg', 'Farmer-Reg') group by country""",
    ACTIVITY_SQL,
)
def monitoring_pivot(t):
    return reports.monitoring_pivot(_activity(t), MONITORED)


ALL_EVENTS = [*reports.REGISTRATIONS, *MONITORED]


@query(
    "enumerator_pivot",
    ACTIVITY_VIEWS,
    "select country, enumerator, "
    + ", ".join(f"""round("{v}", 4) as "{v}\"""" for v in [*ALL_EVENTS, "Other"])
    + f""" from (select country, enumerator, {_pivot_sql(ALL_EVENTS, type_='double')} from (
      select country, enumerator, event, avg(total) as cell from named group by all) group by all)""",
    PEOPLE_SQL,
)
def enumerator_pivot(t):
    return _rounded(reports.enumerator_pivot(_activity(t), ALL_EVENTS), *ALL_EVENTS, "Other")


@query(
    "pivot_other_events",
    ACTIVITY_VIEWS,
    f"""
    select country, {_pivot_sql(MONITORED[:2])} from (select country, event, total as cell from flow)
    where event not in ('Animal-Reg', 'Farmer-Reg') group by country""",
    ACTIVITY_SQL,
)
def pivot_other_events(t):
    return reports.monitoring_pivot(_activity(t), MONITORED[:2])


@query(
    "event_totals",
    ACTIVITY_VIEWS,
    "select event, country, cast(sum(total) as bigint) as total from flow group by event, country",
    ACTIVITY_SQL,
)
def event_totals(t):
    return reports.event_totals(_activity(t))


def _top_sql(direction: str) -> str:
    return f"""
    select country, enumerator, records, cast(dense_rank() over (partition by country order by records desc) as integer) as rank
    from (select *, row_number() over (partition by country order by records {direction}, enumerator) as place from sums)
    where place <= 5"""


@query("top_enumerators", ACTIVITY_VIEWS, _top_sql("desc"), PEOPLE_SQL)
def top_enumerators(t):
    return reports.top_n(_activity(t))


@query("bottom_enumerators", ACTIVITY_VIEWS, _top_sql("asc"), PEOPLE_SQL)
def bottom_enumerators(t):
    return reports.bottom_n(_activity(t))


BY_AGENT = f"field_agent_id is not null and created_at {PERIOD_SQL}"

MILK_SQL = f"""milked as (select animal_id, created_at as milk_date, {strict_sql("additional_attributes")} as total
  from core_animal_event where event_type = 2 and {BY_AGENT}),
lands as (select id as farm_id, {name_sql("core_country", "country_id")} as country from core_farm),
kept_on as (select id as animal_id, country from core_animal join lands using (farm_id) where country is not null),
rows_ as (select country, milk_date, total from milked join kept_on using (animal_id) where total > 0)"""
MILK_VIEWS = "core_animal_event core_animal core_farm core_country"

WEIGHT_SQL = f"""rows_ as (from (select {name_sql("core_country", "country_id")} as country, created_at as weight_date,
    try_cast({attr_sql("additional_attributes", "136")} as double) as total from core_animal_event where event_type = 6 and {BY_AGENT})
  where country is not null)"""
WEIGHT_VIEWS = "core_animal_event core_country"

STATS_SQL = """
    select country, count(total) as "count", round(max(total), 4) as "max", round(min(total), 4) as "min", round(median(total), 4) as median,
      round(avg(total), 4) as avg, round(stddev_samp(total), 4) as std from rows_ group by country"""


@query("dataflow_milk_rows", MILK_VIEWS, "select country, milk_date, round(total, 4) as total from rows_", MILK_SQL)
def dataflow_milk_rows(t):
    return _rounded(dataflow.milk_rows(t, START, END), "total")


@query("dataflow_weight_rows", WEIGHT_VIEWS, "select country, weight_date, round(total, 4) as total from rows_", WEIGHT_SQL)
def dataflow_weight_rows(t):
    return _rounded(dataflow.weight_rows(t, START, END), "total")


@query("milk_stats", MILK_VIEWS, STATS_SQL, MILK_SQL)
def milk_stats(t):
    stats = reports.describe_by(dataflow.milk_rows(t, START, END), "country", "total")
    return _rounded(stats, "max", "min", "median", "avg", "std")


@query("weight_stats", WEIGHT_VIEWS, STATS_SQL, WEIGHT_SQL)
def weight_stats(t):
    stats = reports.describe_by(dataflow.weight_rows(t, START, END), "country", "total")
    return _rounded(stats, "max", "min", "median", "avg", "std")


@query(
    "yield_by_breed_region",
    "core_animal_event core_animal country_units core_master_list",
    "select region, breed, round(avg(cow_mean), 2) as average_milk from cows where region is not null and breed is not null group by all",
    f"""means as (select animal_id, avg({strict_sql("additional_attributes", False)}) as cow_mean from core_animal_event
      where event_type = 2 and event_date >= date '2016-01-01' group by animal_id),
    cows as (select {name_sql("country_units", "region_id")} as region, {label_sql(8, "main_breed")} as breed, cow_mean
      from means, core_animal where id = animal_id)""",
)
def yield_by_breed_region(t):
    return plans.yield_by_breed_region(t)


@query(
    "herds_by_year_type",
    "core_farm core_master_list",
    f"""
    select "year", {label_sql(2, "code", "description")} as farm_type, farms from (
      select cast(year(reg_date) as integer) as "year", farm_type as code, count(id) as farms from core_farm group by all)
    where "year" >= 2016 and exists (select 1 from core_master_list where list_type_id = 2 and value = code)""",
)
def herds_by_year_type(t):
    return plans.herds_by_year_type(t)


@query(
    "animals_by_region",
    "core_animal country_units",
    """
    select name as region, cast(sum(animals) as bigint) as animals from dated join country_units using (id) group by name""",
    "dated as (select region_id as id, count(id) as animals from core_animal where reg_date >= date '2016-01-01' group by region_id)",
)
def animals_by_region(t):
    return plans.animals_by_region(t)


@query(
    "inseminations_by_week",
    "core_animal_event country_units auth_users",
    f"""
    select region, technician, "year", "week", cast(sum(n) as bigint) as inseminations from (
      select {name_sql("country_units", "region_id")} as region, {name_sql("auth_users", "field_agent_id")} as technician,
        cast(year(event_date) as integer) as "year", {week_sql("event_date")} as "week", n
      from (select region_id, field_agent_id, event_date, count(id) as n from core_animal_event where event_type = 3 group by all))
    where region is not null and technician is not null and "year" >= 2016 group by all""",
)
def inseminations_by_week(t):
    return plans.inseminations_by_week(t)
