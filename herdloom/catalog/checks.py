"""Rule-checked extracts and single rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdloom.catalog.base import (
    AS_OF,
    COUNTRY,
    COUNTRY_NAME,
    LONG_END,
    LONG_START,
    attr_sql,
    days_sql,
    label_sql,
    months_sql,
    name_sql,
    num_sql,
    places_sql,
    query,
    week_sql,
)
from herdloom.functions import sunday_week
from herdloom.operators import rules
from herdloom.plans import lactation, pedigree, weight
from herdloom.plans.runs import quality_checks, quality_log_run
from herdloom.sources import shared_path, split_valid_error

NAMES_VIEWS = "core_country country_units core_master_list"
LACTATION_VIEWS = f"core_animal_event core_animal core_farm {NAMES_VIEWS} interface_limit_parameters"
WEIGHT_VIEWS = (
    f"core_animal_event core_animal {NAMES_VIEWS} interface_limit_parameters interface_graduation_settings"
)
PEDIGREE_VIEWS = f"core_animal_event core_animal core_farm {NAMES_VIEWS} core_organization"


def _text_sql(checks: list[tuple[str, str]]) -> str:
    """Messages of the rules that fire, each after a separator; NULL without any."""
    parts = " || ".join(f"case when {c} then ' | {m}' else '' end" for c, m in checks)
    return f"nullif({parts}, '')"


def _period_sql(day: str, start: str = LONG_START, end: str = LONG_END) -> str:
    return f"{day} >= date '{start}' and {day} <= date '{end}'"


def lactation_sql(country: int | None, period: str = _period_sql("event_date")) -> str:
    only = "" if country is None else f"where country_id = {country}"
    earlier = "partition by animal_id order by calving_date, lactation_id rows between unbounded preceding and 1 preceding"
    later = "partition by animal_id order by calving_date, lactation_id rows between 1 following and unbounded following"
    before = "partition by animal_id order by calving_date range between unbounded preceding and interval 1 day preceding"
    return f"""farms as (select id as farm_id, farmer_name as farm_name, country_id, round(longitude, 4) as longitude,
    round(latitude, 4) as latitude, {name_sql("core_country", "country_id")} as country, {places_sql()} from core_farm {only}),
cows as (select id as animal_id, farm_id, tag_id, birthdate, animal_type as animal_type_id, coalesce(reg_date, created_at) as animal_registration_date,
    coalesce({label_sql(8, "main_breed")}, 'Unknown') as main_breed, {label_sql(3, "sex")} as animal_sex, {label_sql(62, "animal_type")} as animal_type
  from core_animal where animal_type <> 6 and farm_id in (select farm_id from farms)),
calved as (select animal_id, id as lactation_id, event_date as calving_date from core_animal_event
  where event_type = 1 and {period} and animal_id in (select animal_id from cows)),
timed as (select *, max(calving_date) over ({earlier}) as previous_calving_date, min(calving_date) over ({later}) as subsequent_calving_date,
    cast(1 + count(*) over ({before}) as integer) as parity from calved),
twice as (select animal_id, calving_date, count(*) as copies from calved group by all),
staged as (select *, {days_sql("calving_date", "birthdate")} as calving_age, {days_sql("calving_date", "previous_calving_date")} as calving_interval
  from timed join twice using (animal_id, calving_date) join cows using (animal_id) join farms using (farm_id)),
lims as (select max(min_value) filter (where category = 'calving_interval') as low, max(max_value) filter (where category = 'calving_interval') as high,
    30 * max(coalesce(min_value, 18)) filter (where category = 'age_at_first_calving') as first_age from interface_limit_parameters),
checked as (select *, {_text_sql(list(LACTATION_CHECKS.values()))} as comments from staged, lims)"""


# Rule name -> (condition, message). The messages are fixed values, written out here on their own.
LACTATION_CHECKS = {
    "calving_duplicate": ("copies > 1", "Duplicate Record"),
    "calved_before_birth": ("birthdate > calving_date", "Calved Before Birth"),
    "future_calving": (f"calving_date > date '{AS_OF}'", "Future Calving Date"),
    "calving_interval": ("parity > 1 and not (calving_interval between low and high)", "Invalid Calving Interval"),
    "calving_age": ("calving_age < first_age", "Invalid Calving Age"),
    "animal_type": ("animal_type_id is not null and animal_type_id not in (1, 2)", "Invalid Animal Type"),
}

LACTATION_OUT = ", ".join(lactation.COLUMNS)


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in ("longitude", "latitude")})


def _lactation(t, country=None):
    return _rounded(lactation.lactation_extract(t, LONG_START, LONG_END, AS_OF, country))


def _lactation_query(name: str, country: int | None):
    @query(
        name,
        LACTATION_VIEWS,
        f"select {LACTATION_OUT}, lactation_id, comments, case when comments is null then 1 else 0 end as status from checked",
        lactation_sql(country),
    )
    def build(t):
        return _lactation(t, country)


_lactation_query("lactation_extract", None)
_lactation_query("lactation_extract_country", COUNTRY)


@query(
    "split_valid",
    LACTATION_VIEWS,
    f"select {LACTATION_OUT}, lactation_id from checked where comments is null",
    lactation_sql(None),
)
def split_valid(t):
    return split_valid_error(_lactation(t))[0]


@query(
    "split_error",
    LACTATION_VIEWS,
    f"select {LACTATION_OUT}, lactation_id, comments from checked where comments is not null",
    lactation_sql(None),
)
def split_error(t):
    return split_valid_error(_lactation(t))[1]


@query(
    "rule_engine",
    LACTATION_VIEWS,
    "select lactation_id, comments, case when comments is null then 1 else 0 end as status from checked",
    lactation_sql(None),
)
def rule_engine(t):
    return _lactation(t).select("lactation_id", "comments", "status")


def _rule_query(name: str, views: str, ctes: str, checks: dict, names: list[str], key: str, channel: str, build):
    """Rows on which the named rules fire, over all countries."""
    text = _text_sql([checks[n] for n in names])
    # The full text of all rules comes from the same conditions, so a subset is checked by its own text.
    body = f"select {key}, {text} as {channel} from staged, lims where {text} is not null"

    @query(name, views, body, ctes)
    def run(t):
        staged, all_rules = build(t)
        chosen = [r for r in all_rules if r.name in names]
        fired = rules.apply_rules(staged, chosen).filter(F.col("status") == 0)
        return fired.select(key, F.col(chosen[0].channel).alias(channel))


def _lactation_rules(t):
    staged = lactation.lactation_staged(t, LONG_START, LONG_END)
    return staged, lactation.lactation_rules(t["interface_limit_parameters"], AS_OF)


for _name, _rules in {
    "rule_calving_dup": ["calving_duplicate"],
    "rule_calving_dates": ["calved_before_birth", "future_calving"],
    "rule_calving_interval": ["calving_interval"],
    "rule_calving_age": ["calving_age"],
    "rule_animal_type": ["animal_type"],
}.items():
    _rule_query(
        _name, LACTATION_VIEWS, lactation_sql(None), LACTATION_CHECKS, _rules, "lactation_id", "comments", _lactation_rules
    )


WEIGHT_CHECKS = {
    "weight_duplicate": ("copies > 1", "Duplicate Record"),
    "weighed_before_birth": ("birthdate > weight_date", "Weight Recorded Before Animal Was Born"),
    "future_weight": (f"weight_date > date '{AS_OF}'", "Weight Date Is In The Future"),
    "nothing_measured": ("heart_girth is null and body_weight is null", "Both Heart Girth & Weight are Null"),
    "girth_any_age": ("birthdate is null and not (girth_value between calf_girth_min and mature_girth_max)", "Heart Girth Out Of Range"),
    "girth_calf": (
        "age_at_weighing <= calf_age and not (girth_value between calf_girth_min and calf_girth_max)",
        "Heart Girth Out Of Range(Considered age at weighing)",
    ),
    "girth_mature": (
        "age_at_weighing > calf_age and not (girth_value between mature_girth_min and mature_girth_max)",
        "Heart Girth Out Of Range(Considered age at weighing)",
    ),
    "weight_any_age": ("birthdate is null and not (weight_value between calf_weight_min and mature_weight_max)", "Body Weight Out Of Range"),
    "weight_calf": (
        "age_at_weighing <= calf_age and not (weight_value between calf_weight_min and calf_weight_max)",
        "Body Weight Out Of Range(Considered age at weighing)",
    ),
    "weight_mature": (
        "age_at_weighing > calf_age and not (weight_value between mature_weight_min and mature_weight_max)",
        "Body Weight Out Of Range(Considered age at weighing)",
    ),
    "gps_range": (
        "longitude is not null and latitude is not null and (longitude not between -180 and 180 or latitude not between -180 and 180)",
        "GPS Out Of Range",
    ),
    "no_gps": ("longitude is null or latitude is null", "No GPS Details"),
}

WEIGHT_OUT = ", ".join(
    f"round({c}, 4) as {c}" if c in ("longitude", "latitude") else c for c in weight.COLUMNS
)


def weight_sql(country: int | None, period: str = _period_sql("event_date")) -> str:
    only = "" if country is None else f"where country_id = {country}"
    girth, mass = attr_sql("additional_attributes", "137"), attr_sql("additional_attributes", "136")
    bounds = ", ".join(
        f"max(case when id = {i} then {end}_value end) as {name}_{end}"
        for i, name in ((5, "mature_girth"), (6, "mature_weight"), (7, "calf_weight"), (8, "calf_girth"))
        for end in ("min", "max")
    )
    return f"""animals as (select id as animal_id, tag_id, birthdate, longitude, latitude, country_id, coalesce(reg_date, created_at) as registration_date,
    coalesce({label_sql(8, "main_breed")}, 'Unknown') as main_breed, {label_sql(3, "sex")} as sex, {label_sql(62, "animal_type")} as animal_type,
    {name_sql("core_country", "country_id")} as country, {places_sql()} from core_animal {only}),
weighed as (select animal_id, id as weight_id, event_date as weight_date, {girth} as heart_girth, {mass} as body_weight
  from core_animal_event where event_type = 6 and {period} and animal_id in (select animal_id from animals)),
twice as (select animal_id, weight_date, count(*) as copies from weighed group by all),
staged as (select *, {months_sql("weight_date", "birthdate")} as age_at_weighing, {num_sql("heart_girth")} as girth_value,
    {num_sql("body_weight")} as weight_value
  from weighed join twice using (animal_id, weight_date) join animals using (animal_id)),
lims as (select {bounds}, (select graduation_value from interface_graduation_settings where id = 1) as calf_age
  from interface_limit_parameters),
checked as (select *, {_text_sql(list(WEIGHT_CHECKS.values()))} as comments from staged, lims)"""


def _weight_query(name: str, country: int | None):
    @query(
        name,
        WEIGHT_VIEWS,
        f"select {WEIGHT_OUT}, weight_id, comments, case when comments is null then 1 else 0 end as status from checked",
        weight_sql(country),
    )
    def build(t):
        return _rounded(weight.weight_extract(t, LONG_START, LONG_END, AS_OF, country))


_weight_query("weight_extract", None)
_weight_query("weight_extract_country", COUNTRY)


@query(
    "age_class",
    WEIGHT_VIEWS,
    """
    select weight_id, age_at_weighing, case when age_at_weighing <= calf_age then 'calf'
      when age_at_weighing > calf_age then 'mature' else 'unknown' end as age_class from staged, lims""",
    weight_sql(None),
)
def age_class(t):
    return weight.weight_staged(t, LONG_START, LONG_END).select("weight_id", "age_at_weighing", "age_class")


def _weight_rules(t):
    staged = weight.weight_staged(t, LONG_START, LONG_END)
    return staged, weight.weight_rules(t["interface_limit_parameters"], AS_OF)


for _name, _rules in {
    "rule_weight_dup": ["weight_duplicate"],
    "rule_weight_dates": ["weighed_before_birth", "future_weight"],
    "rule_weight_null": ["nothing_measured"],
    "rule_girth": ["girth_any_age", "girth_calf", "girth_mature"],
    "rule_weight": ["weight_any_age", "weight_calf", "weight_mature"],
    "rule_gps": ["gps_range", "no_gps"],
}.items():
    _rule_query(_name, WEIGHT_VIEWS, weight_sql(None), WEIGHT_CHECKS, _rules, "weight_id", "comments", _weight_rules)


@query(
    "duplicate_keys",
    "core_animal_event",
    """
    select animal_id, event_date, count(*) as copies from core_animal_event
    where event_type = 6 and animal_id is not null and event_date is not null
    group by animal_id, event_date having count(animal_id) > 1""",
)
def duplicate_keys(t):
    weighings = t["core_animal_event"].filter(F.col("event_type") == 6)
    return rules.duplicate_keys(weighings, "animal_id", "event_date")


PEDIGREE_CHECKS = {
    "tag_duplicate": ("copies > 1 and tag_id is not null", "Duplicate Record"),
    "sex_missing": ("recorded_sex is null", "No or Estimated Sex Details"),
    "both_roles": ("as_sire and as_dam", "Bisexual(Used As Dam and Sire)"),
    "registered_before_birth": ("birthdate > reg_date", "Registered Before Birth"),
    "own_grandsire": ("animal_id = grand_sire_id", "Progeny Is Its Own Grand Sire"),
    "older_than_sire": ("birthdate < sire_birthdate", "Animal Older Than Its Sire"),
    "male_dam": ("sex_id = 1 and as_dam", "Male Animal Used As A Dam"),
    "dam_missing": ("dam_tag_id is not null and dam_id is null", "Dam Details Not Found"),
    "female_sire": ("sex_id = 2 and as_sire", "Female Animal Used As A Sire"),
    "sire_missing": ("sire_tag_id is not null and sire_id is null", "Sire Details Not Found"),
    "own_parent": ("sire_id = animal_id or dam_id = animal_id", "Own Parent"),
}
WARNINGS = ("sex_missing", "registered_before_birth", "older_than_sire", "dam_missing", "sire_missing")


def _pedigree_sql(country_name: str | None) -> str:
    plain = lambda text: f"strip_accents(lower(rtrim({text})))"
    only = "" if country_name is None else (
        f"""where exists (select 1 from core_country named where named.id = country_id and {plain("named.name")} = {plain(f"'{country_name}'")})"""
    )
    of_parent = lambda column, key: f"(select parent.{column} from core_animal parent where parent.id = herd.{key})"
    warnings = _text_sql([c for n, c in PEDIGREE_CHECKS.items() if n in WARNINGS])
    errors = _text_sql([c for n, c in PEDIGREE_CHECKS.items() if n not in WARNINGS])
    return f"""homes as (select id as farm_id, country_id, farmer_name, org_id, project, round(longitude, 4) as longitude, round(latitude, 4) as latitude,
    {name_sql("core_organization", "org_id")} as organization_name, {name_sql("core_country", "country_id")} as country, {places_sql()} from core_farm),
herd as (select id as animal_id, farm_id, tag_id, original_tag_id, sire_id, dam_id, sire_tag_id as noted_sire, dam_tag_id as noted_dam, sex as sex_id,
    {label_sql(3, "sex")} as recorded_sex, {label_sql(8, "main_breed")} as breed, reg_date, birthdate, main_breed from core_animal {only}),
parts as (select sire_id as animal_id, true as sired from core_animal union all select dam_id, false from core_animal),
roles as (select animal_id, bool_or(sired) as as_sire, bool_or(not sired) as as_dam from parts where animal_id is not null group by animal_id),
tags as (select tag_id, count(*) as copies from herd where tag_id is not null group by tag_id),
extracted as (select herd.*, homes.* exclude (farm_id), coalesce(tags.copies, 1) as copies, coalesce(roles.as_sire, false) as as_sire,
    coalesce(roles.as_dam, false) as as_dam, coalesce({of_parent("tag_id", "sire_id")}, noted_sire) as sire_tag_id,
    coalesce({of_parent("tag_id", "dam_id")}, noted_dam) as dam_tag_id, {of_parent("birthdate", "sire_id")} as sire_birthdate,
    {of_parent("sire_id", "sire_id")} as grand_sire_id
  from herd left join homes using (farm_id) left join tags using (tag_id) left join roles using (animal_id)),
hints as (select animal_id, country_id, 3 as weight from core_animal_event where event_type between 1 and 5
  union all select sire_id, country_id, 2 from extracted union all select dam_id, country_id, 1 from extracted),
best as (select animal_id, country_id, max(weight) as weight from hints group by all),
staged as (select extracted.*, case when recorded_sex is null then case best.weight when 2 then 'Male' when 3 then 'Female' when 1 then 'Female' end end as estimated_sex,
    coalesce(recorded_sex, case best.weight when 2 then 'Male' when 3 then 'Female' when 1 then 'Female' end) as sex
  from extracted left join best using (animal_id, country_id)),
lims as (select 1 as one),
checked as (select *, {warnings} as warning, {errors} as error from staged)"""


PEDIGREE_OUT = ", ".join(pedigree.COLUMNS)


def _pedigree_query(name: str, country_name: str | None):
    @query(
        name,
        PEDIGREE_VIEWS,
        f"""
        select {PEDIGREE_OUT}, warning, error, case when warning is null and error is null then 1 else 0 end as status
        from checked""",
        _pedigree_sql(country_name),
    )
    def build(t):
        return _rounded(pedigree.pedigree_extract(t, country_name))


_pedigree_query("pedigree_extract", None)
_pedigree_query("pedigree_extract_country", COUNTRY_NAME)


@query(
    "derive_sex",
    PEDIGREE_VIEWS,
    "select animal_id, recorded_sex, sex, estimated_sex from staged",
    _pedigree_sql(None),
)
def derive_sex(t):
    return pedigree.pedigree_staged(t).select("animal_id", "recorded_sex", "sex", "estimated_sex")


def _pedigree_rules(t):
    return pedigree.pedigree_staged(t), pedigree.pedigree_rules()


for _name, _rules, _channel in (
    ("rule_tag_dup", ["tag_duplicate"], "error"),
    ("rule_sex_missing", ["sex_missing"], "warning"),
    ("rule_both_roles", ["both_roles"], "error"),
    ("rule_reg_before_birth", ["registered_before_birth"], "warning"),
    ("rule_grandsire", ["own_grandsire"], "error"),
    ("rule_older_than_sire", ["older_than_sire"], "warning"),
    ("rule_parent_sex", ["male_dam", "female_sire"], "error"),
    ("rule_parent_missing", ["dam_missing", "sire_missing"], "warning"),
    ("rule_own_parent", ["own_parent"], "error"),
):
    _rule_query(_name, PEDIGREE_VIEWS, _pedigree_sql(None), PEDIGREE_CHECKS, _rules, "animal_id", _channel, _pedigree_rules)


def _rates_sql(staged: str, checks: dict, day: str, by: str = "country_id, country") -> str:
    """Error rates of a rule set per week: every rule judged on every row, then counted."""
    judged = ", ".join(f"coalesce({condition}, false) as {name}" for name, (condition, _) in checks.items())
    return (
        f"""{staged},
judged as (select {by}, cast(year({day}) as integer) as report_year, {week_sql(day)} as report_week, {judged} from staged, lims),
long as (unpivot judged on {", ".join(checks)} into name rule value fires),
rates as (select * exclude (fires), count(*) as total_records, count(*) filter (where fires) as total_error_records from long group by all)"""
    )


def _weekly(staged: DataFrame, all_rules, day: str) -> DataFrame:
    weeks = {"report_year": F.year(day), "report_week": sunday_week(F.col(day))}
    return rules.error_rates(staged.withColumns(weeks), all_rules, ["country_id", "country", "report_year", "report_week"])


RATES_OUT = """
    select country, report_year, report_week, rule, total_records, total_error_records,
      round(100.0 * total_error_records / total_records, 2) as error_rate from rates"""
LACTATION_RATES = _rates_sql(lactation_sql(None), LACTATION_CHECKS, "calving_date")


@query("error_rates", LACTATION_VIEWS, RATES_OUT, LACTATION_RATES)
def error_rates(t):
    return _weekly(*_lactation_rules(t), "calving_date").drop("country_id")


@query("error_rates_weight", WEIGHT_VIEWS, RATES_OUT, _rates_sql(weight_sql(None), WEIGHT_CHECKS, "weight_date"))
def error_rates_weight(t):
    return _weekly(*_weight_rules(t), "weight_date").drop("country_id")


@query("error_rates_pedigree", PEDIGREE_VIEWS, RATES_OUT, _rates_sql(_pedigree_sql(None), PEDIGREE_CHECKS, "reg_date"))
def error_rates_pedigree(t):
    return _weekly(*_pedigree_rules(t), "reg_date").drop("country_id")


@query(
    "quality_report",
    LACTATION_VIEWS,
    """
    select country, rule as quality_check, total_records, total_error_records,
      round(100.0 * total_error_records / total_records, 2) as error_rate
    from rates where report_year = 2024 and report_week = 2 and country_id <> 3""",
    LACTATION_RATES,
)
def quality_report(t):
    names = list(LACTATION_CHECKS)
    checks = t.spark.createDataFrame(list(enumerate(names)), "id bigint, quality_check string")
    ids = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("rule")) - 1
    rates = _weekly(*_lactation_rules(t), "calving_date").drop("country")
    deleted = F.when(F.col("country_id") == 3, 1).otherwise(0)
    logged = rates.withColumns({"quality_check": ids, "deleted": deleted})
    return rules.quality_report(logged, checks, t["core_country"], 2024, 2)


#: Whole weeks that the periods of the log touch.
LOG_START, LOG_END = "2023-12-31", "2024-01-27"
LOG_WEEKS = {
    "lactation": _rates_sql(lactation_sql(None, "true"), LACTATION_CHECKS, "calving_date"),
    "weight": _rates_sql(weight_sql(None, _period_sql("event_date", LOG_START, LOG_END)), WEIGHT_CHECKS, "weight_date"),
    "pedigree": _rates_sql(_pedigree_sql(None), PEDIGREE_CHECKS, "reg_date"),
}
LOG_YEARS = "(report_year = 2023 and report_week = 53 or report_year = 2024 and report_week between 0 and 3)"


@query(
    "quality_log",
    f"{PEDIGREE_VIEWS} interface_limit_parameters interface_graduation_settings",
    " union all ".join(
        f"""
    select '{rule_set}' as rule_set, cast(country_id as bigint) as country_id, rule, total_records, total_error_records,
      round(100.0 * total_error_records / total_records, 2) as error_rate, report_year, report_week
    from (with {rates} select * from rates where {LOG_YEARS})"""
        for rule_set, rates in LOG_WEEKS.items()
    ),
)
def quality_log(t):
    """Two periods, one within a week of both, and the first again: as if logged once over all weeks."""
    path = shared_path(t.spark, "quality")
    for start, end in (("2023-12-31", "2024-01-11"), ("2024-01-12", LONG_END), ("2024-01-10", "2024-01-17"), ("2023-12-31", "2024-01-11")):
        where = quality_log_run(t, path, start, end, AS_OF)
    schema = (
        "country_id bigint, quality_check int, total_records bigint, total_error_records bigint, error_rate double, "
        "rule_set string, report_year int, report_week int"
    )
    names = quality_checks(t, AS_OF).select(F.col("quality_check").alias("rule"), F.col("id").alias("quality_check"))
    return t.spark.read.schema(schema).parquet(where).join(names, "quality_check").drop("quality_check")
