"""The herd tables as views over the test tables.

``VIEW_SQL`` gives each view for the SQL checks; :class:`Tables` builds the same views as DataFrames.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from herdloom.session import SETTINGS
from herdloom.sources import read_table

RAW = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Small tables the test data has no counterpart for, as (columns, rows).
SMALL = {
    "auth_users": (
        "id bigint, name string",
        [(0, "ann lee"), (1, "BEN OKO"), (2, "cara"), (3, "Dan"), (4, "Ann LEE"), (5, "eve"), (6, "fay")],
    ),
    "core_events_type": (
        "event_id int, description string",
        [(1, "Calving"), (2, "Milking"), (3, "Insemination"), (6, "Weight"), (100, "Animal-Reg"), (101, "Farmer-Reg")],
    ),
    "core_master_list": (
        "list_type_id int, value int, label string, description string",
        [
            (2, 1, "Small", "Small holder"),
            (2, 2, "Medium", "Medium holder"),
            (2, 3, "Large", "Large holder"),
            (3, 1, "Male", "Male"),
            (3, 2, "Female", "Female"),
            (8, 1, "Ayrshire", "A"),
            (8, 2, "Friesian", "F"),
            (8, 3, "Jersey", "J"),
            (8, 4, "Sahiwal", "S"),
            (8, 5, "Boran", "B"),
            (62, 1, "Heifer", "H"),
            (62, 2, "Cow", "C"),
            (62, 3, "Male calf", "MC"),
            (62, 4, "Female calf", "FC"),
            (62, 5, "Bull", "B"),
            (62, 6, "Straw", "AI"),
        ],
    ),
    "interface_limit_parameters": (
        "id int, category string, min_value double, max_value double",
        [
            (1, "calving_interval", 3.0, 20.0),
            (2, "age_at_first_calving", 18.0, 48.0),
            (5, "mature_girth", 40.0, 240.0),
            (6, "mature_weight", 20.0, 400.0),
            (7, "calf_weight", 10.0, 90.0),
            (8, "calf_girth", 5.0, 60.0),
        ],
    ),
    "interface_graduation_settings": ("id int, graduation_value double", [(1, 12.0)]),
}


def _literal(value) -> str:
    return f"'{value}'" if isinstance(value, str) else f"{value}"


def _small_sql(name: str) -> str:
    ddl, rows = SMALL[name]
    names = ", ".join(part.split()[0] for part in ddl.split(", "))
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return f"select * from (values {values}) as v({names})"


def _small(spark: SparkSession, name: str) -> DataFrame:
    # A literal relation has an exact size, so the planner knows that it may be broadcast.
    typed = ", ".join("cast({0} as {1}) as {0}".format(*part.split()) for part in SMALL[name][0].split(", "))
    return spark.sql(f"select {typed} from ({_small_sql(name)})")


# Columns of the larger views, as SQL that reads the same in Spark and in DuckDB.
FARM = """
s_suppkey as id; concat('Farm ', s_name) as name; s_name as farmer_name; n_regionkey as country_id;
s_nationkey as region_id; 1000 + s_suppkey as district_id; 1000 + s_suppkey * 2 as ward_id;
case when s_suppkey % 3 = 0 then null else 1000 + s_suppkey * 3 end as village_id;
1 + s_suppkey % 3 as farm_type; 1 + s_suppkey % 3 as gender_code; s_suppkey % 7 as org_id;
case when s_suppkey % 4 = 1 then null else concat('Project ', cast(s_suppkey % 4 as string)) end as project;
case when s_suppkey % 5 = 0 then null else s_suppkey % 7 end as field_agent_id; s_suppkey % 7 as created_by;
date '2024-01-01' + cast(s_suppkey % 30 as int) as created_at;
date '2014-01-01' + cast(s_suppkey * 97 % 3000 as int) as reg_date;
case when s_suppkey % 4 = 0 then null else s_acctbal / 100 end as latitude; s_acctbal / 50 as longitude;
concat('u', cast(s_suppkey as string)) as odk_form_uuid;
concat('{"49":"', cast(s_suppkey % 20 as string), '"}') as additional_attributes"""

ANIMAL = """
c_custkey as id; farm_id; country_id; c_nationkey as region_id; 1000 + c_custkey % 40 as district_id;
1000 + c_custkey % 60 as ward_id; case when c_custkey % 7 = 3 then null else 1000 + c_custkey % 80 end as village_id;
concat('T', cast(c_custkey % 1400 as string)) as tag_id; concat('OT', cast(c_custkey as string)) as original_tag_id;
case when c_custkey % 7 = 0 then null else 1 + c_custkey % 2 end as sex; 1 + c_custkey % 6 as animal_type;
1 + c_custkey % 9 as main_breed;
case when c_custkey % 11 = 0 then null else date '2020-01-01' + cast(c_custkey * 37 % 1500 as int) end as birthdate;
case when c_custkey % 3 = 0 then null else c_custkey % 50 end as sire_id;
concat('S', cast(c_custkey % 50 as string)) as sire_tag_id;
25 + c_custkey % 60 as dam_id; concat('D', cast(c_custkey % 60 as string)) as dam_tag_id;
case when c_custkey % 8 = 0 then null else date '2022-01-01' + cast(c_custkey * 13 % 900 as int) end as reg_date;
date '2024-01-01' + cast(c_custkey % 30 as int) as created_at;
case when c_custkey % 12 = 0 then null else c_custkey % 7 end as created_by;
case when c_custkey % 6 = 0 then null else c_acctbal / 50 end as longitude; c_acctbal / 100 as latitude"""

EVENT = """
event_id as id; animal_id; country_id; region_id;
case event_type when 'signup' then 1 when 'purchase' then 2 when 'click' then 3 when 'view' then 6 else 18 end as event_type;
cast(ts as date) as event_date; cast(ts as date) as created_at;
case when event_id % 9 = 0 then null else event_id % 7 end as field_agent_id; event_id % 7 as created_by;
case event_type
  when 'purchase' then concat('{"59":"', cast(cast(floor(value) as int) as string), '","61":',
    case when event_id % 11 = 0 then 'null' else '"4.5"' end, case when event_id % 13 = 0 then '' else ',"68":"2"' end, '}')
  when 'view' then case when event_id % 19 = 0 then '{"139":"3"}'
    else concat('{"136":"', cast(cast(floor(value) as int) as string), '","137":',
      case when event_id % 17 = 0 then 'null' else concat('"', cast(cast(floor(value / 2) as int) as string), '"') end, '}') end
  else props end as additional_attributes"""

FORM = """
concat('u', cast(s_suppkey - s_suppkey % 4 as string)) as form_uuid; concat('Ver 1.', cast(s_suppkey % 11 as string)) as form_version;
case when s_suppkey % 3 = 0
  then concat('{"farmer_general":[{"a":"x"},{"g/Farmer_GPSLocation":"', cast(s_suppkey as string), '.5 36.2 0 0"}]}')
  else '{"other":1}' end as form_data"""


def _columns(text: str) -> list[str]:
    return [part.strip() for part in text.split(";")]


def _list(text: str) -> str:
    return text.replace(";", ",")


VIEW_SQL: dict[str, str] = {
    "core_country": "select r_regionkey as id, r_name as name from region",
    "country_units": """
        select n_nationkey as id, n_name as name from nation
        union all select 1000 + s_suppkey as id, s_name as name from supplier""",
    "core_organization": "select r_regionkey as id, concat('Org ', r_name) as name from region",
    **{name: _small_sql(name) for name in SMALL},
    "core_farm": f"select {_list(FARM)} from supplier join nation on s_nationkey = n_nationkey",
    "core_animal": f"""select {_list(ANIMAL)} from (select *, c_custkey % 10 as farm_id from customer)
        join (select id as farm_id, country_id from core_farm) using (farm_id)""",
    "core_animal_event": f"""select {_list(EVENT)} from (select *, user_id as animal_id from events)
        join (select id as animal_id, country_id, region_id from core_animal) using (animal_id)""",
    "core_odk_form": f"select {_list(FORM)} from supplier",
}

# Views a view is made of.
VIEW_PARTS = {"core_animal": ["core_farm"], "core_animal_event": ["core_farm", "core_animal"]}


def with_views(*names: str) -> str:
    """CTE list of the views named and of those they are made of."""
    wanted = {p for n in names for p in [*VIEW_PARTS.get(n, []), n]}
    return ",\n".join(f"{n} as ({sql})" for n, sql in VIEW_SQL.items() if n in wanted)


class Tables(Mapping):
    """The herd tables over the test tables in ``sf_dir``, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._built: dict[str, DataFrame] = {}
        # The event view is itself a join by animal, and groupings by animal would build on it.
        spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", SETTINGS["spark.sql.adaptive.forceOptimizeSkewedJoin"])

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name, RAW[name])

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def __iter__(self):
        return iter(VIEW_SQL)

    def __len__(self) -> int:
        return len(VIEW_SQL)

    def _build(self, name: str) -> DataFrame:
        match name:
            case "core_country":
                return self.raw("region").selectExpr("r_regionkey as id", "r_name as name")
            case "country_units":
                nations = self.raw("nation").selectExpr("cast(n_nationkey as bigint) as id", "n_name as name")
                return nations.union(self.raw("supplier").selectExpr("1000 + s_suppkey as id", "s_name as name"))
            case "core_organization":
                return self.raw("region").selectExpr("r_regionkey as id", "concat('Org ', r_name) as name")
            case "core_farm":
                nations = self.raw("nation").withColumnRenamed("n_nationkey", "s_nationkey")
                return self.raw("supplier").join(nations, "s_nationkey").selectExpr(*_columns(FARM))
            case "core_animal":
                farms = self["core_farm"].selectExpr("id as farm_id", "country_id")
                animals = self.raw("customer").selectExpr("*", "c_custkey % 10 as farm_id")
                return animals.join(farms, "farm_id").selectExpr(*_columns(ANIMAL))
            case "core_animal_event":
                animals = self["core_animal"].selectExpr("id as animal_id", "country_id", "region_id")
                events = self.raw("events").withColumnRenamed("user_id", "animal_id")
                return events.join(animals, "animal_id").selectExpr(*_columns(EVENT))
            case "core_odk_form":
                return self.raw("supplier").selectExpr(*_columns(FORM))
            case _:
                return _small(self.spark, name)
