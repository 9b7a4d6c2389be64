"""Source tables: schemas and scans."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Column names and types of the herd database, as DDL.
TABLES: dict[str, str] = {
    "core_country": "id bigint, name string",
    "country_units": "id bigint, name string",
    "core_organization": "id bigint, name string",
    "auth_users": "id bigint, name string",
    "core_events_type": "event_id int, description string",
    "core_master_list": "list_type_id int, value int, label string, description string",
    "core_farm": (
        "id bigint, name string, farmer_name string, country_id bigint, region_id bigint, "
        "district_id bigint, ward_id bigint, village_id bigint, farm_type int, gender_code int, "
        "org_id bigint, project string, field_agent_id bigint, created_by bigint, "
        "created_at timestamp_ntz, reg_date date, latitude double, longitude double, "
        "odk_form_uuid string, additional_attributes string"
    ),
    "core_animal": (
        "id bigint, farm_id bigint, country_id bigint, region_id bigint, district_id bigint, "
        "ward_id bigint, village_id bigint, tag_id string, original_tag_id string, sire_id bigint, "
        "sire_tag_id string, dam_id bigint, dam_tag_id string, sex int, animal_type int, "
        "main_breed int, birthdate date, reg_date date, created_at timestamp_ntz, "
        "created_by bigint, latitude double, longitude double"
    ),
    "core_animal_event": (
        "id bigint, animal_id bigint, country_id bigint, region_id bigint, event_type int, "
        "event_date date, created_at timestamp_ntz, created_by bigint, field_agent_id bigint, "
        "additional_attributes string"
    ),
    "core_odk_form": "form_uuid string, form_version string, form_data string",
    "interface_limit_parameters": "id int, category string, min_value double, max_value double",
    "interface_graduation_settings": "id int, graduation_value double",
    "interface_data_quality_check": "id int, quality_check string",
    "interface_data_quality_report_data_weekly": (
        "country_id bigint, quality_check int, total_records bigint, total_error_records bigint, "
        "error_rate double, report_year int, report_week int, deleted int"
    ),
}


def schema_of(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name])


def read_table(spark: SparkSession, root: str, name: str, schema: str | None = None) -> DataFrame:
    """Scan one Parquet table under ``root`` (a folder ``name`` or a file ``name.parquet``).

    The schema is given, never inferred, so that planning reads no footer. It defaults to the one in
    ``TABLES``.
    """
    suffix = "" if schema is None else ".parquet"
    return spark.read.schema(schema or TABLES[name]).parquet(f"{root}/{name}{suffix}")


def read_jdbc(
    spark: SparkSession, url: str, name: str, key: str, first: int, last: int, parts: int, **options: str
) -> DataFrame:
    """Scan one table of a live database in ``parts`` key ranges, one task and connection each."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name)
    ranges = {"partitionColumn": key, "lowerBound": first, "upperBound": last, "numPartitions": parts}
    return reader.options(**ranges, **options).load()


def shared_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the folder all executors share, removed when the application ends.

    The cluster names the folder in ``spark.checkpoint.dir``; where it names none, the warehouse is the
    one place that every session has and shares.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path
