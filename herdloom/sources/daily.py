"""Tables laid out by day, whose old days move to an archive without being read.

A day is a folder of files. Retention renames the files of days that are over as a whole and rewrites at
most one, that in which the limit falls. All its steps can be repeated: a run that was stopped is taken up
by the next one, from marks that say how far it came.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herdloom.sources.files import Folder

#: Column that names the day of a row's folder. Rows without a time stand in a folder of their own.
DAY = "stored_day"
#: Folder of splits that have begun; Spark passes over names that begin like this.
PENDING = "_pending"


def write_daily(df: DataFrame, path: str, at: str, mode: str = "overwrite") -> None:
    """Write rows into the folders of their days; ``mode`` append adds files to these."""
    df.withColumn(DAY, F.to_date(at)).write.partitionBy(DAY).mode(mode).parquet(path)


def read_daily(spark: SparkSession, path: str, schema: str | T.StructType, since: dt.date | None = None) -> DataFrame:
    """Rows of all days, or of those from ``since`` on, whose folders alone are listed then read.

    A table without any day, or without a folder, has no rows.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    Folder(spark, path).make()
    full = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
    rows = spark.read.schema(full).parquet(path)
    return (rows if since is None else rows.filter(F.col(DAY) >= F.lit(since))).drop(DAY)


def _move_all(source: Folder, target: Folder) -> None:
    # Files have names of their own, so a day that is archived twice gains files.
    for name in source.data():
        source.move(name, target)


def _finish(table: Folder, archive: Folder, split: Folder) -> None:
    """Put the two parts of a split day in place of its files; nothing happens twice."""
    if "ready" in split.names():
        (day,) = split.sub("day").names()
        _move_all(split.sub("rows/expired=true"), archive.sub(day))
        for name in split.sub("replaced").names():
            table.sub(day).delete(name)
        _move_all(split.sub("rows/expired=false"), table.sub(day))
    split.delete()


def recover(spark: SparkSession, path: str, archive: str) -> None:
    """Finish splits that were stopped after both parts were written, and drop those stopped before."""
    table = Folder(spark, path)
    for name in table.sub(PENDING).names():
        _finish(table, Folder(spark, archive), table.sub(f"{PENDING}/{name}"))


def _split(spark: SparkSession, table: Folder, archive: Folder, day: str, at: str, limit: dt.datetime, schema) -> bool:
    split = table.sub(f"{PENDING}/{uuid.uuid4().hex}")
    rows = spark.read.schema(schema).parquet(f"{table.path}/{day}")
    # As a text, so that no time zone has a say in it.
    edge = F.lit(limit.isoformat(sep=" ")).cast("timestamp_ntz")
    marked = rows.withColumn("expired", F.coalesce(F.col(at) < edge, F.lit(False)))
    marked.write.partitionBy("expired").parquet(f"{split.path}/rows")
    found = "expired=true" in split.sub("rows").names()
    if found:
        split.sub("day").mark(day)
        for name in table.sub(day).data():
            split.sub("replaced").mark(name)
        split.mark("ready")
    _finish(table, archive, split)
    return found


def archive_days(
    spark: SparkSession, path: str, archive: str, at: str, limit: dt.date | dt.datetime, schema: str | T.StructType
) -> dict[str, list[str]]:
    """Move rows from before ``limit`` to the archive, which is laid out the same way.

    Days before that of the limit are moved by name; the day it falls in is rewritten only if the limit has
    a time of day and some of its rows are older. Files of all other days stay as they are. Returns the days
    moved and split.
    """
    recover(spark, path, archive)
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    table, target = Folder(spark, path).make(), Folder(spark, archive).make()
    edge = limit.date() if isinstance(limit, dt.datetime) else limit
    done: dict[str, list[str]] = {"moved": [], "split": []}
    for name in table.data():
        try:
            day = dt.date.fromisoformat(name.removeprefix(f"{DAY}="))
        except ValueError:  # rows without a time
            continue
        if day < edge:
            _move_all(table.sub(name), target.sub(name))
            table.delete(name)
            done["moved"].append(day.isoformat())
        elif day == edge and isinstance(limit, dt.datetime) and limit.time() > dt.time():
            if _split(spark, table, target, name, at, limit, schema):
                done["split"].append(day.isoformat())
    return done
