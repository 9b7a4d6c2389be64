"""Staging, report tables and file extracts."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from herdloom.sources.files import Folder
from herdloom.sources.splits import read_split_csv
from herdloom.sources.versions import publish

# Names and format of the two columns stamped on an extract.
STAMP_TIME = "Extract_Datetime_UTC"
STAMP_VERSION = "Version"
STAMP_FORMAT = "%Y-%m-%d %H:%M:%S"

# Texts are written as they are: blanks at either end stay, a quote within a text is doubled.
CSV = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def stage(df: DataFrame, path: str, run_id: str) -> None:
    """Add one run to a staging table.

    Only the partition of this run is replaced, so a retried run never doubles its rows.
    """
    if not run_id:
        raise ValueError("a run needs an id")
    (
        df.withColumn("run_id", F.lit(run_id))
        .write.partitionBy("run_id")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )


def purge_run(spark: SparkSession, path: str, run_id: str) -> None:
    """Remove one run from a staging table by dropping its partition; other runs are not read.

    The partition is found by what its folder's name stands for, as the writer escapes ids in names. A
    run that is not there is an error.
    """
    table = Folder(spark, path)
    for name in table.names():
        if unquote(name) == f"run_id={run_id}":
            table.delete(name)
            return
    raise LookupError(f"no run {run_id!r} in {path}")


def refresh(df: DataFrame, path: str) -> str:
    """Fill a report table anew; until all rows are there readers see the old ones. Returns their folder.

    Read it with :func:`herdloom.sources.read_current`.
    """
    return publish(df, path)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str], touched: Sequence[tuple]) -> None:
    """Replace the partitions named by ``touched`` values of ``by``: by the rows of ``df``, or by none.

    All rows of ``df`` must belong to these; partitions of other values are neither read nor written. Rows
    are computed once and put aside first, so that a failure changes nothing.
    """
    spark, aside = df.sparkSession, f"{path}/_aside/{uuid.uuid4().hex}"
    seen, tests = Observation("partitions"), {}
    for i, key in enumerate(touched):
        same = [F.col(name).eqNullSafe(F.lit(value)) for name, value in zip(by, key)]
        tests[key] = F.count_if(reduce(and_, same)).alias(f"key_{i}")
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *tests.values()).write.parquet(aside)
    found = {key for i, key in enumerate(touched) if seen.get[f"key_{i}"]}
    if seen.get["rows"] != sum(seen.get[f"key_{i}"] for i in range(len(touched))):
        raise ValueError(f"there are rows of other partitions than {list(touched)}")
    rows = spark.read.schema(df.schema).parquet(aside)
    rows.write.partitionBy(*by).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    table = Folder(spark, path)
    for key in set(touched) - found:
        table.delete("/".join(f"{name}={value}" for name, value in zip(by, key)))
    Folder(spark, aside).delete()


def split_valid_error(df: DataFrame, comments: str = "comments") -> tuple[DataFrame, DataFrame]:
    """Rows that broke no rule, without the comment column, and rows that did.

    Both are filters over one frame: stage that frame first where it is costly to compute twice.
    """
    valid = df.filter(F.col("status") == 1).drop("status", comments)
    error = df.filter(F.col("status") == 0).drop("status")
    return valid, error


def write_extract(df: DataFrame, path: str, *order: str, compression: str = "gzip") -> int:
    """Header CSV, sorted across the files when ``order`` is given; returns the rows written.

    Files of ``compression`` ``none`` or ``bzip2`` can be read in splits. Rows are counted above the sort, whose sampling reads the rows once more.
    """
    if order:
        df = df.orderBy(*order)
    seen = Observation()
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    df.write.mode("overwrite").options(**CSV).option("header", True).option("compression", compression).csv(path)
    return seen.get["rows"]


def read_extract(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of an extract; a text may hold line breaks, so a file is read by one task.

    For few large files see :func:`read_extract_in_splits`.
    """
    return spark.read.schema(schema).options(**CSV).option("header", True).option("multiLine", True).csv(path)


def read_extract_in_splits(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of an extract, in no order; many tasks read a file unless it is gzip, which has no splits."""
    return read_split_csv(spark, path, schema, CSV)


def stamp(df: DataFrame, extracted_at: dt.datetime, version: str) -> DataFrame:
    """Extract time, in UTC, and report version on every row."""
    if extracted_at.tzinfo is not None:
        extracted_at = extracted_at.astimezone(dt.UTC)
    return df.withColumns(
        {
            STAMP_TIME: F.lit(extracted_at.strftime(STAMP_FORMAT)),
            STAMP_VERSION: F.lit(version),
        }
    )


def export_lists(lists: dict[str, DataFrame], path: str) -> dict[str, str]:
    """Write each lookup list as a CSV dataset without header; returns where each one went."""
    where = {}
    for name, df in lists.items():
        where[name] = f"{path}/{name}"
        df.write.mode("overwrite").options(**CSV).csv(where[name])
    return where
