"""Report tables that are replaced as a whole: readers see all old rows or all new ones.

Rows go to a folder of their own below ``versions``; once they are all there, an empty file below
``published`` names it. Creating that file is one step on every file system, so a job that fails before
leaves the version that was current, and a reader that has begun keeps its files: the version before the
current one stays until the next but one is published.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from herdloom.sources.files import Folder

#: Versions kept: the current one, and those that readers may still be at.
KEPT_VERSIONS = 2


def _number(name: str) -> int:
    return int(name.split("-")[0])


def publish(df: DataFrame, path: str) -> str:
    """Write a new version of the table at ``path`` and make it the current one; returns its folder.

    ``df`` may read the table itself. Of two writers at the same time one wins, as a whole.
    """
    table = Folder(df.sparkSession, path)
    versions, published = table.sub("versions"), table.sub("published")
    number = max(map(_number, published.names()), default=0) + 1
    name = f"{number:012d}-{uuid.uuid4().hex}"
    df.write.parquet(f"{versions.path}/{name}")
    published.mark(name)
    held = published.names()
    for old in held[:-KEPT_VERSIONS]:
        published.delete(old)
        versions.delete(old)
    # What failed jobs left; a job at work has a higher number.
    for left in set(versions.names()) - set(held):
        if _number(left) <= number - KEPT_VERSIONS:
            versions.delete(left)
    return f"{versions.path}/{name}"


def current(spark: SparkSession, path: str) -> str:
    """Folder of the current version; an error if none was ever published."""
    names = Folder(spark, f"{path}/published").names()
    if not names:
        raise LookupError(f"no version of {path} is published")
    return f"{path}/versions/{names[-1]}"


def read_current(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(current(spark, path))
