"""Events stored for their readers: bucketed by one key and sorted within buckets.

Histories, the as-of link and test-day numbers all put the events of an animal together first. From a table
bucketed by the animal they find them together: groupings, windows and joins by animal, or by animal and
day, take the buckets as they are and shuffle no event; the time line of the as-of link, a union, shuffles days. A bucket is one task and can't be split, so keys
that would fill one by themselves stand in a plain table beside it, which readers shuffle as they do
without buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lets joins by animal and day use buckets by the animal alone.
BUCKET_SETTINGS = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


@dataclass(frozen=True)
class Bucketed:
    """Rows in buckets, and apart from them those of keys too frequent for a bucket."""

    rows: DataFrame
    hot: DataFrame

    def apply(self, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Result of an operator that looks at one key at a time."""
        return operator(self.rows).unionByName(operator(self.hot))


def hot_keys(df: DataFrame, key: str, buckets: int) -> list:
    """Keys with more rows than a bucket has on average; no more of them than there are buckets."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    share = (df.count() or 1) / buckets
    return [row[0] for row in counts.filter(F.col("n") > share).select(key).collect()]


def store_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, order: Sequence[str] = ()) -> Bucketed:
    """Write a frame as table ``name`` at ``path`` in buckets of ``key`` and read it back.

    Rows are dealt by the key before they are written, so a bucket is one file, sorted by the key and
    ``order``. Choose the buckets so that one fits into a task, about the size of the table over 256 MB.
    """
    hot = hot_keys(df, key, buckets)
    apart = F.coalesce(F.col(key).isin([value for value in hot if value is not None]), F.lit(None in hot))
    rows = df.filter(~apart).repartition(buckets, key)
    writer = rows.write.bucketBy(buckets, key).sortBy(key, *order).option("path", f"{path}/buckets")
    writer.mode("overwrite").saveAsTable(name)
    df.filter(apart).write.mode("overwrite").parquet(f"{path}/hot")
    spark = df.sparkSession
    return Bucketed(spark.table(name), spark.read.schema(df.schema).parquet(f"{path}/hot"))
