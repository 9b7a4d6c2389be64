"""Tables changed by key: only files that hold a changed key are written again.

Rows stand in buckets by the hash of their key and, within these, in files by ranges of the key, so the
rows of a few keys lie in few files. A merge reads the buckets of the changed keys, finds the files that
hold one, and writes these anew without the old rows and with the new ones. New files are put in place by
name and the old ones deleted, in steps that can be repeated: a merge that was stopped after all new rows
were written is finished by the next one, an earlier stop changes nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herdloom.sources.files import Folder

#: Column that names the bucket of a row's folder, and how many there are unless a table says otherwise.
BUCKET, BUCKETS = "key_bucket", 64
#: Folder of merges that have begun; Spark passes over names that begin like this.
PENDING = "_pending"


@dataclass(frozen=True)
class KeyedTable:
    """A table at ``path`` with the columns of ``schema``; many rows may have one key, and it may be NULL."""

    spark: SparkSession
    path: str
    key: str
    schema: T.StructType
    buckets: int = BUCKETS

    def _placed(self, df: DataFrame) -> DataFrame:
        rows = df.select(*self.schema.names).withColumn(BUCKET, self._bucket())
        return rows.repartitionByRange(BUCKET, self.key).sortWithinPartitions(BUCKET, self.key)

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _files(self, keys: DataFrame) -> DataFrame:
        """Rows in the buckets of some keys, with their bucket."""
        touched = [r[0] for r in keys.select(self._bucket()).distinct().collect()]
        full = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        Folder(self.spark, self.path).make()
        return self.spark.read.schema(full).parquet(self.path).filter(F.col(BUCKET).isin(touched))

    def _same(self, keys: DataFrame):
        return F.col(self.key).eqNullSafe(keys["_key"])

    def write(self, df: DataFrame) -> None:
        """Write the whole table."""
        self._placed(df).write.partitionBy(BUCKET).mode("overwrite").parquet(self.path)

    def read(self) -> DataFrame:
        """All rows; none without the table."""
        Folder(self.spark, self.path).make()
        return self.spark.read.schema(self.schema).parquet(self.path).select(*self.schema.names)

    def read_keys(self, keys: DataFrame) -> DataFrame:
        """Rows whose key is in the one column of ``keys``; buckets of other keys are not listed."""
        keys = keys.toDF(self.key).distinct()
        wanted = keys.withColumnRenamed(self.key, "_key")
        return self._files(keys).select(*self.schema.names).join(wanted, self._same(wanted), "left_semi")

    def merge(self, changes: DataFrame, keys: DataFrame | None = None) -> int:
        """Put ``changes`` in place of all rows with their keys, or with ``keys``; returns the files replaced.

        Keys without a change lose their rows. ``changes`` may be made from the table itself.
        """
        self.recover()
        keys = (changes.select(self.key) if keys is None else keys.toDF(self.key)).distinct()
        wanted = keys.withColumnRenamed(self.key, "_key")
        rows = self._files(keys).select(self.key, BUCKET, F.col("_metadata.file_name").alias("_file"))
        hits = rows.join(wanted, self._same(wanted), "left_semi").select(BUCKET, "_file").distinct().collect()
        new = changes.select(*self.schema.names)
        if hits:
            files = [f"{self.path}/{BUCKET}={bucket}/{name}" for bucket, name in hits]
            others = self.spark.read.schema(self.schema).parquet(*files).select(*self.schema.names)
            new = others.join(wanted, self._same(wanted), "left_anti").unionByName(new)
        merge = Folder(self.spark, f"{self.path}/{PENDING}/{uuid.uuid4().hex}")
        self._placed(new).write.partitionBy(BUCKET).parquet(f"{merge.path}/rows")
        for bucket, name in hits:
            merge.sub(f"replaced/{BUCKET}={bucket}").mark(name)
        merge.mark("ready")
        self._finish(merge)
        return len(hits)

    def _finish(self, merge: Folder) -> None:
        if "ready" in merge.names():
            table = Folder(self.spark, self.path)
            for bucket in merge.sub("rows").data():
                for name in merge.sub(f"rows/{bucket}").data():
                    merge.sub(f"rows/{bucket}").move(name, table.sub(bucket))
            for bucket in merge.sub("replaced").names():
                for name in merge.sub(f"replaced/{bucket}").names():
                    table.sub(bucket).delete(name)
        merge.delete()

    def recover(self) -> None:
        """Finish merges that were stopped once their rows were written, drop those stopped before."""
        pending = Folder(self.spark, f"{self.path}/{PENDING}")
        for name in pending.names():
            self._finish(pending.sub(name))
