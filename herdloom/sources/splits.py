"""Quoted CSV read by many tasks a file, although a text may hold line breaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herdloom.sources.tables import shared_path


def csv_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Whole records of quoted CSV files as texts, with ``file`` and a ``place`` that orders those of a file.

    Files are read in splits, as lines. A line begins a record where an even number of quotes stands before
    it in its file, which takes the numbers of quotes of the splits before, a row each, and those of the lines
    of its own split. The lines with their records are written aside once; a record of several lines, over
    however many splits, is put together from these alone. Empty records and headers are left out.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
        "value",
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    splits = splits.select("file", "block", F.coalesce(F.sum("quotes").over(before), F.lit(0)).alias("earlier"))
    by_line = Window.partitionBy("file", "block").orderBy("line")
    # Quotes up to the end of a line, and the place of the record it belongs to if that begins in its split.
    lines = lines.join(splits, ["file", "block"]).withColumn("quoted", F.col("earlier") + F.sum("quotes").over(by_line))
    begins, ends = (F.col("quoted") - F.col("quotes")) % 2 == 0, F.col("quoted") % 2 == 0
    lines = lines.withColumn("begun", F.when(begins, F.struct("block", "line")))
    lines = lines.select(
        "file", "block", "line", "value",
        (begins & ends).alias("whole"),
        F.last("begun", ignorenulls=True).over(by_line).alias("place"),
        ((F.col("block") == 0) & (F.row_number().over(by_line) == 1)).alias("first"),
    )
    aside = shared_path(spark, "lines")
    lines.write.parquet(aside)
    lines = spark.read.schema(lines.schema).parquet(aside)
    # Lines at the start of a split may go on with a record of an earlier one.
    begun = lines.groupBy("file", "block").agg(F.max("place").alias("place"))
    begun = begun.select("file", "block", F.last("place", ignorenulls=True).over(before).alias("carried"))
    pieces = lines.filter(~F.col("whole")).join(begun, ["file", "block"])
    pieces = pieces.withColumn("place", F.coalesce("place", "carried"))
    ordered = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    joined = pieces.groupBy("file", "place").agg(ordered.alias("lines"), F.max("first").alias("first"))
    joined = joined.withColumn("value", F.array_join(F.col("lines.value"), "\n"))
    columns = ["file", "place", "value", "first"]
    records = lines.filter("whole").select(columns).unionByName(joined.select(columns))
    if header:
        records = records.filter(~F.col("first"))
    return records.filter(F.trim("value") != "").drop("first")


def read_split_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, options: dict[str, str], header: bool = True
) -> DataFrame:
    """Rows of quoted CSV files, each file read by as many tasks as it has splits; their order is open."""
    ddl = schema if isinstance(schema, str) else schema.toDDL()
    row = F.from_csv("value", ddl, {**options, "multiLine": "true"})
    return csv_records(spark, path, header).select(row.alias("row")).select("row.*")
