"""Registry of the queries over texts, and helpers their operators share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herdloom.sources.tables import shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Rows of an Arrow batch, so that long texts fit, and rows a task turns into Python objects at a time.
BATCH_ROWS = 512
SLICE_ROWS = 256
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Bits of a filter per key, bits that one has at least and at most (16 MB), and bits of a part of it.
FILTER_BITS, LEAST_FILTER, MOST_FILTER, FILTER_PART = 32, 18, 27, 18

ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<bigint>": pa.list_(pa.int64()),
    "array<double>": pa.list_(pa.float64()),
    "array<string>": pa.list_(pa.string()),
}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return register


@cache
def _send_code(spark: SparkSession, application: str) -> None:
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="herdloom-code-"), "herdloom.zip")
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))


def prepare(spark: SparkSession) -> None:
    """Give this package to all executors, those that start later too, and bound the rows of a batch.

    Spark takes that bound from the session alone. Its default of 10,000 rows would have a task hold
    gigabytes of long texts, so a session with a larger bound gets this one.
    """
    _send_code(spark, spark.sparkContext.applicationId)
    if not 0 < int(spark.conf.get(BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, ARROW[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


def release() -> None:
    """Give memory of a finished task back: Spark uses a worker again, for other stages too."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_slices(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], list | None]], ddl: str, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Run ``make()`` once per task and what it returns on slices of a few rows.

    The function gets a record batch and returns the columns of ``ddl`` as lists or Arrow arrays.
    """
    prepare(df.sparkSession)
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                columns = work(batch.slice(at, slice_rows))
                if columns is not None:
                    arrays = [
                        c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                        for c, f in zip(columns, schema, strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)
        del work
        release()

    return df.mapInArrow(run, ddl)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema) -> DataFrame:
    """Like ``map_slices`` with whole rows: the function turns a slice into a record batch of ``schema``."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                yield work(batch.slice(at, SLICE_ROWS))
        del work
        release()

    return df.mapInArrow(run, schema)


def replaced(batch: pa.RecordBatch, column: str, values: pa.Array) -> pa.RecordBatch:
    at = batch.schema.get_field_index(column)
    return batch.set_column(at, batch.schema.field(at), values)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Whole texts of a slice, NULL as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again: computed once, and no lineage to repeat."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files of finished jobs now: it does once the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(df: DataFrame) -> None:
    """Remove the files of a ``stored`` frame that nothing reads any more, and shuffle files of finished jobs."""
    context = df.sparkSession.sparkContext
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    release_shuffles(df.sparkSession)


def id_remainder(column: str, divisor: int):
    """crc32 of the id written as text, modulo ``divisor``; NULL without an id."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(divisor))


def key_filter(keys: DataFrame, column: str) -> np.ndarray:
    """Bits of the hashes of a column, to pass over rows that certainly have none of its values.

    Each value sets two bits of at least 32 per row of ``keys``, a power of two but at most 2^27 in all: a
    filter that is full lets more rows pass, so a join must follow. Parts are made in tasks and sent as bytes.
    """
    n = keys.count()
    size = max(LEAST_FILTER, min(MOST_FILTER, (FILTER_BITS * n).bit_length()))
    width = min(size, FILTER_PART)
    hashed, mask = F.xxhash64(column), F.lit((1 << size) - 1)
    places = F.array(hashed.bitwiseAND(mask), F.shiftright(hashed, 32).bitwiseAND(mask))
    parts = keys.select(F.explode(places).alias("place")).distinct().withColumn("part", F.shiftright("place", width))
    schema = arrow_schema("part bigint, bits binary")

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        bits = np.zeros(1 << width, bool)
        bits[table.column("place").to_numpy() & ((1 << width) - 1)] = True
        columns = [pa.array([key[0].as_py()], pa.int64()), pa.array([np.packbits(bits, bitorder="little").tobytes()])]
        return pa.Table.from_arrays(columns, schema=schema)

    out = np.zeros(1 << size >> 3, np.uint8)
    wide = 1 << width >> 3
    for part, bits in parts.groupBy("part").applyInArrow(pack, "part bigint, bits binary").collect():
        out[part * wide : (part + 1) * wide] = np.frombuffer(bits, np.uint8)
    return out


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes a ``key_filter`` lets pass."""
    mask, out = 8 * len(bits) - 1, np.ones(len(hashes), bool)
    for place in (hashes & mask, hashes >> 32 & mask):
        out &= bits[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1
    return out
