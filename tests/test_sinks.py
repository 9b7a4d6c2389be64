"""Staging, report tables and extracts on disk."""

import datetime as dt
import gzip
from pathlib import Path
from types import SimpleNamespace

import pytest

from herdloom.sources import (
    export_lists,
    purge_run,
    read_current,
    read_extract,
    read_extract_in_splits,
    read_table,
    refresh,
    shared_path,
    split_valid_error,
    stage,
    stamp,
    write_extract,
)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_stage_and_purge(spark, tmp_path):
    path = str(tmp_path / "staged")
    a = spark.createDataFrame([(1, 1), (2, 0)], "id int, status int")
    b = spark.createDataFrame([(3, 1)], "id int, status int")
    stage(a, path, "r1")
    stage(b, path, "r2")
    stage(a, path, "r1")  # a retry does not double
    assert rows_of(spark.read.parquet(path)) == [(1, 1, "r1"), (2, 0, "r1"), (3, 1, "r2")]
    purge_run(spark, path, "r1")
    with pytest.raises(LookupError):
        purge_run(spark, path, "r1")
    assert rows_of(spark.read.parquet(path)) == [(3, 1, "r2")]


@pytest.mark.parametrize("run", ["2024-01-25T06:00", "b c%", "a/b=c", "%3A", "x'{}[]^"])
def test_every_run_that_can_be_staged_can_be_purged(spark, tmp_path, run):
    path = str(tmp_path / "staged")
    for name in (run, "other"):
        stage(spark.range(2), path, name)
    purge_run(spark, path, run)
    schema = "id bigint, run_id string"
    assert rows_of(spark.read.schema(schema).parquet(path)) == [(0, "other"), (1, "other")]
    with pytest.raises(ValueError):
        stage(spark.range(1), path, "")


def test_line_breaks_in_texts_come_back(spark, tmp_path):
    path = str(tmp_path / "extract")
    df = spark.createDataFrame([(1, "two\nlines"), (2, 'a "b",\r\nc')], "id int, name string")
    write_extract(df, path, "id")
    assert rows_of(read_extract(spark, path, "id int, name string")) == rows_of(df)


def test_refresh_replaces(spark, tmp_path):
    path = str(tmp_path / "report")
    refresh(spark.range(5), path)
    refresh(spark.range(2), path)
    assert rows_of(read_current(spark, path, "id bigint")) == [(0,), (1,)]


def test_extract_is_sorted_gzip_with_header(spark, tmp_path):
    path = str(tmp_path / "extract")
    df = spark.createDataFrame([(3, ' say "x", y '), (1, None), (2, "é")], "id int, name string")
    write_extract(df, path, "id")
    files = sorted(Path(path).glob("*.csv.gz"))
    lines = [line for f in files for line in gzip.open(f, "rt").read().splitlines() if line != "id,name"]
    assert [line.split(",")[0] for line in lines] == ["1", "2", "3"]
    assert read_extract(spark, path, "id int, name string").count() == 3
    back = read_extract(spark, path, "id int, name string")
    assert rows_of(back.filter("id > 1")) == [(2, "é"), (3, ' say "x", y ')]
    assert any(line == '3," say ""x"", y "' for line in lines)


def test_valid_plus_error_is_staged(spark):
    df = spark.createDataFrame([(1, None, 1), (2, " | x", 0)], "id int, comments string, status int")
    valid, error = split_valid_error(df)
    assert valid.columns == ["id"] and error.columns == ["id", "comments"]
    assert valid.count() + error.count() == df.count()


def test_stamp_is_utc(spark):
    at = dt.datetime(2024, 1, 1, 2, 0, tzinfo=dt.timezone(dt.timedelta(hours=3)))
    assert tuple(stamp(spark.range(1), at, "V1").first()) == (0, "2023-12-31 23:00:00", "V1")


def test_lists_have_no_header(spark, tmp_path):
    where = export_lists({"staff_list": spark.createDataFrame([(1, "a")], "id int, name string")}, str(tmp_path))
    text = "".join(f.read_text() for f in Path(where["staff_list"]).glob("*.csv"))
    assert text == "1,a\n"


def test_read_table_uses_the_given_schema(spark, tmp_path, table):
    table("core_country", {"id": 1, "name": "Kenya"}).write.parquet(str(tmp_path / "core_country"))
    assert rows_of(read_table(spark, str(tmp_path), "core_country")) == [(1, "Kenya")]


def test_scratch_lies_in_the_shared_folder(spark, monkeypatch):
    given = spark.sparkContext.getCheckpointDir()
    root = spark.conf.get("spark.checkpoint.dir", None) or given or spark.conf.get("spark.sql.warehouse.dir")
    path = shared_path(spark, "x")
    assert path.startswith(root) and path != shared_path(spark, "x")


@pytest.mark.parametrize("size", [16, 37, 100, 4096])
def test_records_over_split_boundaries_come_back_whole(spark, tmp_path, size):
    texts = ["plain", 'a "quoted" word', "two\nlines", "x\n" * 60 + "end", '"', "\n\n", None, " blanks ", 'comma, "\n" and quote', "cr\r\nlf"]
    rows = [(i, texts[i % len(texts)], f"e{i}") for i in range(60)]
    schema = "id bigint, note string, last string"
    path = str(tmp_path / "extract")
    written = write_extract(spark.createDataFrame(rows, schema).coalesce(2), path, compression="none")
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in zip(names, (size, 0)):
            spark.conf.set(name, str(value))
        tasks = spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions()
        found = rows_of(read_extract_in_splits(spark, path, schema))
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    assert found == sorted(rows) == rows_of(read_extract(spark, path, schema)) and written == len(rows)
    assert tasks > 2 or size == 4096


def test_split_reading_of_gzip_and_of_nothing(spark, tmp_path):
    schema, path = "id bigint, note string", str(tmp_path / "extract")
    for rows in ([(1, "a\nb"), (2, None)], []):
        write_extract(spark.createDataFrame(rows, schema), path)
        assert rows_of(read_extract_in_splits(spark, path, schema)) == rows
