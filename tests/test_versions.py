"""Tables that change on disk: versions, partitions replaced by key, days that move to an archive."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from herdloom.functions import whole_weeks
from herdloom.sources import (
    Folder,
    archive_days,
    current,
    publish,
    read_current,
    read_daily,
    refresh,
    replace_partitions,
    write_daily,
)
from herdloom.sources import daily


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def failing(spark):
    return spark.range(100).repartition(4).withColumn("id", F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("x")).cast("bigint")))


def test_a_failed_refresh_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "report")
    with pytest.raises(LookupError):
        current(spark, path)
    refresh(spark.range(3), path)
    before = current(spark, path)
    with pytest.raises(PySparkException):
        refresh(failing(spark), path)
    assert current(spark, path) == before and rows_of(read_current(spark, path, "id bigint")) == [(0,), (1,), (2,)]


def test_readers_keep_their_version_and_old_ones_go(spark, tmp_path):
    path = str(tmp_path / "report")
    publish(spark.range(1), path)
    reader = read_current(spark, path, "id bigint")
    publish(reader.union(spark.range(7, 9)), path)  # a version made from the one before
    assert rows_of(reader) == [(0,)] and rows_of(read_current(spark, path, "id bigint")) == [(0,), (7,), (8,)]
    with pytest.raises(PySparkException):
        publish(failing(spark), path)
    for n in range(3):
        publish(spark.range(n), path)
    assert len(Folder(spark, f"{path}/versions").names()) == len(Folder(spark, f"{path}/published").names()) == 2
    assert rows_of(read_current(spark, path, "id bigint")) == [(0,), (1,)]


def test_an_empty_version_can_be_read(spark, tmp_path):
    path = str(tmp_path / "report")
    refresh(spark.range(2), path)
    refresh(spark.range(0), path)
    assert rows_of(spark.read.parquet(current(spark, path))) == []


def test_touched_partitions_are_replaced_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "log")
    frame = lambda *rows: spark.createDataFrame(rows, "n int, year int, week int")
    replace_partitions(frame((1, 2024, 1), (2, 2024, 2), (3, 2024, 3)), path, ["year", "week"], [(2024, 1), (2024, 2), (2024, 3)])
    kept = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet") if "week=3" in str(p)}
    replace_partitions(frame((4, 2024, 1)), path, ["year", "week"], [(2024, 1), (2024, 2)])
    assert rows_of(spark.read.parquet(path)) == [(3, 2024, 3), (4, 2024, 1)]
    assert kept == {p: p.stat().st_mtime_ns for p in kept}
    with pytest.raises(ValueError):
        replace_partitions(frame((5, 2024, 3)), path, ["year", "week"], [(2024, 1)])
    replace_partitions(frame(), path, ["year", "week"], [(2024, 3)])
    assert rows_of(spark.read.parquet(path)) == [(4, 2024, 1)]


@pytest.mark.parametrize("start, end", [("2024-01-10", "2024-01-10"), ("2023-12-31", "2024-01-02"), (dt.date(2024, 2, 29), dt.date(2024, 3, 2)), ("2022-12-28", "2023-01-04")])
def test_whole_weeks(start, end):
    first, last, weeks = whole_weeks(start, end)
    key = lambda d: (d.year, int(d.strftime("%U")))
    assert first.isoformat() <= str(start) and last.isoformat() >= str(end)
    days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    assert sorted({key(d) for d in days}) == weeks
    assert key(first - dt.timedelta(days=1)) not in weeks and key(last + dt.timedelta(days=1)) not in weeks


# --- days ----------------------------------------------------------------------------------------

SCHEMA = "id bigint, at timestamp_ntz"


@pytest.fixture
def table(spark, tmp_path):
    rows = [(i, dt.datetime(2024, 1, 1 + i // 4, i % 4 * 6)) for i in range(40)] + [(99, None)]
    path = str(tmp_path / "table")
    write_daily(spark.createDataFrame(rows, SCHEMA), path, "at")
    return path, str(tmp_path / "archive"), rows


def files_of(path):
    return {(p.parent.name, p.name): (p.stat().st_ino, p.stat().st_mtime_ns) for p in Path(path).rglob("*.parquet")}


def sides(spark, path, archive):
    return [rows_of(read_daily(spark, where, SCHEMA).select("id")) for where in (path, archive)]


def test_whole_days_move_by_name(spark, table):
    path, archive, rows = table
    before = files_of(path)
    done = archive_days(spark, path, archive, "at", dt.date(2024, 1, 6), SCHEMA)
    assert done == {"moved": [f"2024-01-0{d}" for d in range(1, 6)], "split": []}
    assert files_of(path) | files_of(archive) == before and len(files_of(archive)) >= 5
    assert sides(spark, path, archive) == [[(i,) for i in (*range(20, 40), 99)], [(i,) for i in range(20)]]


def test_only_the_day_of_the_limit_is_rewritten(spark, table):
    path, archive, rows = table
    before, limit = files_of(path), dt.datetime(2024, 1, 6, 7)
    for expected in (["2024-01-06"], []):  # a repeated run leaves all as it is
        assert archive_days(spark, path, archive, "at", limit, SCHEMA)["split"] == expected
    assert sides(spark, path, archive) == [[(i,) for i in (*range(22, 40), 99)], [(i,) for i in range(22)]]
    after = files_of(path)
    later = lambda files: {n: v for n, v in files.items() if n[0] > "stored_day=2024-01-06"}
    assert later(after) == later(before)
    assert read_daily(spark, path, SCHEMA, dt.date(2024, 1, 9)).count() == 8


def test_late_rows_follow_their_day(spark, table):
    path, archive, rows = table
    archive_days(spark, path, archive, "at", dt.date(2024, 1, 3), SCHEMA)
    write_daily(spark.createDataFrame([(50, dt.datetime(2024, 1, 2))], SCHEMA), path, "at", "append")
    archive_days(spark, path, archive, "at", dt.date(2024, 1, 3), SCHEMA)
    assert sides(spark, path, archive)[1] == [(i,) for i in (*range(8), 50)]


def test_empty_sides_can_be_read(spark, table):
    path, archive, rows = table
    assert archive_days(spark, path, archive, "at", dt.date(2023, 1, 1), SCHEMA) == {"moved": [], "split": []}
    assert sides(spark, path, archive)[1] == []
    archive_days(spark, path, archive, "at", dt.date(2030, 1, 1), SCHEMA)
    assert sides(spark, path, archive) == [[(99,)], [(i,) for i in range(40)]]
    assert rows_of(read_daily(spark, f"{path}-none", SCHEMA)) == []


@pytest.mark.parametrize("calls", range(12))
def test_a_stopped_split_is_finished_or_undone(spark, table, monkeypatch, calls):
    """Stopped at any change to the file system; the next run ends with every row once."""
    path, archive, rows = table
    left = [calls]

    def counted(change):
        def run(self, *args):
            if left[0] == 0:
                raise KeyboardInterrupt
            left[0] -= 1
            return change(self, *args)

        return run

    limit = dt.datetime(2024, 1, 1, 7)
    with monkeypatch.context() as patched:
        for name in ("mark", "move", "delete"):
            patched.setattr(daily.Folder, name, counted(getattr(Folder, name)))
        try:
            archive_days(spark, path, archive, "at", limit, SCHEMA)
        except KeyboardInterrupt:
            pass
    archive_days(spark, path, archive, "at", limit, SCHEMA)
    assert sides(spark, path, archive) == [[(i,) for i in (*range(2, 40), 99)], [(0,), (1,)]]
    assert Folder(spark, f"{path}/_pending").names() == []
