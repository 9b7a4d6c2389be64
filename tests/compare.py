"""Run queries next to their SQL in DuckDB and compare names, types and rows."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

# DuckDB type -> Spark type.
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def compare(df, con, sql: str) -> tuple[list[str], int]:
    """Differences found (none: equal) and the row count."""
    rel = con.sql(sql)
    names, types = rel.columns, [str(t) for t in rel.types]
    order = sorted(range(len(names)), key=lambda i: names[i])
    expected = {names[i]: TYPES.get(types[i], types[i]) for i in order}
    actual = {f.name: f.dataType.simpleString() for f in sorted(df.schema.fields, key=lambda f: f.name)}
    problems = []
    if list(expected) != list(actual):
        return [f"columns {list(actual)} expected {list(expected)}"], 0
    off = {n: (actual[n], expected[n]) for n in actual if actual[n] != expected[n]}
    if off:
        problems.append(f"types {off}")
    theirs = Counter(tuple(_cell(row[i]) for i in order) for row in rel.fetchall())
    columns = list(actual)
    ours = Counter(tuple(_cell(row[c]) for c in columns) for row in df.collect())
    if ours != theirs:
        missing, extra = list((theirs - ours).items())[:2], list((ours - theirs).items())[:2]
        problems.append(
            f"rows {sum(ours.values())} expected {sum(theirs.values())}\n   columns {columns}\n   missing {missing}\n   extra {extra}"
        )
    return problems, sum(theirs.values())


def main(sf_dir: str, wanted: list[str]) -> int:
    import __spark_entry__ as e
    from herdloom.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracles, bad = e.oracle_sql(), 0
    for name, build in e.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problems, rows = compare(build(spark, sf_dir), con, oracles[name])
        except Exception as error:  # report and go on with the next query
            problems, rows = [f"{type(error).__name__}: {str(error)[:900]}"], 0
        bad += bool(problems)
        flag = "EMPTY" if not rows and not problems else "ok" if not problems else "DIFF"
        print(f"{flag:5} {name:24} rows={rows:<7} {time.time() - start:5.2f}s", *problems, flush=True)
    print("failed", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
