"""Every registered query gives the rows, names and types of its SQL."""

import pytest

import __spark_entry__ as entry_points
from herdloom.catalog.base import ORACLES, QUERIES
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    problems, _ = compare(entry_points.queries()[name](spark, SF), con, ORACLES[name])
    assert not problems, problems


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert "status" in df.columns and df.count() > 0


@pytest.mark.parametrize("name", ["core_farm", "core_animal", "core_animal_event", "core_odk_form", "country_units"])
def test_views_equal_in_both_engines(spark, con, name):
    from herdloom.catalog.bindings import Tables, with_views

    df = Tables(spark, SF)[name]
    ours = sorted(map(str, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))
    rel = con.sql(f"with {with_views(name)} select * from {name}")
    order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    assert ours == sorted(str(tuple(row[i] for i in order)) for row in rel.fetchall())
