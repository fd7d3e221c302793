"""Every registered query against its SQL."""

import pytest
from compare import SPARK_TO_SQL, column_types, connect, spark_rows, sql_rows

import __spark_entry__ as entry_points
from workload.oracles import ORACLES
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(name, spark, sf_dir, con):
    df = entry_points.queries()[name](spark, sf_dir)
    sql = entry_points.oracle_sql()[name]
    assert {c: SPARK_TO_SQL.get(t, t) for c, t in df.dtypes} == column_types(con, sql)
    assert spark_rows(df) == sql_rows(con, sql)


@pytest.mark.parametrize("name, count, key", [
    ("report_staff_per_faculty", "nb_profs", "faculty"),
    ("report_courses_per_level", "nb_cours", "level"),
    ("report_publications_per_university", "total_publications", "university"),
])
def test_reports_come_in_order(name, count, key, spark):
    """Highest first, then by the group's name, groups without a name first."""
    rows = [(r[count], r[key]) for r in QUERIES[name](spark, "/root/testdata/sf0.01").collect()]
    assert len(rows) > 1
    assert rows == sorted(rows, key=lambda r: (-(r[0] or 0), r[1] is not None, r[1] or ""))


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["university", "total_publications"]
