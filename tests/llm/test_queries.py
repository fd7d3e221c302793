"""Registered queries of the subpackage against their SQL."""

import pytest
from compare import SPARK_TO_SQL, column_types, connect, spark_rows, sql_rows

from quadrangle.llm.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", ORACLES)
def test_matches_sql(name, spark, sf_dir):
    con = connect(sf_dir)
    df = QUERIES[name](spark, sf_dir)
    assert {c: SPARK_TO_SQL.get(t, t) for c, t in df.dtypes} == column_types(con, ORACLES[name])
    assert spark_rows(df) == sql_rows(con, ORACLES[name])
