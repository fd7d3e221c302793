"""Compare a Spark result with a SQL result, order aside."""

import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def sql_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return _sorted(names, cursor.fetchall())


def spark_rows(df):
    return _sorted(df.columns, [tuple(row) for row in df.collect()])


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    shaped = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(shaped, key=repr)


def column_types(con, sql):
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    return {row[0]: row[1] for row in described}


SPARK_TO_SQL = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE",
}
