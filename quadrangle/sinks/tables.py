"""Catalog tables: the curated tables under their reporting names, and search documents."""

from quadrangle import schemas

TABLES = {
    "faculty_profiles": (schemas.PROFILE_REPORT, ["university"]),
    "course_catalog": (schemas.COURSE_REPORT, ["university"]),
    "university_content": (schemas.SEARCH_DOCUMENT, ["university", "faculty"]),
}


def create_tables(spark, location, database="university_db"):
    """Create the database and its partitioned tables where absent; returns their names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")
    names = []
    for table, (schema, partitions) in TABLES.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.`{table}` ({columns}) USING parquet "
            f"PARTITIONED BY ({', '.join(partitions)}) LOCATION '{location}/{table}'"
        )
        names.append(f"`{database}`.`{table}`")
    return names


def append_to_table(df, table):
    """Append by column name; columns the table has and `df` lacks become NULL."""
    spark = df.sparkSession
    target = spark.table(table)
    empty = target.limit(0)
    rows = empty.unionByName(df.select(*[c for c in df.columns if c in target.columns]), True)
    partitions = [c.name for c in spark.catalog.listColumns(table.replace("`", "")) if c.isPartition]
    rows.hint("rebalance", *partitions).write.mode("append").insertInto(table)
