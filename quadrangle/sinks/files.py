"""Partitioned writers."""

from pyspark.sql import functions as F


def land_json(df, fields, folders, path):
    """Write `fields` as JSON Lines below the folders given as {name: column}; a folder that
    gets rows is replaced as a whole, all others stay.

    The record keeps fields that share a name with a folder, and NULL fields. The
    rebalance gives each folder few, evenly sized files: small folders share a task,
    a folder that holds much of the data is split over many.
    """
    record = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value")
    placed = df.select(record, *[column.alias(f"_{name}") for name, column in folders.items()])
    placed = placed.withColumnsRenamed({f"_{name}": name for name in folders})
    (
        placed.hint("rebalance", *folders)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders)
        .text(path)
    )
