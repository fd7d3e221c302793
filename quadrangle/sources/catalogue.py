"""A table of the objects in a bucket, refreshed from listings.

Jobs ask this table what is stored instead of the bucket: requested pairs meet it by a
join, and a listing only has to find what came after the last one. Raw zones are added
to and objects replaced; an object that was taken away stays in the table until it is
built anew.
"""

from pyspark.sql import functions as F

from quadrangle import schemas
from quadrangle.operators.upsert import read_table, upsert
from quadrangle.sources.raw import folder_value, not_sidecar, object_files, relative_path


def refresh(spark, root, table):
    """Enter objects that are new or were changed since the last refresh; returns how many rows
    were put. Objects of the last moment seen are listed again, as others may share it."""
    last = read_table(spark, table, schemas.OBJECT).agg(F.max(F.unix_micros("modified"))).first()[0]
    found = object_files(spark, root, modified_from=last).select(
        relative_path(F.col("path")).alias("path"),
        "length",
        F.col("modificationTime").alias("modified"),
        folder_value(F.col("path"), "university").alias("university"),
        folder_value(F.col("path"), "faculty").alias("faculty"),
    )
    return upsert(found, table, keys=("path",), order="modified")


def objects(spark, table, pairs=None):
    """The objects in the table, sidecars aside; of all folders or of the (university, faculty)
    pairs of a DataFrame."""
    rows = read_table(spark, table, schemas.OBJECT).filter(not_sidecar(F.col("path")))
    return rows if pairs is None else rows.join(pairs.select("university", "faculty").distinct(), ["university", "faculty"], "left_semi")


def partitions(spark, table, root, subfolder=""):
    """university, faculty and path of the folders that hold objects, as `stored_partitions`."""
    rows = read_table(spark, table, schemas.OBJECT)
    inside = F.regexp_extract("path", rf"\A(university=[^/]+/faculty=[^/]+/{subfolder})", 1)
    held = rows.where("university IS NOT NULL AND faculty IS NOT NULL").select("university", "faculty", inside.alias("inside"))
    return held.where("inside <> ''").distinct().select("university", "faculty", F.concat(F.lit(root.rstrip("/") + "/"), "inside").alias("path"))
