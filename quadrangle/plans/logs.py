"""Structured log rows."""

from pyspark.sql import functions as F

from quadrangle import schemas
from quadrangle.functions.text import day_path, iso_timestamp, json_object, short_checksum
from quadrangle.sinks.files import land_json


def log_rows(entries):
    """Entries (ts, level, message, university, faculty, source) as log rows.

    Adds `object_path`, where an entry is stored.
    """
    shaped = entries.select(
        "ts",
        iso_timestamp(F.col("ts")).alias("timestamp"),
        F.upper("level").alias("level"),
        "message",
        "university",
        "faculty",
        F.coalesce("source", F.lit("unknown")).alias("source"),
    )
    content = json_object(**{name: F.col(name) for name in schemas.LOG.names})
    path = F.concat(
        F.lit("university="), "university", F.lit("/faculty="), "faculty", F.lit("/"),
        day_path(F.col("ts")), F.lit("/log_"), short_checksum(content), F.lit(".json"),
    )
    return shaped.withColumn("object_path", path).drop("ts")


def sidecars(rows):
    """The metadata row of each log row, with the path of the object it describes."""
    return rows.select(
        F.col("object_path"), "source", "university", "faculty", F.col("timestamp").alias("log_timestamp"), "level"
    )


def write(rows, root, sidecar_root, batch):
    """Land log rows, and their metadata rows in a tree of their own, below university,
    faculty, day and `batch`, a name for the rows of one call.

    A batch written again replaces itself. Entries are meant to be gathered: one call
    writes any number of them. Without `sidecar_root` there are no metadata rows."""
    day = F.to_date(F.substring("timestamp", 1, 10))
    folders = {
        "university": F.col("university"),
        "faculty": F.col("faculty"),
        "year": F.date_format(day, "yyyy"),
        "month": F.date_format(day, "MM"),
        "day": F.date_format(day, "dd"),
        "batch": F.lit(batch),
    }
    land_json(rows, schemas.LOG.names, folders, root)
    if sidecar_root is None:
        return
    stamped = {**folders, **{n: F.date_format(F.to_date(F.substring("log_timestamp", 1, 10)), f) for n, f in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))}}
    land_json(sidecars(rows), schemas.LOG_SIDECAR.names, stamped, sidecar_root)
