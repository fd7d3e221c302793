"""Extracted-text payloads -> course catalogue."""

from pyspark.sql import functions as F

from quadrangle import schemas
from quadrangle.constants import (
    COURSE_KEYWORDS,
    COURSE_LANGUAGE,
    COURSE_NAME_PATTERN,
    COURSE_SOURCE,
    PDF_STEM_PATTERN,
)
from quadrangle.functions.text import any_of, record_key
from quadrangle.operators.latest import first_per_key
from quadrangle.operators.upsert import upsert
from quadrangle.plans.profiles import quarantine, resolved_folders
from quadrangle.session import cut
from quadrangle.sources.raw import CORRUPT, readable, scan_payloads, unreadable


def is_course(path):
    """The source path carries one of the course keywords."""
    return any_of([F.lower(path).contains(keyword) for keyword in COURSE_KEYWORDS])


def file_stem(path):
    """Name of a `.pdf` file without its ending, "" for other paths."""
    return F.regexp_extract(path, PDF_STEM_PATTERN, 1)


def course_name(raw_filename):
    """The part after the course prefix, or the file stem where that part is blank."""
    name = F.regexp_extract(raw_filename, COURSE_NAME_PATTERN, 1)
    return F.when(F.trim(name) != "", name).otherwise(raw_filename)


def course_documents(payloads):
    """Payloads whose source URL speaks of a course, flattened."""
    path = F.col("metadata.source_url")
    return payloads.filter(is_course(path)).select(
        path.alias("source_path"),
        F.col("text").alias("text_content"),
        "university",
        "faculty",
        F.col("metadata.extract_timestamp").alias("extract_timestamp"),
        F.col("metadata.content_checksum").alias("content_checksum"),
    )


def course_catalog(payloads, run_ts):
    """One course per file stem and faculty; the lowest source path wins, in its newest
    extraction. Texts are not compared: a checksum settles what ties remain."""
    named = course_documents(payloads).withColumn("raw_filename", file_stem(F.col("source_path")))
    keyed = named.withColumns(
        {
            "course_name": course_name(F.col("raw_filename")),
            "record_id": record_key(F.col("raw_filename"), F.col("faculty")),
        }
    )
    survivors = first_per_key(
        keyed.filter(F.col("course_name").isNotNull()),
        ["university", "faculty", "record_id"],
        [F.asc("source_path"), F.desc_nulls_last("extract_timestamp"), F.asc_nulls_last("content_checksum")],
    )
    return survivors.withColumns(
        {
            "source_system": F.lit(COURSE_SOURCE),
            "business_timestamp": run_ts,
            "is_deleted": F.lit(False),
            "language": F.lit(COURSE_LANGUAGE),
        }
    ).select(*schemas.COURSE.names)


def row_counts(payloads):
    """One row: raw payloads, and courses `course_catalog` makes of them, in one pass
    that reads no text."""
    path = F.col("metadata.source_url")
    stem = F.when(is_course(path), file_stem(path)).alias("stem")
    per_key = payloads.groupBy("university", "faculty", stem).agg(F.count(F.lit(1)).alias("rows"))
    return per_key.agg(F.sum("rows").alias("raw_rows"), F.count("stem").alias("clean_rows"))


def preview(courses, rows=20):
    """The first courses by name."""
    return (
        courses.select("course_name", "raw_filename", "faculty")
        .orderBy("course_name", "raw_filename", "faculty")
        .limit(rows)
    )


def run(spark, root, table_path, pairs, run_ts=None, multi_line=False, quarantine_path=None, catalogue=None):
    """Build and upsert the courses of all requested faculties.

    The raw JSON is read once, into a staged table that holds the texts of courses only.
    Returns the raw rows and the rows of the upserted batch, and with `quarantine_path` the
    records put there as not readable."""
    run_ts = run_ts if run_ts is not None else F.current_timestamp()
    counts = {"raw": 0, "clean": 0} | ({"unreadable": 0} if quarantine_path else {})
    # folders go to the reader by name; there are no more of them than requests
    paths = [row.path for row in resolved_folders(spark, root, pairs, catalogue=catalogue).collect()]
    if not paths:
        return counts
    fields = schemas.PAYLOAD.names
    scan = scan_payloads(spark, paths, multi_line)
    needed = scan.withColumn("text", F.when(is_course(F.col("metadata.source_url")) | F.col(CORRUPT).isNotNull(), F.col("text")))
    staged = cut(needed.select(*fields, "university", "faculty", CORRUPT, "object_path"))
    if quarantine_path:
        counts["unreadable"] = quarantine(unreadable(staged, fields), quarantine_path, run_ts)
    payloads = readable(staged, fields)
    counts["raw"] = payloads.count()
    if counts["raw"]:
        counts["clean"] = upsert(course_catalog(payloads, run_ts), table_path)
    return counts
