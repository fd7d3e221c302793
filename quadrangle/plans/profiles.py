"""Raw authors -> faculty profiles."""

from pyspark.sql import functions as F

from quadrangle import schemas
from quadrangle.constants import PROFILE_LANGUAGE, PROFILE_SOURCE
from quadrangle.functions.text import record_key
from quadrangle.operators.latest import first_per_key
from quadrangle.operators.resolve import resolve_universities
from quadrangle.operators.upsert import upsert
from quadrangle.session import cut
from quadrangle.sources.catalogue import partitions
from quadrangle.sources.raw import CORRUPT, readable, scan_authors, stored_partitions, unreadable


def faculty_profiles(authors, run_ts):
    """One named profile per author and faculty.

    `authors`: the raw author columns, university, faculty. Unnamed rows go before the
    shuffle; of several rows the one with most works wins, so that re-runs agree.
    """
    named = authors.filter(F.col("display_name").isNotNull()).select(
        F.col("id").alias("author_id"),
        F.col("display_name").alias("full_name"),
        "orcid",
        "works_count",
        "cited_by_count",
        F.get("last_known_institutions", F.lit(0)).getField("display_name").alias("institution_name"),
        "university",
        "faculty",
    )
    survivors = first_per_key(
        named,
        ["university", "faculty", "author_id"],
        [
            F.desc_nulls_last("works_count"),
            F.asc("full_name"),
            F.desc_nulls_last("cited_by_count"),
            F.asc_nulls_last("institution_name"),
            F.asc_nulls_last("orcid"),
        ],
    )
    return survivors.withColumns(
        {
            "source_system": F.lit(PROFILE_SOURCE),
            "record_id": record_key(F.col("author_id"), F.col("faculty")),
            "business_timestamp": run_ts,
            "is_deleted": F.lit(False),
            "language": F.lit(PROFILE_LANGUAGE),
        }
    ).select(*schemas.PROFILE.names)


def row_counts(authors):
    """One row: raw authors, and profiles `faculty_profiles` makes of them, in one pass."""
    per_key = authors.groupBy("university", "faculty", "id").agg(
        F.count(F.lit(1)).alias("rows"), F.count("display_name").alias("named")
    )
    return per_key.agg(F.sum("rows").alias("raw_rows"), F.count_if(F.col("named") > 0).alias("clean_rows"))


def preview(profiles, rows=10):
    """The first profiles by name."""
    return (
        profiles.select("full_name", "works_count", "cited_by_count", "faculty")
        .orderBy("full_name", "faculty", "works_count", "cited_by_count")
        .limit(rows)
    )


def resolved_folders(spark, root, pairs, subfolder="", catalogue=None):
    """(university, faculty, path) of each requested (hint, faculty) that is stored.

    `catalogue`: the table of objects to ask (see `sources.catalogue`); without one the
    folders are looked up in the bucket."""
    stored = partitions(spark, catalogue, root, subfolder) if catalogue else stored_partitions(spark, root, subfolder)
    requested = spark.createDataFrame(pairs, "hint string, faculty string")
    resolved = resolve_universities(requested, stored).select("university", "faculty").distinct()
    return cut(resolved.join(stored, ["university", "faculty"]).select("university", "faculty", "path"))


def quarantine(rows, path, run_ts):
    """Keep records that could not be read, each once; returns how many there were."""
    keyed = rows.select(
        record_key(F.col("object_path"), F.col("record")).alias("record_id"), "object_path", "record", "reason",
        "university", "faculty", run_ts.alias("found_at"),
    )
    return upsert(keyed, path, order="found_at")


def run(spark, root, table_path, pairs, run_ts=None, multi_line=False, quarantine_path=None, catalogue=None):
    """Build and upsert the profiles of all requested faculties in one go.

    The raw JSON is read once, into a staged table; counts are those of staged rows, so
    that a task that ran again adds nothing. Returns the raw rows and the rows of the
    upserted batch, and with `quarantine_path` the records put there as not readable."""
    run_ts = run_ts if run_ts is not None else F.current_timestamp()
    folders = resolved_folders(spark, root, pairs, "type=authors", catalogue)
    columns = [*schemas.AUTHOR.names, "university", "faculty"]
    # no more folders than requests, a list
    staged = cut(scan_authors(spark, root, folders, multi_line, small=True).select(*columns, CORRUPT, "object_path"))
    counts = {"raw": 0, "clean": 0}
    if quarantine_path:
        counts["unreadable"] = quarantine(unreadable(staged, schemas.AUTHOR.names), quarantine_path, run_ts)
    authors = readable(staged, schemas.AUTHOR.names).dropna("all", subset=schemas.AUTHOR.names)
    counts["raw"] = authors.count()
    if counts["raw"]:
        counts["clean"] = upsert(faculty_profiles(authors, run_ts), table_path)
    return counts
