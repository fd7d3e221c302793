"""Raw works and authors -> landed JSON, with a record count per batch."""

from pyspark.sql import functions as F

from quadrangle import schemas
from quadrangle.constants import LANDING_SOURCE
from quadrangle.functions.text import clock_timestamp, compact_timestamp, iso_timestamp, slug
from quadrangle.operators.latest import cap_rows
from quadrangle.sinks.files import land_json


def publications(works, run_ts):
    """Flat publication rows; no citations and no open-access entry mean 0 and false."""
    return works.select(
        F.col("id").alias("work_id"),
        F.col("display_name").alias("title"),
        "university",
        "faculty",
        "publication_year",
        F.coalesce("cited_by_count", F.lit(0)).cast("bigint").alias("cited_by_count"),
        "type",
        "doi",
        F.coalesce("open_access.is_oa", F.lit(False)).alias("open_access"),
        clock_timestamp(run_ts).alias("retrieved_at"),
    ).select(*schemas.PUBLICATION.names)


def cap_per_faculty(rows, limit):
    """At most `limit` records per faculty, the first by id; the other columns settle ties."""
    order = ["id", "display_name", *(c for c in rows.columns if c not in ("id", "display_name"))]
    return cap_rows(rows, ["university", "faculty"], [F.asc_nulls_first(c) for c in order], limit)


def batch_counts(rows, data_type, run_ts):
    """One sidecar row per landed batch."""
    return rows.groupBy("university", "faculty").agg(F.count(F.lit(1)).alias("records_count")).select(
        F.lit(LANDING_SOURCE).alias("source"),
        "university",
        "faculty",
        F.lit(data_type).alias("data_type"),
        iso_timestamp(run_ts).alias("crawl_timestamp"),
        "records_count",
    )


def land(rows, fields, root, data_type, run_ts):
    """Write `fields` of each record below university slug, faculty, type, day and batch.

    The batch folder is named from `run_ts`: writing a batch again replaces it, a batch
    with another time is added beside it."""
    folders = {
        "university": slug(F.col("university")),
        "faculty": F.col("faculty"),
        "type": F.lit(data_type),
        "year": F.date_format(run_ts, "yyyy"),
        "month": F.date_format(run_ts, "MM"),
        "day": F.date_format(run_ts, "dd"),
        "batch": compact_timestamp(run_ts),
    }
    land_json(rows, fields, folders, root)


def run(authors, works, root, sidecar_root, run_ts):
    """Enrich and land all records of both kinds, and their counts in a tree of their own."""
    for rows, schema, data_type in (
        (authors, schemas.AUTHOR, "authors"),
        (publications(works, run_ts), schemas.PUBLICATION, "publications"),
    ):
        land(rows, schema.names, root, data_type, run_ts)
        counts = batch_counts(rows, data_type, run_ts)
        land(counts, counts.columns, sidecar_root, data_type, run_ts)
