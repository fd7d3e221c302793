"""HTML objects -> search documents."""

from hashlib import sha256

from pyspark.sql import functions as F

from quadrangle import schemas
from quadrangle.constants import BUCKETS
from quadrangle.operators.progress import read_mark, write_mark
from quadrangle.operators.upsert import upsert
from quadrangle.sources.raw import object_files, read_html_objects


def search_documents(objects, run_ts, content_chars=None):
    """`objects`: object_name, html, university, faculty. Mapped fields without a source are NULL.

    The whole text is kept; `content_chars` asks for a preview of that length instead."""
    filled = objects.select(
        F.md5("object_name").alias("record_id"),
        (F.col("html") if content_chars is None else F.substring("html", 1, content_chars)).alias("content"),
        "university",
        "faculty",
        F.lit("html").alias("file_type"),
        F.concat(F.lit(f"s3://{BUCKETS['html']}/"), "object_name").alias("storage_path"),
        run_ts.alias("crawl_timestamp"),
    )
    fields = {f.name: f.dataType for f in schemas.SEARCH_DOCUMENT.fields}
    missing = {n: F.lit(None).cast(t) for n, t in fields.items() if n not in filled.columns}
    return filled.withColumns(missing).select(*fields)


def run(spark, root, table_path, run_ts=None, pairs=None, progress=None):
    """Put the documents of the stored HTML objects, of all faculties or of the given
    (university, faculty) pairs; a later document replaces an earlier one. Returns the
    number of documents put.

    With `progress`, a table of marks, only objects changed since the last run with it are
    read: first their times are listed, then the contents up to the newest time. Objects of
    the very moment of the last mark are read again, as others may share it. A mark is kept
    for every root and set of pairs; a run that fails leaves the old one."""
    start = end = None
    if progress:
        if pairs is not None and not isinstance(pairs, list):
            raise ValueError("marks are kept for pairs given as a list")
        job = f"{root} {sha256(repr(sorted(pairs)).encode()).hexdigest() if pairs else ''}"
        start = read_mark(spark, progress, job)
        end = object_files(spark, root, pairs, start).agg(F.max(F.unix_micros("modificationTime"))).first()[0]
        if end is None:
            return 0
    objects = read_html_objects(spark, root, pairs, start, end)
    documents = search_documents(objects, run_ts if run_ts is not None else F.current_timestamp())
    put = upsert(documents, table_path, order="crawl_timestamp")
    if progress:
        write_mark(spark, progress, job, end)
    return put
