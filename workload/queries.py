"""One query per operator group of the inventory; each takes (spark, sf_dir)."""

import uuid

from pyspark.sql import functions as F

from quadrangle import schemas
from quadrangle.functions.text import last_segment, looks_dynamic, lossy_utf8
from quadrangle.functions.urls import file_type, netloc
from quadrangle.operators.concat import join_pages
from quadrangle.operators.latest import first_per_key
from quadrangle.operators.links import allowed_link, page_links
from quadrangle.operators.reach import reach
from quadrangle.operators.resolve import resolve_universities
from quadrangle.operators.upsert import read_table, upsert
from quadrangle.plans import courses, crawl, landing, logs, payloads, profiles, reports, search
from quadrangle.session import cut, scratch_path
from quadrangle.sinks.compact import compact
from quadrangle.sinks.files import land_json
from quadrangle.sinks.tables import append_to_table, create_tables
from quadrangle.sources import catalogue
from quadrangle.sources.raw import (
    list_objects, read_authors, read_html_objects, read_payloads, read_sidecars, read_stored_pages,
)
from workload import fixtures as fx


def _naive(df, *columns):
    """Instants as wall-clock time, the type the SQL side uses."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _profiles(spark, sf_dir, run_ts=fx.DAY_ONE):
    return profiles.faculty_profiles(fx.authors(spark, sf_dir), fx.instant(run_ts))


def _courses(spark, sf_dir, run_ts=fx.DAY_ONE):
    return courses.course_catalog(fx.course_payloads(spark, sf_dir), fx.instant(run_ts))


def _levelled_courses(spark, sf_dir):
    """Courses with a level: the last digit of the file stem, NULL where there is none."""
    digit = F.regexp_extract("raw_filename", r"([0-9])$", 1)
    return _courses(spark, sf_dir).withColumn("level", F.when(digit != "", digit))


def author_normalize(spark, sf_dir):
    return _naive(_profiles(spark, sf_dir), "business_timestamp")


def report_staff_per_faculty(spark, sf_dir):
    return reports.staff_per_faculty(reports.profile_report_view(_profiles(spark, sf_dir)))


def report_courses_per_level(spark, sf_dir):
    return reports.courses_per_level(reports.course_report_view(_levelled_courses(spark, sf_dir)))


def report_staff_per_university(spark, sf_dir):
    return reports.staff_per_university(reports.profile_report_view(_profiles(spark, sf_dir)))


def report_publications_per_university(spark, sf_dir):
    return reports.publications_per_university(reports.profile_report_view(_profiles(spark, sf_dir)))


def course_keyword_filter(spark, sf_dir):
    return courses.course_documents(fx.course_payloads(spark, sf_dir)).drop("extract_timestamp", "content_checksum")


def course_catalog(spark, sf_dir):
    return _naive(_courses(spark, sf_dir), "business_timestamp")


def _profile_job(spark, sf_dir):
    """Land the authors, build their table; its path and the counts the job returns."""
    root, path = scratch_path(spark, "raw-json"), scratch_path(spark, "faculty_profiles")
    authors = fx.authors(spark, sf_dir)
    landing.land(authors, schemas.AUTHOR.names, root, "authors", fx.instant())
    pairs = [tuple(r) for r in authors.select("university", "faculty").distinct().collect()]
    return path, profiles.run(spark, root, path, [*pairs, ("stored nowhere", "X")], fx.instant())


def _course_job(spark, sf_dir):
    """Land the payloads, build the course table; its path and the counts the job returns."""
    root, path = scratch_path(spark, "raw-json"), scratch_path(spark, "course_catalog")
    landed = fx.course_payloads(spark, sf_dir)
    land_json(landed, ["metadata", "text"], {n: F.col(n) for n in ("university", "faculty")}, root)
    pairs = [tuple(r) for r in landed.select("university", "faculty").distinct().collect()]
    return path, courses.run(spark, root, path, pairs, fx.instant())


def job_profiles(spark, sf_dir):
    path, _ = _profile_job(spark, sf_dir)
    return _naive(read_table(spark, path, schemas.PROFILE), "business_timestamp")


def job_courses(spark, sf_dir):
    path, _ = _course_job(spark, sf_dir)
    return _naive(read_table(spark, path, schemas.COURSE), "business_timestamp")


def job_counts(spark, sf_dir):
    """What the two jobs report, over the rows they stored."""
    (staff, people), (lessons, texts) = _profile_job(spark, sf_dir), _course_job(spark, sf_dir)
    rows = None
    for job, path, schema, counts in (
        ("faculty_profiles", staff, schemas.PROFILE, people), ("course_catalog", lessons, schemas.COURSE, texts)
    ):
        stored = read_table(spark, path, schema).agg(F.count(F.lit(1)).alias("stored_rows"))
        one = stored.select(
            F.lit(job).alias("job"), F.lit(counts["raw"]).cast("bigint").alias("raw_rows"),
            F.lit(counts["clean"]).cast("bigint").alias("clean_rows"), "stored_rows",
        )
        rows = one if rows is None else rows.union(one)
    return rows


def job_landing(spark, sf_dir):
    """Both record kinds landed by the job; the counts it leaves beside them."""
    root, sidecars = scratch_path(spark, "raw-json"), scratch_path(spark, "raw-json-meta")
    for _ in range(2):
        landing.run(fx.authors(spark, sf_dir), fx.works(spark, sf_dir), root, sidecars, fx.instant())
    counts = spark.read.schema(schemas.LANDING_SIDECAR).option("recursiveFileLookup", "true").json(sidecars)
    return counts.select("source", "university", "faculty", "data_type", "crawl_timestamp", "records_count")


def landing_rerun(spark, sf_dir):
    """A batch landed twice is there once."""
    root, sidecars = scratch_path(spark, "raw-json"), scratch_path(spark, "raw-json-meta")
    for _ in range(2):
        landing.run(fx.authors(spark, sf_dir), fx.works(spark, sf_dir), root, sidecars, fx.instant())
    return spark.read.schema(schemas.PUBLICATION).option("pathGlobFilter", "*.txt").json(
        f"{root}/university=*/faculty=*/type=publications/*/*/*/*"
    )


def manifest_rerun(spark, sf_dir):
    """A crawl stored twice has one manifest row per object."""
    path = scratch_path(spark, "manifest")
    for _ in range(2):
        crawl.store_manifest(crawl.manifest(_fetched(spark, sf_dir), fx.instant()), path)
    return read_table(spark, path, schemas.MANIFEST)


def payload_reextract(spark, sf_dir):
    """Texts extracted twice, then again with changes: one payload per object, the last."""
    root = scratch_path(spark, "payloads")
    for day, more in ((fx.DAY_ONE, ""), (fx.DAY_ONE, ""), (fx.DAY_TWO, " changed")):
        payloads.write(_payloads(spark, sf_dir, day, more), root)
    return payloads.newest(read_payloads(spark, root)).select("metadata.source_path", "metadata.content_checksum", "text")


def job_payloads(spark, sf_dir):
    """Page texts joined and landed by the job; the stored payloads."""
    root = scratch_path(spark, "payloads")
    pages = fx.stored_documents(spark, sf_dir).withColumn("page_no", F.lit(0))
    payloads.run(pages, fx.document_sidecars(spark, sf_dir), root, fx.instant(fx.DAY_TWO))
    return read_payloads(spark, root).select("metadata.source_path", "metadata.source_url", "text", "university", "faculty")


def job_crawl(spark, sf_dir):
    """The walk run by the job, twice; counters, and manifest rows per crawl."""
    path = scratch_path(spark, "manifest")
    for _ in range(2):
        counts = crawl.run(fx.web_pages(spark, sf_dir), fx.web_seeds(spark, sf_dir), path, fx.instant())
    stored = read_table(spark, path, schemas.MANIFEST).groupBy("university").agg(F.count(F.lit(1)).alias("manifest_rows"))
    return counts.join(stored, "university", "left")


def log_sidecars(spark, sf_dir):
    """The metadata rows written beside the log entries."""
    root, sidecars = scratch_path(spark, "logs"), scratch_path(spark, "logs-meta")
    logs.write(logs.log_rows(fx.log_entries(spark, sf_dir)), root, sidecars, "day")
    return spark.read.schema(schemas.LOG_SIDECAR).option("recursiveFileLookup", "true").json(sidecars)


def preview_topn(spark, sf_dir):
    return profiles.preview(_profiles(spark, sf_dir))


def preview_courses(spark, sf_dir):
    return courses.preview(_courses(spark, sf_dir))


def publication_enrich(spark, sf_dir):
    rows = landing.publications(fx.works(spark, sf_dir), fx.instant())
    return rows.withColumn("work_code", last_segment(F.col("work_id")))


def cap_per_faculty(spark, sf_dir):
    capped = landing.cap_per_faculty(fx.works(spark, sf_dir), 500)
    return capped.select("university", "faculty", "id", "display_name")


def batch_record_counts(spark, sf_dir):
    return landing.batch_counts(fx.works(spark, sf_dir), "publications", fx.instant())


def landing_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "landing")
    rows = landing.publications(fx.works(spark, sf_dir), fx.instant())
    landing.land(rows, schemas.PUBLICATION.names, root, "publications", fx.instant())
    landed = spark.read.schema(schemas.PUBLICATION).option("recursiveFileLookup", "true").json(root)
    folder = F.regexp_extract("_metadata.file_path", r"(type=.*)/[^/]+\z", 1)
    return landed.withColumn("folder", folder)


def author_scan_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "authors")
    landing.land(fx.authors(spark, sf_dir), schemas.AUTHOR.names, root, "authors", fx.instant())
    institution = F.get("last_known_institutions", F.lit(0)).getField("display_name")
    return read_authors(spark, root).withColumn("institution_name", institution).drop("last_known_institutions")


def file_type_route(spark, sf_dir):
    return crawl.classified(fx.crawled(spark, sf_dir).select("url")).withColumn(
        "is_fetched", F.col("file_type") != "skip"
    )


def _fetched(spark, sf_dir):
    content = F.col("content")
    return fx.crawled(spark, sf_dir).withColumn("content_checksum", crawl.content_checksum(content))


def crawl_manifest(spark, sf_dir):
    return crawl.manifest(_fetched(spark, sf_dir), fx.instant())


def manifest_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "manifest")
    crawl.store_manifest(crawl.manifest(_fetched(spark, sf_dir), fx.instant()), path)
    return read_table(spark, path, schemas.MANIFEST)


def crawl_stats(spark, sf_dir):
    return crawl.crawl_counts(_fetched(spark, sf_dir))


def dynamic_pages(spark, sf_dir):
    return fx.marked_pages(spark, sf_dir).select("page_id", "url", looks_dynamic(F.col("html")).alias("is_dynamic"))


def _own_links(spark, sf_dir):
    return page_links(fx.linked_pages(spark, sf_dir), keep=["page_id", "url"]).filter(
        allowed_link(netloc(F.col("url")))
    )


def page_links_query(spark, sf_dir):
    return _own_links(spark, sf_dir).select("page_id", "link", file_type(F.col("link")).alias("file_type"))


def links_per_page(spark, sf_dir):
    # links are distinct within their page, so a plain count is enough
    return _own_links(spark, sf_dir).groupBy("page_id").agg(F.count(F.lit(1)).alias("n_links"))


def bounded_reach(spark, sf_dir):
    return reach(fx.link_edges(spark, sf_dir), fx.link_seeds(spark, sf_dir), groups=["university"])


def crawl_walk(spark, sf_dir):
    fetched = crawl.fetched_objects(fx.web_pages(spark, sf_dir), fx.web_seeds(spark, sf_dir))
    return crawl.crawl_counts(fetched)


def text_concat(spark, sf_dir):
    return join_pages(fx.table(spark, sf_dir, "conversations"), ["conv_id"], page_no="turn")


def _payloads(spark, sf_dir, run_ts=fx.DAY_TWO, more=""):
    documents = fx.stored_documents(spark, sf_dir).withColumn("text", F.when(F.col("text") != "", F.concat("text", F.lit(more))).otherwise(F.col("text")))
    return payloads.payloads(documents, fx.document_sidecars(spark, sf_dir), fx.instant(run_ts))


def extraction_payload(spark, sf_dir):
    return _payloads(spark, sf_dir).select("metadata.*", "text")


def extraction_stats(spark, sf_dir):
    documents = fx.stored_documents(spark, sf_dir).withColumn("n_chars", F.length("text"))
    return payloads.extraction_counts(documents)


def payload_scan_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "payloads")
    payloads.write(_payloads(spark, sf_dir), root)
    return read_payloads(spark, root).select(
        "metadata.source_path", "metadata.source_url", "metadata.content_checksum", "text", "university", "faculty"
    )


def payload_folders(spark, sf_dir):
    root = scratch_path(spark, "payloads")
    payloads.write(_payloads(spark, sf_dir), root)
    folder = F.regexp_replace("path", "/[^/]*$", "").alias("folder")
    return list_objects(spark, root).where("length > 0").select("university", "faculty", folder).distinct()


def _site(spark, sf_dir, days=(1, 2)):
    root = scratch_path(spark, "raw-web-html")
    for day in days:
        fx.store_site(spark, sf_dir, root, day)
    return root


def object_listing(spark, sf_dir):
    """Path and length of stored objects; the sidecars among them are no objects."""
    return list_objects(spark, _site(spark, sf_dir))


def object_catalogue(spark, sf_dir):
    """The table of objects after two refreshes, for the folders of one university's pairs."""
    root, path = scratch_path(spark, "raw-web-html"), scratch_path(spark, "catalogue")
    for day in (1, 2):
        fx.store_site(spark, sf_dir, root, day)
        catalogue.refresh(spark, root, path)
    pairs = fx.site_objects(spark, sf_dir, 2).select("university", "faculty").where("faculty <> 'en'")
    return catalogue.objects(spark, path, pairs).select("university", "faculty", "path", "length")


def html_scan(spark, sf_dir):
    objects = read_html_objects(spark, _site(spark, sf_dir))
    return objects.select("university", "faculty", "object_name", F.length("html").cast("bigint").alias("n_chars"), F.md5("html").alias("checksum"))


def sidecar_scan(spark, sf_dir):
    """Sidecars read from storage, where they lie among the objects."""
    return read_sidecars(spark, _site(spark, sf_dir))


def stored_pages(spark, sf_dir):
    """The newest stored copy of every page that has a sidecar."""
    newest = crawl.newest_pages(read_stored_pages(spark, _site(spark, sf_dir)))
    return newest.select("url", F.md5("html").alias("checksum"))


def job_search(spark, sf_dir):
    """Stored HTML objects put as search documents, day by day; each run reads what is new."""
    root, path, progress = (scratch_path(spark, name) for name in ("raw-web-html", "university_content", "progress"))
    for day, stamp in ((1, fx.DAY_ONE), (2, fx.DAY_TWO)):
        fx.store_site(spark, sf_dir, root, day)
        search.run(spark, root, path, fx.instant(stamp), progress=progress)
    return read_table(spark, path, schemas.SEARCH_DOCUMENT).select("record_id", "content", "university", "faculty", "file_type", "storage_path")


def search_preview(spark, sf_dir):
    """The first 10,000 characters beside the length of the whole text."""
    objects = fx.site_objects(spark, sf_dir, 1)
    short = search.search_documents(objects, fx.instant(), content_chars=10_000).select("record_id", F.col("content").alias("preview"))
    whole = search.search_documents(objects, fx.instant()).select("record_id", F.length("content").cast("bigint").alias("n_chars"))
    return short.join(whole, "record_id")


def scan_quarantine(spark, sf_dir):
    """What the profile job puts aside: records it could not read, or not in every field."""
    root, path, aside = (scratch_path(spark, name) for name in ("raw-json", "faculty_profiles", "quarantine"))
    fx.store_author_lines(spark, sf_dir, root)
    pairs = [tuple(r) for r in fx.author_lines(spark, sf_dir).select("university", "faculty").distinct().collect()]
    profiles.run(spark, root, path, pairs, fx.instant(), quarantine_path=aside)
    return read_table(spark, aside, schemas.UNREADABLE).select("record", "reason", "university", "faculty")


def scan_readable(spark, sf_dir):
    """What is read beside the records put aside."""
    root = scratch_path(spark, "raw-json")
    fx.store_author_lines(spark, sf_dir, root)
    return read_authors(spark, root).select("id", "display_name", "works_count", "university", "faculty")


def job_empty(spark, sf_dir):
    """The two jobs over folders that are not stored: nothing read, nothing written."""
    root, path = scratch_path(spark, "raw-json"), scratch_path(spark, "never-written")
    landing.land(fx.authors(spark, sf_dir), schemas.AUTHOR.names, root, "authors", fx.instant())
    pairs = [tuple(r) for r in fx.authors(spark, sf_dir).select("university", F.concat(F.lit("no "), "faculty").alias("f")).distinct().collect()]
    rows = None
    for job, run in (("faculty_profiles", profiles.run), ("course_catalog", courses.run)):
        counts = run(spark, root, path, pairs, fx.instant())
        stored = read_table(spark, path, schemas.PROFILE).agg(F.count(F.lit(1)).alias("stored_rows"))
        one = stored.select(F.lit(job).alias("job"), F.lit(counts["raw"]).cast("bigint").alias("raw_rows"), F.lit(counts["clean"]).cast("bigint").alias("clean_rows"), "stored_rows")
        rows = one if rows is None else rows.union(one)
    return rows


def reports_from_tables(spark, sf_dir):
    """The four reports over the tables that upserts keep, after a second batch."""
    database = f"university_db_{uuid.uuid4().hex}"
    paths = {name: scratch_path(spark, name) for name in ("faculty_profiles", "course_catalog")}
    upsert(_profiles(spark, sf_dir), paths["faculty_profiles"])
    upsert(_courses(spark, sf_dir), paths["course_catalog"])
    reports.declare_tables(spark, paths, database)
    upsert(profiles.faculty_profiles(fx.later_authors(spark, sf_dir), fx.instant(fx.DAY_TWO)), paths["faculty_profiles"])
    reports.refresh_tables(spark, paths, database)
    rows = None
    for name, report in reports.run(spark, database).items():
        key, value = report.columns
        one = report.select(F.lit(name).alias("report"), F.col(key).alias("name"), F.col(value).cast("bigint").alias("value"))
        rows = one if rows is None else rows.union(one)
    kept = cut(rows)
    spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return kept


def log_rows(spark, sf_dir):
    return logs.log_rows(fx.log_entries(spark, sf_dir))


def log_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "logs")
    logs.write(logs.log_rows(fx.log_entries(spark, sf_dir)), root, scratch_path(spark, "logs-meta"), "day")
    return spark.read.schema(schemas.LOG).option("recursiveFileLookup", "true").json(root)


def log_compaction(spark, sf_dir):
    """Log rows landed in three batches, two of them merged: the same rows."""
    root = scratch_path(spark, "logs")
    rows = logs.log_rows(fx.log_entries(spark, sf_dir)).withColumn("part", F.pmod(F.crc32("object_path"), F.lit(3)))
    for part in range(3):
        logs.write(rows.where(F.col("part") == part).drop("part"), root, None, f"b{part}")
    compact(spark, root, "b2")
    return spark.read.schema(schemas.LOG).option("recursiveFileLookup", "true").json(f"{root}/university=*")


def search_docs(spark, sf_dir):
    return _naive(search.search_documents(fx.html_objects(spark, sf_dir), fx.instant()), "crawl_timestamp")


def lossy_decode(spark, sf_dir):
    text = lossy_utf8(F.col("raw"))
    return fx.raw_bytes(spark, sf_dir).select(
        "doc_id", F.length(text).cast("bigint").alias("n_chars"), F.md5(text).alias("checksum")
    )


def resolve_university(spark, sf_dir):
    return resolve_universities(
        fx.requested_universities(spark, sf_dir), fx.stored_universities(spark, sf_dir)
    )


def precombine_latest(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return first_per_key(events, ["user_id"], [F.desc("ts"), F.desc("event_id")])


def upsert_profiles(spark, sf_dir):
    path = scratch_path(spark, "faculty_profiles")
    upsert(_profiles(spark, sf_dir), path)
    upsert(profiles.faculty_profiles(fx.later_authors(spark, sf_dir), fx.instant(fx.DAY_TWO)), path)
    stored = read_table(spark, path, schemas.PROFILE)
    return _naive(stored, "business_timestamp")


def upsert_courses(spark, sf_dir):
    path = scratch_path(spark, "course_catalog")
    upsert(_courses(spark, sf_dir), path)
    upsert(courses.course_catalog(fx.later_course_payloads(spark, sf_dir), fx.instant(fx.DAY_TWO)), path)
    stored = read_table(spark, path, schemas.COURSE)
    return _naive(stored, "business_timestamp")


def upsert_search_docs(spark, sf_dir):
    path = scratch_path(spark, "university_content")
    for objects, day in (
        (fx.html_objects(spark, sf_dir), fx.DAY_ONE),
        (fx.later_html_objects(spark, sf_dir), fx.DAY_TWO),
    ):
        upsert(search.search_documents(objects, fx.instant(day)), path, order="crawl_timestamp")
    stored = read_table(spark, path, schemas.SEARCH_DOCUMENT)
    return _naive(stored, "crawl_timestamp")


def tables_roundtrip(spark, sf_dir):
    """Rows per catalog table and university after creating and filling the tables."""
    database = f"university_db_{uuid.uuid4().hex}"
    names = create_tables(spark, scratch_path(spark, "curated"), database)
    filled = [
        reports.profile_report_view(_profiles(spark, sf_dir)),
        reports.course_report_view(_levelled_courses(spark, sf_dir)),
        search.search_documents(fx.html_objects(spark, sf_dir), fx.instant()),
    ]
    counts = None
    for rows, name in zip(filled, names):
        append_to_table(rows, name)
        short = name.split("`")[-2]
        per_university = spark.table(name).groupBy("university").agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(short).alias("table_name"), "university", "n_rows"
        )
        counts = per_university if counts is None else counts.union(per_university)
    rows = cut(counts)
    spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return rows


QUERIES = {
    "author_normalize": author_normalize,
    "report_staff_per_faculty": report_staff_per_faculty,
    "report_courses_per_level": report_courses_per_level,
    "report_staff_per_university": report_staff_per_university,
    "report_publications_per_university": report_publications_per_university,
    "course_keyword_filter": course_keyword_filter,
    "course_catalog": course_catalog,
    "job_counts": job_counts,
    "job_profiles": job_profiles,
    "job_courses": job_courses,
    "job_landing": job_landing,
    "job_payloads": job_payloads,
    "job_crawl": job_crawl,
    "landing_rerun": landing_rerun,
    "manifest_rerun": manifest_rerun,
    "payload_reextract": payload_reextract,
    "log_sidecars": log_sidecars,
    "preview_topn": preview_topn,
    "preview_courses": preview_courses,
    "publication_enrich": publication_enrich,
    "cap_per_faculty": cap_per_faculty,
    "batch_record_counts": batch_record_counts,
    "landing_roundtrip": landing_roundtrip,
    "author_scan_roundtrip": author_scan_roundtrip,
    "file_type_route": file_type_route,
    "crawl_manifest": crawl_manifest,
    "manifest_roundtrip": manifest_roundtrip,
    "crawl_stats": crawl_stats,
    "dynamic_pages": dynamic_pages,
    "page_links": page_links_query,
    "links_per_page": links_per_page,
    "bounded_reach": bounded_reach,
    "crawl_walk": crawl_walk,
    "text_concat": text_concat,
    "extraction_payload": extraction_payload,
    "extraction_stats": extraction_stats,
    "payload_scan_roundtrip": payload_scan_roundtrip,
    "payload_folders": payload_folders,
    "object_listing": object_listing,
    "object_catalogue": object_catalogue,
    "html_scan": html_scan,
    "sidecar_scan": sidecar_scan,
    "stored_pages": stored_pages,
    "job_search": job_search,
    "search_preview": search_preview,
    "scan_quarantine": scan_quarantine,
    "scan_readable": scan_readable,
    "job_empty": job_empty,
    "reports_from_tables": reports_from_tables,
    "log_rows": log_rows,
    "log_roundtrip": log_roundtrip,
    "log_compaction": log_compaction,
    "search_docs": search_docs,
    "lossy_decode": lossy_decode,
    "resolve_university": resolve_university,
    "precombine_latest": precombine_latest,
    "upsert_profiles": upsert_profiles,
    "upsert_courses": upsert_courses,
    "upsert_search_docs": upsert_search_docs,
    "tables_roundtrip": tables_roundtrip,
}
