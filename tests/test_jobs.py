"""The jobs over landed files, laid out object by object as a crawler leaves them."""

import hashlib
import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quadrangle import schemas
from quadrangle.plans import courses, crawl, landing, logs, payloads, profiles, reports, search
from quadrangle.operators.upsert import read_table
from quadrangle.sinks.tables import append_to_table, create_tables
from quadrangle.sources import raw


def now():
    return F.lit("2024-06-01 08:30:00").cast("timestamp")


def put(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = content if isinstance(content, bytes) else content.encode()
    with open(path, "wb") as out:
        out.write(data)


def author(key, name, works=1, place="P"):
    return {
        "id": key, "display_name": name, "orcid": None, "works_count": works, "cited_by_count": 2,
        "last_known_institutions": [{"id": "x", "display_name": place}] if place else [], "extra": 1,
    }


@pytest.fixture
def authors_root(folder):
    root = f"{folder}/raw-json"
    day = "type=authors/year=2024/month=06/day=01"
    for university, faculty, rows in (
        ("hassan_ii", "SCI1", [author("A1", "Ann", 5), author("A1", "Ann", 9), author("A2", None), author("A3", "Cyd", 1, None)]),
        ("Cadi Ayyad", "SCI2", [author("A1", "Ann", 4)]),
        ("other", "X", [author("A9", "Zed")]),
    ):
        base = f"{root}/university={university}/faculty={faculty}/{day}/authors_0.json"
        put(base, json.dumps(rows, indent=1))
        put(base + ".meta.json", json.dumps({"source": "openalex", "university": university, "records_count": 4}))
    put(f"{root}/university=hassan_ii/faculty=SCI1/{day}/authors_1.json", '[{"id": "A4", broken')
    put(f"{root}/university=hassan2/faculty=SCI1/year=2024/month=06/day=01/doc.json", '{"metadata": {}, "text": "t"}')
    return root


def test_author_scan_leaves_out_sidecars_and_broken_objects(spark, authors_root):
    rows = raw.read_authors(spark, authors_root, multi_line=True).collect()
    assert sorted((r.id, r.university, r.month) for r in rows) == [
        ("A1", "Cadi Ayyad", "06"), ("A1", "hassan_ii", "06"), ("A1", "hassan_ii", "06"),
        ("A2", "hassan_ii", "06"), ("A3", "hassan_ii", "06"), ("A9", "other", "06"),
    ]


def test_author_scan_reads_only_the_requested_folders(spark, authors_root):
    scan = raw.read_authors(spark, authors_root, [("Cadi Ayyad", "SCI2")], multi_line=True)
    assert [(r.id, r.faculty) for r in scan.collect()] == [("A1", "SCI2")]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_profile_job(spark, authors_root, folder):
    table = f"{folder}/faculty_profiles"
    asked = [("hassan2", "SCI1"), ("cadi_ayyad", "SCI2"), ("nowhere", "Y")]
    # hassan2 itself has a folder for the faculty, but without authors
    counts = profiles.run(spark, authors_root, table, asked, now(), multi_line=True)
    assert counts == {"raw": 5, "clean": 3}
    stored = spark.read.schema(schemas.PROFILE).parquet(table).collect()
    assert sorted((r.author_id, r.works_count, r.institution_name, r.university) for r in stored) == [
        ("A1", 4, "P", "Cadi Ayyad"), ("A1", 9, "P", "hassan_ii"), ("A3", 1, None, "hassan_ii"),
    ]
    ann = next(r for r in stored if r.university == "hassan_ii" and r.author_id == "A1")
    assert ann.record_id == hashlib.md5(b"A1_SCI1").hexdigest()
    assert (ann.source_system, ann.is_deleted, ann.language) == ("openalex_api", False, "en")
    assert profiles.run(spark, authors_root, table, asked, now(), multi_line=True) == counts
    assert spark.read.parquet(table).count() == 3
    assert [r.full_name for r in profiles.preview(spark.read.schema(schemas.PROFILE).parquet(table), 2).collect()] == ["Ann", "Ann"]


def test_profile_job_without_input_writes_nothing(spark, authors_root, folder):
    assert profiles.run(spark, authors_root, f"{folder}/t", [("nowhere", "Y")], now()) == {"raw": 0, "clean": 0}
    assert not os.path.exists(f"{folder}/t")


COURSE_URLS = {
    "https://h/formation/Filiere_Droit.pdf": ("Droit", "Filiere_Droit"),
    "https://h/x/Filières_Eco.pdf": ("Eco", "Filières_Eco"),
    "https://h/x/filiere_low.pdf": ("filiere_low", "filiere_low"),
    "https://h/x/my_Filieres2024.pdf": ("2024", "my_Filieres2024"),
    "https://h/cursus/Filiere_ .pdf": ("Filiere_ ", "Filiere_ "),
    "https://h/programme.PDF": ("", ""),
    "https://h/programme.pdf?x=1": ("", ""),
    "https://h/x/Fili%C3%A8re_Y.pdf": None,
    "https://h/news/1.pdf": None,
}


def test_course_names(spark):
    rows = [({"source_url": url}, "t", "u", "f") for url in COURSE_URLS] + [({"source_url": None}, "t", "u", "f"), (None, "t", "u", "f")]
    df = spark.createDataFrame(rows, "metadata struct<source_url:string>, text string, university string, faculty string")
    df = df.withColumn("metadata", F.when(F.col("metadata").isNotNull(), F.struct(
        "metadata.source_url", F.lit("2024").alias("extract_timestamp"), F.lit("c").alias("content_checksum"))))
    built = courses.course_catalog(df, now()).collect()
    wanted = {v for v in COURSE_URLS.values() if v}
    assert {(r.course_name, r.raw_filename) for r in built} == wanted
    # all stems that come out empty share one record, the lowest path stands for them
    assert len(built) == len(wanted)
    assert next(r.source_path for r in built if r.raw_filename == "") == "https://h/programme.PDF"
    assert next(r.record_id for r in built if r.raw_filename == "") == hashlib.md5(b"_f").hexdigest()


def test_extraction_then_course_job(spark, folder):
    """Page texts and sidecars -> landed payloads -> course table."""
    root, docs = f"{folder}/raw-json", f"{folder}/raw-documents"
    base = "university=hassan2/faculty=SCI1/year=2024/month=06/day=01"
    names = {"a.pdf": "https://h/formation/Filiere_A.pdf", "b.docx": "https://h/cursus/b.pdf", "c.doc": None, "d.document": None, "e.pdf": "https://h/cursus/e.pdf"}
    for name, url in names.items():
        put(f"{docs}/{base}/{name}", b"\x00binary")
        if url:
            put(f"{docs}/{base}/{name}.meta.json", json.dumps({"source_url": url, "university": "hassan2", "faculty": "SCI1", "depth_level": 1, "crawl_timestamp": "2024-05-31T07:00:00"}, indent=2))
    listed = raw.list_objects(spark, docs).collect()
    assert sorted(os.path.basename(r.path) for r in listed) == sorted(names)
    assert {(r.university, r.faculty, r.length) for r in listed} == {("hassan2", "SCI1", 7)}

    sidecars = raw.read_sidecars(spark, docs)
    assert sidecars.count() == 3
    pages = spark.createDataFrame(
        [(f"{base}/a.pdf", 1, "second "), (f"{base}/a.pdf", 0, " first"), (f"{base}/b.docx", 0, "para"),
         (f"{base}/c.doc", 0, "no sidecar"), (f"{base}/d.document", 0, "skipped"), (f"{base}/e.pdf", 0, "")],
        "path string, page_no long, text string",
    )
    counts = payloads.run(pages, sidecars, root, now()).first()
    assert counts.asDict() == {"pdf": 1, "docx": 2, "skipped": 2, "errors": 0}
    landed = {r.metadata.source_path: r for r in raw.read_payloads(spark, root).collect()}
    assert set(landed) == {f"{base}/a.pdf", f"{base}/b.docx", f"{base}/c.doc"}
    first = landed[f"{base}/a.pdf"]
    assert first.text == "first\nsecond" and first.metadata.content_checksum == hashlib.md5(b"first\nsecond").hexdigest()
    assert first.metadata.storage_path == f"s3://raw-json/{base}/a.json"
    assert (landed[f"{base}/c.doc"].metadata.source_url, landed[f"{base}/c.doc"].metadata.university) == ("", "")
    assert (first.university, first.faculty) == ("hassan2", "SCI1")

    # other JSON in the same tree does not become a course
    put(f"{root}/university=hassan2/faculty=SCI1/type=authors/year=2024/month=06/day=01/x.json", '{"id": "A1", "display_name": "formation"}')
    table = f"{folder}/course_catalog"
    assert courses.run(spark, root, table, [("hassan2", "SCI1")], now()) == {"raw": 4, "clean": 2}
    stored = spark.read.schema(schemas.COURSE).parquet(table).collect()
    assert sorted((r.course_name, r.text_content) for r in stored) == [("A", "first\nsecond"), ("b", "para")]
    assert len(courses.preview(spark.read.parquet(table)).collect()) == 2


def test_a_document_of_many_pages_is_one_payload(spark, folder):
    pages = spark.range(0, 120_000).selectExpr("'university=u/faculty=f/a.pdf' AS path", "id AS page_no", "concat('p', id) AS text")
    no_sidecars = spark.createDataFrame([], schemas.with_partitions(schemas.MANIFEST, "object_path"))
    counts = payloads.run(pages, no_sidecars, f"{folder}/r", now()).first()
    assert counts.asDict() == {"pdf": 1, "docx": 0, "skipped": 0, "errors": 0}
    rows = raw.read_payloads(spark, f"{folder}/r").collect()
    assert [r.text for r in rows] == ["\n".join(f"p{i}" for i in range(120_000))]


def test_payloads_as_single_objects(spark, folder):
    root = f"{folder}/raw-json"
    path = f"{root}/university=Hassan II/faculty=F S/year=2024/month=06/day=01/x.json"
    put(path, json.dumps({"metadata": {"source_url": "https://h/cursus/x.pdf"}, "text": "é"}, ensure_ascii=False, indent=2))
    row = raw.read_payloads(spark, root, multi_line=True).first()
    assert (row.text, row.university, row.faculty) == ("é", "Hassan II", "F S")
    assert courses.run(spark, root, f"{folder}/t", [("hassan2", "F S")], now(), multi_line=True) == {"raw": 1, "clean": 1}


def test_folder_names_with_special_characters(spark, folder):
    """Names come back as they were, from the landing to the table."""
    university, faculty = "a+b: 50%", "F=1 [x]"
    authors = spark.createDataFrame(
        [("A1", "Ann", None, 1, 1, [], university, faculty)],
        schemas.with_partitions(schemas.AUTHOR, "university", "faculty"),
    )
    root = f"{folder}/raw-json"
    landing.land(authors, schemas.AUTHOR.names, root, "authors", now())
    names = raw.stored_partitions(spark, root).select("university", "faculty").collect()
    assert [tuple(r) for r in names] == [("a+b:_50%", faculty)]
    assert {(r.university, r.faculty) for r in raw.list_objects(spark, root).collect()} == {("a+b:_50%", faculty)}
    table = f"{folder}/t"
    assert profiles.run(spark, root, table, [(university, faculty)], now()) == {"raw": 1, "clean": 1}
    profiles.run(spark, root, table, [(university, faculty)], now())
    row = spark.read.schema(schemas.PROFILE).parquet(table).collect()
    assert [(r.university, r.faculty) for r in row] == [("a+b:_50%", faculty)]

    put_payload = spark.createDataFrame(
        [({"source_url": "https://h/cursus/c.pdf", "source_path": "x"}, "text", university, faculty)],
        "metadata struct<source_url:string, source_path:string>, text string, university string, faculty string",
    )
    from quadrangle.sinks.files import land_json

    land_json(put_payload, ["metadata", "text"], {"university": F.col("university"), "faculty": F.col("faculty")}, f"{folder}/texts")
    assert courses.run(spark, f"{folder}/texts", f"{folder}/c", [(university, faculty)], now()) == {"raw": 1, "clean": 1}
    assert [(r.university, r.faculty) for r in spark.read.schema(schemas.COURSE).parquet(f"{folder}/c").collect()] == [(university, faculty)]


def test_landing_job(spark, folder):
    authors = spark.createDataFrame(
        [("A%04d" % i, f"n{i}", None, 1, 1, [("P",)], "Hassan II", "SCI1") for i in range(505)],
        schemas.with_partitions(schemas.AUTHOR, "university", "faculty"),
    )
    works = spark.createDataFrame(
        [("https://h/W1", "t1", 2020, None, "article", None, None, "Hassan II", "SCI1"), ("https://h/W2", "t2", None, 3, "book", "d", (True,), "Hassan II", "SCI1")],
        schemas.with_partitions(schemas.WORK, "university", "faculty"),
    )
    root, sidecars = f"{folder}/raw-json", f"{folder}/raw-json-meta"
    landing.run(authors, works, root, sidecars, now())
    landing.run(authors, works, root, sidecars, now())  # a batch landed again replaces itself
    landed = raw.read_authors(spark, root, [("hassan_ii", "SCI1")])
    assert landed.count() == 505
    publications = spark.read.schema(schemas.PUBLICATION).json(
        f"{root}/university=hassan_ii/faculty=SCI1/type=publications/year=2024/month=06/day=01/batch=20240601_083000"
    )
    rows = {r.work_id: r for r in publications.collect()}
    one = rows["https://h/W1"]
    assert (one.university, one.type, one.cited_by_count, one.open_access, one.retrieved_at) == ("Hassan II", "article", 0, False, "2024-06-01 08:30:00")
    assert (rows["https://h/W2"].cited_by_count, rows["https://h/W2"].open_access) == (3, True)
    raw_line = spark.read.text(f"{root}/university=hassan_ii/faculty=SCI1/type=publications").filter("value like '%W1%'").first().value
    assert '"doi":null' in raw_line
    counts = spark.read.schema(schemas.LANDING_SIDECAR).option("recursiveFileLookup", "true").json(sidecars).collect()
    assert sorted((r.data_type, r.records_count, r.university, r.source) for r in counts) == [
        ("authors", 505, "Hassan II", "openalex"), ("publications", 2, "Hassan II", "openalex")]


def test_logs(spark, folder):
    root = f"{folder}/raw-logs"
    stamp = datetime(2024, 6, 1, 8, 30, 0, 5)
    fields = "ts timestamp, level string, message string, university string, faculty string, source string"
    entries = [(stamp, level, 'say "é"', "u", "f", "job") for level in ("info", "warning", "error", "debug")] + [(stamp, "info", "m", "u", "f", None)]
    for _ in range(2):
        logs.write(logs.log_rows(spark.createDataFrame(entries, fields)), root, f"{folder}/meta", "b1")
    logs.write(logs.log_rows(spark.createDataFrame([], fields)), root, f"{folder}/meta", "b2")
    rows = spark.read.schema(schemas.LOG).json(f"{root}/university=u/faculty=f/year=2024/month=06/day=01/batch=b1").collect()
    beside = spark.read.schema(schemas.LOG_SIDECAR).option("recursiveFileLookup", "true").json(f"{folder}/meta").collect()
    assert sorted(r.level for r in beside) == sorted(r.level for r in rows) and {r.log_timestamp for r in beside} == {"2024-06-01T08:30:00.000005"}
    assert sorted(r.level for r in rows) == ["DEBUG", "ERROR", "INFO", "INFO", "WARNING"]
    assert {r.source for r in rows} == {"job", "unknown"}
    assert {r.timestamp for r in rows} == {"2024-06-01T08:30:00.000005"}
    entry = spark.createDataFrame([(stamp, "info", "é", "u", "f", None)], "ts timestamp, level string, message string, university string, faculty string, source string")
    row = logs.log_rows(entry).first()
    content = json.dumps({"timestamp": stamp.isoformat(), "level": "INFO", "message": "é", "university": "u", "faculty": "f", "source": "unknown"}, ensure_ascii=False)
    assert row.object_path == f"university=u/faculty=f/year=2024/month=06/day=01/log_{hashlib.md5(content.encode()).hexdigest()[:8]}.json"


SITE = {
    "https://h/": '<a href="/a.html">a</a><a href="/doc.pdf">d</a><a href="/s.css">s</a><a href="https://o/x.html">o</a><img src="https://cdn/i.png">',
    "https://h/a.html": '<a href="/b.html#x">b</a><a href="/">home</a><a href="/gone.html">g</a>',
    "https://h/b.html": '<a href="/c.html">c</a>',
    "https://h/c.html": '<a href="/too-deep.html">t</a>',
    "https://h/too-deep.html": "deep",
    "https://h/doc.pdf": '<a href="/hidden.html">no</a>',
    "https://h/hidden.html": "hidden",
    "https://cdn/i.png": "png",
    "https://o/x.html": '<a href="/y.html">y</a>',
    "https://o/y.html": "",
}


def test_crawl_job(spark, folder):
    pages = spark.createDataFrame(list(SITE.items()), "url string, html string")
    seeds = spark.createDataFrame([("u", "f", "https://h/"), ("w", "g", "https://o/x.html")], "university string, faculty string, url string")
    counts = {r.university: r for r in crawl.run(pages, seeds, f"{folder}/manifest", now()).collect()}
    first = counts["u"]
    assert (first.html, first.pdf, first.image, first.skip, first.errors, first.visited) == (4, 1, 1, 1, 1, 8)
    assert (counts["w"].html, counts["w"].errors, counts["w"].visited) == (1, 1, 2)
    rows = {(r.university, r.source_url): r for r in spark.read.schema(schemas.MANIFEST).parquet(f"{folder}/manifest").collect()}
    assert {url: r.depth_level for (u, url), r in rows.items() if u == "u"} == {
        "https://h/": 0, "https://h/a.html": 1, "https://h/doc.pdf": 1, "https://cdn/i.png": 1, "https://h/b.html": 2, "https://h/c.html": 3}
    doc = rows["u", "https://h/doc.pdf"]
    assert doc.content_checksum == hashlib.md5(SITE["https://h/doc.pdf"].encode()).hexdigest()
    assert doc.storage_path == f"s3://raw-documents/university=u/faculty=f/year=2024/month=06/day=01/{hashlib.md5(b'https://h/doc.pdf').hexdigest()}.pdf"


def test_search_job(spark, folder):
    root, table = f"{folder}/raw-web-html", f"{folder}/university_content"
    name = "university=hassan2/faculty=F S/year=2024/month=06/day=01/p.html"
    put(f"{root}/{name}", b"<p>\xffcaf\xc3\xa9</p>" + b"x" * 20000)
    put(f"{root}/{name}.meta.json", "{}")
    search.run(spark, root, table, now())
    row = spark.read.schema(schemas.SEARCH_DOCUMENT).parquet(table).first()
    assert row.record_id == hashlib.md5(name.encode()).hexdigest()
    assert row.content.startswith("<p>café</p>") and len(row.content) == 20011
    assert (row.storage_path, row.university, row.faculty) == (f"s3://raw-web-html/{name}", "hassan2", "F S")
    put(f"{root}/{name}", b"new")
    put(f"{root}/university=other/faculty=X/q.html", b"not asked for")
    search.run(spark, root, table, F.lit("2024-06-02 00:00:00").cast("timestamp"), [("hassan2", "F S"), ("stored", "nowhere")])
    assert [r.content for r in spark.read.parquet(table).collect()] == ["new"]
    assert raw.read_html_objects(spark, root, [("stored", "nowhere")]).count() == 0
    assert raw.list_objects(spark, f"{folder}/no-such-bucket").count() == 0


def test_stored_pages_in_their_newest_copy(spark, folder):
    root = f"{folder}/raw-web-html"
    for day, html in (("01", "old"), ("02", "new")):
        name = f"university=u/faculty=f/year=2024/month=06/day={day}/p.html"
        put(f"{root}/{name}", html)
        put(f"{root}/{name}.meta.json", json.dumps({"source_url": "https://h/", "crawl_timestamp": f"2024-06-{day}T00:00:00"}))
    put(f"{root}/university=u/faculty=f/year=2024/month=06/day=01/lost.html", "no sidecar")
    pages = raw.read_stored_pages(spark, root)
    assert pages.count() == 2
    assert [tuple(r) for r in crawl.newest_pages(pages).collect()] == [("https://h/", "new")]


def test_course_shows_the_text_extracted_last(spark, folder):
    pages = spark.createDataFrame([("university=u/faculty=f/a.pdf", 0, "z old")], "path string, page_no long, text string")
    sidecars = spark.createDataFrame([("university=u/faculty=f/a.pdf", "https://h/cursus/a.pdf", "u", "f", "2024")], "object_path string, source_url string, university string, faculty string, crawl_timestamp string")
    root, table = f"{folder}/r", f"{folder}/t"
    payloads.run(pages, sidecars, root, now())
    assert courses.run(spark, root, table, [("u", "f")], now()) == {"raw": 1, "clean": 1}
    for day in ("2024-06-02 00:00:00", "2024-06-02 00:00:00"):
        payloads.run(pages.withColumn("text", F.lit("a new")), sidecars, root, F.lit(day).cast("timestamp"))
    assert raw.read_payloads(spark, root).count() == 2
    courses.run(spark, root, table, [("u", "f")], now())
    assert [r.text_content for r in read_table(spark, table, schemas.COURSE).collect()] == ["a new"]


def test_tables_and_reports_in_sql(spark, folder):
    names = create_tables(spark, folder, "campus")
    assert create_tables(spark, folder, "campus") == names
    columns = {c.name: (c.dataType, c.isPartition) for c in spark.catalog.listColumns("campus.faculty_profiles")}
    assert columns["research_topics"] == ("array<string>", False) and columns["university"] == ("string", True)
    assert {c.name for c in spark.catalog.listColumns("campus.university_content")} == set(schemas.SEARCH_DOCUMENT.names)
    raw_authors = spark.createDataFrame(
        [("A1", "Ann", None, 5, 1, [], "u", "f"), ("A2", "Bob", None, None, 1, [], "u", "g"), ("A3", "Cyd", None, None, 1, [], "w", "g")],
        schemas.with_partitions(schemas.AUTHOR, "university", "faculty"),
    )
    built = profiles.faculty_profiles(raw_authors, now())
    no_courses = spark.createDataFrame([], schemas.COURSE)
    append_to_table(reports.profile_report_view(built), names[0])
    stored = spark.table(names[0])
    assert {r.university: r.total_publications for r in reports.publications_per_university(stored).collect()} == {"u": 5, "w": None}
    assert [r.faculty for r in reports.staff_per_faculty(stored).collect()] == ["g", "f"]
    reports.register_views(built, no_courses)
    assert spark.sql("SELECT sum(publications_count) AS s FROM faculty_profiles").first().s == 5
    assert spark.sql("SELECT level, department FROM course_catalog").count() == 0
