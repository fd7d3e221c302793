"""What is stored, what is new, and what cannot be read."""

import json
import os

import pytest
from pyspark.sql import functions as F

from quadrangle import schemas
from quadrangle.operators.progress import read_mark
from quadrangle.operators.upsert import read_table, upsert
from quadrangle.plans import courses, profiles, reports, search
from quadrangle.session import cut
from quadrangle.sources import catalogue, raw
from test_jobs import author, now, put


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def put_at(path, content, seconds):
    put(path, content)
    os.utime(path, (seconds, seconds))


@pytest.fixture
def site(folder):
    root = f"{folder}/raw-web-html"
    for n, place in enumerate(("university=u/faculty=f/year=2024/a.html", "university=u/faculty=f/b.html", "university=w x/faculty=g/c.html")):
        put_at(f"{root}/{place}", f"<p>{n}</p>", 1_700_000_000 + n)
        put_at(f"{root}/{place}.meta.json", "{}", 1_700_000_000 + n)
    return root


def test_a_search_run_reads_what_came_since_the_last(spark, site, folder):
    table, progress = f"{folder}/documents", f"{folder}/progress"
    assert search.run(spark, site, table, now(), progress=progress) == 3
    assert read_mark(spark, progress, f"{site} ") == 1_700_000_002_000_000
    # only the object of the last moment is read again
    assert search.run(spark, site, table, now(), progress=progress) == 1
    put_at(f"{site}/university=u/faculty=f/b.html", "<p>changed</p>", 1_700_000_100)
    put_at(f"{site}/university=u/faculty=f/d.html", "<p>late</p>", 1_700_000_050)
    assert search.run(spark, site, table, now(), progress=progress) == 3
    rows = read_table(spark, table, schemas.SEARCH_DOCUMENT).collect()
    assert sorted(r.content for r in rows) == ["<p>0</p>", "<p>2</p>", "<p>changed</p>", "<p>late</p>"]
    # marks of other pairs and of a failed run are apart
    assert search.run(spark, site, table, now(), pairs=[("w x", "g")], progress=progress) == 1
    assert search.run(spark, f"{folder}/nothing", table, now(), progress=progress) == 0
    recent = raw.object_files(spark, site, modified_from=1_700_000_050_000_000, modified_to=1_700_000_050_000_000)
    assert [os.path.basename(r.path) for r in recent.collect()] == ["d.html"]


def test_catalogue_follows_the_bucket(spark, site, folder):
    table = f"{folder}/catalogue"
    assert catalogue.refresh(spark, site, table) == 6
    assert catalogue.refresh(spark, site, table) == 2  # those of the last moment
    put_at(f"{site}/university=u/faculty=f/b.html", "<p>changed</p>", 1_700_000_100)
    catalogue.refresh(spark, site, table)
    rows = {r.path: (r.length, r.university, r.faculty) for r in catalogue.objects(spark, table).collect()}
    assert rows == {
        "university=u/faculty=f/year=2024/a.html": (8, "u", "f"), "university=u/faculty=f/b.html": (14, "u", "f"),
        "university=w x/faculty=g/c.html": (8, "w x", "g"),
    }
    listed = {r.path: (r.length, r.university, r.faculty) for r in raw.list_objects(spark, site).collect()}
    assert listed == rows
    pairs = spark.createDataFrame([("w x", "g"), ("w x", "none")], "university string, faculty string")
    assert [r.path for r in catalogue.objects(spark, table, pairs).collect()] == ["university=w x/faculty=g/c.html"]
    assert [r.path for r in raw.list_objects(spark, site, [("w x", "g")]).collect()] == ["university=w x/faculty=g/c.html"]


def test_jobs_ask_the_catalogue_for_folders(spark, folder):
    root, table = f"{folder}/raw-json", f"{folder}/catalogue"
    put(f"{root}/university=hassan_ii/faculty=SCI1/type=authors/year=2024/month=06/day=01/a.json", json.dumps([author("A1", "Ann")]))
    put(f"{root}/university=hassan_ii/faculty=SCI1/batch=1/p.json", json.dumps({"metadata": {"source_url": "https://h/cursus/x.pdf"}, "text": "t"}))
    catalogue.refresh(spark, root, table)
    asked = [("hassan2", "SCI1"), ("nowhere", "X")]
    assert profiles.run(spark, root, f"{folder}/t", asked, now(), multi_line=True, catalogue=table) == {"raw": 1, "clean": 1}
    assert courses.run(spark, root, f"{folder}/c", asked, now(), multi_line=True, catalogue=table) == {"raw": 2, "clean": 1}
    folders = profiles.resolved_folders(spark, root, asked, "type=authors", table).collect()
    assert [tuple(r) for r in folders] == [("hassan_ii", "SCI1", f"{root}/university=hassan_ii/faculty=SCI1/type=authors")]


def test_unreadable_records_are_kept_aside_and_counted(spark, folder):
    root, aside = f"{folder}/raw-json", f"{folder}/quarantine"
    base = f"{root}/university=u/faculty=f/type=authors/year=2024/month=06/day=01"
    put(f"{base}/a.json", "\n".join([json.dumps(author("A1", "Ann")), '{"id": "A2", cut', json.dumps({"id": "A3", "display_name": "Cyd", "works_count": "x"}), "{}", ""]))
    put(f"{base}/a.json.meta.json", "broken {")
    put(f"{base}/b.json", b"\xff\xfe\x00binary")
    for _ in range(2):
        counts = profiles.run(spark, root, f"{folder}/t", [("u", "f")], now(), quarantine_path=aside)
        assert counts == {"raw": 2, "clean": 2, "unreadable": 3}
    rows = read_table(spark, aside, schemas.UNREADABLE).collect()
    assert sorted((os.path.basename(r.object_path), r.reason, r.faculty) for r in rows) == [
        ("a.json", "partly read", "f"), ("a.json", "unreadable", "f"), ("b.json", "unreadable", "f")]
    put(f"{root}/university=u/faculty=f/batch=1/p.json", '{"metadata": {"source_url": "https://h/cursus/x.pdf"}, "text": "t"}\n{"metadata": 7')
    counts = courses.run(spark, root, f"{folder}/c", [("u", "f")], now(), quarantine_path=f"{folder}/q2")
    assert counts["clean"] == 1 and counts["unreadable"] >= 1
    assert courses.run(spark, root, f"{folder}/c", [("no", "f")], now(), quarantine_path=f"{folder}/q2") == {"raw": 0, "clean": 0, "unreadable": 0}


def test_pairs_prune_the_folders_of_a_scan(spark, folder):
    root = f"{folder}/raw-json"
    for n in range(3):
        put(f"{root}/university=u{n}/faculty=f/type=authors/year=2024/month=06/day=01/a.json", json.dumps([author(f"A{n}", "Ann")]))
    pairs = cut(spark.createDataFrame([("u1", "f")], "university string, faculty string"))
    for asked in (pairs, [("u1", "f")]):
        scan = raw.read_authors(spark, root, asked, multi_line=True)
        assert [r.id for r in scan.collect()] == ["A1"]
        assert "dynamicpruning" in plan_of(scan)
    assert raw.read_authors(spark, f"{folder}/none", pairs).collect() == []


def test_tables_over_the_upserts_folders(spark, folder):
    """Rows of a batch put twice are there once, and later batches are seen."""
    path, none = f"{folder}/profiles", f"{folder}/courses"
    authors = [("A%d" % i, f"n{i}", None, i, 1, [], "u" if i % 2 else "w", "f") for i in range(40)]
    table = lambda rows: profiles.faculty_profiles(spark.createDataFrame(rows, schemas.with_partitions(schemas.AUTHOR, "university", "faculty")), now())
    payload = [({"source_url": "https://h/cursus/x.pdf", "extract_timestamp": "1", "content_checksum": "c"}, "t", "u", "f")]
    upsert(courses.course_catalog(spark.createDataFrame(payload, "metadata struct<source_url:string,extract_timestamp:string,content_checksum:string>, text string, university string, faculty string"), now()), none)
    paths, database = {"faculty_profiles": path, "course_catalog": none}, "campus_kept"
    for _ in range(2):
        upsert(table(authors[:20]), path, slot_bytes=4_000)
        reports.declare_tables(spark, paths, database)
    total = lambda: {r.university: r.total_publications for r in reports.run(spark, database)["publications_per_university"].collect()}
    assert total() == {"u": sum(range(1, 20, 2)), "w": sum(range(0, 20, 2))}
    upsert(table(authors), path, slot_bytes=4_000)  # splits slots
    reports.refresh_tables(spark, paths, database)
    assert total() == {"u": sum(range(1, 40, 2)), "w": sum(range(0, 40, 2))}
    row = spark.sql(f"SELECT level, department, title FROM {database}.course_catalog").first()
    assert (row.level, row.department, row.title) == (None, None, "x")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    assert spark.read.parquet(path).count() == 40
