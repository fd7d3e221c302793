import random
from collections import deque
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quadrangle.operators import upsert as upsert_module
from quadrangle.operators.concat import join_pages
from quadrangle.operators.latest import cap_rows, first_per_key
from quadrangle.operators.reach import reach, spread_hot_sources
from quadrangle.operators.resolve import resolve_universities
from quadrangle.operators.upsert import read_table, upsert
from quadrangle.session import cut


def test_first_per_key(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "hot", None, "a", "b"]), rng.randrange(50), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, v int, i int").repartition(4)
    got = {(r.k, r.v, r.i) for r in first_per_key(df, ["k"], [F.desc("v"), F.asc("i")]).collect()}
    best = {}
    for k, v, i in rows:
        best[k] = min(best.get(k, (1, 0)), (-v, i)) if k in best else (-v, i)
    assert got == {(k, -v, i) for k, (v, i) in best.items()}


@pytest.mark.parametrize("salts", [1, 7, 64])
@pytest.mark.parametrize("limit", [1, 20, 1500])
def test_cap_rows_is_exact_with_a_hot_group_and_copies(spark, salts, limit):
    rng = random.Random(2)
    rows = [("hot", f"id{rng.randrange(3000):05d}") for _ in range(3000)]
    rows += [("hot", "id00100")] * 1000 + [("cold", f"id{i}") for i in range(15)]
    df = spark.createDataFrame(rows, "g string, id string").repartition(4)
    got = sorted((r.g, r.id) for r in cap_rows(df, ["g"], [F.asc("id")], limit, salts).collect())
    want = [row for g in ("cold", "hot") for row in sorted(r for r in rows if r[0] == g)[:limit]]
    assert got == want


def _walk(edges, seed, max_depth):
    """Queue-based reach, as a check."""
    out, queue = {}, deque([(seed, 0)])
    targets = {}
    for src, dst in edges:
        targets.setdefault(src, []).append(dst)
    while queue:
        url, depth = queue.popleft()
        if url in out or depth > max_depth:
            continue
        out[url] = depth
        if depth < max_depth and not url.endswith((".pdf", ".css")):
            queue.extend((t, depth + 1) for t in targets.get(url, []))
    return out


@pytest.mark.parametrize("hot_minimum", [1, 10, 1_000_000])
def test_reach_agrees_with_a_queue(spark, hot_minimum):
    rng = random.Random(3)
    name = lambda i: f"https://h/{i}" + (".pdf" if i % 7 == 3 else "")
    edges = [(name(rng.randrange(60)), name(rng.randrange(60))) for _ in range(120)]
    edges += [(name(0), name(i)) for i in range(60, 120)] + [(name(i), name(0)) for i in range(60, 120)]
    df = spark.createDataFrame(edges, "src string, dst string")
    seeds = [("one", name(0)), ("two", name(5)), ("three", name(3)), ("four", "https://h/alone")]
    got = reach(df, spark.createDataFrame(seeds, "crawl string, url string"), ["crawl"], hot_minimum=hot_minimum)
    rows = got.collect()
    want = {(crawl, url, depth) for crawl, seed in seeds for url, depth in _walk(edges, seed, 3).items()}
    assert {(r.crawl, r.url, r.depth) for r in rows} == want
    assert len(rows) == len(want)


def test_reach_grows_with_depth(spark):
    edges = spark.createDataFrame([(f"https://h/{i}", f"https://h/{i + 1}") for i in range(6)], "src string, dst string")
    seeds = spark.createDataFrame([("https://h/0",)], "url string")
    reached = [{r.url for r in reach(edges, seeds, max_depth=d).collect()} for d in range(4)]
    assert all(a < b for a, b in zip(reached, reached[1:]))
    assert len(reached[3]) == 4


def test_hot_sources_are_split_evenly_and_keep_every_link(spark):
    edges = [("hub", f"d{i}") for i in range(1000)] + [(f"s{i}", "hub") for i in range(1000)]
    df = spark.createDataFrame(edges, "src string, dst string")
    links, hot = spread_hot_sources(df, hot_minimum=100)
    assert [(r.src, r.slots) for r in hot.collect()] == [("hub", 10)]
    assert sorted((r.src, r.dst) for r in links.collect()) == sorted(edges)
    per_slot = links.filter("src = 'hub'").groupBy("slot").count().collect()
    assert len(per_slot) == 10 and max(r["count"] for r in per_slot) < 200


def _batch(spark, rows):
    return spark.createDataFrame(
        rows, "record_id string, v int, business_timestamp timestamp, university string, faculty string"
    )


def _stored(spark, path):
    return sorted((r.record_id, r.v, r.university, r.faculty) for r in spark.read.parquet(path).collect())


DAYS = [datetime(2024, 6, d) for d in (1, 2, 3)]


def test_upsert(spark, folder):
    path = f"{folder}/t"
    first = _batch(spark, [("a", 1, DAYS[0], "u", "f"), ("a", 2, DAYS[1], "u", "f"), ("b", 3, DAYS[0], "u", "f"),
                           ("a", 4, DAYS[0], "u", "g"), ("c", 5, DAYS[0], "w x", "f=1")])
    assert upsert(first, path) == 4  # rows put
    once = [("a", 2, "u", "f"), ("a", 4, "u", "g"), ("b", 3, "u", "f"), ("c", 5, "w x", "f=1")]
    assert _stored(spark, path) == once
    upsert(first, path)
    assert _stored(spark, path) == once
    # an older batch still replaces the stored row, new keys are added, others stay
    assert upsert(_batch(spark, [("a", 9, DAYS[0], "u", "f"), ("d", 8, DAYS[0], "u", "f")]), path) == 2
    assert _stored(spark, path) == [("a", 4, "u", "g"), ("a", 9, "u", "f"), ("b", 3, "u", "f"), ("c", 5, "w x", "f=1"), ("d", 8, "u", "f")]


@pytest.mark.parametrize("missing", [None, ""])
def test_upsert_keeps_rows_without_a_folder_name(spark, folder, missing):
    path = f"{folder}/t"
    upsert(_batch(spark, [("a", 1, DAYS[0], missing, "f"), ("b", 2, DAYS[0], missing, "f"), ("c", 3, DAYS[0], "u", "f")]), path)
    upsert(_batch(spark, [("a", 9, DAYS[1], missing, "f")]), path)
    assert sorted((r.record_id, r.v, r.university) for r in spark.read.parquet(path).collect()) == [
        ("a", 9, None), ("b", 2, None), ("c", 3, "u")]


def test_upsert_of_nothing_changes_nothing(spark, folder):
    path = f"{folder}/t"
    batch = _batch(spark, [("a", 1, DAYS[0], "u", "f")])
    assert upsert(batch.limit(0), path) == 0
    assert upsert(batch, path) == 1
    assert upsert(batch.limit(0), path) == 0
    assert len(_stored(spark, path)) == 1


def test_upsert_rewrites_touched_partitions_only(spark, folder):
    path = f"{folder}/t"
    upsert(_batch(spark, [("a", 1, DAYS[0], "u", "f"), ("b", 1, DAYS[0], "u", "g")]), path)
    files = lambda: {r.p for r in spark.read.parquet(path).select(F.input_file_name().alias("p")).distinct().collect()}
    before = files()
    upsert(_batch(spark, [("a", 2, DAYS[1], "u", "f")]), path)
    kept = before & files()
    assert len(kept) == 1 and "faculty=g" in kept.pop()


def test_a_one_key_batch_rewrites_one_folder(spark, folder):
    path = f"{folder}/t"
    batch = _batch(spark, [(f"k{i}", i, DAYS[0], "u", "f") for i in range(300)])
    assert upsert(batch, path, slots=8) == 300
    files = lambda: {r.p for r in spark.read.parquet(path).select(F.input_file_name().alias("p")).distinct().collect()}
    before = files()
    assert upsert(_batch(spark, [("k7", 999, DAYS[1], "u", "f")]), path, slots=8) == 1
    after = files()
    assert len({p.rsplit("/", 1)[0] for p in before}) == 8
    assert len({p.rsplit("/", 1)[0] for p in before - after}) == 1
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 300 and {r.v for r in rows if r.record_id == "k7"} == {999}


def test_the_scan_of_an_upsert_is_pruned_to_the_batch(spark, folder):
    path = f"{folder}/t"
    batch = _batch(spark, [(f"k{i}", i, DAYS[0], "u" if i % 2 else None, f"f{i}") for i in range(600)]).repartition(2)
    upsert(batch, path, slots=4)
    small = _batch(spark, [("k1", 1, DAYS[0], "u", "f1")]).withColumn(upsert_module.SLOT, F.lit(3))
    stored, staged = read_table(spark, path, small.schema), cut(small)
    near = upsert_module.touched_rows(stored, staged, ("university", "faculty"))
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert upsert(batch.withColumn("v", F.col("v") + 10_000), path, slots=4) == 600
    assert spark.read.parquet(path).agg(F.min("v"), F.count("*")).first()[:] == (10_000, 600)


def test_a_missing_table_reads_as_empty(spark, folder):
    schema = _batch(spark, []).schema
    assert read_table(spark, f"{folder}/none", schema).count() == 0


def test_join_pages(spark):
    rows = [("d", 2, "two "), ("d", 0, "\n zero"), ("d", 1, ""), ("d", 10, "ten"), ("e", 0, None), ("e", 1, ""), ("f", 3, None), ("f", 0, "x")]
    df = spark.createDataFrame(rows, "path string, page_no long, text string")
    got = {r.path: r.text for r in join_pages(df, ["path"]).collect()}
    assert got == {"d": "zero\ntwo \nten", "e": "", "f": "x"}


def test_resolve(spark):
    stored = [("hassan_2", "F1"), ("Hassan II", "F1"), ("some_place", "F2"), ("kaddi_ayad", "F3"), ("Other", "F4")]
    asked = [("hassan2", "F1"), ("Some Place", "F2"), ("cadi_ayyad", "F3"), ("Other", "F4"), ("hassan2", "F9"), ("hassan2", "F1")]
    got = resolve_universities(
        spark.createDataFrame(asked, "hint string, faculty string"),
        spark.createDataFrame(stored, "university string, faculty string"),
    ).collect()
    assert {(r.hint, r.faculty): (r.university, r.found) for r in got} == {
        ("hassan2", "F1"): ("Hassan II", True), ("Some Place", "F2"): ("some_place", True),
        ("cadi_ayyad", "F3"): ("kaddi_ayad", True), ("Other", "F4"): ("Other", True),
        ("hassan2", "F9"): ("hassan2", False),
    }
    assert len(got) == 5


@pytest.mark.parametrize("span", [1, 7, 1024])
def test_pages_of_a_long_document_meet_in_ranges(spark, span):
    """A third of all pages in one document: no task joins more than a range of them, same text."""
    rows = [("hot", n, f"p{n}" if n % 5 else "") for n in range(3000)] + [(f"d{n}", n % 4, f"x{n} ") for n in range(600)]
    df = spark.createDataFrame(rows, "path string, page_no long, text string").repartition(6)
    got = {r.path: r.text for r in join_pages(df, ["path"], span=span).collect()}
    assert got["hot"] == "\n".join(f"p{n}" for n in range(3000) if n % 5) and len(got) == 601
    plan = join_pages(df, ["path"], span=span)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(path" in plan and "_range" in plan
