"""The physical plans are the ones meant for large inputs."""

import re

import pytest

from quadrangle.operators.links import page_links
from quadrangle.session import shared_dir
from workload import fixtures as fx
from workload.queries import QUERIES


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan):
    return len(re.findall(r"\bExchange (?:hash|range|Single|Round)", plan))


@pytest.mark.parametrize("name", ["author_normalize", "course_catalog", "precombine_latest"])
def test_survivors_are_picked_before_the_shuffle(spark, sf_dir, name):
    """One row per key and task crosses the shuffle, however hot the key."""
    plan = plan_of(QUERIES[name](spark, sf_dir))
    final, shuffle, partial = plan.index(", Final"), plan.index("Exchange hash"), plan.index(", Partial")
    assert final < shuffle < partial
    assert exchanges(plan) == 1


@pytest.mark.parametrize(
    "name", ["file_type_route", "crawl_manifest", "publication_enrich", "log_rows", "search_docs", "lossy_decode",
             "dynamic_pages", "course_keyword_filter", "page_links"],
)
def test_row_wise_operators_do_not_shuffle(spark, sf_dir, name):
    assert exchanges(plan_of(QUERIES[name](spark, sf_dir))) == 0


@pytest.mark.parametrize(
    "name, count", [("batch_record_counts", 1), ("crawl_stats", 1), ("links_per_page", 1), ("text_concat", 2), ("extraction_stats", 1)],
)
def test_aggregates_combine_before_their_shuffles(spark, sf_dir, name, count):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert exchanges(plan) == count
    assert "partial_" in plan


def test_no_cross_or_nested_loop_joins(spark, sf_dir):
    for name in ("author_normalize", "extraction_payload", "resolve_university", "job_counts"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize(
    "name, columns",
    [
        ("batch_record_counts", {"o_custkey", "o_orderstatus"}),
        ("dynamic_pages", {"page_id", "url", "html"}),
        ("log_rows", {"ts", "user_id", "event_type", "props"}),
    ],
)
def test_scans_read_only_needed_columns(spark, sf_dir, name, columns):
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan_of(QUERIES[name](spark, sf_dir))).group(1)
    assert {field.split(":")[0] for field in read.split(",")} == columns


def test_counting_courses_does_not_read_texts(spark, sf_dir):
    from quadrangle.plans.courses import row_counts

    scans = re.findall(r"documents\.parquet.*?ReadSchema: struct<([^>]*)>", plan_of(row_counts(fx.course_payloads(spark, sf_dir))))
    assert scans and all("text" not in scan for scan in scans)


def test_course_levels_are_counted_without_texts(spark, sf_dir):
    """Which of several payloads of a course survives is told by checksums, not by texts."""
    plan = plan_of(QUERIES["report_courses_per_level"](spark, sf_dir))
    scans = re.findall(r"documents\.parquet.*?ReadSchema: struct<([^>]*)>", plan)
    assert scans and all("text" not in scan for scan in scans)


def test_row_filters_reach_the_scan(spark, folder):
    path = f"{folder}/authors"
    fx.authors(spark, "/root/testdata/sf0.001").write.parquet(path)
    from quadrangle.plans.profiles import faculty_profiles

    plan = plan_of(faculty_profiles(spark.read.parquet(path), fx.instant()))
    assert "IsNotNull(display_name)" in re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)


def test_link_plan_stays_small(spark, sf_dir):
    """Every step works on finished values; the expression must not multiply. The table of
    named references is printed with the plan, once or twice."""
    assert len(plan_of(page_links(fx.table(spark, sf_dir, "pages"), keep=["page_id"]))) < 45_000


def test_the_shared_folder_is_the_named_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_no_python_in_the_plans(spark, sf_dir):
    for name in ("author_normalize", "page_links", "text_concat", "lossy_decode", "search_docs"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        assert not re.search(r"pythonUDF|EvalPython|MapIn(Arrow|Pandas)", plan)


@pytest.mark.parametrize("hot_minimum", [1, 1_000_000])
def test_links_are_not_shuffled_again_in_the_rounds(spark, sf_dir, hot_minimum):
    from quadrangle.operators import reach as module

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges, seeds = fx.link_edges(spark, sf_dir), fx.link_seeds(spark, sf_dir)
        slotted, hot = module.spread_hot_sources(edges, hot_minimum)
        frontier = seeds.selectExpr("university", "url", "0 AS depth")
        with module._laid_out(slotted, ["src"] if hot is None else ["src", "slot"]) as links:
            sources = frontier.selectExpr("university", "url AS src")
            plan = plan_of(module._follow_links(sources, links, hot))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in plan
    assert exchanges(plan) == 1
