"""Plans of the corpus operators."""

import re

import pytest

from quadrangle.llm.registry import QUERIES


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["op1_sharding", "op10_line_dedup"])
def test_native_operators_run_no_python(spark, sf_dir, name):
    assert not re.search(r"pythonUDF|EvalPython|MapIn(Arrow|Pandas)|InPandas", plan_of(QUERIES[name](spark, sf_dir)))


@pytest.mark.parametrize("name", ["op1_sharding", "op2_decontamination", "op6_minhash_near_dedup", "op7_substring_dedup", "op10_line_dedup"])
def test_no_cross_or_nested_loop_joins(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["op2_decontamination", "op3_toxicity", "op4_language_id", "op5_token_counts"])
def test_scoring_does_not_shuffle_texts(spark, sf_dir, name):
    assert not re.search(r"\bExchange (?:hash|range|Single|Round)", plan_of(QUERIES[name](spark, sf_dir)))


def test_results_do_not_depend_on_the_partitioning(spark, sf_dir):
    from quadrangle.llm.minhash import near_duplicates
    from quadrangle.llm.substrings import drop_repeated_substrings

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for operator in (near_duplicates, drop_repeated_substrings):
        one, many = operator(docs.coalesce(1)), operator(docs.repartition(7))
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
