import pytest

import __spark_entry__ as registered
from catalog.check import compare
from catalog.registry import QUERIES
from tests.conftest import SF, plan_of

# One of every kind; `python -m catalog.check` runs all.
SOME = [
    "csv_scan", "resolve_columns", "folder_scan_txt", "union_sources", "labels_append", "redact_pii", "redact_url",
    "build_features", "education_context_filter", "parse_job_description", "chunk_words", "rank_candidates_semantic",
    "evaluate_rankings", "stratified_pool", "skill_gap_counts",
]


@pytest.mark.parametrize("name", SOME)
def test_query_equals_its_sql(spark, name):
    verdict, rows, _, _ = compare(spark, SF, registered.queries()[name], registered.oracle_sql()[name])
    assert verdict == "ok" and rows > 0


def test_every_query_of_the_catalog_has_sql():
    assert QUERIES.keys() <= registered.oracle_sql().keys()
    assert QUERIES.keys() <= registered.queries().keys()


def test_entry(spark):
    assert registered.entry(spark).count() == 10


@pytest.mark.parametrize("name", ["rank_candidates_by_source", "tfidf_cosine", "semantic_top3_mean", "skill_score", "doc_job_cross"])
def test_plans_have_no_cross_join_and_no_python(spark, name):
    plan = plan_of(registered.queries()[name](spark, SF))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert forbidden not in plan


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(registered.queries()["extract_skills"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
