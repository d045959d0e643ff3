"""Plan shapes that must hold at any size."""

import os

import pytest

from deckmill.catalog import registered

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
QUERIES = {name: query for name, (query, _) in registered().items()}
# Python runs only where bytes are parsed (or made from the given tables), and for the automaton of a long term list.
PYTHON = {n for n in QUERIES if n.startswith(("deck_", "delivery_", "transfer_", "corpus_slide"))} | {"archive_payloads", "archive_records", "long_term_list"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_cross_joins_and_no_python_rows(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name not in PYTHON:
        assert "MapInPandas" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("name,columns", [
    ("size_groups", "ReadSchema: struct<text:string>"),
    ("source_priority", "ReadSchema: struct<page_id:bigint,url:string>"),
    ("stage_dashboard", "ReadSchema: struct<source:string>"),
    ("once_per_entity", "ReadSchema: struct<user_id:bigint,event_type:string>"),
])
def test_columns_are_pruned(spark, name, columns):
    assert columns in plan_of(QUERIES[name](spark, SF))


def test_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["source_quota"](spark, SF)) + plan_of(QUERIES["next_batch_ids"](spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,signup)]" in plan


def test_verdict_needs_one_shuffle_for_its_counts(spark):
    plan = plan_of(QUERIES["verdict_by_source"](spark, SF))
    assert plan.count("Scan parquet") == 1 and "Join" not in plan


def test_policy_needs_no_join(spark):
    plan = plan_of(QUERIES["domain_policy"](spark, SF))
    assert "Exchange" not in plan and "Join" not in plan and "INSET" in plan.upper() or "IN (" in plan
