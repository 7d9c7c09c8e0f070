"""What the physical plans must and must not contain."""

import pytest

from tallyspan.operators import logs
from tallyspan.plans.all_plans import QUERIES
from tallyspan.sources.bindings import Tables

# Queries whose work is a user function or an array kernel by nature.
PYTHON = {
    "judge_sessions", "evaluate_sessions", "row_scorer", "predict", "similarity_topk",
    "question_doc_topk", "similarity_topk_lsh", "text_topk", "data_plus_docs", "index_search",
    "predict_by_search", "judge_transcripts",
}
EAGER = {name for name in QUERIES if name.startswith("stream_")} | {"incremental_index"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_join_and_no_stray_python(spark, tiny, name):
    text = plan(QUERIES[name](spark, tiny))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text
    if name not in PYTHON:
        for bad in ("Python", "InPandas", "InArrow"):
            assert bad not in text


def test_time_and_endpoint_filters_reach_the_scan(spark, tiny):
    usage = spark.read.parquet(f"{tiny}/events.parquet").selectExpr(
        "ts AS event_time", "event_type AS endpoint_name", "event_id AS total_tokens",
        "event_id AS input_tokens", "event_id AS output_tokens")
    text = plan(logs.hourly_usage(usage, ["click", "view"], "2024-01-02 00:00:00", 24))
    pushed = text[text.index("PushedFilters"):text.index("ReadSchema")]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(t" in pushed
    assert "In(event_type" in pushed
    assert "user_id" not in text[text.index("ReadSchema"):].splitlines()[0]


def test_reports_by_name(spark, tiny):
    tables = Tables(spark, tiny)
    assert logs.log_report(tables.payload, "all", limit=7).count() == 7
    assert logs.log_report(tables.payload, "failed").count() == 50
    month = {"as_of": "2024-02-01 00:00:00", "hours": 744}
    assert logs.log_report(tables.payload, "token_usage", **month).count() == 2
    assert logs.log_report(tables.calls, "system_usage", names=["x"], **month).count() == 0
    with pytest.raises(KeyError):
        logs.log_report(tables.payload, "unknown")


def test_reports_over_rows_without_numbers(spark):
    empty = spark.createDataFrame(
        [("a", "p", None, None, None)],
        "agent string, provider string, event_time timestamp, latency_ms double, response string")
    assert {r.avg_latency_ms for r in logs.usage_cube(empty).collect()} == {None}
    free = spark.createDataFrame([("e", 0), ("f", 0)], "endpoint_name string, total_tokens bigint")
    assert [r.share for r in logs.chargeback(free).collect()] == [None, None]


def test_newest_rows_need_no_full_sort(spark, tiny):
    assert "TakeOrderedAndProject" in plan(logs.all_requests(Tables(spark, tiny).payload))


def test_capping_cuts_each_task_first(spark, tiny):
    text = plan(QUERIES["cap_per_group"](spark, tiny))
    assert text.count("WindowGroupLimit") == 2


def test_cube_expands_sums_and_not_rows(spark, tiny):
    text = plan(logs.usage_cube(Tables(spark, tiny).payload))
    # Read from the bottom: an exchange of the finest sums lies below the Expand.
    assert "Exchange" in text[text.index("Expand"):]
