"""Loads, log tables, configs, prompts' catalogue."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from tallyspan import schemas
from tallyspan.operators.scenarios import expand_task, flatten_groups, runnable_scenarios
from tallyspan.operators.lookups import scenario_agent_join
from tallyspan.sources import configs, loads


def test_fact_load_and_comment(spark):
    loads.ensure_schema(spark, "gov")
    loads.ensure_schema(spark, "gov")
    raw = spark.createDataFrame(
        [("D1", 2024, "CA", "fire", 5, 10, 1.25, "2024-02-03")],
        "disaster_id string, year bigint, state string, disaster_type string, severity bigint, "
        "affected_population bigint, federal_aid_amount double, declaration_date string",
    )
    table = loads.load_fact(raw, "gov.fact")
    assert table.schema.simpleString() == spark.createDataFrame(
        [], schemas.DISASTER).schema.simpleString()
    assert table.first().declaration_date == datetime.date(2024, 2, 3)
    loads.load_fact(raw, "gov.fact")
    assert loads.readback_count(spark.table("gov.fact")).first().n == 1
    loads.comment_table(spark, "gov.fact", "it's a 'fact' table")
    assert spark.catalog.getTable("gov.fact").description == "it's a 'fact' table"


def test_documents_need_a_unique_key(spark):
    loads.ensure_schema(spark, "gov")
    docs = spark.createDataFrame([("a", "u", "t"), ("b", "u", "t2")], schemas.POLICY_DOCS)
    table = loads.load_documents(docs, "gov.docs")
    assert table.select("content_hash").distinct().count() == 2
    with pytest.raises(ValueError):
        loads.load_documents(docs.unionByName(docs), "gov.docs")
    nothing = spark.createDataFrame([(None, "u", "t")], schemas.POLICY_DOCS)
    with pytest.raises(Exception, match="doc_id must not be null"):
        loads.versioned_documents(nothing).collect()


def test_names_with_hyphens(spark):
    assert loads.quote_name("`a`.b-c") == "`a`.`b-c`"
    # The built-in catalog takes hyphens in view names only.
    spark.range(3).createOrReplaceTempView("`my-svc_payload`")
    assert loads.read_log_table(spark, "my-svc_payload").count() == 3


def test_traces_are_appended_by_day(spark):
    loads.ensure_schema(spark, "gov")
    rows = [(f"t{i}", "r", datetime.datetime(2024, 1, 1 + i % 2), "q", "a", {}, {}) for i in range(4)]
    df = spark.createDataFrame(rows, schemas.TRACE)
    loads.append_traces(df, "gov.x_traces")
    loads.append_traces(df, "gov.x_traces")
    table = spark.table("gov.x_traces")
    assert table.count() == 8
    day = table.filter(F.col("day") == "2024-01-01")
    assert day.count() == 4
    assert "PartitionFilters: [isnotnull(day" in day._jdf.queryExecution().executedPlan().toString()


def test_a_batch_appended_again_replaces_itself(spark):
    loads.ensure_schema(spark, "gov")

    def traces(first, text="a"):
        rows = [(f"t{i}", "r", datetime.datetime(2024, 1, 1 + i % 2), "q", text, {}, {})
                for i in range(first, first + 4)]
        return spark.createDataFrame(rows, schemas.TRACE)

    for batch, rows in (("one", traces(0)), ("two", traces(10)), ("one", traces(0, "b")),
                        ("two", traces(10)), ("it's {x}", traces(20)), ("it's {x}", traces(20))):
        loads.append_traces(rows, "gov.y_traces", batch)
    table = spark.table("gov.y_traces")
    assert table.count() == 12 == table.select("trace_id").distinct().count()
    assert {r.response for r in table.filter("batch = 'one'").collect()} == {"b"}


CONFIGS = [
    ("main.gw.a", {"service_policies": [
        {"name": "pii", "options": {"phases": ["pre_call"], "action": "flag"}},
        {"name": "gone", "is_deleted": True}, {"name": "bare"}],
        "routing": {"destinations": [{"name": "system.ai.m1"}, {"name": "m2"}]},
        "inference_table": {"table": "tables/main.other.a_payload"}}),
    ("main.gw.b", {"inference_table": {"table": "main.gw.b_payload"}, "routing": {}}),
    ("main.gw.c", {}),
]


@pytest.fixture()
def service_configs(spark):
    return spark.createDataFrame(
        [(s, json.dumps(c)) for s, c in CONFIGS], schemas.SERVICE_CONFIG)


def test_configs(service_configs):
    tables = {r.model_service: r.log_table
              for r in configs.discover_log_tables(service_configs).collect()}
    assert tables == {"main.gw.a": "main.other.a_payload", "main.gw.b": "main.gw.b_payload"}
    policies = [tuple(r) for r in configs.active_policies(service_configs).collect()]
    assert policies == [("main.gw.a", "pii", ["pre_call"], "flag"),
                        ("main.gw.a", "bare", None, "block")]
    models = {r.model_service: r.routed_model
              for r in configs.routed_model(service_configs).collect()}
    assert models == {"main.gw.a": "m1", "main.gw.b": "", "main.gw.c": ""}
    drift = configs.schema_drift(service_configs).collect()
    assert [tuple(r) for r in drift] == [("main.gw.a", "main.gw", "main.other")]
    found = configs.discover_log_tables(service_configs)
    assert [r.model_service for r in configs.missing_services(service_configs, found).collect()] \
        == ["main.gw.c"]
    assert configs.covered_services(service_configs, found).count() == 2


def test_expand_task(spark):
    tasks = spark.createDataFrame(
        [("pi", 0, "sort", "fix", "Sort it", "\n        def f():\n            pass\n\n        done\n    "),
         ("zz", 0, "t", "k", "L", "flat")],
        schemas.CLEAN_TASK,
    )
    labels = spark.createDataFrame([("pi", "Pi")], "agent string, display_name string")
    got = {r.agent: r for r in expand_task(tasks, labels).collect()}
    assert got["pi"].name == "clean_pi_sort"
    assert got["pi"].description == "Clean/fix: Sort it (Pi)"
    assert got["pi"].messages[0].content == "def f():\n    pass\n\ndone"
    assert got["zz"].description == "Clean/k: L ()"


def test_catalogue_and_runnable(spark):
    groups = spark.createDataFrame(
        [({"Data": [("q1", "data"), ("q2", "data")], "Docs": [("q3", "docs")]},)],
        "groups map<string,array<struct<query:string,category:string>>>",
    )
    assert sorted(map(tuple, flatten_groups(groups).collect())) == [
        ("Data", "q1", "data"), ("Data", "q2", "data"), ("Docs", "q3", "docs")]
    scenarios = spark.createDataFrame(
        [("a", True), ("b", False), ("c", None)], "name string, requires_complaint_agent boolean")
    assert [r.name for r in runnable_scenarios(scenarios, False).collect()] == ["b", "c"]
    assert runnable_scenarios(scenarios, True).count() == 3


def test_unknown_agent_is_an_error(spark):
    agents = spark.createDataFrame([("pi", "g")], "agent string, provider string")
    services = spark.createDataFrame([("g", "svc")], "provider string, model_service string")
    known = spark.createDataFrame([("s1", "pi")], "name string, agent string")
    assert scenario_agent_join(known, agents, services).first().model_service == "svc"
    unknown = spark.createDataFrame([("s2", "nobody")], "name string, agent string")
    with pytest.raises(Exception, match="without a known agent"):
        scenario_agent_join(unknown, agents, services).collect()


def test_limits_of_services(spark):
    def service(name, limits):
        return name, json.dumps({"rate_limits": limits, "usage_tracking": {"enabled": True}})

    rows = [
        service("a", [{"calls": 8, "tokens": 2000, "renewal_period": "minute"}, {"calls": 5}]),
        service("b", [{"calls": 3, "renewal_period": "minute"}]),
        service("c", [{"calls": 1, "tokens": 1, "renewal_period": "hour"}]),
        service("d", None), ("e", "{}"),
    ]
    table = spark.createDataFrame(rows, schemas.SERVICE_CONFIG)
    assert [tuple(r) for r in configs.service_limits(table).collect()] == [("a", 5, 2000)]
    settings = {r.model_service: r.usage_tracking for r in configs.service_settings(table).collect()}
    assert "enabled" in settings["a"] and settings["e"] is None
