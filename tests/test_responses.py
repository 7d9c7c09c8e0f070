"""Response shapes, one by one."""

import json

import pytest
from pyspark.sql import functions as F

from tallyspan.functions.responses import (
    burst_outcome, extract_answer, format_results, json_usage, message_content,
    normalize_content, outcome, parse_body, policy_block, preview,
)


def one(spark, value, build):
    df = spark.createDataFrame([(value,)], "body string")
    return df.select(build(F.col("body")).alias("out")).first()["out"]


def reply(content):
    return json.dumps({"choices": [{"message": {"content": content}}]})


@pytest.mark.parametrize(
    "body,want",
    [
        (reply("plain"), "plain"),
        (reply("[1, 2]"), "[1, 2]"),
        (reply([{"type": "text", "text": "a", "thoughtSignature": "zz"}, "raw",
                {"type": "image"}, {"type": "text", "text": "b"}]), "arawb"),
        (reply([]), ""),
        (reply(None), ""),
        (reply(7), "7"),
        (reply(True), "true"),
        (json.dumps({"choices": [{"message": {}}]}), ""),
        ("not json", ""),
        (None, ""),
    ],
)
def test_normalize_content(spark, body, want):
    got = one(spark, body, lambda b: normalize_content(message_content(parse_body(b))))
    assert got == want


DENIED = {
    "choices": [{"message": {"content": "blocked"}, "finish_reason": "content_filter"}],
    "any_vendor_service_policy": {
        "name": "PII", "action": "deny", "phase": "pre_call", "reason": "because"},
}


@pytest.mark.parametrize(
    "body,want",
    [
        (DENIED, ("PII", "deny", "pre_call", "because")),
        ({**DENIED, "any_vendor_service_policy": None}, ("unknown", "deny", None, None)),
        ({"choices": [{"finish_reason": "content_filter"}]}, ("unknown", "deny", None, None)),
        ({"choices": [{"finish_reason": "stop"}],
          "x_service_policy": {"name": "PII", "action": "allow"}}, None),
        ({"choices": [{"finish_reason": "stop",
                       "message": {"content": "about content_filter"}}]}, None),
        ({"choices": []}, None),
    ],
)
def test_policy_block(spark, body, want):
    got = one(spark, json.dumps(body), policy_block)
    assert (tuple(got) if got else None) == want


@pytest.mark.parametrize(
    "body,want",
    [
        ({"output": [
            {"role": "assistant", "content": [{"type": "output_text", "text": "old"}]},
            {"role": "assistant", "content": [{"type": "output_text", "text": "a"},
                                              {"type": "tool", "text": "no"},
                                              {"type": "output_text", "text": "b"}]},
            {"role": "user", "content": "later"}]}, "a\nb"),
        ({"output": [{"role": "assistant", "content": "plain"},
                     {"role": "assistant", "content": []},
                     {"role": "assistant", "content": ""}]}, "plain"),
        ({"output": [{"role": "user", "content": "q"}],
          "choices": [{"message": {"content": "choice"}}]}, "choice"),
        ({"choices": [{"message": {"content": "only"}}]}, "only"),
        ({"other": 1}, '{"other":1}'),
    ],
)
def test_extract_answer(spark, body, want):
    assert one(spark, json.dumps(body), lambda b: extract_answer(parse_body(b))) == want


@pytest.mark.parametrize(
    "body,want",
    [
        ('{"usage":{"prompt_tokens":1,"completion_tokens":"2","total_tokens":4}}', (1, 2, 4)),
        ('{"usage":{"total_tokens":"x"}}', (None, None, None)),
        ("{broken", (None, None, None)),
        (None, (None, None, None)),
    ],
)
def test_json_usage(spark, body, want):
    assert tuple(one(spark, body, json_usage)) == want


def test_outcomes(spark):
    rows = [(200, None), (200, "p"), (429, None), (500, None)]
    df = spark.createDataFrame(rows, "status int, policy string")
    got = df.select(
        outcome(F.col("status"), F.col("policy")).alias("a"),
        burst_outcome(F.col("status"), F.col("policy")).alias("b"),
    ).collect()
    assert [r.a for r in got] == ["allowed", "blocked", "blocked", "blocked"]
    assert [r.b for r in got] == ["allowed", "blocked", "rate_limited", "error"]


def test_format_results(spark):
    schema = ("answer string, results array<struct<title:string,url:string,content:string>>")
    hits = [("t1", "u1", "x" * 400), ("t2", "u2", "c2"), ("t3", "u3", "c3"), ("t4", "u4", "c4")]
    df = spark.createDataFrame([("sum", hits), (None, hits[1:2]), ("", None)], schema)
    got = [r[0] for r in df.select(format_results(F.col("answer"), F.col("results"))).collect()]
    assert got[0] == ("Summary: sum\n\n- [t1](u1)\n  " + "x" * 300
                      + "\n\n- [t2](u2)\n  c2\n\n- [t3](u3)\n  c3")
    assert got[1] == "- [t2](u2)\n  c2"
    assert got[2] == "No results found."


def test_preview(spark):
    assert one(spark, "a" * 151, lambda b: preview(b, 150)) == "a" * 150 + "..."
    assert one(spark, "a" * 150, lambda b: preview(b, 150)) == "a" * 150
