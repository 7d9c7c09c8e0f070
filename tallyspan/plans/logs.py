"""Queries over the request log, the usage table and scenario results."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspan.functions.responses import (
    extract_answer, json_usage, message_content, normalize_content, parse_body, policy_block,
)
from tallyspan.operators import limits, logs, lookups
from tallyspan.plans.registry import query

# The whole month of the test log, and a day inside it for the window operator.
MONTH_END, MONTH_HOURS = "2024-02-01 00:00:00", 24 * 31
DAY_END = "2024-01-15 00:00:00"
ENDPOINTS = ["main.gw.claude-svc", "main.gw.gemini-svc", "main.gw.openai-svc"]


@query("token_usage", over="p", sql="""
SELECT CASE WHEN status_code = 200 THEN 'succeeded' ELSE 'failed' END AS outcome,
  count(*) AS request_count, CAST(sum(total_tokens) AS BIGINT) AS total_tokens,
  CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
  CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
  round(avg(latency_ms), 0) AS avg_latency_ms
FROM p WHERE event_time >= TIMESTAMP '2024-01-01' AND event_time < TIMESTAMP '2024-02-01'
GROUP BY 1 ORDER BY total_tokens DESC NULLS LAST""")
def _(t):
    return logs.token_usage(t.payload, MONTH_END, MONTH_HOURS)


_REQUEST = """'{"messages":[{"role":"system","content":"be brief"},{"role":"user","content":"ask '
 || request_id || '"}]}'"""
_RESPONSE = """CASE WHEN status_code <> 200 THEN '{"error":"HTTP ' || status_code || '"}' ELSE
 '{"choices":[{"finish_reason":"' || CASE WHEN denied THEN 'content_filter' ELSE 'stop' END
 || '","message":{"content":' || CASE WHEN denied THEN '"This request was blocked."'
    WHEN request_id % 4 = 0 THEN '"reply ' || request_id || '"'
    WHEN request_id % 4 = 1 THEN '[{"type":"text","text":"reply "},{"type":"text","text":"'
      || request_id || '"}]'
    WHEN request_id % 4 = 2 THEN 'null'
    ELSE '[{"type":"thought"},"raw ",{"type":"text","text":"' || request_id || '"}]' END
 || '}}],"usage":{"prompt_tokens":' || input_tokens || ',"completion_tokens":' || output_tokens
 || ',"total_tokens":' || total_tokens || '}'
 || CASE WHEN denied AND request_id % 3 <> 0 THEN ',"acme_service_policy":{"name":"'
    || CASE WHEN request_id % 3 = 1 THEN 'pii' ELSE 'jailbreak' END
    || '","action":"deny","phase":"'
    || CASE WHEN request_id % 2 = 0 THEN 'pre_call' ELSE 'post_call' END
    || '","reason":"rule ' || request_id || '"}' ELSE '' END || '}' END"""


@query("all_requests", over="p", sql=f"""
SELECT event_time, request_id, status_code, requester, latency_ms,
  {_REQUEST} AS request, {_RESPONSE} AS response
FROM p ORDER BY event_time DESC, request_id DESC LIMIT 50""")
def _(t):
    return logs.all_requests(t.payload)


@query("failed_requests", over="p", sql=f"""
SELECT event_time, request_id, status_code, requester, latency_ms, {_REQUEST} AS request,
  array_to_string(logging_error_codes, ',') AS logging_error_codes
FROM p WHERE status_code <> 200
  OR (logging_error_codes IS NOT NULL AND len(logging_error_codes) > 0)
ORDER BY event_time DESC, request_id DESC LIMIT 50""")
def _(t):
    return logs.failed_requests(t.payload).withColumn(
        "logging_error_codes", F.array_join("logging_error_codes", ",")
    )


@query("sent_content", over="p", sql="""
SELECT event_time, request_id, requester, destination_model, 'ask ' || request_id AS content,
  latency_ms
FROM p WHERE event_time >= TIMESTAMP '2024-01-01' AND event_time < TIMESTAMP '2024-02-01'""")
def _(t):
    return logs.sent_content(t.payload, MONTH_END, MONTH_HOURS)


@query("recent_window", over="p", sql="""
SELECT event_time, request_id, status_code FROM p
WHERE event_time >= TIMESTAMP '2024-01-14' AND event_time < TIMESTAMP '2024-01-15'""")
def _(t):
    return logs.recent_window(t.calls, DAY_END, 24).select(
        "event_time", "request_id", "status_code"
    )


@query("endpoint_in", over="p", sql="""
SELECT request_id, endpoint_name, total_tokens FROM p
WHERE endpoint_name IN ('main.gw.claude-svc', 'main.gw.openai-svc')""")
def _(t):
    return logs.endpoint_in(t.calls, [ENDPOINTS[0], ENDPOINTS[2]]).select(
        "request_id", "endpoint_name", "total_tokens"
    )


@query("menu_filter", sql="""
SELECT p_partkey, p_name, p_size, p_retailprice FROM part
WHERE p_brand = 'Brand#17' AND p_retailprice <= 1200 AND p_size >= 5""")
def _(t):
    return logs.attribute_filter(
        t.read("part"), equals={"p_brand": "Brand#17"}, at_most={"p_retailprice": 1200},
        at_least={"p_size": 5},
    ).select("p_partkey", "p_name", "p_size", "p_retailprice")


@query("preview_columns", sql="""
SELECT doc_id, CASE WHEN length(text) > 150 THEN substr(text, 1, 150) || '...' ELSE text END
  AS preview, substr(text, 1, 60) || '...' AS label FROM documents""")
def _(t):
    return logs.preview_columns(t.read("documents"), "text", "text").select(
        "doc_id", "preview", "label"
    )


@query("hourly_usage", over="p", sql="""
SELECT endpoint_name, date_trunc('hour', event_time) AS hour, count(*) AS request_count,
  CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
  CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
  CAST(sum(total_tokens) AS BIGINT) AS total_tokens
FROM p WHERE event_time >= TIMESTAMP '2024-01-01' AND event_time < TIMESTAMP '2024-02-01'
GROUP BY 1, 2""")
def _(t):
    return logs.hourly_usage(t.calls, ENDPOINTS, MONTH_END, MONTH_HOURS)


@query("union_logs", over="p", sql="""
SELECT provider, request_id, status_code FROM p""")
def _(t):
    return logs.union_logs(t.logs).select("provider", "request_id", "status_code")


@query("usage_by_provider", over="p", sql="""
SELECT provider, count(*) AS request_count,
  count(*) FILTER (WHERE status_code = 200) AS succeeded,
  CAST(sum(total_tokens) AS BIGINT) AS total_tokens, round(avg(latency_ms), 2) AS avg_latency_ms
FROM p GROUP BY 1""")
def _(t):
    return logs.usage_by_provider(t.logs)


@query("chargeback", over="p", sql="""
SELECT endpoint_name, count(*) AS request_count, CAST(sum(total_tokens) AS BIGINT) AS total_tokens,
  round(sum(total_tokens) / (SELECT CAST(sum(total_tokens) AS DOUBLE) FROM p), 6) AS share
FROM p GROUP BY 1""")
def _(t):
    return logs.chargeback(t.calls)


@query("hourly_activity", over="p", sql="""
SELECT date_trunc('hour', event_time) AS hour, requester, count(*) AS request_count,
  round(avg(latency_ms), 2) AS avg_latency_ms
FROM p GROUP BY 1, 2""")
def _(t):
    return logs.hourly_activity(t.calls)


@query("usage_cube", over="p", sql="""
SELECT agent, provider, date_trunc('hour', event_time) AS hour,
  CAST(grouping_id(agent, provider, date_trunc('hour', event_time)) AS BIGINT) AS level,
  count(*) AS request_count, CAST(sum(total_tokens) AS BIGINT) AS total_tokens,
  round(avg(latency_ms), 2) AS avg_latency_ms
FROM p GROUP BY CUBE (agent, provider, date_trunc('hour', event_time))""")
def _(t):
    return logs.usage_cube(t.payload)


@query("latency_percentiles", over="p", sql="""
SELECT provider, count(*) AS n, quantile_cont(latency_ms, 0.5) AS p50,
  quantile_cont(latency_ms, 0.75) AS p75, quantile_cont(latency_ms, 0.95) AS p95
FROM p GROUP BY 1""")
def _(t):
    return logs.latency_percentiles(t.calls)


@query("latency_fractions", over="p", sql="""
SELECT provider, count(*) AS n, round(quantile_cont(latency_ms / 1000, 0.5), 6) AS p50,
  round(quantile_cont(latency_ms / 1000, 0.95), 6) AS p95 FROM p GROUP BY 1""")
def _(t):
    """Percentiles of seconds with decimals."""
    rows = t.calls.withColumn("latency_s", F.col("latency_ms") / 1000)
    found = logs.exact_percentiles(rows, ["provider"], "latency_s", {"p50": 0.5, "p95": 0.95})
    return found.withColumns({q: F.round(q, 6) for q in ("p50", "p95")})


@query("attribution", over="p", sql="""
SELECT agent, provider, endpoint_name AS model_service, count(*) AS requests,
  CAST(sum(total_tokens) AS BIGINT) AS total_tokens
FROM p GROUP BY 1, 2, 3""")
def _(t):
    return logs.attribution(t.tagged)


@query("token_gap", over="p", sql="""
SELECT endpoint_name, CAST(sum(total_tokens) AS BIGINT) AS total_tokens,
  CAST(sum(total_tokens) - sum(input_tokens) - sum(output_tokens) AS BIGINT) AS gap
FROM p GROUP BY 1""")
def _(t):
    return logs.token_gap(t.calls)


@query("rolling_rate", over="p", sql="""
SELECT endpoint_name, w AS window_start, count(*) AS requests,
  CAST(sum(total_tokens) AS BIGINT) AS total_tokens
FROM (SELECT endpoint_name, total_tokens,
        unnest([time_bucket(INTERVAL 10 SECOND, event_time) - INTERVAL 10 SECOND * i
                FOR i IN range(6)]) AS w FROM p)
GROUP BY 1, 2""")
def _(t):
    return logs.rolling_rate(t.calls)


@query("json_usage", over="p", sql="""
SELECT request_id, input_tokens, output_tokens, total_tokens FROM p""")
def _(t):
    return t.payload.select("request_id", json_usage(F.col("response")).alias("u")).select(
        "request_id",
        F.col("u.input").alias("input_tokens"),
        F.col("u.output").alias("output_tokens"),
        F.col("u.total").alias("total_tokens"),
    )


@query("normalize_content", over="r", sql="SELECT request_id, content FROM r")
def _(t):
    body = parse_body(F.col("response"))
    return t.payload.select(
        "request_id", normalize_content(message_content(body)).alias("content")
    )


@query("policy_block", over="r", sql="""
SELECT request_id, policy_name AS name, CASE WHEN denied THEN 'deny' END AS action,
  policy_phase AS phase, CASE WHEN denied AND request_id % 3 <> 0 THEN 'rule ' || request_id END
  AS reason FROM r""")
def _(t):
    return t.payload.select("request_id", policy_block(F.col("response")).alias("v")).select(
        "request_id", "v.name", "v.action", "v.phase", "v.reason"
    )


@query("extract_answer", over="r", sql="""
SELECT request_id, CASE request_id % 3 WHEN 0 THEN content
  WHEN 1 THEN 'first ' || request_id || chr(10) || 'second ' || request_id
  ELSE 'plain ' || request_id END AS answer FROM r""")
def _(t):
    rid = F.col("request_id").cast("string")
    reply = F.concat(F.lit('{"output":[{"role":"user","content":"q"},{"role":"assistant",'
                           '"content":'))
    body = (
        F.when(
            F.col("request_id") % 3 == 0,
            F.to_json(F.struct(F.array(F.struct(F.struct("content").alias("message")))
                               .alias("choices"))),
        )
        .when(
            F.col("request_id") % 3 == 1,
            F.concat(
                reply, F.lit('[{"type":"output_text","text":"first '), rid,
                F.lit('"},{"type":"note","text":"x"},{"type":"output_text","text":"second '),
                rid, F.lit('"}]},{"role":"assistant","content":[]}]}'),
            ),
        )
        .otherwise(
            F.concat(reply, F.lit('"plain '), rid,
                     F.lit('"},{"role":"tool","content":"later"}]}'))
        )
    )
    return t.results.select(
        "request_id", extract_answer(parse_body(body)).alias("answer")
    )


@query("outcome", over="r", sql="""
SELECT request_id, status, expected_outcome, actual_outcome, pass FROM r""")
def _(t):
    return t.results.select("request_id", "status", "expected_outcome", "actual_outcome", "pass")


@query("burst_outcome", over="r", sql="SELECT request_id, status, burst AS outcome FROM r")
def _(t):
    return t.burst.select("request_id", "status", "outcome")


@query("blocked_only", over="r", sql="""
SELECT request_id, provider, policy_name AS policy FROM r WHERE actual_outcome = 'blocked'""")
def _(t):
    return lookups.blocked_only(t.results).select(
        "request_id", "provider", F.col("policy.name").alias("policy")
    )


@query("pass_summary", over="r", sql="""
SELECT CAST(sum(CAST(pass AS INTEGER)) AS BIGINT) AS passed, count(*) AS total FROM r""")
def _(t):
    return lookups.pass_summary(t.results)


@query("pass_by_provider", over="r", sql="""
SELECT provider, count(*) FILTER (WHERE pass) AS passed, count(*) AS total FROM r GROUP BY 1""")
def _(t):
    return lookups.pass_by_provider(t.results)


@query("blocks_by_policy", over="r", sql="""
SELECT provider, coalesce(policy_name, '—') AS policy, count(*) AS blocks
FROM r WHERE actual_outcome = 'blocked' GROUP BY 1, 2""")
def _(t):
    return lookups.blocks_by_policy(t.results)


@query("burst_summary", over="r", sql="""
SELECT provider, count(*) FILTER (WHERE burst = 'allowed') AS allowed,
  count(*) FILTER (WHERE burst = 'rate_limited') AS rate_limited,
  count(*) FILTER (WHERE burst = 'blocked') AS blocked,
  count(*) FILTER (WHERE burst = 'error') AS errors, count(*) AS total
FROM r GROUP BY 1""")
def _(t):
    return lookups.burst_summary(t.burst, ["provider"])


@query("status_counts", over="r", sql="""
SELECT CASE WHEN status = 200 THEN 'success' ELSE 'error' END AS status, count(*) AS n
FROM r GROUP BY 1""")
def _(t):
    status = F.when(F.col("status") == 200, "success").otherwise("error")
    return lookups.status_counts(t.results.withColumn("status", status))


@query("results_summary", over="r", sql="""
SELECT description AS test, agent, provider, upper(expected_outcome) AS expected,
  upper(actual_outcome) AS actual, coalesce(policy_name, '—') AS policy, status AS http,
  CASE WHEN pass THEN 'PASS' ELSE 'FAIL' END AS result FROM r""")
def _(t):
    return lookups.results_summary(t.results)


@query("union_results", over="r", sql="""
SELECT request_id, provider, actual_outcome FROM r WHERE expected_outcome = 'allowed'
UNION ALL SELECT request_id, NULL, actual_outcome FROM r WHERE expected_outcome = 'blocked'
UNION ALL SELECT request_id, provider, actual_outcome FROM r WHERE actual_outcome = 'blocked'""")
def _(t):
    rows = t.results.select("request_id", "provider", "expected_outcome", "actual_outcome")
    return logs.union_results(
        rows.filter(F.col("expected_outcome") == "allowed"),
        rows.filter(F.col("expected_outcome") == "blocked").drop("provider"),
        lookups.blocked_only(rows),
    ).drop("expected_outcome")


@query("rate_limit_fixed", over="l", sql="SELECT * FROM limited")
def _(t):
    return limits.rate_limit_fixed(t.limited_calls, t.service_limits, window="1 hour").select(
        "request_id", "provider", "window_start", "admitted", "limit_status", "limit_hit"
    )


@query("final_attempt", over="p", sql="""
SELECT request_id, request_id % 4 + 1 AS attempts, status_code AS status,
  latency_ms + request_id % 4 + 1 AS latency_s,
  CAST(2 * (pow(2, request_id % 4) - 1) AS BIGINT) AS backoff_s FROM p""")
def _(t):
    return limits.final_attempt(t.attempts)
