"""The test tables in the shapes the operators expect.

``Tables`` reads one folder of Parquet tables lazily; each property is one of
the record families (request log, usage, results, fact, traces, ...), derived
from a whole table. ``CTE`` holds the same derivations as SQL text.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions.responses import (
    burst_outcome, json_usage, message_content, normalize_content, outcome, parse_body,
    policy_block,
)

# Tables whose rows are long texts, with their keys.
TEXT_KEYS = {"documents": "doc_id", "pages": "page_id"}

# Provider and agent names of the request log, by user_id % 5.
PROVIDERS = ["claude", "claude", "openai", "gemini", "gemini"]
AGENTS = ["cursor", "claude_code", "codex_cli", "gemini_cli", "pi"]


def _pick(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def read(self, name: str) -> DataFrame:
        """A table; long texts lying in fewer files than there are slots are spread over them."""
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        slots = self.spark.sparkContext.defaultParallelism
        if name in TEXT_KEYS and len(df.inputFiles()) < slots:
            df = df.repartition(slots, TEXT_KEYS[name])
        return df

    # -- request log ------------------------------------------------------

    @cached_property
    def calls(self) -> DataFrame:
        """Log fields and token numbers as plain columns."""
        slot = F.pmod("user_id", F.lit(5))
        ok = F.col("status_code") == 200
        k = F.get_json_object("props", "$.k").cast("bigint")
        return (
            self.read("events")
            .select(
                F.col("ts").alias("event_time"),
                F.col("event_id").alias("request_id"),
                F.when(F.col("event_type") != "error", 200)
                .when(F.col("event_id") % 2 == 0, 429)
                .otherwise(500)
                .alias("status_code"),
                F.concat(F.lit("user_"), "user_id").alias("requester"),
                _pick(slot, PROVIDERS).alias("provider"),
                _pick(slot, AGENTS).alias("agent"),
                F.round(F.col("value") * 10).alias("latency_ms"),
                k.alias("k"),
                F.when(F.col("event_id") % 97 == 0, F.array(F.lit("E1"))).alias(
                    "logging_error_codes"
                ),
            )
            .withColumns(
                {
                    "endpoint_name": F.concat(F.lit("main.gw."), "provider", F.lit("-svc")),
                    "service_type": F.lit("MODEL_SERVICE"),
                    "destination_model": F.concat("provider", F.lit("-large")),
                    "input_tokens": F.when(ok, F.col("k")),
                    "output_tokens": F.when(ok, 2 * F.col("k")),
                    "total_tokens": F.when(ok, 3 * F.col("k") + F.col("request_id") % 5),
                }
            )
        )

    @cached_property
    def limited_calls(self) -> DataFrame:
        """Calls as they arrive: some of them twice, some without a time."""
        again = self.calls.filter(F.col("request_id") % 7 == 0)
        timeless = F.col("request_id") % 101 == 0
        kind = dict(self.calls.dtypes)["event_time"]
        return self.calls.unionByName(again).withColumn(
            "event_time", F.when(timeless, F.lit(None).cast(kind)).otherwise(F.col("event_time"))
        )

    @cached_property
    def service_limits(self) -> DataFrame:
        """Other limits for each provider, and none for one of them."""
        return self.spark.createDataFrame(
            [("claude", 8, 1000), ("openai", 3, 10**6)], "provider string, qpm int, tpm int"
        )

    @cached_property
    def payload(self) -> DataFrame:
        """The log with JSON request and response bodies instead of token columns."""
        rid = F.col("request_id").cast("string")
        request = F.concat(
            F.lit('{"messages":[{"role":"system","content":"be brief"},'
                  '{"role":"user","content":"ask '), rid, F.lit('"}]}'),
        )
        denied = (F.col("status_code") == 200) & (F.col("request_id") % 11 == 0)
        phase = F.when(F.col("request_id") % 2 == 0, "pre_call").otherwise("post_call")
        content = (
            F.when(denied, F.lit('"This request was blocked."'))
            .when(F.col("request_id") % 4 == 0, F.concat(F.lit('"reply '), rid, F.lit('"')))
            .when(
                F.col("request_id") % 4 == 1,
                F.concat(
                    F.lit('[{"type":"text","text":"reply "},{"type":"text","text":"'),
                    rid, F.lit('"}]'),
                ),
            )
            .when(F.col("request_id") % 4 == 2, F.lit("null"))
            .otherwise(
                F.concat(F.lit('[{"type":"thought"},"raw ",{"type":"text","text":"'), rid,
                         F.lit('"}]'))
            )
        )
        usage = F.concat(
            F.lit('"usage":{"prompt_tokens":'), "input_tokens",
            F.lit(',"completion_tokens":'), "output_tokens",
            F.lit(',"total_tokens":'), "total_tokens", F.lit("}"),
        )
        verdict = F.when(
            denied & (F.col("request_id") % 3 != 0),
            F.concat(
                F.lit(',"acme_service_policy":{"name":"'),
                F.when(F.col("request_id") % 3 == 1, "pii").otherwise("jailbreak"),
                F.lit('","action":"deny","phase":"'), phase,
                F.lit('","reason":"rule '), rid, F.lit('"}'),
            ),
        ).otherwise(F.lit(""))
        response = F.when(
            F.col("status_code") == 200,
            F.concat(
                F.lit('{"choices":[{"finish_reason":"'),
                F.when(denied, "content_filter").otherwise("stop"),
                F.lit('","message":{"content":'), content, F.lit("}}],"), usage, verdict,
                F.lit("}"),
            ),
        ).otherwise(F.concat(F.lit('{"error":"HTTP '), "status_code", F.lit('"}')))
        return self.calls.withColumns({"request": request, "response": response}).drop(
            "k", "input_tokens", "output_tokens", "total_tokens"
        )

    @cached_property
    def logs(self) -> dict[str, DataFrame]:
        """The log as its per-provider tables."""
        return {
            name: self.payload.filter(F.col("provider") == name).drop("provider")
            for name in dict.fromkeys(PROVIDERS)
        }

    @cached_property
    def results(self) -> DataFrame:
        """Scenario results: one row per call, with verdict, expectation and outcome."""
        expected = F.when(F.col("request_id") % 5 == 0, "blocked").otherwise("allowed")
        status = F.col("status_code")
        return (
            self.payload.select(
                F.concat(F.lit("req_"), "request_id").alias("scenario"),
                F.concat(F.lit("request "), "request_id").alias("description"),
                "request_id", "event_time", "agent", "provider", "destination_model",
                status.alias("status"),
                (F.col("latency_ms") / 1000).alias("latency_s"),
                normalize_content(message_content(parse_body(F.col("response")))).alias("content"),
                policy_block(F.col("response")).alias("policy"),
                json_usage(F.col("response")).alias("tokens"),
                expected.alias("expected_outcome"),
            )
            .withColumn("actual_outcome", outcome(F.col("status"), F.col("policy")))
            .withColumn("pass", F.col("actual_outcome") == F.col("expected_outcome"))
        )

    @cached_property
    def burst(self) -> DataFrame:
        return self.results.select(
            "request_id", "provider", "event_time", "status",
            burst_outcome(F.col("status"), F.col("policy")).alias("outcome"),
            F.coalesce("tokens.total", F.lit(0)).alias("total_tokens"),
        )

    @cached_property
    def tagged(self) -> DataFrame:
        """Calls as traces carrying tags."""
        return self.calls.select(
            F.col("request_id").alias("trace_id"),
            F.create_map(
                F.lit("agent"), "agent", F.lit("provider"), "provider",
                F.lit("model_service"), "endpoint_name",
            ).alias("tags"),
            "total_tokens",
        )

    @cached_property
    def attempts(self) -> DataFrame:
        """Up to four attempts per call, of which the last is the logged one."""
        tries = F.sequence(F.lit(1), (F.col("request_id") % 4 + 1).cast("int"))
        return self.calls.select(
            "request_id", "status_code", "latency_ms",
            (F.col("request_id") % 4 + 1).cast("int").alias("n"),
            F.explode(tries).alias("attempt"),
        ).select(
            "request_id", "attempt",
            F.when(F.col("attempt") == F.col("n"), F.col("status_code")).otherwise(503)
            .alias("status"),
            (F.col("latency_ms") + F.col("attempt")).alias("latency_s"),
        )

    # -- fact table -------------------------------------------------------

    @cached_property
    def fact(self) -> DataFrame:
        return (
            self.read("orders")
            .join(self.read("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("o_orderkey").alias("disaster_id"),
                F.year("o_orderdate").alias("year"),
                F.col("n_name").alias("state"),
                F.col("c_mktsegment").alias("disaster_type"),
                (6 - F.substring("o_orderpriority", 1, 1).cast("int")).alias("severity"),
                (F.col("o_custkey") * 100).alias("affected_population"),
                F.col("o_totalprice").alias("federal_aid_amount"),
                F.col("o_orderdate").cast("date").alias("declaration_date"),
            )
        )

    @cached_property
    def line_timings(self) -> DataFrame:
        """Days from order to shipment per line, and the supplier's location."""
        days = F.date_diff("l_shipdate", "o_orderdate")
        return (
            self.read("lineitem")
            .join(self.read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.read("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .filter(F.col("l_shipdate") >= F.col("o_orderdate"))
            .select(
                F.col("l_orderkey").alias("order_id"),
                F.col("l_linenumber").alias("line"),
                F.col("l_partkey").alias("part"),
                F.col("s_nationkey").alias("location"),
                days.alias("duration"),
            )
        )

    # -- sessions ---------------------------------------------------------

    @cached_property
    def conversation(self) -> DataFrame:
        return self.read("conversations").select(
            F.concat(F.lit("session-"), "conv_id").alias("session_id"), "turn", "role", "text"
        )


_CALLS = """
calls AS (
  SELECT ts AS event_time, event_id AS request_id,
    CASE WHEN event_type <> 'error' THEN 200 WHEN event_id % 2 = 0 THEN 429 ELSE 500 END
      AS status_code,
    'user_' || user_id AS requester,
    CASE WHEN user_id % 5 < 2 THEN 'claude' WHEN user_id % 5 = 2 THEN 'openai'
         ELSE 'gemini' END AS provider,
    CASE user_id % 5 WHEN 0 THEN 'cursor' WHEN 1 THEN 'claude_code' WHEN 2 THEN 'codex_cli'
         WHEN 3 THEN 'gemini_cli' ELSE 'pi' END AS agent,
    round(value * 10) AS latency_ms,
    CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k,
    CASE WHEN event_id % 97 = 0 THEN ['E1'] END AS logging_error_codes
  FROM events),
p AS (
  SELECT *, 'main.gw.' || provider || '-svc' AS endpoint_name,
    provider || '-large' AS destination_model,
    CASE WHEN status_code = 200 THEN k END AS input_tokens,
    CASE WHEN status_code = 200 THEN 2 * k END AS output_tokens,
    CASE WHEN status_code = 200 THEN 3 * k + request_id % 5 END AS total_tokens,
    status_code = 200 AND request_id % 11 = 0 AS denied
  FROM calls)"""

_LIMITED = (
    _CALLS
    + """,
sent AS (
  SELECT request_id, provider, total_tokens,
    CASE WHEN request_id % 101 <> 0 THEN event_time END AS event_time
  FROM p),
arrived AS (SELECT * FROM sent UNION ALL SELECT * FROM sent WHERE request_id % 7 = 0),
service_limits(provider, qpm, tpm) AS (VALUES ('claude', 8, 1000), ('openai', 3, 1000000)),
counted AS (
  SELECT *, date_trunc('hour', event_time) AS window_start, row_number() OVER w AS call,
    coalesce(sum(coalesce(total_tokens, 0)) OVER (
      PARTITION BY provider, date_trunc('hour', event_time) ORDER BY event_time, request_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sent WINDOW w AS (PARTITION BY provider, date_trunc('hour', event_time)
                         ORDER BY event_time, request_id)),
judged AS (
  SELECT c.*, qpm, tpm, CASE WHEN qpm IS NULL THEN true
    ELSE event_time IS NOT NULL AND call <= qpm AND before < tpm END AS admitted
  FROM counted c LEFT JOIN service_limits USING (provider)),
spent AS (
  SELECT provider, window_start, sum(coalesce(total_tokens, 0)) AS spent
  FROM judged WHERE admitted GROUP BY 1, 2),
verdict AS (
  SELECT request_id, provider, j.window_start, admitted,
    CASE WHEN admitted THEN 200 ELSE 429 END AS limit_status,
    CASE WHEN admitted THEN NULL WHEN event_time IS NULL THEN 'no_time'
         WHEN spent >= tpm THEN 'tpm' ELSE 'qpm' END AS limit_hit
  FROM judged j LEFT JOIN spent USING (provider, window_start)),
limited AS (SELECT v.* FROM arrived JOIN verdict v USING (request_id))"""
)

_RESULTS = (
    _CALLS
    + """,
verdicts AS (
  SELECT *,
    CASE WHEN denied THEN CASE request_id % 3 WHEN 0 THEN 'unknown' WHEN 1 THEN 'pii'
         ELSE 'jailbreak' END END AS policy_name,
    CASE WHEN denied AND request_id % 3 <> 0 THEN
         CASE WHEN request_id % 2 = 0 THEN 'pre_call' ELSE 'post_call' END END AS policy_phase,
    CASE WHEN request_id % 5 = 0 THEN 'blocked' ELSE 'allowed' END AS expected_outcome,
    CASE WHEN status_code <> 200 OR denied THEN 'blocked' ELSE 'allowed' END AS actual_outcome,
    CASE WHEN status_code <> 200 THEN ''
         WHEN denied THEN 'This request was blocked.'
         WHEN request_id % 4 IN (0, 1) THEN 'reply ' || request_id
         WHEN request_id % 4 = 2 THEN ''
         ELSE 'raw ' || request_id END AS content
  FROM p),
r AS (
  SELECT *, 'req_' || request_id AS scenario, 'request ' || request_id AS description,
    status_code AS status, actual_outcome = expected_outcome AS pass,
    CASE WHEN status_code = 200 AND denied THEN 'blocked' WHEN status_code = 200 THEN 'allowed'
         WHEN status_code = 429 THEN 'rate_limited' ELSE 'error' END AS burst
  FROM verdicts)"""
)

_FACT = """
f AS (
  SELECT o_orderkey AS disaster_id, CAST(year(o_orderdate) AS INTEGER) AS year, n_name AS state,
    c_mktsegment AS disaster_type, 6 - CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS severity,
    o_custkey * 100 AS affected_population, o_totalprice AS federal_aid_amount,
    CAST(o_orderdate AS DATE) AS declaration_date
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

_TIMINGS = """
lt AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part, s_nationkey AS location,
    CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER)
      AS duration
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
  WHERE l_shipdate >= o_orderdate)"""

_TURNS = """
c AS (SELECT 'session-' || conv_id AS session_id, turn, role, text FROM conversations),
m AS (SELECT * FROM c WHERE role IN ('user', 'assistant')),
nx AS (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
       FROM m WINDOW w AS (PARTITION BY session_id ORDER BY turn)),
tr AS (SELECT session_id, turn, text AS request,
         CASE WHEN next_role = 'assistant' THEN next_text END AS response
       FROM nx WHERE role = 'user')"""

# The bindings as SQL: prefix a query with "WITH " + CTE[name].
CTE = {
    "p": "WITH" + _CALLS,
    "l": "WITH" + _LIMITED,
    "r": "WITH" + _RESULTS,
    "f": "WITH" + _FACT,
    "lt": "WITH" + _TIMINGS,
    "t": "WITH" + _TURNS,
}
