"""Queries over the fact table, orders and other reference tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyspan.operators import facts, sessions, lookups, scenarios
from tallyspan.plans.registry import query
from tallyspan.sources import configs, loads


@query("load_fact", over="f", sql="""
SELECT CAST(disaster_id AS VARCHAR) AS disaster_id, year, state, disaster_type, severity,
  affected_population, federal_aid_amount, declaration_date FROM f""")
def _(t):
    text_dates = t.fact.withColumn("declaration_date", F.col("declaration_date").cast("string"))
    return loads.typed_fact(text_dates)


def _table_name(t, name):
    """A table of its own in the checks' schema, which is made if need be."""
    loads.ensure_schema(t.spark, "tallyspan_checks")
    loads.ensure_schema(t.spark, "tallyspan_checks")
    return f"tallyspan_checks.{name}_{uuid.uuid4().hex}"


@query("load_documents", sql="""
SELECT doc_id, text, lang, source, n_chars, sha256(text) AS content_hash FROM documents""")
def _(t):
    """Written as a table and read back."""
    return loads.load_documents(t.read("documents"), _table_name(t, "documents"))


@query("load_fact_table", over="f", sql="""
SELECT CAST(disaster_id AS VARCHAR) AS disaster_id, CAST(year AS INTEGER) AS year, state,
  disaster_type, severity, CAST(affected_population AS BIGINT) AS affected_population,
  CAST(federal_aid_amount AS DOUBLE) AS federal_aid_amount, declaration_date,
  'facts about orders' AS comment FROM f""")
def _(t):
    """Schema, typed table and comment, all read back."""
    name = _table_name(t, "fact")
    loaded = loads.load_fact(t.fact, name)
    loads.comment_table(t.spark, name, "facts about orders")
    comment = t.spark.catalog.getTable(name).description
    return loaded.withColumn("comment", F.lit(comment))


@query("read_log_table", over="p", sql="""
SELECT request_id, status_code, requester, total_tokens FROM p""")
def _(t):
    name = f"log-{uuid.uuid4().hex}_payload"
    t.calls.createOrReplaceTempView(f"`{name}`")
    return loads.read_log_table(t.spark, name).select(
        "request_id", "status_code", "requester", "total_tokens"
    )


@query("append_traces", over="t", sql="""
SELECT CAST(TIMESTAMP '2024-01-01' + to_days(CAST(turn % 3 AS INTEGER)) AS DATE) AS day,
  2 * count(*) AS traces, count(DISTINCT session_id) AS sessions FROM tr GROUP BY 1""")
def _(t):
    """Every request twice, in two appends, counted by the days the table is divided in."""
    pairs = sessions.turn_pairs(t.conversation)
    rows = pairs.select(
        F.concat("session_id", F.lit("/"), "turn").alias("trace_id"), "session_id",
        (F.lit("2024-01-01").cast("timestamp_ntz")
         + F.make_dt_interval((F.col("turn") % 3).cast("int"))).alias("request_time"),
        "request", "response",
    )
    name = _table_name(t, "traces")
    loads.append_traces(rows, name)
    loads.append_traces(rows, name)
    return t.spark.table(name).groupBy("day").agg(
        F.count("*").alias("traces"), F.count_distinct("session_id").alias("sessions")
    )


@query("readback_count", sql="SELECT count(*) AS n FROM documents")
def _(t):
    return loads.readback_count(t.read("documents"))


@query("recent_facts", over="f", sql="SELECT * FROM f WHERE year >= 2000")
def _(t):
    return facts.recent_facts(t.fact, 2000)


@query("count_where", over="f", sql="""
SELECT count(*) AS n FROM f WHERE state = 'NATION_7' AND year = 1998""")
def _(t):
    return facts.count_where(t.fact, "NATION_7", 1998)


@query("sum_where", over="f", sql="""
SELECT round(sum(federal_aid_amount), 2) AS total_aid FROM f
WHERE disaster_type = 'BUILDING' AND year = 1998""")
def _(t):
    return facts.sum_where(t.fact, "BUILDING", 1998)


@query("distinct_entities", over="f", sql="""
SELECT state, year, count(DISTINCT disaster_id) AS disasters FROM f GROUP BY 1, 2""")
def _(t):
    return facts.distinct_entities(t.fact, ["state", "year"])


@query("approx_entities", over="f", sql="""
SELECT state, count(DISTINCT disaster_id) AS disasters, true AS close FROM f GROUP BY 1""")
def _(t):
    # The estimate held against the exact number: within 10 %, five standard errors.
    exact = facts.distinct_entities(t.fact, ["state"])
    guess = facts.approx_entities(t.fact, ["state"]).withColumnRenamed("disasters", "guess")
    near = F.abs(F.col("guess") - F.col("disasters")) <= 0.1 * F.col("disasters")
    return exact.join(guess, "state").select("state", "disasters", near.alias("close"))


@query("sum_by_category", over="f", sql="""
SELECT disaster_type, CAST(sum(affected_population) AS BIGINT) AS affected_population
FROM f GROUP BY 1""")
def _(t):
    return facts.sum_by_category(t.fact)


@query("compare_by_state", over="f", sql="""
SELECT state, round(sum(federal_aid_amount), 2) AS total_aid FROM f WHERE year = 1998
GROUP BY 1""")
def _(t):
    return facts.compare_by_state(t.fact, 1998)


@query("top_state_by_severity", over="f", sql="""
SELECT state, n FROM (SELECT state, count(*) AS n, rank() OVER (ORDER BY count(*) DESC) AS r
  FROM f WHERE severity = 5 GROUP BY 1) WHERE r = 1""")
def _(t):
    return facts.top_state(t.fact, 5)


@query("max_severity_state", over="f", sql="""
SELECT disaster_type, severity, state FROM f
QUALIFY row_number() OVER (PARTITION BY disaster_type
  ORDER BY severity DESC, affected_population DESC, disaster_id DESC) = 1""")
def _(t):
    return facts.max_severity_state(t.fact)


@query("distinct_rows", over="f", sql="""
SELECT DISTINCT state, disaster_type, severity FROM f WHERE severity = 5 AND year = 1998""")
def _(t):
    return facts.distinct_rows(t.fact, 5, 1998)


@query("location_timings", over="lt", sql="""
SELECT location, count(*) AS n, quantile_cont(duration, 0.5) AS p50,
  quantile_cont(duration, 0.75) AS p75 FROM lt GROUP BY 1""")
def _(t):
    return facts.location_timings(t.line_timings)


@query("late_vs_p75", over="lt", sql="""
SELECT order_id, line, part, location, duration, p75, duration > p75 AS refund
FROM lt JOIN (SELECT location, quantile_cont(duration, 0.75) AS p75 FROM lt GROUP BY 1)
  USING (location)""")
def _(t):
    return facts.late_vs_p75(t.line_timings)


def _orders(t):
    return t.read("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"),
    )


def _items(t):
    return t.read("lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"), F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
    )


@query("order_overview", sql="""
SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS total, items, quantity,
  items_total
FROM orders LEFT JOIN (SELECT l_orderkey AS o_orderkey, count(*) AS items,
  sum(l_quantity) AS quantity, round(sum(l_extendedprice), 2) AS items_total
  FROM lineitem GROUP BY 1) USING (o_orderkey)""")
def _(t):
    return facts.order_overview(_orders(t), _items(t))


@query("order_items", sql="""
SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part, l_quantity AS quantity,
  l_extendedprice AS price, o_orderstatus AS status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(t):
    return facts.order_items(_orders(t), _items(t))


@query("order_timing", sql="""
SELECT order_id, min(d) AS first_event, max(d) AS last_event,
  CAST(date_diff('day', min(d), max(d)) AS INTEGER) AS elapsed_days
FROM (SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS d FROM orders
      UNION ALL SELECT l_orderkey, CAST(l_shipdate AS DATE) FROM lineitem) GROUP BY 1""")
def _(t):
    placed = t.read("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("date").alias("event_date")
    )
    shipped = t.read("lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").cast("date").alias("event_date")
    )
    return facts.order_timing(placed.unionByName(shipped))


_MANGLED = """CASE s_suppkey % 4 WHEN 0 THEN '  ' || lower(n_name) || ' '
  WHEN 1 THEN replace(n_name, 'I', '') WHEN 2 THEN 'x' || n_name || 'y' ELSE 'far ' || n_name END"""


@query("entity_match", sql=f"""
WITH s AS (SELECT s_suppkey, {_MANGLED} AS typed FROM supplier
           JOIN nation ON s_nationkey = n_nationkey),
d AS (SELECT s_suppkey, typed, n_name,
        levenshtein(lower(trim(typed)), lower(trim(n_name))) AS e FROM s, nation),
b AS (SELECT s_suppkey, n_name, e FROM d WHERE e <= 2
      QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY e, n_name) = 1)
SELECT s_suppkey, typed, b.n_name AS matched, CAST(b.e AS INTEGER) AS edits
FROM s LEFT JOIN b USING (s_suppkey)""")
def _(t):
    name = F.col("n_name")
    typed = (
        F.when(F.col("s_suppkey") % 4 == 0, F.concat(F.lit("  "), F.lower(name), F.lit(" ")))
        .when(F.col("s_suppkey") % 4 == 1, F.replace(name, F.lit("I"), F.lit("")))
        .when(F.col("s_suppkey") % 4 == 2, F.concat(F.lit("x"), name, F.lit("y")))
        .otherwise(F.concat(F.lit("far "), name))
    )
    nation = t.read("nation")
    asked = (
        t.read("supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", typed.alias("typed"))
    )
    return facts.entity_match(asked, "typed", nation, "n_name")


# -- lookups and catalogue order, over calls as scenarios -------------------


def _agents(t):
    return t.calls.select("agent", "provider").distinct()


def _services(t):
    return t.calls.select("provider", F.col("endpoint_name").alias("model_service")).distinct()


@query("scenario_agent_join", over="p", sql="""
SELECT request_id, agent, provider, endpoint_name AS model_service FROM p""")
def _(t):
    return lookups.scenario_agent_join(
        t.calls.select("request_id", "agent"), _agents(t), _services(t)
    )


@query("label_default_join", sql="""
SELECT doc_id, lang, CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' ELSE 'Other' END
  AS label FROM documents""")
def _(t):
    # The two labelled languages.
    labels = t.spark.createDataFrame(
        [("en", "English"), ("de", "German")], "lang string, label string"
    )
    return lookups.label_default_join(
        t.read("documents").select("doc_id", "lang"), labels, "lang", "label", "Other"
    )


def _logged(t):
    """Requesters with at least one logging error, standing for services that have a log."""
    return t.calls.filter(F.col("logging_error_codes").isNotNull()).select(
        F.col("requester").alias("model_service")
    ).distinct()


@query("services_without_log", over="p", sql="""
SELECT DISTINCT requester AS model_service FROM p
WHERE requester NOT IN (SELECT requester FROM p WHERE logging_error_codes IS NOT NULL)""")
def _(t):
    everyone = t.calls.select(F.col("requester").alias("model_service")).distinct()
    return configs.missing_services(everyone, _logged(t))


@query("services_with_log", over="p", sql="""
SELECT DISTINCT requester AS model_service FROM p WHERE logging_error_codes IS NOT NULL""")
def _(t):
    everyone = t.calls.select(F.col("requester").alias("model_service")).distinct()
    return configs.covered_services(everyone, _logged(t))



def _configs(t):
    """One service config per requester: some without a table, some in another schema."""
    n = F.regexp_extract("requester", r"(\d+)", 1).cast("int")
    body = F.concat(
        F.lit('{"service_policies":[{"name":"pii","is_deleted":false,"options":{"phases":'
              '["pre_call","post_call"]}},{"name":"old","is_deleted":true},'
              '{"name":"safety","options":{"action":"flag"}}]'),
        F.when(n % 4 > 0, F.concat(
            F.lit(',"routing":{"destinations":[{"name":"system.ai.model-'), n, F.lit('"}]}')
        )).otherwise(F.lit('')),
        F.when(n % 3 > 0, F.concat(
            F.lit(',"inference_table":{"table":"tables/'),
            F.when(n % 3 == 1, "main.gw").otherwise("main.logs"),
            F.lit("."), F.col("requester"), F.lit('_payload"}'),
        )).otherwise(F.lit('')),
        F.lit("}"),
    )
    return t.calls.select("requester").distinct().select(
        F.concat(F.lit("main.gw."), "requester").alias("model_service"), body.alias("config")
    )


_SERVICES = """+
s AS (SELECT DISTINCT requester, CAST(substr(requester, 6) AS BIGINT) AS n FROM p)
"""


@query("discover_log_tables", over="p", sql=_SERVICES + """
SELECT 'main.gw.' || requester AS model_service,
  CASE WHEN n % 3 = 1 THEN 'main.gw' ELSE 'main.logs' END || '.' || requester || '_payload'
  AS log_table FROM s WHERE n % 3 > 0""")
def _(t):
    return configs.discover_log_tables(_configs(t))


@query("active_policies", over="p", sql=_SERVICES + """
SELECT 'main.gw.' || requester AS model_service, 'pii' AS name, 'pre_call,post_call' AS phases,
  'block' AS action FROM s
UNION ALL SELECT 'main.gw.' || requester, 'safety', NULL, 'flag' FROM s""")
def _(t):
    return configs.active_policies(_configs(t)).withColumn(
        "phases", F.array_join("phases", ",")
    )


@query("routed_model", over="p", sql=_SERVICES + """
SELECT 'main.gw.' || requester AS model_service,
  CASE WHEN n % 4 > 0 THEN 'model-' || n ELSE '' END AS routed_model FROM s""")
def _(t):
    return configs.routed_model(_configs(t))


@query("schema_drift", over="p", sql=_SERVICES + """
SELECT 'main.gw.' || requester AS model_service, 'main.gw' AS service_schema,
  'main.logs' AS table_schema FROM s WHERE n % 3 = 2""")
def _(t):
    return configs.schema_drift(_configs(t))


@query("cap_per_group", over="p", sql="""
SELECT request_id, agent FROM p
QUALIFY row_number() OVER (PARTITION BY agent ORDER BY event_time, request_id) <= 15""")
def _(t):
    rows = t.calls.select("request_id", "agent", "event_time")
    return scenarios.cap_per_group(rows, "agent", ["event_time", "request_id"], 15).drop(
        "event_time"
    )


@query("interleave", over="p", sql="""+
n AS (SELECT request_id, agent,
    row_number() OVER (PARTITION BY agent ORDER BY event_time, request_id) AS pos FROM p)
SELECT request_id, agent, row_number() OVER (ORDER BY pos, agent) AS seq FROM n""")
def _(t):
    rows = t.calls.select("request_id", "agent", "event_time")
    return scenarios.interleave(rows, "agent", ["event_time", "request_id"]).drop("event_time")


@query("session_ids", over="p", sql="""
SELECT request_id, 'session-' || agent || '-' || CASE WHEN n < 1000
  THEN lpad(CAST(n AS VARCHAR), 3, '0') ELSE CAST(n AS VARCHAR) END AS session_id
FROM (SELECT request_id, agent,
  row_number() OVER (PARTITION BY agent ORDER BY event_time, request_id) AS n FROM p)""")
def _(t):
    rows = t.calls.select("request_id", "agent", "event_time")
    return scenarios.session_ids(rows, "agent", ["event_time", "request_id"]).select(
        "request_id", "session_id"
    )


@query("number_requests", over="p", sql="""
SELECT request_id, provider,
  row_number() OVER (PARTITION BY provider ORDER BY event_time, request_id) AS request_num
FROM p""")
def _(t):
    rows = t.calls.select("request_id", "provider", "event_time")
    return scenarios.number_requests(rows, "provider", ["event_time", "request_id"]).drop(
        "event_time"
    )


@query("expand_task", sql="""
SELECT 'clean_' || lang || '_' || doc_id AS name, lang AS agent,
  'Clean/' || source || ': doc ' || doc_id || ' (' ||
  CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' ELSE '' END || ')' AS description,
  'say:' || chr(10) || '  ' || doc_id || chr(10) || 'end' AS content
FROM documents""")
def _(t):
    doc = F.col("doc_id").cast("string")
    prompt = F.concat(F.lit("\n    say:\n      "), doc, F.lit("\n    end\n  "))
    tasks = t.read("documents").select(
        F.col("lang").alias("agent"), F.lit(0).alias("pos"), doc.alias("task_id"),
        F.col("source").alias("kind"), F.concat(F.lit("doc "), doc).alias("label"),
        prompt.alias("prompt"),
    )
    labels = t.spark.createDataFrame(
        [("en", "English"), ("de", "German")], "agent string, display_name string"
    )
    return scenarios.expand_task(tasks, labels).select(
        "name", "agent", "description", F.col("messages")[0]["content"].alias("content")
    )


@query("flatten_groups", sql="""
SELECT source AS "group", 'q' || doc_id AS query, lang AS category FROM documents""")
def _(t):
    one = F.array(
        F.struct(F.concat(F.lit("q"), "doc_id").alias("query"), F.col("lang").alias("category"))
    )
    return scenarios.flatten_groups(
        t.read("documents").select(F.create_map(F.col("source"), one).alias("groups"))
    )
