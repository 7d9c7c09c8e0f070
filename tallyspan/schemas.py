"""Explicit schemas of every record family."""

from __future__ import annotations


DISASTER = (
    "disaster_id string, year int, state string, disaster_type string, severity int, "
    "affected_population bigint, federal_aid_amount double, declaration_date date"
)
POLICY_DOCS = "doc_id string, doc_uri string, text string"
PAYLOAD = (
    "event_time timestamp, request_id string, status_code int, requester string, "
    "latency_ms double, destination_model string, request string, response string, "
    "logging_error_codes array<string>"
)
USAGE = (
    "endpoint_name string, service_type string, event_time timestamp, input_tokens bigint, "
    "output_tokens bigint, total_tokens bigint"
)
SERVICE_CONFIG = "model_service string, config string"
SERVICE_CONFIG_BODY = (
    "service_policies array<struct<name:string,is_deleted:boolean,"
    "options:struct<phases:array<string>,action:string>>>, "
    "routing struct<destinations:array<struct<name:string>>>, "
    "inference_table struct<table:string>, rate_limits string, usage_tracking string"
)
SCENARIO = (
    "name string, agent string, messages array<struct<role:string,content:string>>, "
    "expected_outcome string, guardrail_type string, description string"
)
CLEAN_TASK = "agent string, pos int, task_id string, kind string, label string, prompt string"
RESULT = (
    "agent string, provider string, model string, status int, content string, "
    "tokens struct<input:bigint,output:bigint,total:bigint>, "
    "policy struct<name:string,action:string,phase:string,reason:string>, latency_s double, "
    "error string, scenario string, description string, expected_outcome string, "
    "guardrail_type string, agent_key string, actual_outcome string, pass boolean"
)
BURST = "request_num int, status int, outcome string, content string, total_tokens bigint"
ATTEMPT = "request_id string, attempt int, status int, latency_s double"
TRACE = (
    "trace_id string, run_id string, request_time timestamp, request string, response string, "
    "tags map<string,string>, metadata map<string,string>"
)
SPAN = "trace_id string, span_id string, parent_id string, type string, name string"
SESSION_SCENARIO = (
    "name string, session_id string, expected_coherence boolean, expected_retention string, "
    "expected_search_quality string, expected_intents array<string>, "
    "requires_complaint_agent boolean, messages array<string>"
)
ASSESSMENT = (
    "session_id string, judge string, value string, reason string, justification string"
)
PROMPT = "name string, version int, template string, commit_message string"
SEARCH_RESULT = (
    "query_id bigint, answer string, "
    "results array<struct<title:string,url:string,content:string>>"
)
