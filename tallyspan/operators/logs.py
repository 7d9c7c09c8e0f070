"""Audit, failure, usage and cost reports over request logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.responses import json_usage, preview


def _newest_first() -> list[Column]:
    return [F.col("event_time").desc(), F.col("request_id").desc()]


def all_requests(log: DataFrame, limit: int = 50) -> DataFrame:
    return (
        log.select(
            "event_time", "request_id", "status_code", "requester", "latency_ms",
            "request", "response",
        )
        .orderBy(*_newest_first())
        .limit(limit)
    )


def failed_requests(log: DataFrame, limit: int = 50) -> DataFrame:
    """Transport or backend failures and rows whose own logging failed, newest first."""
    codes = F.col("logging_error_codes")
    return (
        log.filter((F.col("status_code") != 200) | (codes.isNotNull() & (F.size(codes) > 0)))
        .select(
            "event_time", "request_id", "status_code", "requester", "latency_ms",
            "request", "logging_error_codes",
        )
        .orderBy(*_newest_first())
        .limit(limit)
    )


def recent_window(df: DataFrame, as_of: str, hours: int = 1) -> DataFrame:
    """Rows of the ``hours`` before ``as_of``; the bounds are literals, so scans are pruned."""
    kind = dict(df.dtypes)["event_time"]
    end = F.lit(as_of).cast(kind)
    start = end - F.expr(f"INTERVAL {int(hours)} HOURS")
    return df.filter((F.col("event_time") >= start) & (F.col("event_time") < end))


def sent_content(log: DataFrame, as_of: str, hours: int = 1) -> DataFrame:
    """Who sent what to which model: the last user message of every request."""
    messages = F.from_json(
        "request", "struct<messages:array<struct<role:string,content:string>>>"
    )["messages"]
    asked = F.filter(messages, lambda m: m["role"] == "user")
    return recent_window(log, as_of, hours).select(
        "event_time", "request_id", "requester", "destination_model",
        F.get(asked, F.size(asked) - 1)["content"].alias("content"),
        "latency_ms",
    )


def endpoint_in(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.filter(F.col("endpoint_name").isin(*names))


def attribute_filter(
    df: DataFrame,
    equals: Mapping[str, object] | None = None,
    at_most: Mapping[str, object] | None = None,
    at_least: Mapping[str, object] | None = None,
) -> DataFrame:
    """All given attribute tests together, as plain predicates a scan can push down."""
    tests = [F.col(c) == v for c, v in (equals or {}).items()]
    tests += [F.col(c) <= v for c, v in (at_most or {}).items()]
    tests += [F.col(c) >= v for c, v in (at_least or {}).items()]
    return df.filter(reduce(lambda a, b: a & b, tests, F.lit(True)))


def preview_columns(df: DataFrame, text: str, label: str) -> DataFrame:
    """Texts over 150 characters are cut; the label is always cut to 60 and marked."""
    return df.withColumns(
        {
            "preview": preview(F.col(text), 150),
            "label": F.concat(F.substring(F.col(label), 1, 60), F.lit("...")),
        }
    )


def token_usage(log: DataFrame, as_of: str, hours: int = 1, limit: int = 50) -> DataFrame:
    """Requests, tokens and mean latency of succeeded and failed calls."""
    usage = json_usage(F.col("response"))
    return (
        recent_window(log, as_of, hours)
        .select(
            F.when(F.col("status_code") == 200, "succeeded").otherwise("failed").alias("outcome"),
            usage.alias("usage"),
            "latency_ms",
        )
        .groupBy("outcome")
        .agg(
            F.count("*").alias("request_count"),
            F.sum("usage.total").alias("total_tokens"),
            F.sum("usage.input").alias("input_tokens"),
            F.sum("usage.output").alias("output_tokens"),
            F.round(F.avg("latency_ms"), 0).alias("avg_latency_ms"),
        )
        .orderBy(F.col("total_tokens").desc_nulls_last())
        .limit(limit)
    )


def _token_sums() -> list[Column]:
    return [
        F.count("*").alias("request_count"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.sum("total_tokens").alias("total_tokens"),
    ]


def _hour(df: DataFrame) -> Column:
    return F.date_trunc("hour", "event_time").cast(dict(df.dtypes)["event_time"])


def hourly_usage(
    usage: DataFrame, names: Sequence[str], as_of: str, hours: int = 1
) -> DataFrame:
    return (
        recent_window(endpoint_in(usage, names), as_of, hours)
        .groupBy("endpoint_name", _hour(usage).alias("hour"))
        .agg(*_token_sums())
        .orderBy(F.col("hour").desc(), F.col("total_tokens").desc())
    )


def union_logs(logs: Mapping[str, DataFrame]) -> DataFrame:
    """The providers' logs on top of each other, each row naming its provider."""
    named = [df.withColumn("provider", F.lit(provider)) for provider, df in logs.items()]
    return reduce(lambda a, b: a.unionByName(b), named)


def union_results(*parts: DataFrame) -> DataFrame:
    """All suites together, duplicates kept, missing columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def usage_by_provider(logs: Mapping[str, DataFrame]) -> DataFrame:
    """One row per provider; every log is pre-aggregated map-side before rows move."""
    usage = json_usage(F.col("response"))
    narrow = {
        name: df.select("status_code", "latency_ms", usage.alias("usage"))
        for name, df in logs.items()
    }
    return (
        union_logs(narrow)
        .groupBy("provider")
        .agg(
            F.count("*").alias("request_count"),
            F.count_if(F.col("status_code") == 200).alias("succeeded"),
            F.sum("usage.total").alias("total_tokens"),
            F.round(F.avg("latency_ms"), 2).alias("avg_latency_ms"),
        )
    )


def chargeback(usage: DataFrame) -> DataFrame:
    """Tokens per endpoint and their share of all tokens, largest first."""
    per_endpoint = usage.groupBy("endpoint_name").agg(
        F.count("*").alias("request_count"), F.sum("total_tokens").alias("total_tokens")
    )
    grand_total = per_endpoint.agg(F.sum("total_tokens")).scalar()
    return per_endpoint.withColumn(
        "share", F.round(F.try_divide(F.col("total_tokens"), grand_total), 6)
    ).orderBy(F.col("total_tokens").desc_nulls_last(), "endpoint_name")


def hourly_activity(log: DataFrame) -> DataFrame:
    return log.groupBy(_hour(log).alias("hour"), "requester").agg(
        F.count("*").alias("request_count"),
        F.round(F.avg("latency_ms"), 2).alias("avg_latency_ms"),
    )


def usage_cube(log: DataFrame) -> DataFrame:
    """Requests, tokens and latency at every level of agent, provider and hour.

    The rows are summed to the finest level first; only those sums are expanded
    into the levels, not the log itself.
    """
    finest = (
        log.select(
            "agent", "provider", _hour(log).alias("hour"), "latency_ms",
            json_usage(F.col("response"))["total"].alias("tokens"),
        )
        .groupBy("agent", "provider", "hour")
        .agg(
            F.count("*").alias("n"),
            F.sum("tokens").alias("tokens"),
            F.sum("latency_ms").alias("latency"),
            F.count("latency_ms").alias("timed"),
        )
    )
    return (
        finest.cube("agent", "provider", "hour")
        .agg(
            F.grouping_id().cast("long").alias("level"),
            F.sum("n").alias("request_count"),
            F.sum("tokens").alias("total_tokens"),
            F.round(F.try_divide(F.sum("latency"), F.sum("timed")), 2).alias("avg_latency_ms"),
        )
    )


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float]
) -> DataFrame:
    """Interpolated percentiles of a measure per group, whole or fractional.

    Rows are first counted per (group, value), map-side, so the state of a group
    is its distinct values and not its rows.
    """
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("_value"))
        .agg(F.count("*").alias("_n"))
    )
    return counted.groupBy(*keys).agg(
        F.sum("_n").alias("n"),
        *[
            F.percentile("_value", F.lit(q), F.col("_n")).alias(name)
            for name, q in quantiles.items()
        ],
    )


def latency_percentiles(log: DataFrame, exact: bool = True) -> DataFrame:
    quantiles = {"p50": 0.5, "p75": 0.75, "p95": 0.95}
    if exact:
        return exact_percentiles(log, ["provider"], "latency_ms", quantiles)
    return log.groupBy("provider").agg(
        F.count("latency_ms").alias("n"),
        *[F.percentile_approx("latency_ms", q).alias(name) for name, q in quantiles.items()],
    )


def attribution(traces: DataFrame) -> DataFrame:
    """Requests and tokens by the tags every trace carries."""
    tags = F.col("tags")
    return traces.groupBy(
        tags["agent"].alias("agent"),
        tags["provider"].alias("provider"),
        tags["model_service"].alias("model_service"),
    ).agg(F.count("*").alias("requests"), F.sum("total_tokens").alias("total_tokens"))


def token_gap(usage: DataFrame) -> DataFrame:
    """Tokens billed beyond input and output (reasoning, cache), per endpoint."""
    return usage.groupBy("endpoint_name").agg(
        F.sum("total_tokens").alias("total_tokens"),
        (F.sum("total_tokens") - F.sum("input_tokens") - F.sum("output_tokens")).alias("gap"),
    )


def rolling_rate(
    log: DataFrame, size: str = "1 minute", slide: str = "10 seconds", key: str = "endpoint_name"
) -> DataFrame:
    """Requests and tokens per sliding window and service.

    Rows are summed per slide first, so only the sums are copied into the
    windows that overlap them. ``size`` must be a multiple of ``slide``. A row without a time
    belongs to no window and is left out.
    """
    step = (
        log.groupBy(key, F.window("event_time", slide).alias("_step"))
        .agg(F.count("*").alias("n"), F.sum("total_tokens").alias("tokens"))
        .select(key, F.col("_step.start").alias("_at"), "n", "tokens")
    )
    return (
        step.groupBy(key, F.window("_at", size, slide).alias("_window"))
        .agg(F.sum("n").alias("requests"), F.sum("tokens").alias("total_tokens"))
        .select(key, F.col("_window.start").alias("window_start"), "requests", "total_tokens")
    )


def log_report(log: DataFrame, name: str, **parameters) -> DataFrame:
    """A report by its name: ``all``, ``failed``, ``token_usage`` or ``system_usage``."""
    reports = {
        "all": all_requests,
        "failed": failed_requests,
        "token_usage": token_usage,
        "system_usage": hourly_usage,
    }
    return reports[name](log, **parameters)
