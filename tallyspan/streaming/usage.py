"""Windowed usage, de-duplication and sessions over arriving records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The usage table may lag this much behind the calls it reports.
LATENESS = "15 minutes"


def stream_usage(source: DataFrame, delay: str = LATENESS) -> DataFrame:
    """Hourly usage per endpoint; an hour is emitted once no late rows can reach it."""
    return (
        source.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", "1 hour").alias("_hour"), "endpoint_name")
        .agg(
            F.count("*").alias("request_count"),
            F.sum("input_tokens").alias("input_tokens"),
            F.sum("output_tokens").alias("output_tokens"),
            F.sum("total_tokens").alias("total_tokens"),
        )
        .select(
            "endpoint_name", F.col("_hour.start").alias("hour"), "request_count",
            "input_tokens", "output_tokens", "total_tokens",
        )
    )


def stream_dedup(source: DataFrame, delay: str = LATENESS) -> DataFrame:
    """One row per request id where a row may be delivered more than once."""
    return source.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(
        ["request_id"]
    )


def stream_sessions(
    source: DataFrame, gap: str, key: str = "requester", delay: str = LATENESS
) -> DataFrame:
    """A conversation closes after ``gap`` without a message.

    With ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` set, sessions
    are merged inside each map task before rows are shuffled, so a very busy key arrives
    as its sessions and not as its rows.
    """
    return (
        source.withWatermark("event_time", delay)
        .groupBy(F.session_window("event_time", gap).alias("_session"), key)
        .agg(F.count("*").alias("turns"))
        .select(
            key, F.col("_session.start").alias("session_start"),
            F.col("_session.end").alias("session_end"), "turns",
        )
    )


def stream_rolling_rate(
    source: DataFrame, size: str = "1 minute", slide: str = "10 seconds",
    key: str = "endpoint_name", delay: str = LATENESS,
) -> DataFrame:
    """Sliding requests and tokens per service."""
    return (
        source.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", size, slide).alias("_window"), key)
        .agg(F.count("*").alias("requests"), F.sum("total_tokens").alias("total_tokens"))
        .select(key, F.col("_window.start").alias("window_start"), "requests", "total_tokens")
    )
