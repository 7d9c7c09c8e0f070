"""Streaming operators run over everything that has arrived, and their batch twins."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from tallyspan.operators import limits
from tallyspan.plans.registry import query
from tallyspan.sources.bindings import Tables
from tallyspan.storage import shared_folder
from tallyspan.streaming import limits as stream_limits
from tallyspan.streaming import transcripts, usage
from tallyspan.streaming.runs import arrivals, drain


class Arriving(Tables):
    """The same tables as streams."""

    def read(self, name):
        return arrivals(self.spark, self.folder, f"{name}.parquet")

    @cached_property
    def calls(self):
        plain = Tables.calls.func(self)
        return plain.withColumn("event_time", F.col("event_time").cast("timestamp"))


def _stream(t):
    return Arriving(t.spark, t.folder)


def _plain_times(df, *names):
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


_MARK = "(SELECT date_trunc('millisecond', max(event_time)) - INTERVAL 15 MINUTE FROM p)"


@query("stream_usage", over="p", sql=f"""
SELECT endpoint_name, date_trunc('hour', event_time) AS hour, count(*) AS request_count,
  CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
  CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
  CAST(sum(total_tokens) AS BIGINT) AS total_tokens
FROM p WHERE date_trunc('hour', event_time) + INTERVAL 1 HOUR <= {_MARK} GROUP BY 1, 2""")
def _(t):
    return _plain_times(drain(usage.stream_usage(_stream(t).calls), "usage"), "hour")


@query("stream_dedup", over="p", sql="SELECT request_id, provider, total_tokens FROM p")
def _(t):
    twice = _stream(t).calls.unionByName(_stream(t).calls)
    rows = twice.select("request_id", "provider", "total_tokens", "event_time")
    return drain(usage.stream_dedup(rows), "dedup").drop("event_time")


@query("stream_sessions", over="p", sql=f"""+
g AS (SELECT requester, event_time, CASE WHEN event_time - lag(event_time) OVER w
    < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens
  FROM p WINDOW w AS (PARTITION BY requester ORDER BY event_time, request_id)),
n AS (SELECT *, sum(opens) OVER (PARTITION BY requester ORDER BY event_time
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM g)
SELECT requester, min(event_time) AS session_start,
  max(event_time) + INTERVAL 6 HOUR AS session_end, count(*) AS turns
FROM n GROUP BY requester, s HAVING max(event_time) + INTERVAL 6 HOUR <= {_MARK}""")
def _(t):
    rows = drain(usage.stream_sessions(_stream(t).calls, "6 hours"), "sessions")
    return _plain_times(rows, "session_start", "session_end")


@query("stream_rolling_rate", over="p", sql=f"""
SELECT endpoint_name, w AS window_start, count(*) AS requests,
  CAST(sum(total_tokens) AS BIGINT) AS total_tokens
FROM (SELECT endpoint_name, total_tokens,
        unnest([time_bucket(INTERVAL 10 SECOND, event_time) - INTERVAL 10 SECOND * i
                FOR i IN range(6)]) AS w FROM p)
WHERE w + INTERVAL 1 MINUTE <= {_MARK} GROUP BY 1, 2""")
def _(t):
    return _plain_times(drain(usage.stream_rolling_rate(_stream(t).calls), "rolling"),
                        "window_start")


def _in_order(t, calls, parts=4):
    """The calls as files that arrive one after another, so that state goes from one to the next."""
    path = shared_folder(t.spark, "arriving")
    calls = calls.withColumn("event_time", F.col("event_time").cast("timestamp"))
    edges = calls.approxQuantile("_at", [k / parts for k in range(1, parts)], 0.001)
    for low, high in zip([None, *edges], [*edges, None]):
        at = F.col("_at")
        later = F.lit(True) if low is None else at > low
        part = calls.filter(later if high is None else later & (at <= high))
        part.drop("_at").coalesce(1).write.mode("append").parquet(path)
    return arrivals(t.spark, path, files_per_batch=1)


def _in_order_by_hour(t, calls):
    """Files cut at full hours: a bucket's interval is granted to one batch."""
    at = F.unix_timestamp(F.date_trunc("hour", F.col("event_time").cast("timestamp")))
    return _in_order(t, calls.withColumn("_at", at.cast("double")))


def _timed(calls):
    """``_at``: seconds, and for calls without a time those of the row in the test table."""
    return calls.withColumn("_at", F.coalesce(
        F.unix_timestamp(F.col("event_time").cast("timestamp")), F.lit(0)).cast("double"))


@query("stream_rate_limit", over="l", sql="""
SELECT request_id, provider, admitted, limit_hit FROM limited""")
def _(t):
    path = shared_folder(t.spark, "limit")
    calls = t.limited_calls.select("request_id", "provider", "event_time", "total_tokens")
    stream_limits.stream_rate_limit(
        _in_order(t, _timed(calls)), path, t.service_limits, window="1 hour"
    ).awaitTermination()
    return t.spark.read.parquet(f"{path}/verdicts").select(
        "request_id", "provider", "admitted", "limit_hit")


@query("stream_transcripts", over="t", sql="""+
said AS (SELECT *, TIMESTAMP '2024-01-01' + to_minutes(
    10 * CAST(substr(session_id, 9) AS BIGINT) + turn) AS event_time FROM c)
SELECT session_id, min(event_time) AS session_start, max(event_time) + INTERVAL 30 MINUTE AS session_end,
  count(*) AS turns, CAST(0 AS BIGINT) AS part, 'Judge this:' || chr(10) || string_agg(
    coalesce(role, '') || ': ' || coalesce(text, ''), chr(10) ORDER BY event_time) || chr(10)
    || 'Value?' AS transcript
FROM said GROUP BY session_id
HAVING session_end <= (SELECT max(event_time) - INTERVAL 15 MINUTE FROM said)""")
def _(t):
    """A conversation begins every ten minutes and has a message a minute; half an hour closes it."""
    number = F.substring_index("session_id", "-", -1).cast("bigint")
    seconds = 1_704_067_200 + 60 * (10 * number + F.col("turn"))
    messages = t.conversation.withColumns({
        "_at": seconds.cast("double"), "event_time": F.timestamp_seconds(seconds),
    })
    rows = drain(
        transcripts.stream_transcripts(
            _in_order(t, messages), 1800, template="Judge this:\n{{ conversation }}\nValue?"),
        "transcripts", keyed=True,
    )
    return _plain_times(rows, "session_start", "session_end")


_BUCKETED = """+
h AS (SELECT provider, date_trunc('hour', event_time) AS w, count(*) AS c FROM p GROUP BY 1, 2),
o AS (SELECT *, row_number() OVER (PARTITION BY provider ORDER BY w) AS i,
        epoch(w) // 3600 AS hr FROM h),
walk AS (
  WITH RECURSIVE s(provider, w, i, hr, granted, level) AS (
    SELECT provider, w, i, hr, least(c, 10), 10 - least(c, 10) FROM o WHERE i = 1
    UNION ALL
    SELECT o.provider, o.w, o.i, o.hr, least(o.c, least(10, s.level + 4 * (o.hr - s.hr))),
      least(10, s.level + 4 * (o.hr - s.hr))
        - least(o.c, least(10, s.level + 4 * (o.hr - s.hr)))
    FROM s JOIN o ON o.provider = s.provider AND o.i = s.i + 1)
  SELECT * FROM s)
SELECT request_id, p.provider, row_number() OVER (PARTITION BY p.provider,
  date_trunc('hour', event_time) ORDER BY event_time, request_id) <= granted AS admitted
FROM p JOIN walk ON walk.provider = p.provider AND walk.w = date_trunc('hour', event_time)"""


@query("token_bucket", over="p", sql=_BUCKETED)
def _(t):
    return limits.token_bucket(t.calls, rate=4, burst=10, interval="1 hour").select(
        "request_id", "provider", "admitted"
    )


@query("stream_token_bucket", over="p", sql=_BUCKETED)
def _(t):
    path = shared_folder(t.spark, "bucket")
    calls = t.calls.select("request_id", "provider", "event_time", "total_tokens")
    stream_limits.stream_token_bucket(
        _in_order_by_hour(t, calls), path, rate=4, burst=10, interval="1 hour"
    ).awaitTermination()
    return t.spark.read.parquet(f"{path}/verdicts").select("request_id", "provider", "admitted")
