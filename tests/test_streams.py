"""Streams over several micro-batches against their batch form on closed windows."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tallyspan.operators.logs import rolling_rate
from tallyspan.operators.sessions import render_transcript
from tallyspan.streaming.runs import arrivals, drain
from tallyspan.streaming.transcripts import stream_transcripts
from tallyspan.streaming.usage import (
    stream_dedup, stream_rolling_rate, stream_sessions, stream_usage,
)


@pytest.fixture(scope="module")
def folder(spark, tiny, tmp_path_factory):
    """Calls of the test log in five files, in order of arrival."""
    path = str(tmp_path_factory.mktemp("calls"))
    calls = spark.read.parquet(f"{tiny}/events.parquet").select(
        F.col("ts").cast("timestamp").alias("event_time"), F.col("event_id").alias("request_id"),
        F.col("event_type").alias("endpoint_name"), F.col("user_id").alias("requester"),
        F.col("event_id").alias("input_tokens"), F.lit(1).cast("bigint").alias("output_tokens"),
        F.col("event_id").alias("total_tokens"))
    for i in range(5):
        start = datetime.datetime(2024, 1, 1) + datetime.timedelta(days=6 * i)
        end = start + datetime.timedelta(days=6)
        rows = calls.filter((F.col("event_time") >= start) & (F.col("event_time") < end))
        rows.coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, folder):
    return arrivals(spark, folder, files_per_batch=1)


def mark(batch, minutes=15):
    newest = batch.agg(F.max("event_time")).first()[0]
    return newest - datetime.timedelta(minutes=minutes)


def test_usage_equals_batch_on_closed_hours(spark, folder):
    got = drain(stream_usage(stream(spark, folder)), "usage")
    batch = spark.read.parquet(folder)
    want = (
        batch.groupBy("endpoint_name", F.date_trunc("hour", "event_time").alias("hour"))
        .agg(F.count("*").alias("request_count"), F.sum("input_tokens").alias("input_tokens"),
             F.sum("output_tokens").alias("output_tokens"),
             F.sum("total_tokens").alias("total_tokens"))
        .filter(F.col("hour") + F.expr("INTERVAL 1 HOUR") <= F.lit(mark(batch)))
    )
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).isEmpty()


def test_late_rows_within_the_delay_count(spark, tmp_path):
    path = str(tmp_path / "late")
    schema = ("event_time timestamp, endpoint_name string, input_tokens bigint, "
              "output_tokens bigint, total_tokens bigint")

    def at(hour, minute):
        return (datetime.datetime(2024, 1, 1, hour, minute), "e", 1, 1, 2)

    # A row is late by the watermark of the batch before, so one batch lies between.
    arriving = ([at(0, 50), at(1, 5)], [at(0, 55)], [at(3, 0)], [at(3, 1)], [at(0, 56)], [at(9, 0)])
    for rows in arriving:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    got = drain(stream_usage(stream(spark, path)), "late").collect()
    assert {r.hour.hour: r.request_count for r in got} == {0: 2, 1: 1, 3: 2}


def test_dedup(spark, folder, tmp_path):
    twice = str(tmp_path / "twice")
    batch = spark.read.parquet(folder)
    batch.coalesce(1).write.mode("append").parquet(twice)
    batch.coalesce(1).write.mode("append").parquet(twice)
    got = drain(stream_dedup(arrivals(spark, twice)), "dedup")
    assert got.count() == batch.count()
    assert got.select("request_id").distinct().count() == batch.count()


def test_sessions_close_after_the_gap(spark, folder):
    got = drain(stream_sessions(stream(spark, folder), "6 hours"), "sessions").collect()
    batch = spark.read.parquet(folder)
    gap, want = datetime.timedelta(hours=6), set()
    times = {}
    for r in batch.select("requester", "event_time").orderBy("event_time").collect():
        times.setdefault(r.requester, []).append(r.event_time)
    for who, at in times.items():
        run = [at[0]]
        for t in at[1:] + [None]:
            if t is not None and t - run[-1] < gap:
                run.append(t)
                continue
            if run[-1] + gap <= mark(batch):
                want.add((who, run[0], run[-1] + gap, len(run)))
            run = [t]
    assert {tuple(r) for r in got} == want


def test_rolling_rate_equals_batch(spark, folder):
    got = drain(stream_rolling_rate(stream(spark, folder)), "rolling")
    batch = spark.read.parquet(folder)
    want = rolling_rate(batch).filter(
        F.col("window_start") + F.expr("INTERVAL 1 MINUTE") <= F.lit(mark(batch)))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).isEmpty()


MESSAGES = "session_id string, event_time timestamp, turn long, role string, text string"
FIRST = datetime.datetime(2024, 3, 1)


def closed_transcripts(spark, path, batches, **how):
    for rows in batches:
        spark.createDataFrame(rows, MESSAGES).coalesce(1).write.mode("append").parquet(path)
    found = stream_transcripts(stream(spark, path), 600, delay="5 minutes", **how)
    return drain(found, "transcripts", keyed=True)


def message(key, minute, turn, role="user", text="hi"):
    return (key, FIRST + datetime.timedelta(minutes=minute), turn, role, text)


def test_transcripts_of_closed_sessions_equal_the_batch_form(spark, tmp_path):
    rng = random.Random(3)
    rows = [message(f"s{k}", k * 7 + turn, turn, rng.choice(["user", "assistant", None]),
                    rng.choice(["a", None, "long text"]))
            for k in range(40) for turn in range(rng.randrange(1, 9))]
    rows.sort(key=lambda r: r[1])
    batches = [rows[i : i + 37] for i in range(0, len(rows), 37)]
    for part in batches:
        rng.shuffle(part)
    template = "Judge:\n{{ conversation }}\nDone"
    got = closed_transcripts(spark, str(tmp_path / "m"), batches, template=template, part_turns=3)
    newest = max(r[1] for r in rows)
    last = {}
    for r in rows:
        last[r[0]] = max(r[1], last.get(r[0], r[1]))
    done = [k for k, at in last.items()
            if at + datetime.timedelta(minutes=10) <= newest - datetime.timedelta(minutes=5)]
    whole = spark.createDataFrame(rows, MESSAGES)
    want = render_transcript(whole.filter(F.col("session_id").isin(done)), template, 3)
    assert got.count() == want.count() > 40
    assert got.select(*want.columns).exceptAll(want).isEmpty()


def test_pauses_divide_and_late_messages_join_sessions(spark, tmp_path):
    batches = [
        [message("a", 0, 0), message("a", 12, 2), message("b", 0, 0), message("b", 30, 1)],
        [message("a", 6, 1, text="between")],  # 24 minutes late, its neighbours are open or closed
        [message("c", 31, 0), message("b", 33, 2), (None, FIRST, 0, "user", "x"), ("a", None, 0, "user", "x")],
        [message("c", 90, 1)],
        [message("a", 0, 9, text="far too late"), message("c", 91, 2)],
        [message("c", 200, 3)],
    ]
    rows = closed_transcripts(spark, str(tmp_path / "m"), batches).collect()
    minutes = lambda at: (at - FIRST).total_seconds() / 60
    got = {(r.session_id, minutes(r.session_start), minutes(r.session_end), r.turns) for r in rows}
    assert ("b", 0, 10, 1) in got and ("b", 30, 43, 2) in got
    assert ("c", 31, 41, 1) in got and ("c", 90, 101, 2) in got
    assert not any("too late" in r.transcript for r in rows)
    assert not any(r.session_id is None or minutes(r.session_start) == 200 for r in rows)


def test_a_message_within_the_delay_joins_two_sessions(spark, tmp_path):
    batches = [[message("a", 0, 0), message("a", 12, 2)], [message("a", 7, 1)], [message("z", 60, 0)],
               [message("z", 61, 1)]]
    rows = closed_transcripts(spark, str(tmp_path / "m"), batches).collect()
    assert [(r.session_id, r.turns, r.transcript) for r in rows if r.session_id == "a"] == [
        ("a", 3, "user: hi\nuser: hi\nuser: hi")]
