"""Limiters against call-by-call simulations, in one batch and over many."""

import datetime
import random

import pytest

from tallyspan.operators.limits import (
    final_attempt, rate_limit_fixed, same_limits, token_bucket,
)
from tallyspan.streaming.limits import stream_rate_limit, stream_token_bucket
from tallyspan.streaming.runs import arrivals

START = datetime.datetime(2024, 1, 1)
CALLS = "provider string, event_time timestamp, request_id bigint, total_tokens bigint"


def calls(seed, n=400, span=1200):
    rng = random.Random(seed)
    times = sorted(rng.randrange(span) for _ in range(n))
    return [
        (
            "busy" if rng.random() < 0.8 else "calm",
            START + datetime.timedelta(seconds=second),
            i,
            None if rng.random() < 0.1 else rng.randrange(60),
        )
        for i, second in enumerate(times)
    ]


def sequential_window(rows, qpm, tpm):
    seen, out = {}, {}
    for provider, at, request, tokens in sorted(rows, key=lambda r: (r[1], r[2])):
        state = seen.setdefault((provider, at.replace(second=0)), [0, 0])
        if state[0] < qpm and state[1] < tpm:
            state[0] += 1
            state[1] += tokens or 0
            out[request] = (True, None)
        else:
            out[request] = (False, "tpm" if state[1] >= tpm else "qpm")
    return out


def sequential_bucket(rows, rate, burst):
    level, last, out = {}, {}, {}
    for provider, at, request, _ in sorted(rows, key=lambda r: (r[1], r[2])):
        slot = int((at - START).total_seconds()) // 60
        refill = rate * (slot - last.get(provider, slot))
        now = min(burst, level.get(provider, burst) + refill)
        out[request] = now >= 1
        level[provider], last[provider] = now - (now >= 1), slot
    return out


@pytest.mark.parametrize("seed,qpm,tpm", [(1, 8, 200), (2, 5, 10**6), (3, 100, 150), (4, 1, 1)])
def test_fixed_window(spark, seed, qpm, tpm):
    rows = calls(seed)
    log = spark.createDataFrame(rows, CALLS)
    got = rate_limit_fixed(log, same_limits(log, qpm, tpm)).collect()
    assert {r.request_id: (r.admitted, r.limit_hit) for r in got} == sequential_window(
        rows, qpm, tpm
    )
    assert all(r.limit_status == (200 if r.admitted else 429) for r in got)


@pytest.mark.parametrize("seed,rate,burst", [(1, 4, 10), (2, 1, 1), (3, 20, 30)])
def test_token_bucket(spark, seed, rate, burst):
    rows = calls(seed)
    got = token_bucket(spark.createDataFrame(rows, CALLS), rate, burst).collect()
    assert {r.request_id: r.admitted for r in got} == sequential_bucket(rows, rate, burst)


def test_token_bucket_of_each_service(spark, tmp_path):
    rows = [("other" if r[2] % 3 == 0 else r[0], *r[1:]) for r in calls(5)]
    names = sorted({r[0] for r in rows})
    own = {names[0]: (1, 3), names[1]: (6, 12)}
    want = {}
    for name in names:
        rate, burst = own.get(name, (2, 5))
        want |= sequential_bucket([r for r in rows if r[0] == name], rate, burst)
    table = [(name, rate, burst) for name, (rate, burst) in own.items()]
    table += [(names[0], 9, 90), (names[2], None, None), ("unseen", 50, 50), (None, 1, -4)]
    allowances = spark.createDataFrame(table, "provider string, rate int, burst int")
    nameless = [(None, START, 10**6 + k, 1) for k in range(3)]
    log = spark.createDataFrame(rows + nameless, CALLS)
    got = token_bucket(log, 2, 5, allowances=allowances).collect()
    assert {r.request_id: r.admitted for r in got} == want | {10**6 + k: False for k in range(3)}
    source = batches_of(spark, str(tmp_path / "calls"), [
        [r for r in rows if r[1] < START + datetime.timedelta(minutes=4)],
        [r for r in rows if r[1] >= START + datetime.timedelta(minutes=4)]])
    path = str(tmp_path / "bucket")
    stream_token_bucket(source, path, rate=2, burst=5, allowances=allowances).awaitTermination()
    assert {r.request_id: r.admitted for r in spark.read.parquet(f"{path}/verdicts").collect()} == want


def write_in_order(spark, rows, folder, parts=5):
    size = len(rows) // parts + 1
    for i in range(0, len(rows), size):
        spark.createDataFrame(rows[i:i + size], CALLS).coalesce(1).write.mode("append").parquet(
            folder
        )


def test_streams_equal_the_sequential_limiters(spark, tmp_path):
    rows = calls(9, n=300)
    folder = str(tmp_path / "calls")
    write_in_order(spark, rows, folder)

    def source():
        return arrivals(spark, folder, files_per_batch=1)

    window = str(tmp_path / "window")
    limits = same_limits(spark.createDataFrame(rows, CALLS), 6, 150)
    stream_rate_limit(source(), window, limits).awaitTermination()
    got = spark.read.parquet(f"{window}/verdicts").collect()
    assert len(got) == len(rows) and len({r.batch for r in got}) == 5
    want = sequential_window(rows, 6, 150)
    assert {r.request_id: r.admitted for r in got} == {k: v[0] for k, v in want.items()}

    bucket = str(tmp_path / "bucket")
    stream_token_bucket(source(), bucket, rate=3, burst=9).awaitTermination()
    got = spark.read.parquet(f"{bucket}/verdicts").collect()
    assert {r.request_id: r.admitted for r in got} == sequential_bucket(rows, 3, 9)


def test_a_batch_run_again_gives_the_same_verdicts(spark, tmp_path):
    rows = calls(5, n=120)
    folder, path = str(tmp_path / "calls"), str(tmp_path / "limit")
    write_in_order(spark, rows, folder, parts=3)
    source = arrivals(spark, folder, files_per_batch=1)
    limits = same_limits(spark.createDataFrame(rows, CALLS), 4, 10**6)
    stream_rate_limit(source, path, limits).awaitTermination()
    first = sorted(map(tuple, spark.read.parquet(f"{path}/verdicts").drop("batch").collect()))
    # As after a crash before the last batch was committed.
    (tmp_path / "limit/checkpoint/commits/2").unlink()
    (tmp_path / "limit/checkpoint/commits/.2.crc").unlink(missing_ok=True)
    stream_rate_limit(source, path, limits).awaitTermination()
    again = sorted(map(tuple, spark.read.parquet(f"{path}/verdicts").drop("batch").collect()))
    assert again == first


def test_final_attempt(spark):
    rows = [("a", 1, 503, 9.0), ("a", 2, 429, 8.0), ("a", 3, 200, 1.5), ("b", 1, 200, 0.5)]
    df = spark.createDataFrame(rows, "request_id string, attempt int, status int, latency_s double")
    got = {r.request_id: tuple(r)[1:] for r in final_attempt(df).collect()}
    assert got == {"a": (3, 200, 1.5, 6), "b": (1, 200, 0.5, 0)}


def test_windows_are_cut_before_the_shuffle(spark):
    df = spark.createDataFrame(calls(1), CALLS)
    for out in (rate_limit_fixed(df, same_limits(df, 8, 100)), token_bucket(df, 4, 10)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan and "Python" not in plan and "Pandas" not in plan


def test_calls_delivered_again_and_without_a_time(spark):
    rows = [("a", START, 1, 5), ("a", START, 2, 5), ("a", START + datetime.timedelta(seconds=5), 3, 5),
            ("a", START + datetime.timedelta(seconds=6), 4, 5), ("a", None, 5, 5), ("free", START, 6, 1),
            ("free", None, 7, 1), (None, START, 8, 1)]
    log = spark.createDataFrame(rows + rows[:2] * 3 + rows[4:5], CALLS)
    limits = spark.createDataFrame([("a", 3, 1000), ("half", 1, None)],
                                   "provider string, qpm int, tpm int")
    got = rate_limit_fixed(log, limits).collect()
    assert len(got) == len(rows) + 7
    verdicts = {(r.request_id, r.admitted, r.limit_hit) for r in got}
    assert verdicts == {(1, True, None), (2, True, None), (3, True, None), (4, False, "qpm"),
                        (5, False, "no_time"), (6, True, None), (7, True, None), (8, True, None)}
    bucket = token_bucket(log, 1, 2).collect()
    assert len(bucket) == len(rows) + 7
    assert {(r.request_id, r.admitted) for r in bucket if r.provider == "a"} == {
        (1, True), (2, True), (3, False), (4, False), (5, False)}


def test_limits_differ_by_service(spark):
    rows = calls(3)
    log = spark.createDataFrame(rows, CALLS)
    limits = spark.createDataFrame([("busy", 4, 10**6), ("calm", 2, 60)],
                                   "provider string, qpm int, tpm int")
    got = {r.request_id: r.admitted for r in rate_limit_fixed(log, limits).collect()}
    for name, qpm, tpm in (("busy", 4, 10**6), ("calm", 2, 60)):
        own = [r for r in rows if r[0] == name]
        assert {r[2]: got[r[2]] for r in own} == {
            k: v[0] for k, v in sequential_window(own, qpm, tpm).items()}


def test_late_calls_of_closed_windows_are_rejected(spark, tmp_path):
    hour = datetime.timedelta(hours=1)
    batches = [
        [("a", START + datetime.timedelta(seconds=k), k, 1) for k in range(3)],
        [("a", START + 2 * hour, 10, 1)],
        [("a", START + datetime.timedelta(seconds=9), 20, 1), ("a", START + 2 * hour, 21, 1)],
    ]
    folder, path = str(tmp_path / "calls"), str(tmp_path / "limit")
    for rows in batches:
        spark.createDataFrame(rows, CALLS).coalesce(1).write.mode("append").parquet(folder)
    limits = spark.createDataFrame([("a", 3, 1000)], "provider string, qpm int, tpm int")
    stream_rate_limit(arrivals(spark, folder, files_per_batch=1), path, limits).awaitTermination()
    got = {r.request_id: (r.admitted, r.limit_hit)
           for r in spark.read.parquet(f"{path}/verdicts").collect()}
    assert got[20] == (False, "late") and got[21] == (True, None)
    assert all(got[k][0] for k in (0, 1, 2, 10))


def test_a_bucket_over_many_blocks(spark, monkeypatch):
    from tallyspan.operators import limits

    monkeypatch.setattr(limits, "BLOCK", 4)
    rows = calls(11, n=500, span=6000)
    got = token_bucket(spark.createDataFrame(rows, CALLS), 2, 7).collect()
    assert {r.request_id: r.admitted for r in got} == sequential_bucket(rows, 2, 7)


def batches_of(spark, folder, batches):
    for rows in batches:
        spark.createDataFrame(rows, CALLS).coalesce(1).write.mode("append").parquet(folder)
    return arrivals(spark, folder, files_per_batch=1)


def test_calls_delivered_again_in_later_batches_consume_once(spark, tmp_path):
    second = datetime.timedelta(seconds=1)
    first = ("a", START, 1, 5)
    batches = [[first], [first, ("a", START + second, 2, 5)], [first, ("a", START + 2 * second, 3, 5)],
               [("a", START + 3 * second, 4, 5), first, ("a", START + second, 2, 5)]]
    path = str(tmp_path / "limit")
    limits = spark.createDataFrame([("a", 3, 1000)], "provider string, qpm int, tpm int")
    stream_rate_limit(
        batches_of(spark, str(tmp_path / "calls"), batches), path, limits).awaitTermination()
    rows = spark.read.parquet(f"{path}/verdicts").collect()
    assert len(rows) == sum(map(len, batches))
    assert {(r.request_id, r.admitted, r.limit_hit) for r in rows} == {
        (1, True, None), (2, True, None), (3, True, None), (4, False, "qpm")}


def test_calls_without_a_service_are_one_service(spark, tmp_path):
    batches = [[(None, START + datetime.timedelta(seconds=k), k, 1), ("a", START, 10 + k, 1)]
               for k in range(4)]
    source = batches_of(spark, str(tmp_path / "calls"), batches)
    limits = spark.createDataFrame([(None, 3, 1000)], "provider string, qpm int, tpm int")
    window, bucket = str(tmp_path / "window"), str(tmp_path / "bucket")
    stream_rate_limit(source, window, limits).awaitTermination()
    got = {r.request_id: r.admitted for r in spark.read.parquet(f"{window}/verdicts").collect()}
    assert got == {0: True, 1: True, 2: True, 3: False, **{10 + k: True for k in range(4)}}
    stream_token_bucket(source, bucket, rate=1, burst=3).awaitTermination()
    got = {r.request_id: r.admitted for r in spark.read.parquet(f"{bucket}/verdicts").collect()}
    assert got == {**{k: k < 3 for k in range(4)}, **{10 + k: k < 3 for k in range(4)}}
    assert spark.read.parquet(f"{bucket}/balances/batch=3").count() == 2


def test_a_service_listed_twice_has_its_lowest_limits(spark):
    log = spark.createDataFrame([("a", START, k, 1) for k in range(4)], CALLS)
    limits = spark.createDataFrame([("a", 3, 100), ("a", 2, 1000)], "provider string, qpm int, tpm int")
    got = rate_limit_fixed(log, limits).collect()
    assert {r.request_id: r.admitted for r in got} == {0: True, 1: True, 2: False, 3: False}
    assert len(got) == 4
