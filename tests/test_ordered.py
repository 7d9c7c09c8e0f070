"""The ordered primitives against plain Python, with one group holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from tallyspan.operators.ordered import (
    first_n, next_value, number_rows, running_sums,
)


def skewed(seed, n=600):
    """Rows (key, turn, amount): key 'hot' has most rows; turns are unique with gaps."""
    rng = random.Random(seed)
    rows = []
    for key, share in (("hot", n), ("b", 40), ("c", 1), (None, 7)):
        for turn in sorted(rng.sample(range(share * 3), share)):
            rows.append((key, turn, rng.randrange(10)))
    rng.shuffle(rows)
    return rows


def by_key(rows):
    groups = {}
    for key, turn, amount in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        groups.setdefault(key, []).append((turn, amount))
    return groups


@pytest.fixture(scope="module", params=[1, 2])
def rows(request):
    return skewed(request.param)


@pytest.fixture()
def frame(spark, rows):
    return spark.createDataFrame(rows, "key string, turn bigint, amount int").repartition(5)


def test_number_rows(frame, rows):
    got = number_rows(
        frame, ["key"], [F.col("turn")], running={"spent": F.col("amount")}
    ).collect()
    want = {}
    for key, items in by_key(rows).items():
        spent = 0
        for position, (turn, amount) in enumerate(items, 1):
            want[(key, turn)] = (position, spent)
            spent += amount
    assert {(r.key, r.turn): (r.position, r.spent) for r in got} == want
    assert len(got) == len(rows)


def test_number_rows_splits_the_hot_group(spark, frame):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = frame.repartitionByRange("key", "turn").withColumn(
            "p", F.spark_partition_id()
        )
        assert placed.filter("key = 'hot'").select("p").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_number_rows_descending_without_keys(frame, rows):
    got = number_rows(
        frame, [], [F.col("turn").desc(), F.col("key").asc_nulls_first()], position="seq"
    ).collect()
    want = sorted(rows, key=lambda r: (-r[1], r[0] is not None, r[0] or ""))
    assert [(r.key, r.turn) for r in sorted(got, key=lambda r: r.seq)] == [
        (k, t) for k, t, _ in want
    ]


@pytest.mark.parametrize("size", [1, 3, 50, 4096])
def test_running_sums_over_blocks(frame, rows, size):
    plain = frame.filter("key is not null")
    got = running_sums(
        plain, ["key"], "turn", {"n": F.lit(1), "spent": F.col("amount")}, size=size
    ).collect()
    want = {}
    for key, items in by_key(rows).items():
        for i, (turn, _) in enumerate(items):
            want[(key, turn)] = (i, sum(a for _, a in items[:i]))
    want = {k: v for k, v in want.items() if k[0] is not None}
    assert {(r.key, r.turn): (r.n, r.spent) for r in got} == want


@pytest.mark.parametrize("size", [1, 3, 50, 4096])
def test_next_value_over_blocks(frame, rows, size):
    plain = frame.filter("key is not null")
    got = next_value(plain, ["key"], "turn", F.struct("amount"), "nxt", size=size).collect()
    want = {}
    for key, items in by_key(rows).items():
        for i, (turn, _) in enumerate(items):
            want[(key, turn)] = items[i + 1][1] if i + 1 < len(items) else None
    want = {k: v for k, v in want.items() if k[0] is not None}
    assert {(r.key, r.turn): r.nxt.amount if r.nxt else None for r in got} == want


@pytest.mark.parametrize("threshold", ["1000", "2"])
def test_first_n_on_both_sides_of_the_group_limit(spark, frame, rows, threshold):
    name = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, threshold)
    try:
        got = first_n(frame, ["key"], [F.col("turn")], 5).collect()
    finally:
        spark.conf.set(name, before)
    want = {(k, t, i) for k, items in by_key(rows).items() for i, (t, _) in enumerate(items[:5], 1)}
    assert {(r.key, r.turn, r._rank) for r in got} == want


def test_ties_give_the_same_rows_both_ways(spark):
    df = spark.createDataFrame([("k", 1, n) for n in range(40)], "key string, turn int, n int")
    name = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(name)
    found = []
    for threshold in (1000, 2):
        spark.conf.set(name, threshold)
        rows = first_n(df.repartition(3), ["key"], [F.col("turn")], 5).collect()
        found.append({(r.n, r._rank) for r in rows})
    spark.conf.set(name, before)
    assert found[0] == found[1] and len(found[0]) == 5
