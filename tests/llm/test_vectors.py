"""Operators on vectors against brute force, and their odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspan.llm import hard_negatives, near_vectors
from tallyspan.llm.simhash import forest

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def results(df):
    return sorted(map(tuple, df.collect()), key=repr)


def clustered(count, groups, width=16, seed=1, noise=0.05):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(groups, width))
    which = random.integers(groups, size=count)
    rows = centres[which] + noise * random.normal(size=(count, width))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    return [(k, rows[k].astype(np.float32).tolist(), int(which[k] % 3)) for k in range(count)]


ODD = [
    (1000, None, 1), (1001, [], 1), (1050, [0.0] * 16, 1), (1051, [0.0] * 16, 2),
    (1002, [1.0, None] + [0.0] * 14, 1), (1003, [NAN] * 16, 1), (1004, [INF] + [0.0] * 15, 1),
    (1100, [1.0] * 16, None), (None, [1.0] * 16, 1), (1150, [0.5, 0.25], 1), (1151, [0.5, 0.2], 1),
    (1152, [0.5, 0.3], 0), (1153, [0.4, 0.1], 0), (1200, [1.0] * 16, 1), (1200, [1.0] * 16, 1),
    (1200, [-1.0] * 16, 2), (1200, [0.9] * 16, 1), (1201, [0.8] * 16, 0), (1202, [0.8] * 16, 2),
    (1203, [0.6] * 16, 2), (1250, [3e9] * 16, 1), (1251, [3e9] * 16, 1), (1252, [2.5e9] * 16, 0),
    (-50, [0.7] * 16, 1),
]


# Hard negatives

def plain_negatives(rows, positives=5, negatives=3):
    good = sorted({
        (i, l, tuple(math.floor(256 * float(x)) for x in v)) for i, v, l in rows
        if i is not None and l is not None and v and all(x is not None and math.isfinite(x) for x in v)
    }, key=lambda r: r[:2])
    limit = {len(r[2]): math.floor(math.sqrt(2.0**62 / len(r[2]))) for r in good}
    good = [(i, l, tuple(max(-limit[len(v)], min(limit[len(v)], x)) for x in v)) for i, l, v in good]
    found = []
    for a in good:
        if a[0] % 50:
            continue
        others = sorted(
            (-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in good
            if b is not a and len(b[2]) == len(a[2])
        )
        for score, positive, label in [o for o in others if o[2] == a[1]][:positives]:
            fit = [o for o in others if o[2] != a[1] and 50 * -score <= 100 * -o[0] <= 95 * -score]
            found += [(a[0], positive, k + 1, o[1], -score, -o[0]) for k, o in enumerate(fit[:negatives])]
    return sorted(found, key=repr)


def mined(spark, rows, **how):
    vectors = hard_negatives.whole_numbers(spark.createDataFrame(rows, SCHEMA).repartition(4))
    return results(hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0, **how))


@pytest.mark.parametrize("how", [{}, {"first": 40, "members": 2, "clusters": 3}])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, how):
    if how:
        monkeypatch.setattr(hard_negatives, "STEP", 16)
        monkeypatch.setattr(hard_negatives, "PART_BYTES", 16 * 8 * 32)
    rows = clustered(600, 12, noise=0.4) + ODD
    found = mined(spark, rows, **how)
    assert found == plain_negatives(rows) and len(found) > 50


def test_hard_negatives_ties_go_to_smaller_ids(spark):
    rows = [(50 * k, [1.0, 0.0], 0) for k in range(3)] + [(k, [0.75, 0.5], 1) for k in range(1, 30)]
    rows += [(200 + k, [0.0, 0.0], 0) for k in range(8)]
    assert mined(spark, rows, first=4) == plain_negatives(rows)


def test_hard_negatives_of_nothing(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 0)]) == []
    assert mined(spark, [(50, [1.0], 0), (51, [1.0], 0)]) == []


def test_hard_negatives_pass_over_other_columns(spark):
    rows = clustered(200, 6, noise=0.4)
    vectors = hard_negatives.whole_numbers(spark.createDataFrame(rows, SCHEMA)).withColumns(
        {c: F.lit(1) for c in ("row", "n", "key", "cluster", "lo", "anchor")})
    found = results(hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0))
    assert found == plain_negatives(rows)


def test_members_stop_early(spark):
    """A certified member walks on no further: products of the far half are not looked at."""
    asked = hard_negatives.Part(*[np.array([v]) for v in (0, 0, 1, 2)], np.array([[100, 0]]))
    n = 2000
    vectors = np.stack([np.linspace(100, -100, n).astype(np.int64), np.zeros(n, dtype=np.int64)], axis=1)
    listed = hard_negatives.Part(np.arange(1, n + 1), np.arange(1, n + 1), np.ones(n, dtype=int),
                                 np.full(n, 2), vectors)
    seen = []
    whole = hard_negatives._products
    try:
        hard_negatives._products = lambda a, b: (seen.append(len(b)), whole(a, b))[1]
        low, high = np.array([[hard_negatives.LOW]]), np.array([[hard_negatives.HIGH]])
        a, score, row, who, slot = hard_negatives._walk(
            asked, low, high, low.copy(), listed, vectors[:, 0].astype(float), 100.0, True, 5)
    finally:
        hard_negatives._products = whole
    assert sum(seen) <= hard_negatives.STEP
    assert score.tolist() == sorted((100 * vectors[:, 0]).tolist(), reverse=True)[:5]


# Near-duplicate vectors

def plain_groups(rows, threshold=0.98):
    usable = [
        k for k, (_, v, l) in enumerate(rows)
        if l is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    i, j = [], []
    for a, p in enumerate(usable):
        for q in usable[a + 1:]:
            x, y = np.array(rows[p][1], dtype=np.float32), np.array(rows[q][1], dtype=np.float32)
            if rows[p][2] == rows[q][2] and len(x) == len(y):
                x, y = x.astype(float), y.astype(float)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                    i.append(p)
                    j.append(q)
    label = forest(len(rows), np.array(i, dtype=int), np.array(j, dtype=int))
    links = np.bincount(i + j, minlength=len(rows))
    first = {}
    for k, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            first[label[k]] = min(vec_id, first.get(label[k], vec_id))
    return sorted(((r[0], int(links[k]), first.get(label[k]), r[0] == first.get(label[k]))
                   for k, r in enumerate(rows)), key=repr)


@pytest.mark.parametrize("how", [{}, {"window": 12, "block": 40, "tile": 8, "passes": 8}])
def test_groups_equal_brute_force(spark, how):
    rows = clustered(500, 40, noise=0.03) + ODD + clustered(500, 40, noise=0.03)[:100]
    found = results(near_vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4), **how))
    assert found == plain_groups(rows)
    assert sum(r[1] for r in found) > 500


def test_a_large_group_is_counted_whole(spark):
    """Far more near copies than the window: every link counts, and copies as often as they are there."""
    rows = clustered(400, 1, noise=0.004) + clustered(400, 1, noise=0.004)[:50]
    rows = [(k, v, 0) for k, (_, v, _) in enumerate(rows)]
    found = results(near_vectors.near_duplicates(
        spark.createDataFrame(rows, SCHEMA), window=8, block=64, tile=32))
    assert found == plain_groups(rows)
    assert all(r[1] == len(rows) - 1 for r in found)


def test_recall_where_neighbours_are_crowded(spark):
    """Vectors of one narrow cone share most signs; batches go on until few links are missing."""
    random = np.random.default_rng(5)
    centre = random.normal(size=32)
    rows = centre / np.linalg.norm(centre) + 0.06 * random.normal(size=(1500, 32))
    rows[1000:] = rows[:500] + 0.02 * random.normal(size=(500, 32)) * np.linalg.norm(rows[:500], axis=1)[:, None] / 2
    table = [(k, v.astype(np.float32).tolist(), 0) for k, v in enumerate(rows)]
    found = results(near_vectors.near_duplicates(spark.createDataFrame(table, SCHEMA), window=16, block=256))
    want = plain_groups(table)
    assert sum(r[1] for r in found) >= 0.95 * sum(r[1] for r in want)
    assert all(a[1] <= b[1] for a, b in zip(found, want))


def test_groups_of_nothing(spark):
    assert results(near_vectors.near_duplicates(spark.createDataFrame([], SCHEMA))) == []
    alone = [(None, None, 1), (5, [0.0], 1), (6, [1.0], None), (7, [1.0], 1)]
    found = results(near_vectors.near_duplicates(spark.createDataFrame(alone, SCHEMA)))
    assert found == sorted([(None, 0, None, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True)], key=repr)


def test_groups_pass_over_other_columns(spark):
    rows = clustered(120, 10, noise=0.03)
    table = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit(1) for c in ("cid", "n", "k1", "rows", "first", "root", "position")})
    assert results(near_vectors.near_duplicates(table)) == plain_groups(rows)
