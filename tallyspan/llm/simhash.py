"""SimHash fingerprints and their links within a few bits, by tiled exact comparison.

Fingerprints that differ in at most r bits agree in one of r + 1 bands of the 64 bits (or in k
of r + k). Equal texts share a fingerprint, so only distinct ones are compared. They meet in a
*tile* per combination of k bands and their value; a tile of more than ``TILE`` fingerprints is
cut into tiles by population count, and two such tiles are compared only if their counts
differ by at most the radius, for every differing bit changes the count by one.
Inside a task, tiles are compared with numpy's exclusive-or and bit counts. A tile gives the
links of a spanning forest, never all its pairs.

Null or empty texts, and texts of white space, have fingerprint zero and are linked like any
other. Rows with a null ``doc_id`` are fingerprinted and linked, but never name a component
(a component of such rows alone has a null id). Repeated rows come back repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.components import components
from tallyspan.llm.tables import fresh_name, only_rows, partitions, text_keys, without_rows
from tallyspan.storage import settle

SHINGLE = 4
RADIUS = 4
BITS = 64
TILE = 4096
# Tiles should hold about this many fingerprints on average; more bands must agree if not.
TILE_AIM = 2048
_UPPER_TO_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of a UTF-8 text, as an unsigned number."""
    words = text.translate(_UPPER_TO_LOWER).split()  # of bytes: ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[: max(1, len(words) - shingle + 1)].tolist(),
                ends[min(shingle, len(words)) - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], 42) for a, b in spans], dtype=np.uint64)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # a long text needs no more room than others
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keyed: bool = False) -> DataFrame:
    """``(doc_id, fp)``, one row per row of ``docs``; ``fp`` holds the bits in a signed long.

    The keys of the texts, ``t`` and ``u``, follow if ``keyed``.
    """
    keys = ["t", "u"] if keyed else []

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            more = batch.columns[2:]
            found = [fingerprint(t.as_py() or b"", shingle) for t in texts]
            fps = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), fps, *more], names=["doc_id", "fp", *keys]
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", *(text_keys() if keyed else [])
    ).mapInArrow(scan, "doc_id long, fp long" + ", t long, u int" * keyed)


def band_masks(count: int, radius: int = RADIUS) -> list[int]:
    """Masks of which two fingerprints within the radius agree in one at least.

    ``agree`` of ``radius + agree`` bands are equal; it is the smallest number for which
    ``count`` fingerprints spread evenly give tiles of ``TILE_AIM``.
    """
    agree = 1
    while agree < 4 and count >> (BITS * agree // (radius + agree)) > TILE_AIM:
        agree += 1
    bands = radius + agree
    cuts = [BITS * k // bands for k in range(bands + 1)]
    single = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(single, agree)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def near_pairs(left: np.ndarray, right: np.ndarray | None, radius: int, tile: int = 1024):
    """Index pairs within the radius: inside ``left``, or between ``left`` and ``right``.

    Both sides are ordered by population count and compared tile by tile; tile pairs whose
    counts are further apart than the radius are skipped.
    """
    same = right is None
    a = np.argsort(np.bitwise_count(left), kind="stable")
    b = a if same else np.argsort(np.bitwise_count(right), kind="stable")
    x, y = left[a], (left if same else right)[b]
    nx, ny = np.bitwise_count(x).astype(int), np.bitwise_count(y).astype(int)
    found_i, found_j = [], []
    for i in range(0, len(x), tile):
        top = min(i + tile, len(x))
        first = int(np.searchsorted(ny, nx[i] - radius))
        last = int(np.searchsorted(ny, nx[top - 1] + radius, side="right"))
        for j in range(max(first, i) if same else first, last, tile):
            end = min(j + tile, last)
            near = np.bitwise_count(x[i:top, None] ^ y[None, j:end]) <= radius
            p, q = np.nonzero(near)
            p, q = p + i, q + j
            if same:
                keep = p < q
                p, q = p[keep], q[keep]
            found_i.append(a[p])
            found_j.append(b[q])
    none = np.zeros(0, dtype=np.int64)
    return (np.concatenate(found_i) if found_i else none,
            np.concatenate(found_j) if found_j else none)


def forest(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``size`` items the first item of its component."""
    label = np.arange(size)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        label = label[label]
        if np.array_equal(before, label):
            break
    return label


def _compare(radius: int):
    """For rows (tile, side, fp) grouped by tile: forest links of each tile."""

    def links(fps: np.ndarray, side: np.ndarray):
        left = fps[side == 0]
        right = fps[side == 1]
        if len(right):
            i, j = near_pairs(left, right, radius)
            j = j + len(left)
        else:
            i, j = near_pairs(left, None, radius)
        both = np.concatenate([left, right])
        if not len(i):
            return both[:0], both[:0]
        label = forest(len(both), i, j)
        moved = np.flatnonzero(label != np.arange(len(both)))
        return both[moved], both[label[moved]]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(parts):
            a = np.concatenate([p[0] for p in parts]).view(np.int64)
            b = np.concatenate([p[1] for p in parts]).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        keys = sides = fps = None
        for batch in batches:
            new = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            key = np.stack(new[:2])
            if keys is not None:
                key = np.concatenate([keys, key], axis=1)
                new[2], new[3] = np.concatenate([sides, new[2]]), np.concatenate([fps, new[3]])
            edges = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            bounds = [0, *edges.tolist()]
            parts = []
            values = new[3].view(np.uint64)
            for a, b in zip(bounds, bounds[1:]):
                if b - a > 1:
                    parts.append(links(values[a:b], new[2][a:b]))
            last = bounds[-1]  # the last tile may go on in the next batch
            keys, sides, fps = key[:, last:], new[2][last:], new[3][last:]
            if parts:
                yield out(parts)
        if keys is not None and keys.shape[1] > 1:
            yield out([links(fps.view(np.uint64), sides)])

    return scan


def links(distinct: DataFrame, count: int, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links ``(a, b)`` that join all fingerprints ``fp`` connected within the radius."""
    spark = distinct.sparkSession
    masks = band_masks(count, radius)
    banded = distinct.select(
        "fp",
        F.explode(F.array(*[
            F.struct(F.lit(k).alias("band"), F.col("fp").bitwiseAND(_signed(m)).alias("value"))
            for k, m in enumerate(masks)
        ])).alias("k"),
    ).select("k.band", "k.value", "fp")

    crowded = banded.groupBy("band", "value").count().filter(F.col("count") > tile).select(
        "band", "value"
    )
    banded = banded.join(crowded.withColumn("_crowded", F.lit(True)), ["band", "value"], "left")
    whole = banded.filter("_crowded is null").select(
        F.xxhash64("band").alias("t0"), F.col("value").alias("t1"), F.lit(0).alias("side"), "fp"
    )
    # Crowded combinations: tiles by population count, cut further by a hash.
    ones = F.bit_count("fp")
    parts = banded.filter("_crowded").withColumn("ones", ones).groupBy(
        "band", "value", "ones"
    ).agg(F.ceil(F.count("*") / tile).cast("int").alias("parts"))
    tiles = parts.select(
        "band", "value", "ones", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    here, there = tiles.alias("x"), tiles.alias("y")
    # Grows with the square of the tiles of one band value, which comparing pairs exactly does.
    pairs = here.join(
        there,
        F.expr("x.band = y.band and x.value = y.value")
        & F.expr(f"abs(x.ones - y.ones) <= {radius}")
        & F.expr("(x.ones, x.part) <= (y.ones, y.part)"),
    ).select(
        "x.band", "x.value",
        F.struct(F.col("x.ones"), F.col("x.part"), F.lit(0).alias("side")).alias("left"),
        F.struct(F.col("y.ones"), F.col("y.part"), F.lit(1).alias("side")).alias("right"),
    )
    ends = pairs.select(
        "band", "value",
        F.xxhash64("band", "left.ones", "left.part", "right.ones", "right.part").alias("t0"),
        F.explode(
            F.when(
                (F.col("left.ones") == F.col("right.ones"))
                & (F.col("left.part") == F.col("right.part")),
                F.array("left"),
            ).otherwise(F.array("left", "right"))
        ).alias("end"),
    ).select("band", "value", "t0", "end.ones", "end.part", "end.side")
    cut = (
        banded.filter("_crowded").withColumn("ones", ones)
        .join(parts, ["band", "value", "ones"])
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .join(ends, ["band", "value", "ones", "part"])
        .select("t0", F.col("value").alias("t1"), "side", "fp")
    )
    tiled = whole.union(cut)
    return (
        tiled.repartition(partitions(spark), "t0", "t1")
        .sortWithinPartitions("t0", "t1")
        .mapInArrow(_compare(radius), "a long, b long")
    )


def _grouped(docs: DataFrame, shingle: int, radius: int, tile: int, keyed: bool = False) -> DataFrame:
    """Every row's ``doc_id``, ``fp`` and ``component_id``.

    With its text's keys and ``best``, the smallest (no id, doc_id, t, u) of its group, if ``keyed``.
    """
    prints = settle(fingerprints(docs, shingle, keyed), "fingerprints")
    chosen = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "t", "u"))
    distinct = prints.groupBy("fp").agg(
        F.min("doc_id").alias("first"), *([chosen.alias("best")] if keyed else [])
    )
    distinct = settle(distinct, "distinct-fingerprints")
    joined = components(links(distinct.select("fp"), distinct.count(), radius, tile))
    rooted = (
        distinct.join(joined.withColumnRenamed("node", "fp"), "fp", "left")
        .withColumn("root", F.coalesce("root", "fp"))
    )
    best = [F.min("best").alias("best")] if keyed else []
    named = rooted.drop("best").join(
        rooted.groupBy("root").agg(F.min("first").alias("component_id"), *best), "root"
    )
    return prints.join(named.drop("root", "first"), "fp")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``."""
    return _grouped(docs, shingle, radius, tile).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def first_of_each(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE,
    unnamed: bool = False,
) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, all columns kept.

    The row with the smallest doc_id stays, of several the one of the smallest text hash; rows
    without a doc_id come last if ``unnamed``, and all stay if not. Rows are told apart by doc_id and
    text, so a doc_id's texts in other groups are not concerned. Of rows equal in both one stays.
    """
    key = ["doc_id", "t", "u"]
    found = _grouped(docs, shingle, radius, tile, keyed=True).withColumn(
        "stays",
        F.col("doc_id").eqNullSafe(F.col("best.doc_id"))
        & (F.col("t") == F.col("best.t")) & (F.col("u") == F.col("best.u")),
    ).select(*key, "stays")
    if not unnamed:
        found = found.filter("doc_id is not null")
    found = settle(found, "components")
    left = without_rows(docs, found.filter("not stays").select(*key))
    repeated = found.filter("stays").groupBy(*key).count().filter("count > 1")
    repeated = settle(repeated.select(*key), "repeated-rows")
    if repeated.isEmpty():
        return left
    # Combined in the map tasks, however many rows repeat one.
    t, u = fresh_name(docs, "_t"), fresh_name(docs, "_u")
    again = only_rows(left, repeated).withColumns({t: F.xxhash64("text"), u: F.hash("text")})
    one = again.dropDuplicates(["doc_id", t, u]).drop(t, u)
    return without_rows(left, repeated).union(one)
