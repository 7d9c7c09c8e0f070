"""Hard negatives by inner product, from candidate lists that clusters of anchors share.

Anchors are clustered by direction. For a cluster with centre c whose members lie within the angle b of
it, no member u can have a product above ``|u| * |i| * cos(max(0, angle(i, c) - b))`` with candidate i. The
candidates of a cluster are sorted by that bound (without ``|u|``, so one order serves all members) once;
each member walks the list and stops when what it has found is above the bound of all that follows.

A list is walked in segments, each ``GROWTH`` times as long as all before it. A round sends the next
segment to the clusters that have members still walking; a segment is cut into parts of at most ``PART_BYTES`` and
a cluster's members into blocks of ``MEMBERS``, so no task holds more, and inside a task the part is walked in
the order of the bounds. Nobody stops uncertified: the last segment ends where the list ends. Segments follow from
a histogram of the bounds (``BINS`` counts a cluster).

The first walk is for positives (rows of the anchor's label), the second for negatives (other labels),
whose products must lie in a window below each positive; a member also stops once the bound falls
below its windows.

Only the centres come from a sample (of ``SAMPLE`` anchors at most, chosen by hash); the result does
not depend on them. Products are exact: components are integers, cut at the size at which sums would pass
64 bits. Rows meet rows of their own vector length. Rows with a null id, label or vector, or a null component,
take no part; equal rows count once; rows that share an id are rows of their own, in the order of label and
vector. A zero vector has product 0 with all. Without anchors, positives or negatives there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.tables import partitions
from tallyspan.operators.ordered import number_rows
from tallyspan.storage import settle

CLUSTERS = 8
SAMPLE = 4096
BINS = 1024
#: Candidates in a cluster's first segment.
FIRST = 8192
GROWTH = 4
PART_BYTES = 16 << 20
MEMBERS = 2048
STEP = 512
SEED = 20240229
LOW = -(2**63) + 1
HIGH = 2**63 - 1
_MET = ("key long, side int, row long, vec_id long, label long, n int, bound double, "
        "lo array<long>, hi array<long>, least array<long>, vector array<long>")


class Lists(NamedTuple):
    """The shared lists: what a task needs to find a candidate's place in each of them."""

    centres: np.ndarray
    #: Largest angle of a member to its cluster's centre.
    angles: np.ndarray
    #: No candidate is longer.
    longest: float

    def bounds(self, vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """The most that a unit vector of each cluster can have as product with each vector."""
        cosines = vectors @ self.centres.T / np.where(norms > 0, norms, 1.0)[:, None]
        apart = np.arccos(np.clip(cosines, -1, 1)) - self.angles
        return norms[:, None] * np.cos(np.maximum(apart, 0.0))

    def bins(self, bounds: np.ndarray) -> np.ndarray:
        if self.longest <= 0:
            return np.zeros(bounds.shape, dtype=np.int64)
        place = np.floor((bounds / self.longest + 1) / 2 * BINS).astype(np.int64)
        return np.clip(place, 0, BINS - 1)

    def top(self, place: int) -> float:
        """No bound in this bin or a lower one is above it, rounding included."""
        return self.longest * ((place + 1) / BINS * 2 - 1 + 1e-7)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of 64-bit integers, shorter ones with zeros behind."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy()
    lengths = column.value_lengths().to_numpy()
    if (lengths == width).all():
        return flat.reshape(-1, width)
    rows = np.zeros((len(lengths), width), dtype=np.int64)
    rows[np.arange(width) < lengths[:, None]] = flat
    return rows


def _norms(rows: np.ndarray) -> np.ndarray:
    return np.linalg.norm(rows.astype(np.float64), axis=1)


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors."""
    most = max(np.abs(left).max(initial=0), np.abs(right).max(initial=0))
    if float(most) ** 2 * left.shape[1] < 2**53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left @ right.T


def numbered(vectors: DataFrame) -> DataFrame:
    """``vectors`` (vec_id, label, vector) that take part, by ``row``, which follows vec_id."""
    limit = F.floor(F.sqrt(F.lit(float(2**62)) / F.size("vector"))).cast("long")
    cut = F.transform(
        F.col("vector").cast("array<long>"), lambda x: F.greatest(F.least(x, limit), -limit)
    )
    good = vectors.filter(
        "vec_id is not null and label is not null and vector is not null and size(vector) > 0"
        " and forall(vector, x -> x is not null)"
    ).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        cut.alias("vector"),
    ).distinct()
    order = [F.col("vec_id"), F.col("label"), F.xxhash64("vector"), F.hash("vector")]
    return settle(number_rows(good, [], order, "row"), "numbered-vectors").select(
        "row", "vec_id", "label", F.size("vector").alias("n"), "vector"
    )


def _centres(anchors: DataFrame, width: int, clusters: int) -> np.ndarray:
    """Centres of spherical k-means over a bounded sample of the anchors."""
    sample = anchors.select("row", "vector").orderBy(F.xxhash64("row"), "row").limit(SAMPLE).toArrow()
    rows = _matrix(sample.column("vector"), width).astype(np.float64)
    norms = _norms(rows)
    units = rows[norms > 0] / norms[norms > 0, None]
    if not len(units):
        return np.eye(1, width)
    random = np.random.default_rng(SEED)
    centres = units[random.permutation(len(units))[:clusters]]
    for _ in range(10):
        near = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, units)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 1e-9, sums / np.where(size > 1e-9, size, 1.0), centres)
    return centres


def _members(anchors: DataFrame, centres: np.ndarray, width: int) -> DataFrame:
    """Anchors with their cluster, the angle to its centre and their length."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(4), width)
            norms = _norms(rows)
            cosines = rows @ centres.T / np.where(norms > 0, norms, 1.0)[:, None]
            near = cosines.argmax(axis=1)
            angle = np.arccos(np.clip(cosines.max(axis=1), -1, 1)) * (norms > 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near.astype(np.int32)), pa.array(angle), pa.array(norms)],
                names=["row", "vec_id", "label", "n", "vector", "cluster", "angle", "norm"],
            )

    schema = ("row long, vec_id long, label long, n int, vector array<long>, cluster int, "
              "angle double, norm double")
    return settle(anchors.mapInArrow(assign, schema), "anchors")


def _histogram(rows: DataFrame, lists: Lists, width: int) -> np.ndarray:
    """How many candidates each cluster's list has in each bin of bounds."""
    clusters = len(lists.centres)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((clusters, BINS), dtype=np.int64)
        for batch in batches:
            vectors = _matrix(batch.column(0), width)
            for c, place in enumerate(lists.bins(lists.bounds(vectors, _norms(vectors))).T):
                counts[c] += np.bincount(place, minlength=BINS)
        c, place = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c), pa.array(place), pa.array(counts[c, place])], names=["c", "bin", "n"]
        )

    found = rows.select("vector").mapInArrow(scan, "c long, bin long, n long")
    total = np.zeros((clusters, BINS), dtype=np.int64)
    for r in found.groupBy("c", "bin").agg(F.sum("n").alias("n")).collect():
        total[r["c"], r["bin"]] = r["n"]
    return total


def _segments(counts: np.ndarray, first: int, growth: int) -> list[tuple[int, int, int]]:
    """(from bin, to bin, candidates) from the highest bounds down to the list's end."""
    segments, end, size, target = [], BINS, 0, first
    for place in range(BINS - 1, -1, -1):
        size += int(counts[place])
        if size >= target or place == 0:
            segments.append((place, end, size))
            target, end, size = target * growth, place, 0
    return segments


def _send(lists: Lists, width: int, ranges: dict[int, tuple[int, int]], blocks: dict[int, int],
          parts: dict[int, int]):
    """Candidates to the blocks of the clusters in whose present segments they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                vectors = _matrix(batch.column(4), width)
                bounds = lists.bounds(vectors, _norms(vectors))
                bins = lists.bins(bounds)
                row = batch.column(0).to_numpy()
                for c, (low, high) in ranges.items():
                    here = np.flatnonzero((bins[:, c] >= low) & (bins[:, c] < high))
                    if not len(here):
                        continue
                    part = (row[here] * 2654435761 >> 7) % parts[c]
                    some = batch.take(pa.array(here))
                    for block in range(blocks[c]):
                        n = len(here)
                        none = pa.nulls(n, pa.list_(pa.int64()))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array((c << 48) + (block << 24) + part),
                             pa.array(np.ones(n, dtype=np.int32)), *some.columns[:4],
                             pa.array(bounds[here, c]), none, none, none, some.column(4)],
                            names=["key", "side", "row", "vec_id", "label", "n", "bound",
                                   "lo", "hi", "least", "vector"],
                        )

    return run


class Part(NamedTuple):
    row: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    n: np.ndarray
    vector: np.ndarray


def _walk(asked: Part, lo: np.ndarray, hi: np.ndarray, least: np.ndarray, listed: Part,
          bound: np.ndarray, longest: float, same: bool, count: int):
    """(member, slot, score, row, vec_id): the best ``count`` in each member's windows.

    ``least``: what a member has already for a slot; nothing below it is wanted.
    """
    norms = _norms(asked.vector)
    slots = lo.shape[1]
    best = [(np.zeros(0, dtype=np.int64),) * 4 for _ in range(slots)]
    # Positives come from the members' own labels only, so each label's list is walked by itself.
    groups = np.unique(asked.label) if same else [None]
    for group in groups:
        members = np.flatnonzero(asked.label == group) if same else np.arange(len(asked.row))
        chosen = np.flatnonzero(listed.label == group) if same else np.arange(len(listed.row))
        order = chosen[np.argsort(-bound[chosen], kind="stable")]
        for at in range(0, len(order), STEP):
            reach = norms[members] * (bound[order[at]] + 1e-7 * longest)
            walking = ((lo[members] <= hi[members]) & (reach[:, None] >= lo[members])
                       & (reach[:, None] >= least[members])).any(axis=1)
            members = members[walking]
            if not len(members):
                break
            some = order[at : at + STEP]
            scores = _products(asked.vector[members], listed.vector[some])
            fits = listed.n[some] == asked.n[members][:, None]
            fits &= listed.row[some] != asked.row[members][:, None]
            if not same:
                fits &= listed.label[some] != asked.label[members][:, None]
            for slot in range(slots):
                inside = fits & (scores >= lo[members, slot][:, None])
                inside &= scores <= hi[members, slot][:, None]
                held = np.where(inside, scores, LOW)
                last = (np.partition(held, -count, axis=1)[:, -count] if len(some) > count
                        else held.min(axis=1))
                floor = np.maximum(np.maximum(last, least[members, slot]), LOW + 1)
                m, j = np.nonzero(held >= floor[:, None])
                if not len(m):
                    continue
                a = np.concatenate([best[slot][0], members[m]])
                score = np.concatenate([best[slot][1], held[m, j]])
                row = np.concatenate([best[slot][2], listed.row[some[j]]])
                who = np.concatenate([best[slot][3], listed.vec_id[some[j]]])
                by = np.lexsort((row, -score, a))
                a, score, row, who = a[by], score[by], row[by], who[by]
                rank = np.arange(len(a)) - np.searchsorted(a, a)
                keep = rank < count
                best[slot] = a[keep], score[keep], row[keep], who[keep]
                full = rank == count - 1
                least[a[full], slot] = np.maximum(least[a[full], slot], score[full])
    slot = np.concatenate([np.full(len(b[0]), k) for k, b in enumerate(best)])
    return (*[np.concatenate([b[k] for b in best]) for k in range(4)], slot)


def _search(width: int, longest: float, same: bool, count: int):
    """Rows sorted by key and side, members first, to what the members find in the part."""

    def found(held: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        table = pa.Table.from_batches(held).combine_chunks()
        side = table.column("side").to_numpy()
        cut = int(np.searchsorted(side, 1))
        if cut in (0, len(side)):
            return None
        sides = []
        for rows in (table.slice(0, cut), table.slice(cut)):
            sides.append(Part(*[rows.column(c).to_numpy() for c in ("row", "vec_id", "label", "n")],
                              _matrix(rows.column("vector"), width)))
        bound = table.slice(cut).column("bound").to_numpy()
        lo, hi, least = (
            np.array(table.slice(0, cut).column(c).combine_chunks().flatten().to_numpy()).reshape(cut, -1)
            for c in ("lo", "hi", "least")
        )
        a, score, row, who, slot = _walk(sides[0], lo, hi, least, sides[1], bound, longest, same, count)
        return pa.RecordBatch.from_arrays(
            [pa.array(sides[0].row[a]), pa.array(slot.astype(np.int32)), pa.array(score),
             pa.array(row), pa.array(who)],
            names=["anchor", "slot", "score", "row", "vec_id"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                if held and keys[a] != key:
                    if (out := found(held)) is not None:
                        yield out
                    held = []
                key = keys[a]
                held.append(batch.slice(a, b - a))
        if held and (out := found(held)) is not None:
            yield out

    return run


def _rounds(rows: DataFrame, asked: DataFrame, lists: Lists, counts: np.ndarray, width: int,
            same: bool, count: int, first: int, members: int) -> DataFrame:
    """(anchor, slot, score, row, vec_id, rank): the first ``count`` in every window of ``asked``."""
    spark = rows.sparkSession
    plans = [_segments(c, first, GROWTH) for c in counts]
    part_rows = max(STEP, PART_BYTES // (8 * width))
    slots = F.size("lo")
    nothing = F.array_repeat(F.lit(LOW), slots)
    best = spark.createDataFrame([], "anchor long, slot int, score long, row long, vec_id long, rank int")
    walking = asked.withColumn("least", nothing)
    for turn in range(max(map(len, plans))):
        ranges = {c: p[turn][:2] for c, p in enumerate(plans) if turn < len(p) and p[turn][2]}
        heads = [lists.top(p[turn][1] - 1) if turn < len(p) else float("-inf") for p in plans]
        reach = F.col("norm") * F.array(*map(F.lit, heads))[F.col("cluster")]
        open_slot = F.exists(
            F.arrays_zip("lo", "hi", "least"),
            lambda x: (x["lo"] <= x["hi"]) & (reach >= x["lo"]) & (reach >= x["least"]),
        )
        # A zero vector reaches 0 in every segment; minus infinity times 0 is no number.
        ended = F.array(*[F.lit(turn >= len(p)) for p in plans])[F.col("cluster")]
        walking = settle(walking.filter(~ended & open_slot), "walking")
        active = {r["cluster"]: r["count"] for r in walking.groupBy("cluster").count().collect()}
        if not active:
            break
        ranges = {c: r for c, r in ranges.items() if c in active}
        if not ranges:
            continue
        blocks = {c: -(-active[c] // members) for c in ranges}
        parts = {c: -(-plans[c][turn][2] // part_rows) for c in ranges}

        def of(given: dict[int, int]) -> Column:
            return F.array(*[F.lit(given.get(c, 0)).cast("long") for c in range(len(plans))])[
                F.col("cluster")]

        block = F.pmod(F.xxhash64("row"), F.greatest(of(blocks), F.lit(1)))
        sent = walking.filter(of(parts) > 0).select(
            "*", block.alias("block"),
            F.explode(F.sequence(F.lit(0).cast("long"), of(parts) - 1)).alias("part"),
        ).select(
            (F.shiftleft(F.col("cluster").cast("long"), 48) + F.shiftleft("block", 24)
             + F.col("part")).alias("key"),
            F.lit(0).alias("side"), "row", "vec_id", "label", "n", F.lit(0.0).alias("bound"),
            "lo", "hi", "least", "vector",
        )
        listed = rows.mapInArrow(_send(lists, width, ranges, blocks, parts), _MET)
        new = (
            sent.union(listed).repartition(partitions(spark), "key").sortWithinPartitions("key", "side")
            .mapInArrow(_search(width, lists.longest, same, count),
                        "anchor long, slot int, score long, row long, vec_id long")
        )
        spec = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "row")
        best = settle(
            best.drop("rank").union(new).withColumn("rank", F.row_number().over(spec))
            .filter(F.col("rank") <= count),
            "best",
        )
        # At most a row for each of an anchor's windows.
        last = best.filter(F.col("rank") == count).groupBy("anchor").agg(
            F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("found")
        )
        kept = [c for c in walking.columns if c != "least"]
        walking = walking.join(last, walking["row"] == last["anchor"], "left").select(
            *kept,
            F.transform(
                F.sequence(F.lit(0), slots - 1),
                lambda k: F.coalesce(F.element_at("found", k), F.lit(LOW)),
            ).alias("least"),
        )
    return best


def mine(vectors: DataFrame, asked: Column, positives: int = 5, negatives: int = 3, least: int = 50,
         most: int = 95, clusters: int = CLUSTERS, first: int = FIRST,
         members: int = MEMBERS) -> DataFrame:
    """Hard negatives of the rows of ``vectors`` (vec_id, label, vector of integers) ``asked`` is true for.

    ``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``: for each anchor and
    each of its first ``positives`` rows of the same label, the first ``negatives`` rows of another label with
    a product of ``least`` to ``most`` hundredths of the positive's.
    """
    rows = numbered(vectors)
    anchors = rows.filter(asked)
    width = rows.agg(F.max("n")).first()[0] or 1
    centres = _centres(anchors, width, clusters)
    anchors = _members(anchors, centres, width)
    angles = np.zeros(len(centres))
    for r in anchors.groupBy("cluster").agg(F.max("angle").alias("angle")).collect():
        angles[r["cluster"]] = r["angle"]
    square = F.aggregate(
        "vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    longest = (rows.agg(F.max(F.sqrt(square))).first()[0] or 0.0) * (1 + 1e-9)
    lists = Lists(centres, angles, longest)
    counts = _histogram(rows, lists, width)
    near = _rounds(
        rows, anchors.withColumns({"lo": F.array(F.lit(LOW)), "hi": F.array(F.lit(HIGH))}),
        lists, counts, width, True, positives, first, members,
    ).select("anchor", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"),
             F.col("score").alias("positive_score"))
    # Exact in 64 bits and beyond: hundredths are taken of quotient and remainder apart.
    def share(score: Column, percent: int, up: bool) -> Column:
        whole, rest = F.expr("positive_score div 100"), F.expr("positive_score % 100") * percent
        return whole * percent + (F.ceil(rest / 100) if up else F.floor(rest / 100))

    windows = near.withColumns({
        "low": share(F.col("positive_score"), least, True),
        "high": share(F.col("positive_score"), most, False),
    })
    windows = settle(windows, "positives")
    by_slot = windows.groupBy("anchor").agg(
        F.map_from_entries(F.collect_list(F.struct("slot", F.struct("low", "high")))).alias("w")
    )  # at most ``positives`` entries
    places = F.sequence(F.lit(0), F.lit(positives - 1))
    wanted = anchors.join(by_slot, anchors["row"] == by_slot["anchor"]).select(
        *anchors.columns,
        F.transform(places, lambda k: F.coalesce(F.element_at("w", k)["low"], F.lit(1))).alias("lo"),
        F.transform(places, lambda k: F.coalesce(F.element_at("w", k)["high"], F.lit(0))).alias("hi"),
    )
    far = _rounds(rows, wanted, lists, counts, width, False, negatives, first, members)
    return (
        far.select("anchor", "slot", "rank", F.col("vec_id").alias("negative_id"),
                   F.col("score").alias("negative_score"))
        .join(windows, ["anchor", "slot"])
        .join(anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                "positive_score", "negative_score")
    )


def whole_numbers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vectors`` with ``vector``: each component of ``embedding`` times ``scale``, rounded down.

    Null where a component is null or not finite; the null takes the row out of ``mine``.
    """
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return vectors.withColumn("vector", F.when(finite, scaled))
