"""Near-duplicate vectors by sorted projection passes.

In a pass every vector gets ``BITS`` signs of random projections, and the vectors of a label are put in the
lexicographic order of these signs. Near vectors share a long beginning in most passes, so each
vector is compared with the ``WINDOW`` next ones, and pairs whose cosine reaches the threshold are links.
The order is cut into blocks that see the first ``WINDOW`` vectors of the following one, so a label
of any size stays spread. A block gives the links of a spanning forest, never all its pairs.

Passes come in batches of ``PASSES``. Of the links that a further batch finds, the share whose ends no earlier pass
had connected estimates what is still missing, whatever the data are like; batches go on until it is
at most ``MISSED``. A label of no more vectors than the window is compared whole by one pass.

Then the links inside each connected group are counted exactly, not only those the windows met: a group's
vectors are sorted by their angle to one of them, cut into tiles of ``TILE``, and tiles are compared where
their angles are near enough (angles obey the triangle inequality). Only counts leave the tiles.

Links need equal labels that are not null, and equal lengths. Vectors that are null, empty, zero or hold null
or non-finite components link with nothing. Equal vectors of a label are one class with a
number of rows: its rows link with each other. Every row comes back, repeated ones too. Rows with a null
vec_id are linked, but never name a component; one of such rows alone is null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.components import components
from tallyspan.llm.simhash import forest
from tallyspan.llm.tables import partitions
from tallyspan.operators.ordered import number_rows
from tallyspan.storage import settle

THRESHOLD = 0.98
BITS = 63
WINDOW = 64
BLOCK = 2048
PASSES = 6
MISSED = 0.005
TILE = 1024
SEED = 20240229
_LINKS = (
    "label is not null and embedding is not null and size(embedding) > 0"
    " and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf'))"
    " and exists(embedding, x -> x != 0)"
)


def _units(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, unit vectors) of the rows of each length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy()
    starts = np.cumsum(lengths) - lengths
    found = []
    for n in np.unique(lengths):
        places = np.flatnonzero(lengths == n)
        rows = flat[starts[places][:, None] + np.arange(n)]
        scaled = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares of huge values stay finite
        found.append((places, scaled / np.linalg.norm(scaled, axis=1, keepdims=True)))
    return found


def _one_length(column: pa.Array) -> np.ndarray:
    (_, units), = _units(column)
    return units


def _taking_part(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, label, embedding, n, k1, k2): equal vectors have equal keys."""
    clean = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))  # no negative zero
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    good = rows.filter(_LINKS).withColumn("embedding", clean)
    return good.withColumns({
        "n": F.size("embedding"), "k1": F.xxhash64("embedding"), "k2": F.hash("embedding")
    })


def _signs(first: int, count: int):
    """Each vector's keys in the passes ``first`` to ``first + count - 1``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                for places, units in _units(batch.column(3)):
                    some = [batch.column(c).take(pa.array(places)) for c in range(3)]
                    for turn in range(first, first + count):
                        random = np.random.default_rng([SEED, turn, units.shape[1]])
                        planes = random.standard_normal((units.shape[1], BITS))
                        keys = (units @ planes > 0) @ weights
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(places), turn, dtype=np.int32)), *some, pa.array(keys)],
                            names=["pass", "cid", "label", "n", "key"],
                        )

    return run


def _blocks(work, columns: list[str]):
    """Runs ``work`` on each run of rows with equal first column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def done():
            out = work(pa.Table.from_batches(held).combine_chunks())
            return pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=columns)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                if held and keys[a] != key:
                    yield done()
                    held = []
                key = keys[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield done()

    return run


def _in_windows(threshold: float, window: int):
    """Rows (key, position, own, cid, embedding) of one block: forest links among neighbours."""

    def work(block: pa.Table):
        cid = block.column("cid").to_numpy()
        own = block.column("own").to_numpy()
        units = _one_length(block.column("embedding"))
        left, right = [], []
        for at in range(0, len(cid), 256):
            end = min(at + 256, len(cid))
            near = units[at:end] @ units[at : end + window].T >= threshold
            i, j = np.nonzero(near)
            i, j = i + at, j + at
            keep = (i < j) & (j <= i + window) & own[i]
            left.append(i[keep])
            right.append(j[keep])
        label = forest(len(cid), np.concatenate(left), np.concatenate(right))
        moved = np.flatnonzero(label != np.arange(len(cid)))
        return cid[moved], cid[label[moved]]

    return _blocks(work, ["a", "b"])


def _pass_links(base: DataFrame, first: int, count: int, threshold: float, window: int,
                block: int) -> DataFrame:
    """Links (a, b) of classes that are neighbours in one of the passes."""
    group = ["pass", "label", "n"]
    label = dict(base.dtypes)["label"]
    keys = base.select("cid", "label", "n", "embedding").mapInArrow(
        _signs(first, count), f"pass int, cid long, label {label}, n int, key long"
    )
    placed = number_rows(keys, group, [F.col("key"), F.col("cid")]).select(
        *group, "cid", (F.col("position") - 1).alias("position")
    )
    at = F.floor(F.col("position") / block)
    # A block's first rows are also neighbours of the last ones of the block before.
    also = F.when(
        (F.col("position") % block < window) & (at > 0), F.array(at, at - 1)
    ).otherwise(F.array(at))
    dealt = placed.select(*group, "cid", "position", F.explode(also).alias("block")).select(
        F.xxhash64(*group, "block").alias("key"), "position",
        (F.floor(F.col("position") / block) == F.col("block")).alias("own"), "cid",
    )
    return (
        dealt.join(base.select("cid", "embedding"), "cid")
        .select("key", "position", "own", "cid", "embedding")
        .repartition(partitions(base.sparkSession), "key").sortWithinPartitions("key", "position")
        .mapInArrow(_in_windows(threshold, window), "a long, b long")
    )


def _connected(base: DataFrame, threshold: float, window: int, block: int, passes: int,
               missed: float) -> DataFrame:
    """(node, root) of the classes that are linked with others."""
    most = base.groupBy("label", "n").count().agg(F.max("count")).first()[0] or 0
    if most <= window + 1:
        return settle(components(_pass_links(base, 0, 1, threshold, window, block)), "near-vectors")
    turn, known = 0, None
    while True:
        links = settle(_pass_links(base, turn, passes, threshold, window, block), "vector-links")
        turn += passes
        if known is None:
            known = settle(components(links), "near-vectors")
            continue
        total = links.count()
        a = known.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = known.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        ends = links.join(a, "a", "left").join(b, "b", "left").select(
            F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")
        )
        fresh = settle(ends.filter("a != b").distinct(), "fresh-links")
        new = fresh.count()
        if new:
            old = known.select(F.col("node").alias("a"), F.col("root").alias("b")).filter("a != b")
            known = settle(components(old.union(fresh)), "near-vectors")
        if new <= missed * total:
            return known


def _in_tiles(threshold: float):
    """Rows (key, side, cid, rows, embedding) of two tiles, or of one: each class's linked rows."""

    def work(tiles: pa.Table):
        side = tiles.column("side").to_numpy()
        cid, rows = tiles.column("cid").to_numpy(), tiles.column("rows").to_numpy()
        units = _one_length(tiles.column("embedding"))
        cut = int(np.searchsorted(side, 1))
        if cut == len(side):
            near = units @ units.T >= threshold
            np.fill_diagonal(near, False)
            return cid, near @ rows
        near = units[:cut] @ units[cut:].T >= threshold
        return cid, np.concatenate([near @ rows[cut:], rows[:cut] @ near])

    return _blocks(work, ["cid", "linked"])


def _pivot_angles():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            angle = np.zeros(batch.num_rows)
            for (places, units), (_, pivots) in zip(_units(batch.column(2)), _units(batch.column(3))):
                cosine = np.einsum("ij,ij->i", units, pivots)
                angle[places] = np.arccos(np.clip(cosine, -1, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(angle)], names=["root", "cid", "angle"]
            )

    return run


def _linked_rows(base: DataFrame, known: DataFrame, threshold: float, tile: int) -> DataFrame:
    """(cid, linked): rows of the other classes that each class of a connected group links with."""
    spark = base.sparkSession
    vectors = base.select("cid", "embedding")
    pivots = known.select("root").distinct().join(
        vectors.toDF("root", "pivot"), "root"
    )
    apart = (
        known.join(vectors.withColumnRenamed("cid", "node"), "node").join(pivots, "root")
        .select("root", F.col("node").alias("cid"), "embedding", "pivot")
        .mapInArrow(_pivot_angles(), "root long, cid long, angle double")
    )
    placed = number_rows(apart, ["root"], [F.col("angle"), F.col("cid")]).select(
        "root", "cid", "angle", F.floor((F.col("position") - 1) / tile).alias("tile")
    )
    placed = settle(placed, "vector-tiles")
    tiles = placed.groupBy("root", "tile").agg(
        F.min("angle").alias("low"), F.max("angle").alias("high")
    )
    reach = math.acos(threshold) + 1e-6
    x, y = tiles.alias("x"), tiles.alias("y")
    # Grows with the square of a group's tiles, which counting its links exactly does.
    pairs = x.join(
        y, F.expr("x.root = y.root and x.tile <= y.tile") & (F.expr("y.low - x.high") <= reach)
    ).select(F.col("x.root").alias("root"), F.col("x.tile").alias("left"), F.col("y.tile").alias("right"))

    def end(tile: str, side: int):
        return F.struct(F.col(tile).alias("tile"), F.lit(side).alias("side"))

    ends = pairs.select(
        "root", F.xxhash64("root", "left", "right").alias("key"),
        F.explode(
            F.when(F.col("left") == F.col("right"), F.array(end("left", 0)))
            .otherwise(F.array(end("left", 0), end("right", 1)))
        ).alias("end"),
    ).select("root", "key", "end.tile", "end.side")
    return (
        placed.join(ends, ["root", "tile"]).join(base.select("cid", "rows", "embedding"), "cid")
        .select("key", "side", "cid", "rows", "embedding")
        .repartition(partitions(spark), "key").sortWithinPartitions("key", "side")
        .mapInArrow(_in_tiles(threshold), "cid long, linked long")
        .groupBy("cid").agg(F.sum("linked").alias("linked"))
    )


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, window: int = WINDOW,
                    block: int = BLOCK, passes: int = PASSES, missed: float = MISSED,
                    tile: int = TILE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors`` (vec_id, embedding, label)."""
    good = _taking_part(vectors)
    same = ["label", "n", "k1", "k2"]
    classes = good.groupBy(*same).agg(F.count("*").alias("rows"), F.min("vec_id").alias("first"))
    classes = settle(
        number_rows(classes, [], [F.col(c) for c in same], "cid").select(*same, "rows", "first", "cid"),
        "vector-classes",
    )
    one = good.select(*same, "embedding").dropDuplicates(same)
    base = settle(one.join(classes.drop("first"), same).drop("k1", "k2"), "class-vectors")
    known = _connected(base, threshold, window, block, passes, missed)
    linked = _linked_rows(base, known, threshold, tile)
    rooted = classes.join(known.withColumnRenamed("node", "cid"), "cid", "left").withColumn(
        "root", F.coalesce("root", "cid")
    )
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    found = rooted.join(names, "root").join(linked, "cid", "left").select(
        *same, (F.col("rows") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id"
    )
    found = settle(found, "vector-groups")
    rows = good.select("vec_id", *same).join(found, same).select("vec_id", "n_links", "component_id")
    out = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding").filter(f"not coalesce({_LINKS}, false)")
    alone = out.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return rows.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
