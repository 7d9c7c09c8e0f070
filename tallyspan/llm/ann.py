"""Approximate nearest neighbours by cross-polytope hashing.

Unit vectors go through three rounds of random signs and a fast Hadamard transform; the
nearest signed axis, the largest component and its sign, is the hash. A table joins ``hashes`` of
them, ``HASHES`` at every size of the input unless the caller asks for more and smaller buckets. Every vector is
filed once in each of ``TABLES`` tables; a query looks into its own bucket and the next best ones,
which come out of the sorted axes of each hash without all combinations being formed.

How many buckets it looks into is measured, not guessed: ``SAMPLE`` queries are answered by
brute force over all rows in one pass, and the number is the smallest one that finds ``RECALL`` of
their neighbours. The sample is all that the index is fitted on; every row is filed. Queries that
find too few rows there look into eight times as many buckets, and so on; what is still short after that is held
against all rows, in blocks.

Candidates are not written out as pairs. The vectors of a bucket and the queries that look into it
meet in one task, in parts of at most ``PART`` vectors, and every query takes its best few from
there by exact cosine in double precision.

Equal vectors are one class: only the first is filed, and a class needs no more members than the
neighbours asked for, and one, since they tie and the smaller ids win. Vectors that are null,
empty, zero, or hold null or non-finite components take no part, nor do rows without vec_id. Vectors of
different lengths have no cosine: each length has an index of its own, and lengths are searched one after another.
Repeated rows count once; of a vec_id with several vectors each has its own list, and none is in another's.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.tables import partitions
from tallyspan.storage import settle

TABLES = 4
HASHES = 1
SAMPLE = 96
RECALL = 0.96
PART = 8192
SEED = 20240229


class Index:
    """The pseudo-rotations of all tables."""

    def __init__(self, dimension: int, hashes: int, tables: int = TABLES, seed: int = SEED):
        self.dimension, self.hashes, self.tables = dimension, hashes, tables
        self.width = 1 << max(0, dimension - 1).bit_length()
        random = np.random.default_rng(seed)
        self.signs = random.choice([-1.0, 1.0], size=(tables, hashes, 3, self.width))
        self.buckets = (2 * self.width) ** hashes

    def _rotated(self, units: np.ndarray, table: int, k: int) -> np.ndarray:
        x = np.zeros((len(units), self.width))
        x[:, : self.dimension] = units
        for signs in self.signs[table, k]:
            x = x * signs
            half = 1
            while half < self.width:
                pairs = x.reshape(len(x), -1, 2, half)
                a, b = pairs[:, :, 0], pairs[:, :, 1]
                x = np.stack([a + b, a - b], axis=2).reshape(len(x), self.width)
                half *= 2
            x /= np.sqrt(self.width)
        return np.concatenate([x, -x], axis=1)

    def bucket(self, units: np.ndarray, table: int) -> np.ndarray:
        found = np.zeros(len(units), dtype=np.int64)
        for k in range(self.hashes):
            found = found * 2 * self.width + self._rotated(units, table, k).argmax(axis=1)
        return found

    def _nearest(self, units: np.ndarray, table: int, count: int) -> tuple[np.ndarray, np.ndarray]:
        """(buckets, sums of their axes' components), the ``count`` largest sums of each row."""
        rows = np.arange(len(units))[:, None]
        found = np.zeros((len(units), 1), dtype=np.int64)
        total = np.zeros((len(units), 1))
        for k in range(self.hashes):
            side = self._rotated(units, table, k)
            axes = np.argsort(-side, axis=1, kind="stable")[:, :count]
            # With both sorted, place (i, j) has (i + 1) * (j + 1) - 1 others before it at least.
            i, j = np.array([
                (i, j) for i in range(total.shape[1]) for j in range(min(axes.shape[1], -(-count // (i + 1))))
                if (i + 1) * (j + 1) <= count
            ]).T
            sums = total[:, i] + side[rows, axes[:, j]]
            best = np.argsort(-sums, axis=1, kind="stable")[:, :count]
            total = np.take_along_axis(sums, best, axis=1)
            found = found[rows, i[best]] * 2 * self.width + axes[rows, j[best]]
        return found, total

    def probes(self, units: np.ndarray, table: int, count: int) -> np.ndarray:
        return self._nearest(units, table, min(count, self.buckets))[0]

    def ranks(self, asked: np.ndarray, units: np.ndarray, table: int) -> np.ndarray:
        """At which place of each ``asked`` vector's probes the bucket of its partner in ``units`` comes."""
        bucket = self.bucket(units, table)
        sides = [self._rotated(asked, table, k) for k in range(self.hashes)]
        axes = []
        for _ in sides:
            axes.append(bucket % (2 * self.width))
            bucket = bucket // (2 * self.width)
        axes.reverse()
        rows = np.arange(len(asked))
        mine = sum(side[rows, axis] for side, axis in zip(sides, axes))
        places = np.ones(len(asked), dtype=np.int64)
        for row in rows:
            sums = np.zeros(1)
            for side in sides[:-1]:
                sums = (sums[:, None] + side[row]).reshape(-1)
            last = np.sort(sides[-1][row])
            above = len(last) - np.searchsorted(last, mine[row] - sums + 1e-12, side="right")
            places[row] += int(above.sum())
        return places


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().astype(np.float64).reshape(-1, dimension)


def _units(rows: np.ndarray) -> np.ndarray:
    largest = np.abs(rows).max(axis=1, keepdims=True, initial=0.0)
    scaled = rows / np.where(largest > 0, largest, 1.0)  # squares of huge values stay finite
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _best(queries: np.ndarray, units: np.ndarray, ids: np.ndarray, count: int):
    """(query place, id, cosine) of the best ``count`` of ``units`` for each query; ties by id."""
    cosines = queries @ units.T
    order = np.lexsort((np.broadcast_to(ids, cosines.shape), -cosines), axis=1)[:, :count] \
        if len(ids) <= 4 * count else None
    if order is None:
        part = np.argpartition(-cosines, count - 1, axis=1)[:, :count]
        edge = np.take_along_axis(cosines, part, axis=1).min(axis=1, keepdims=True)
        place, at = np.nonzero(cosines >= edge)  # with everything that ties with the last one
        score = cosines[place, at]
        order = np.lexsort((ids[at], -score, place))
        place, at, score = place[order], at[order], score[order]
        rank = np.arange(len(place)) - np.searchsorted(place, place)
        keep = rank < count
        return place[keep], ids[at[keep]], score[keep]
    place = np.repeat(np.arange(len(queries)), order.shape[1])
    return place, ids[order].reshape(-1), np.take_along_axis(cosines, order, axis=1).reshape(-1)


def usable(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, embedding) that take part."""
    double = F.col("embedding").cast("array<double>")
    good = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), double.alias("embedding"))
    return good.filter(
        "vec_id is not null and embedding is not null and size(embedding) > 0"
        " and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf'))"
        " and exists(embedding, x -> x != 0)"
    )


def _measured_probes(base: DataFrame, queries: DataFrame, index: Index, neighbours: int,
                     recall: float) -> int:
    """The fewest buckets a table that find ``recall`` of a sample's true neighbours."""
    sample = queries.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    if not sample.num_rows:
        return 1
    asked = _units(_matrix(sample.column("embedding"), index.dimension))
    own = sample.column("id").to_numpy()
    dimension = index.dimension

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column(1), dimension)
                ids = batch.column(0).to_numpy()
                for at in range(0, len(ids), PART):
                    place, found, score = _best(
                        asked, _units(rows[at : at + PART]), ids[at : at + PART], neighbours + 1
                    )
                    near = np.searchsorted(np.sort(ids), found)
                    vectors = rows[np.argsort(ids)[near]]
                    ends = np.arange(len(found) + 1, dtype=np.int32) * dimension
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(place), pa.array(found), pa.array(score), pa.ListArray.from_arrays(
                            pa.array(ends), pa.array(vectors.reshape(-1)))],
                        names=["place", "id", "score", "embedding"],
                    )

    spec = Window.partitionBy("place").orderBy(F.desc("score"), "id")
    exact = (
        base.mapInArrow(brute, "place long, id long, score double, embedding array<double>")
        .withColumn("rank", F.row_number().over(spec))
        .filter(F.col("rank") <= neighbours + 1)
        .toArrow()
    )  # at most SAMPLE * (neighbours + 1) rows
    place, ids = exact.column("place").to_numpy(), exact.column("id").to_numpy()
    other = ids != own[place]
    place, units = place[other], _units(_matrix(exact.column("embedding"), dimension)[other])
    if not len(place):
        return 1
    needed = np.full(len(place), index.buckets)
    for table in range(index.tables):
        needed = np.minimum(needed, index.ranks(asked[place], units, table))
    return int(np.sort(needed)[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)])


def _search(dimension: int, count: int):
    """Rows (key, is_query, id, embedding) sorted by key and side, to the best of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = units = ids = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            side = batch.column(1).to_numpy(zero_copy_only=False)
            who = batch.column(2).to_numpy()
            rows = _units(_matrix(batch.column(3), dimension))
            cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (side[1:] != side[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(keys)]):
                if side[a] == 0:
                    if key == keys[a]:  # vectors of one part that came in two batches
                        units = np.concatenate([units, rows[a:b]])
                        ids = np.concatenate([ids, who[a:b]])
                    else:
                        key, units, ids = keys[a], rows[a:b], who[a:b]
                elif key == keys[a]:
                    for at in range(a, b, 512):
                        top = min(at + 512, b)
                        place, found, score = _best(rows[at:top], units, ids, count)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(who[at:top][place]), pa.array(found), pa.array(score)],
                            names=["query", "id", "score"],
                        )

    return run


def neighbours(vectors: DataFrame, asked: Column, count: int = 5, tables: int = TABLES,
               recall: float = RECALL, part: int = PART, hashes: int = HASHES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the nearest found of every row that ``asked`` is true for."""
    good = usable(vectors)
    length = F.size("embedding")
    lengths = sorted(r["n"] for r in good.select(length.alias("n")).distinct().toLocalIterator())
    found = [
        _among(good.filter(length == n) if len(lengths) > 1 else good, n, asked, count, tables,
               recall, part, hashes)
        for n in lengths or [1]
    ]
    return reduce(DataFrame.union, found)


def _among(good: DataFrame, dimension: int, asked: Column, count: int, tables: int, recall: float,
           part: int, hashes: int) -> DataFrame:
    """``neighbours`` among vectors of one length."""
    spark = good.sparkSession
    # Equal vectors have equal keys; 96 bits tell different ones apart.
    good = good.withColumns({"k1": F.xxhash64("embedding"), "k2": F.hash("embedding")})
    narrow = settle(good.select("vec_id", "k1", "k2").distinct(), "vector-keys")
    spec = Window.partitionBy("k1", "k2").orderBy("vec_id")
    members = settle(
        narrow.withColumn("n", F.row_number().over(spec)).filter(F.col("n") <= count + 1), "members"
    )
    named = members.groupBy("k1", "k2").agg(
        F.min("vec_id").alias("id"), F.sort_array(F.collect_list("vec_id")).alias("ids")
    )  # at most count + 1 ids each
    named = settle(named, "classes")
    base = settle(
        good.drop("k1", "k2").withColumnRenamed("vec_id", "id")
        .join(named.select("id"), "id", "left_semi").dropDuplicates(["id"]),
        "vectors",
    )
    queries = narrow.filter(asked).join(named.select("k1", "k2", "id"), ["k1", "k2"]).select(
        F.col("vec_id").alias("query_id"), "id"
    )
    queries = settle(queries, "queries")
    asking = base.join(queries.select("id").distinct(), "id", "left_semi")

    index = Index(dimension, hashes, tables)
    look = _measured_probes(base, asking, index, count, recall)

    def file(probes: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            step = max(1, min(1024, (1 << 19) // max(1, probes)))
            for batch in batches:
                for at in range(0, batch.num_rows, step):
                    rows = batch.slice(at, step)
                    units = _units(_matrix(rows.column(1), dimension))
                    for table in range(tables):
                        if probes:
                            found = index.probes(units, table, probes)
                        else:
                            found = index.bucket(units, table)[:, None]
                        n = found.size
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, table, dtype=np.int32)),
                             pa.array(found.reshape(-1)),
                             pa.array(np.repeat(rows.column(0).to_numpy(), found.shape[1]))],
                            names=["table", "bucket", "id"],
                        )
        return run

    places = "table int, bucket long, id long"
    filed = settle(base.mapInArrow(file(0), places), "filed")
    # A row per bucket at most: tables * (2 * width) ** hashes.
    parts = filed.groupBy("table", "bucket").agg(
        F.ceil(F.count("*") / part).cast("int").alias("parts")
    )
    key = F.xxhash64("table", "bucket", "part").alias("key")
    left = filed.join(parts, ["table", "bucket"]).withColumn(
        "part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    ).select(key, F.lit(0).alias("side"), "id")
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "id")

    def in_buckets(looked: DataFrame) -> DataFrame:
        right = looked.join(parts, ["table", "bucket"]).withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        ).select(key, F.lit(1).alias("side"), "id")
        return nearest(left, right)

    def in_all(looking: DataFrame) -> DataFrame:
        blocks = max(1, -(-base.count() // part))
        rows = base.select(
            F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("key"), F.lit(0).alias("side"), "id"
        )
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("key")
        right = looking.select(each, F.lit(1).alias("side"), "id")
        return nearest(rows, right)

    def nearest(left: DataFrame, right: DataFrame) -> DataFrame:
        met = left.union(right).join(base, "id").select("key", "side", "id", "embedding")
        found = (
            met.repartition(partitions(spark), "key")
            .sortWithinPartitions("key", "side")
            .mapInArrow(_search(dimension, count + 1), "query long, id long, score double")
        )
        best = found.groupBy("query", "id").agg(F.max("score").alias("score"))
        best = best.withColumn("n", F.row_number().over(ranked)).filter(F.col("n") <= count + 1)
        return settle(best.drop("n"), "nearest")

    classes = in_buckets(asking.mapInArrow(file(look), places))
    members = named.select("id", F.size("ids").alias("members"))
    while look < index.buckets:
        enough = classes.join(members, "id").groupBy("query").agg(F.sum("members").alias("rows"))
        enough = enough.filter(F.col("rows") > count).select(F.col("query").alias("id"))
        short = settle(asking.join(enough, "id", "left_anti"), "short-queries")
        if short.isEmpty():
            break
        look *= 8
        if look * 4 > index.buckets:
            look = index.buckets
            more = in_all(short)
        else:
            more = in_buckets(short.mapInArrow(file(look), places))
        known = classes.join(
            short.select(F.col("id").alias("query")), "query", "left_anti"
        ).select("query", "id", "score")
        classes = known.union(more)
    each = classes.join(named.select("id", "ids"), "id").select(
        "query", "score", F.explode("ids").alias("vec_id")
    )
    in_class = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    lists = (
        each.withColumn("n", F.row_number().over(in_class)).filter(F.col("n") <= count + 1)
        .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("l"))
    )
    own = F.filter("l", lambda x: x["vec_id"] != F.col("query_id"))
    return (
        queries.join(lists, queries["id"] == lists["query"])
        .select("query_id", F.posexplode(F.slice(own, 1, count)).alias("at", "x"))
        .select(
            "query_id", (F.col("at") + 1).cast("int").alias("rank"),
            F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"),
        )
    )
