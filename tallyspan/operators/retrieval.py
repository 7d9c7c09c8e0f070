"""Similarity search over documents, by vector or by words.

No question passes through the driver, and no plan grows with their number. By vector, blocks of questions
meet parts of the documents in tasks that keep their best k per question, so what is shuffled on is k rows per
question and part and never a question-document pair. By words, questions look into an inverted
index whose posting lists are cut into blocks by segments of the documents; a task adds up the blocks of a segment,
and what its documents can no longer gain is not added. An index that is kept is written with its blocks. Where documents are
searched once, the questions' words go to the tasks, which invert these words' postings and add them up at once: only
the documents' words and counts are written.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyspan.functions.rules import words
from tallyspan.operators.ordered import first_n
from tallyspan.storage import settle, settle_keys

# Questions that meet a part of the documents in one task, and numbers (64 MB) in such a part.
QUESTION_BLOCK = 2048
PART_CELLS = 1 << 23
# Scores are compared at this precision, so that equal texts tie wherever they lie.
SCORE_DIGITS = 9
# Documents in a segment of an index, and so postings in a block of a word's list, at most; postings (12 MB)
# in a segment, unless one document has more.
POSTINGS = 1 << 16
SEGMENT_CELLS = 1 << 20
# Word weights (32 MB) that are sent to the tasks at most; more of them are joined.
SENT_WORDS = 1 << 21
# Weights (96 MB) of the documents' words that are sent at most. Words of one document only need not be sent.
SENT_WEIGHTS = 3 << 21
# Pairs of two ids that are sent at most.
SENT_PAIRS = 1 << 18
# Weightiest blocks of a question that are added up before the rest is held against the bound.
LEADING_WORDS = 8
# Scores added up in another order differ by far less than this, and so do scores that tie.
MARGIN = 2 * 10.0**-SCORE_DIGITS


def finite(vector: Column) -> Column:
    """True for a vector that can be compared: not null, not empty, all components numbers."""
    return F.coalesce(
        vector.isNotNull() & (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))),
        F.lit(False),
    )


class _Best:
    """The k best documents per question seen so far, ties broken by id."""

    def __init__(self, questions: int, k: int):
        self.k = k
        self.rows: list[list[tuple[float, object]]] = [[] for _ in range(questions)]

    def offer(self, scores: np.ndarray, ids: Sequence) -> None:
        """``scores`` is documents x questions; only rows reaching the k-th best are sorted."""
        n = scores.shape[0]
        if n == 0:
            return
        floor = np.partition(scores, n - self.k, axis=0)[n - self.k] if n > self.k else None
        for q, kept in enumerate(self.rows):
            column = scores[:, q]
            bar = -np.inf if floor is None else floor[q]
            if len(kept) == self.k:
                bar = max(bar, -kept[-1][0])
            hits = np.flatnonzero(column >= bar)
            if hits.size:
                kept.extend((-float(column[i]), ids[i]) for i in hits)
                kept.sort()
                del kept[self.k:]

    def batch(self, question_ids: Sequence, schema: pa.Schema) -> pa.RecordBatch:
        flat = [(question_ids[q], i, -s) for q, kept in enumerate(self.rows) for s, i in kept]
        columns = list(zip(*flat)) if flat else [[], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema
        )


def _scan(
    docs: DataFrame, doc_key: str, question_key: str, question_kind: str, question_ids: list,
    k: int, score: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, list]]],
) -> DataFrame:
    """Score all documents against a few given vectors; best k per partition."""
    doc_kind = docs.schema[doc_key].dataType
    schema = pa.schema(
        [(question_key, pa.int32()), (doc_key, to_arrow_type(doc_kind)), ("score", pa.float64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(question_ids), k)
        for batch in batches:
            for scores, ids in score(batch):
                best.offer(np.round(scores, SCORE_DIGITS), ids)
        yield best.batch(question_ids, schema)

    return docs.mapInArrow(
        run, f"`{question_key}` {question_kind}, `{doc_key}` {doc_kind.simpleString()}, score double"
    )


def _ranked(found: DataFrame, question_key: str, doc_key: str, k: int) -> DataFrame:
    order = [F.col("score").desc(), F.col(doc_key)]
    return first_n(found, [question_key], order, k).withColumnRenamed("_rank", "rank")


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _vector_scan(docs, doc_key, vector, question_key, question_kind, ids, targets, k):
    unit = _unit_rows(np.asarray(targets, dtype=np.float64))

    def score(batch: pa.RecordBatch):
        if batch.num_rows:
            yield _unit_rows(_vectors(batch.column(1))) @ unit.T, batch.column(0).to_pylist()

    same = F.size(vector) == unit.shape[1]
    held = docs.select(doc_key, vector).filter(finite(F.col(vector)) & same)
    return _scan(held, doc_key, question_key, question_kind, ids, k, score)


def _best_in_parts(question_type, doc_type, k: int):
    """Rows (unit, side, question, doc, vector), questions first, to each question's best of the unit."""
    schema = pa.schema([("question", question_type), ("doc", doc_type), ("score", pa.float64())])

    def best(held: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        rows = pa.Table.from_batches(held).combine_chunks()
        cut = int(np.searchsorted(rows.column("side").to_numpy(), 1))
        if cut in (0, rows.num_rows):
            return None
        sides = [_unit_rows(_vectors(part.column("vector").combine_chunks()))
                 for part in (rows.slice(0, cut), rows.slice(cut))]
        ids = rows.slice(cut).column("doc").to_pylist()
        found = _Best(cut, k)
        for at in range(0, len(ids), 4096):
            scores = sides[1][at : at + 4096] @ sides[0].T
            found.offer(np.round(scores, SCORE_DIGITS), ids[at : at + 4096])
        return found.batch(rows.slice(0, cut).column("question").to_pylist(), schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, unit = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            units = batch.column(0).to_numpy()
            cuts = np.flatnonzero(units[1:] != units[:-1]) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(units)]):
                if held and units[a] != unit:
                    if (out := best(held)) is not None:
                        yield out
                    held = []
                unit = units[a]
                held.append(batch.slice(a, b - a))
        if held and (out := best(held)) is not None:
            yield out

    return run


def question_doc_topk(
    questions: DataFrame, docs: DataFrame, k: int = 3, question_key: str = "question_id",
    question_vector: str = "question", doc_key: str = "doc_id", vector: str = "embedding",
    block: int = QUESTION_BLOCK, part_cells: int = PART_CELLS,
) -> DataFrame:
    """Exact best k documents for every question by cosine: ``(question, doc, score, rank)``.

    Vectors that are null, empty or hold null or non-finite components take no part; a question meets the
    documents of its own vector length. The documents go once to every ``block`` questions, in parts of ``part_cells``
    numbers, and a task holds one block and one part.
    """
    def ready(rows: DataFrame, key: str, value: str) -> DataFrame:
        held = F.col(value).cast("array<double>")
        return rows.filter(finite(F.col(value))).select(F.col(key).alias("id"), held.alias("vector"))

    asked = ready(questions, question_key, question_vector)
    held = ready(docs, doc_key, vector)
    # One row per vector length.
    sizes = asked.groupBy(F.size("vector").alias("n")).agg(
        F.ceil(F.count("*") / block).alias("blocks")
    ).join(held.groupBy(F.size("vector").alias("n")).agg(
        F.ceil(F.count("*") * F.first(F.size("vector")) / part_cells).alias("parts")), "n")
    sizes = settle(sizes, "vector-sizes")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        met = rows.withColumn("n", F.size("vector")).join(sizes, "n")
        mine = F.pmod(F.xxhash64("id"), F.col(own))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))
        return met.select("n", "id", "vector", mine.alias(own[:-1]), every.alias(other[:-1]))

    q_type, d_type = (rows.schema["id"].dataType for rows in (asked, held))
    unit = F.xxhash64("n", "block", "part").alias("unit")
    left = dealt(asked, "blocks", "parts").select(
        unit, F.lit(0).alias("side"), F.col("id").alias("question"),
        F.lit(None).cast(d_type).alias("doc"), "vector", "n", "block", "part")
    right = dealt(held, "parts", "blocks").select(
        unit, F.lit(1).alias("side"), F.lit(None).cast(q_type).alias("question"),
        F.col("id").alias("doc"), "vector", "n", "block", "part")
    found = (
        left.union(right)
        .repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "unit")
        .sortWithinPartitions("unit", "side").select("unit", "side", "question", "doc", "vector")
        .mapInArrow(
            _best_in_parts(to_arrow_type(q_type), to_arrow_type(d_type), k),
            f"question {q_type.simpleString()}, doc {d_type.simpleString()}, score double",
        )
    ).toDF(question_key, doc_key, "score")
    return _ranked(found, question_key, doc_key, k)


def similarity_topk(
    docs: DataFrame, query: Sequence[float], k: int = 3, doc_key: str = "doc_id",
    vector: str = "embedding",
) -> DataFrame:
    """Exact best k documents for one query vector."""
    found = _vector_scan(docs, doc_key, vector, "query", "int", [0], [list(query)], k)
    return _ranked(found, "query", doc_key, k).drop("query")


def centroids(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Mean vector per key, averaged map-side first."""
    mean = Summarizer.mean(array_to_vector(F.col(vector)))
    return df.groupBy(key).agg(vector_to_array(mean).alias("centroid"))


# -- approximate search -----------------------------------------------------


def _planes(dim: int, tables: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(dim, tables * bits))


def _codes(vectors: np.ndarray, tables: int, bits: int, seed: int) -> np.ndarray:
    """Bucket per vector and table: the sides of ``bits`` random planes, table number on top."""
    side = (vectors @ _planes(vectors.shape[1], tables, bits, seed) > 0).astype(np.int64)
    weights = 1 << np.arange(bits)
    code = side.reshape(len(vectors), tables, bits) @ weights
    return code + (np.arange(tables) << bits)


def lsh_table(
    docs: DataFrame, doc_key: str = "doc_id", vector: str = "embedding", tables: int = 6,
    bits: int = 6, seed: int = 7,
) -> DataFrame:
    """One row per document and hash table, with its bucket.

    Save it partitioned by ``bucket``: a search then reads only the buckets it probes.
    """
    kind = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(1).value_lengths().to_numpy()
            for n in np.unique(lengths):
                rows = batch.take(pa.array(np.flatnonzero(lengths == n)))
                buckets = _codes(_vectors(rows.column(1)), tables, bits, seed)
                values = pa.array(buckets.tolist(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, values], names=[*rows.schema.names, "buckets"]
                )

    held = docs.select(doc_key, vector).filter(finite(F.col(vector)))
    coded = held.mapInArrow(
        run, f"`{doc_key}` {kind[doc_key]}, `{vector}` {kind[vector]}, buckets array<bigint>"
    )
    return coded.select(doc_key, vector, F.explode("buckets").alias("bucket"))


def similarity_topk_lsh(
    table: DataFrame, query: Sequence[float], k: int = 3, doc_key: str = "doc_id",
    vector: str = "embedding", tables: int = 6, bits: int = 6, seed: int = 7,
) -> DataFrame:
    """Approximate best k: exact scores of the documents sharing a bucket with the query.

    Buckets one plane away are looked into as well, and further ones, a plane at a time, while
    fewer than k documents were found. ``buckets`` says how many were looked into.
    """
    target = np.asarray([list(query)], dtype=np.float64)
    table = table.filter(F.size(vector) == target.shape[1])
    probes = {int(c) for c in _codes(target, tables, bits, seed)[0]}
    for _ in range(bits):
        probes |= {c ^ (1 << b) for c in probes for b in range(bits)}
        near = table.filter(F.col("bucket").isin(sorted(probes)))
        if near.select(doc_key).distinct().limit(k).count() == k:
            break
    # A document can turn up once per hash table.
    found = _vector_scan(near, doc_key, vector, "query", "int", [0], target.tolist(), k * tables)
    ranked = _ranked(found.dropDuplicates(["query", doc_key]), "query", doc_key, k).drop("query")
    return ranked.withColumn("buckets", F.lit(len(probes)))


# -- search by words --------------------------------------------------------


def word_keys(text: Column) -> Column:
    """Every word of the whole text as its 64-bit key."""
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _word_counts(rows: DataFrame, key: str, terms: Column) -> DataFrame:
    """``(_id, _words, _counts)``: each row's distinct word keys in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = batch.column(1).offsets.to_numpy()
            flat = batch.column(1).values.to_numpy(zero_copy_only=False)
            found = [np.unique(flat[a:b], return_counts=True) for a, b in zip(ends, ends[1:])]
            cuts = pa.array(np.cumsum([0, *[len(w) for w, _ in found]]).astype(np.int32))
            columns = [
                pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(
                    [np.zeros(0, dtype=np.int64), *[x[side] for x in found]])))
                for side in (0, 1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], names=["_id", "_words", "_counts"])

    none = F.array().cast("array<bigint>")
    held = rows.select(F.col(key).alias("_id"), F.coalesce(terms, none).alias("_terms"))
    kind = dict(held.dtypes)["_id"]
    return held.mapInArrow(run, f"_id {kind}, _words array<bigint>, _counts array<bigint>")


def _weighing(weights: DataFrame, rest: float, most: int) -> Callable[[DataFrame], DataFrame] | None:
    """What makes vectors of length one (``_words``, ``_values``) of ``_words`` and ``_counts``; other words weigh ``rest``.

    The weights go to the tasks as two sorted arrays. None if there are more than ``most``.
    """
    if weights.limit(most + 1).count() > most:
        return None
    table = weights.select("_word", "_weight").toArrow()
    keys, values = (table.column(c).to_numpy() for c in ("_word", "_weight"))
    del table
    order = np.argsort(keys)
    shared = weights.sparkSession.sparkContext.broadcast((keys[order], values[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weight = shared.value
        for batch in batches:
            *own, lists, counts = batch.columns
            flat = lists.values.to_numpy(zero_copy_only=False)
            value = np.full(len(flat), rest)
            if len(known):
                place = np.minimum(np.searchsorted(known, flat), len(known) - 1)
                value = np.where(known[place] == flat, weight[place], rest)
            value = value * counts.values.to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            norm = np.sqrt(np.bincount(row, weights=value * value, minlength=batch.num_rows))
            value = value / np.where(norm > 0, norm, 1.0)[row]
            yield pa.RecordBatch.from_arrays(
                [*own, lists, pa.ListArray.from_arrays(lists.offsets, pa.array(value)), pa.array(norm)],
                names=[*batch.schema.names[:-1], "_values", "_norm"])

    def weighed(counts: DataFrame) -> DataFrame:
        own = [f"`{c}` {kind}" for c, kind in counts.dtypes[:-2]]
        return counts.mapInArrow(run, ", ".join(
            [*own, "_words array<bigint>", "_values array<double>", "_norm double"])
        ).filter("_norm > 0").drop("_norm")

    return weighed


def _word_vectors(counts: DataFrame, weights: DataFrame, rest: float, most: int) -> DataFrame:
    """``counts``, whose last columns are ``_words`` and ``_counts``, with ``_words`` and ``_values`` of length one.

    Weights of at most ``most`` words go to the tasks; more of them are joined.
    """
    if (weighed := _weighing(weights, rest, most)) is not None:
        return weighed(counts)
    own = counts.columns[:-2]
    single = counts.select(*own, F.explode(F.arrays_zip("_words", "_counts")).alias("x")).select(
        *own, F.col("x._words").alias("_word"), F.col("x._counts").alias("_n"))
    valued = single.join(weights.select("_word", "_weight"), "_word", "left").select(
        *own, "_word", (F.col("_n") * F.coalesce("_weight", F.lit(rest))).alias("_value")
    )
    gathered = valued.groupBy(*own).agg(
        F.array_sort(F.collect_list(F.struct("_word", "_value"))).alias("x"),
        F.sqrt(F.sum(F.col("_value") * F.col("_value"))).alias("_norm"),
    )
    return gathered.filter("_norm > 0").select(
        *own, F.col("x._word").alias("_words"),
        F.transform("x", lambda x: x["_value"] / F.col("_norm")).alias("_values"),
    )


class TextIndex(NamedTuple):
    """An inverted index over documents, written once, or for one search with its blocks left to the tasks."""

    #: (_segment, _word, most, docs, values): a word's postings in a segment of the documents, whose places
    #: are ``_segment`` plus ``docs``, and the largest value. None if only one search is made.
    blocks: DataFrame | None
    #: (_word, _n, _weight): in how many documents a word is, and what it weighs.
    weights: DataFrame
    #: (_place, _id, _words, _values): each document's words in order of their keys, of length one.
    vectors: DataFrame
    documents: int
    #: (_place, _id, _words, _counts) and what makes vectors of them, where ``vectors`` is not written.
    counts: DataFrame | None = None
    weighed: Callable[[DataFrame], DataFrame] | None = None


def _held(known: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which of ``words`` are among ``known``, which is sorted."""
    if not len(known):
        return np.zeros(len(words), dtype=bool)
    return known[np.minimum(np.searchsorted(known, words), len(known) - 1)] == words


def _posting_blocks(postings: int, cells: int, asked: np.ndarray | None = None):
    """Rows (_place, _words, _values) to the posting blocks of segments, of all words or of those ``asked``.

    The places of a segment rise and lie within ``postings``.
    """
    def inverted(held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        first = int(held[0][0][0])
        places, sizes, words, values = (np.concatenate([part[i] for part in held]) for i in range(4))
        docs = np.repeat((places - first).astype(np.int32), sizes)
        kept = values > 0
        if asked is not None:
            kept &= _held(asked, words)
        docs, words, values = docs[kept], words[kept], values[kept]
        order = np.argsort(words, kind="stable")
        docs, words, values = docs[order], words[order], values[order]
        starts = np.flatnonzero(np.diff(words, prepend=words[:1] - 1)) if len(words) else np.zeros(0, int)
        cuts = pa.array(np.append(starts, len(words)).astype(np.int32))
        most = np.maximum.reduceat(values, starts) if len(starts) else values
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(starts), first)), pa.array(words[starts]), pa.array(most),
             pa.ListArray.from_arrays(cuts, pa.array(docs)),
             pa.ListArray.from_arrays(cuts, pa.array(values))],
            names=["_segment", "_word", "most", "docs", "values"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, first, last = [], 0, None, None
        for batch in batches:
            places = batch.column(0).to_numpy()
            ends = batch.column(1).offsets.to_numpy()
            words, values = (batch.column(c).values.to_numpy(zero_copy_only=False) for c in (1, 2))
            falls = np.append(np.flatnonzero(np.diff(places) <= 0) + 1, len(places))
            a = 0
            while a < len(places):
                if held and (places[a] <= last or places[a] - first >= postings or size >= cells):
                    yield inverted(held)
                    held, size = [], 0
                if not held:
                    first = places[a]
                rising = int(falls[np.searchsorted(falls, a, "right")])
                near = a + int(np.searchsorted(places[a:rising], first + postings))
                fit = int(np.searchsorted(ends, ends[a] + cells - size, "right")) - 1
                b = min(near, max(fit, a + 1))
                held.append((places[a:b], np.diff(ends[a : b + 1]), words[ends[a] : ends[b]],
                             values[ends[a] : ends[b]]))
                size, last = size + int(ends[b] - ends[a]), places[b - 1]
                a = b
        if held:
            yield inverted(held)

    return run


def text_index(
    docs: DataFrame, doc_key: str = "doc_id", text: str = "text", terms: str | None = None,
    postings: int = POSTINGS, sent: int = SENT_WEIGHTS, kept: bool = True,
) -> TextIndex:
    """The index of ``docs``, whose keys are unique. ``terms`` names a column that holds their words as keys
    already, as the entries of an incremental index do; ``text`` is not read then.

    Tasks invert segments of at most ``postings`` documents by themselves, so no posting is shuffled unless more
    than ``sent`` words are in several documents. Without ``kept`` neither vectors nor blocks are written, but
    made anew from words and counts by the tasks of a search.
    """
    counts = settle_keys(
        _word_counts(docs, doc_key, word_keys(F.col(text)) if terms is None else F.col(terms))
        .select(F.monotonically_increasing_id().alias("_place"), "_id", "_words", "_counts"),
        "word-counts",
    )
    total = counts.count()
    weights = settle(
        counts.select(F.explode("_words").alias("_word")).groupBy("_word").agg(F.count("*").alias("_n"))
        .withColumn("_weight", F.log(F.lit(total + 1.0)) - F.log(F.col("_n") + F.lit(1.0))), "word-weights")
    several, rest = weights.filter("_n > 1"), math.log(total + 1.0) - math.log(2.0)
    counts = counts.filter("_id is not null")
    if not kept and (weighed := _weighing(several, rest, sent)) is not None:
        return TextIndex(None, weights, weighed(counts), total, counts, weighed)
    vectors = settle(_word_vectors(counts, several, rest, sent), "word-vectors")
    return TextIndex(_written_blocks(vectors, postings) if kept else None, weights, vectors, total)


def _written_blocks(vectors: DataFrame, postings: int) -> DataFrame:
    return settle(vectors.select("_place", "_words", "_values").mapInArrow(
        _posting_blocks(postings, SEGMENT_CELLS),
        "_segment bigint, _word bigint, most double, docs array<int>, values array<double>",
    ), "posting-blocks")


def _dots():
    """The inner product of the two vectors of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = [batch.column(c).offsets.to_numpy() for c in (2, 4)]
            flat = [batch.column(c).values.to_numpy(zero_copy_only=False) for c in (2, 3, 4, 5)]
            scores = np.zeros(batch.num_rows)
            for i in range(batch.num_rows):
                a, b = (slice(e[i], e[i + 1]) for e in ends)
                _, p, q = np.intersect1d(flat[0][a], flat[2][b], assume_unique=True, return_indices=True)
                scores[i] = flat[1][a][p] @ flat[3][b][q]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.round(scores, SCORE_DIGITS))],
                names=["_question", "_id", "score"],
            )

    return run


def _scored(pairs: DataFrame, asked: DataFrame, index: TextIndex) -> DataFrame:
    """Pairs (_row, _place) as (_question, _id) with their whole score; few pairs go to the vectors, many meet them."""
    pairs = settle(pairs, "question-documents")
    few = pairs.limit(SENT_PAIRS + 1).count() <= SENT_PAIRS
    vectors = index.vectors
    if index.counts is not None:  # only those that are looked at are weighed
        places = pairs.select("_place").distinct()
        vectors = index.weighed(index.counts.join(F.broadcast(places) if few else places, "_place", "left_semi"))
    if few:
        pairs = F.broadcast(pairs)
    both = vectors.toDF("_place", "_id", "_doc_words", "_doc_values").join(pairs, "_place").join(
        asked, "_row"
    ).select("_question", "_id", "_words", "_values", "_doc_words", "_doc_values")
    kinds = dict(both.dtypes)
    return both.mapInArrow(
        _dots(), f"_question {kinds['_question']}, _id {kinds['_id']}, score double"
    )


class _Sums:
    """Adds up the blocks of a segment for the questions of a block; keeps each question's k best scores so far."""

    def __init__(self, k: int, leading: int):
        self.k, self.leading = k, leading
        self.best: dict[int, np.ndarray] = {}

    def question(self, row: int, weights: np.ndarray, tops: np.ndarray, lists: list) -> tuple:
        """(places in the segment, scores) of the documents that can be among a question's k best.

        ``tops``: the most each list can add, falling. Once all that are left can add less than the
        k-th best score, they are only looked up for the documents that can still reach it.
        """
        bound = self.best[row][0] - MARGIN if len(self.best.get(row, ())) == self.k else 0.0
        left = np.minimum(np.cumsum(tops[::-1])[::-1],
                          np.sqrt(np.cumsum((weights * weights)[::-1])[::-1])) * (1 + 1e-9)
        sums = np.zeros(1 + max(int(docs[-1]) for docs, _ in lists))
        for at, (docs, values) in enumerate(lists):
            if at >= self.leading and left[at] < bound:
                open_still = np.flatnonzero(sums + left[at] >= bound)
                for weight, (docs, values) in zip(weights[at:], lists[at:]):
                    place = np.minimum(np.searchsorted(docs, open_still), len(docs) - 1)
                    there = docs[place] == open_still
                    sums[open_still[there]] += weight * values[place[there]]
                break
            sums[docs] += weights[at] * values
        found = np.flatnonzero(sums > 0)
        scores = sums[found]
        if len(scores) > self.k:
            bound = max(bound, np.partition(scores, -self.k)[-self.k] - MARGIN)
        reached = scores >= bound
        found, scores = found[reached], scores[reached]
        self.best[row] = np.sort(np.append(self.best.get(row, ()), scores))[-self.k:]
        return found, scores

    def segment(self, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        first = rows.column("_segment")[0].as_py()
        most = rows.column("most").to_numpy()

        def lists(name):
            column = rows.column(name).combine_chunks()
            column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
            return column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)

        (ends, docs), (_, values), (asked, numbers), (_, weights) = map(
            lists, ("docs", "values", "rows", "weights"))
        block = np.repeat(np.arange(len(most)), np.diff(asked))
        numbers, weights = (flat[asked[0] : asked[-1]] for flat in (numbers, weights))
        tops = weights * most[block]
        order = np.lexsort((-tops, numbers))
        numbers, weights, tops, block = numbers[order], weights[order], tops[order], block[order]
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        out = ([], [], [])
        for a, b in zip(cuts, cuts[1:]):
            found, scores = self.question(int(numbers[a]), weights[a:b], tops[a:b], [
                (docs[ends[i] : ends[i + 1]], values[ends[i] : ends[i + 1]]) for i in block[a:b]])
            for column, part in zip(out, (np.full(len(found), numbers[a]), first + found, scores)):
                column.append(part)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(column)) for column in out], names=["_row", "_place", "part"])

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, unit = [], None
        for batch in batches:
            units = np.stack([batch.column(c).to_numpy() for c in (0, 1)])
            changes = (np.flatnonzero((units[:, 1:] != units[:, :-1]).any(axis=0)) + 1).tolist()
            for a, b in zip([0, *changes], [*changes, batch.num_rows]):
                if a == b:
                    continue
                if held and tuple(units[:, a]) != unit:
                    yield self.segment(held)
                    held = []
                unit = tuple(units[:, a])
                held.append(batch.slice(a, b - a))
        if held:
            yield self.segment(held)


def _sent_questions(asked: DataFrame, most: int) -> tuple | None:
    """The questions' words in order, and where among ``rows`` and ``weights`` each one's questions lie.

    None if there are more than ``most`` pairs of a question and a word.
    """
    pairs = asked.select("_row", F.explode(F.arrays_zip("_words", "_values")).alias("x")).select(
        "_row", F.col("x._words").alias("_word"), F.col("x._values").alias("weight"))
    if pairs.limit(most + 1).count() > most:
        return None
    table = pairs.toArrow()
    rows, words, weights = (table.column(c).to_numpy() for c in ("_row", "_word", "weight"))
    order = np.lexsort((rows, words))
    known, starts = np.unique(words[order], return_index=True)
    return known, np.append(starts, len(order)).astype(np.int32), rows[order], weights[order]


def _search_segments(shared, k: int, leading: int, postings: int):
    """Documents' vectors (_place, _words, _values) to what the questions that were sent find in their segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cuts, rows, weights = shared.value
        lists = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat)) for flat in (rows, weights)]
        sums = _Sums(k, leading)
        for blocks in _posting_blocks(postings, SEGMENT_CELLS, known)(batches):
            if blocks.num_rows:
                at = pa.array(np.searchsorted(known, blocks.column("_word").to_numpy()))
                yield sums.segment([pa.RecordBatch.from_arrays(
                    [*(blocks.column(c) for c in ("_segment", "most", "docs", "values")),
                     *(column.take(at) for column in lists)],
                    names=["_segment", "most", "docs", "values", "rows", "weights"])])

    return run


def search_index(
    questions: DataFrame, index: TextIndex, k: int = 3, question_key: str = "question_id",
    question_text: str = "question", doc_key: str = "doc_id", leading: int = LEADING_WORDS,
    sent: int = SENT_WORDS, postings: int = POSTINGS,
) -> DataFrame:
    """Best k documents of an index for every question: ``(question, doc, score, rank)``.

    The posting blocks of the questions' words meet the blocks of questions that use them, and a task adds up
    those of one segment and one block of questions. Where the index has no blocks, at most ``sent`` words of questions go to the
    tasks, which invert segments of ``postings`` documents themselves. After the ``leading`` weightiest lists a
    question's others stay shut but for documents that can still reach the k-th best score it has seen.
    What is shuffled on is k rows per question and segment, and ties; the best of them are scored in full.
    """
    counts = _word_counts(questions, question_key, word_keys(F.col(question_text)))
    known = counts.select(F.explode("_words").alias("_word")).distinct()
    weights = settle(index.weights.join(known, "_word", "left_semi"), "question-weights")
    vectors = _word_vectors(
        counts, weights, math.log(index.documents + 1.0), sent).filter("_id is not null")
    # Questions are told apart by a number of their own: an id may come twice.
    asked = settle(vectors.withColumnRenamed("_id", "_question").withColumn(
        "_row", F.monotonically_increasing_id()), "questions")
    kinds = "_row bigint, _place bigint, part double"
    if index.blocks is None and (table := _sent_questions(asked, sent)) is not None:
        shared = questions.sparkSession.sparkContext.broadcast(table)
        found = index.vectors.select("_place", "_words", "_values").mapInArrow(
            _search_segments(shared, k, leading, postings), kinds)
    else:
        blocks = index.blocks if index.blocks is not None else _written_blocks(index.vectors, postings)
        groups = math.ceil(asked.count() / QUESTION_BLOCK) or 1
        used = settle(asked.select(
            F.pmod(F.xxhash64("_row"), F.lit(groups)).alias("_block"), "_row",
            F.explode(F.arrays_zip("_words", "_values")).alias("x"),
        ).groupBy("_block", F.col("x._words").alias("_word")).agg(
            F.sort_array(F.collect_list(F.struct("_row", F.col("x._values").alias("weight")))).alias("x")
        ).select("_block", "_word", F.col("x._row").alias("rows"), F.col("x.weight").alias("weights")),
            "question-words")
        found = (
            blocks.join(used, "_word")
            .repartition(int(questions.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                         "_segment", "_block")
            .sortWithinPartitions("_segment", "_block")
            .select("_segment", "_block", "most", "docs", "values", "rows", "weights")
            .mapInArrow(lambda batches: _Sums(k, leading).run(batches), kinds)
        )
    found = settle(found, "found-documents")
    best = first_n(found, ["_row"], [F.col("part").desc(), F.col("_place")], k)
    least = F.when(F.count("*") == k, F.min("part") - MARGIN).otherwise(0.0)
    bound = best.groupBy("_row").agg(least.alias("bound"))
    candidates = found.join(bound, "_row").filter("part >= bound").select("_row", "_place")
    scored = _scored(candidates, asked, index).filter("score > 0").toDF(question_key, doc_key, "score")
    return _ranked(scored, question_key, doc_key, k)


def text_topk(
    questions: DataFrame, docs: DataFrame, k: int = 3, question_key: str = "question_id",
    question_text: str = "question", doc_key: str = "doc_id", text: str = "text",
    terms: str | None = None, **how,
) -> DataFrame:
    """Best k documents for every question by the cosine of TF-IDF weighted words.

    Questions and documents without words, or null, find and are nothing. ``terms`` as in ``text_index``,
    ``how`` as in ``search_index``.
    """
    index = text_index(docs, doc_key, text, terms, kept=False)
    return search_index(questions, index, k, question_key, question_text, doc_key, **how)


def answers_from_search(
    questions: DataFrame, docs: DataFrame, question_key: str = "question_id",
    question_text: str = "question", doc_key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """A predict function that answers with the best document found; null if there is none."""
    best = settle(text_topk(questions, docs, 1, question_key, question_text, doc_key, text), "best-documents")
    if best.limit(SENT_PAIRS + 1).count() <= SENT_PAIRS:
        best = F.broadcast(best)
    found = best.join(docs.select(doc_key, F.col(text).alias("answer")), doc_key).select(
        question_key, doc_key, "answer"
    )
    return questions.select(question_key, question_text).join(found, question_key, "left")


def data_plus_docs(summary: DataFrame, hits: DataFrame, topic: str) -> DataFrame:
    """Questions needing both: each topic's figures next to its best documents."""
    return summary.join(hits, topic)
