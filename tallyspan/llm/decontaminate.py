"""Benchmark passages in documents, found with suffix arrays over the documents' words.

Every task sorts the suffixes of its documents' words, about a megabyte of text at a time
(a shard), and binary-searches the windows that begin the benchmark's suffixes in it, word by
word. Words are numbered by the benchmark's vocabulary, and suffixes that hold a word outside
it before the shortest window ends are not sorted, because no search can end there.
Windows next to each other in one item and one document make the longest verbatim match.

The benchmark is the query set. It is read in blocks of at most ``BLOCK_BYTES`` of text, and one
block at a time is sent to the tasks, so a large one costs passes, not memory.

Null and empty texts have no words and no hits; items without words never match. An item without an
id makes words count as hit but is not listed; rows that share an item_id are one item.
Repeated document rows come back repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.bytewords import LOWER, LOWER_WORD, find_words, slices, span_hashes

WINDOW = 10
BLOCK_BYTES = 16 << 20


class Tests:
    """A block of the benchmark: vocabulary, distinct windows, and where they come from."""

    def __init__(self, names: list[str | None], texts: list[str | None], window: int):
        self.window = window
        self.names = np.array([n if n is not None else "" for n in names], dtype=object)
        self.named = np.array([n is not None for n in names], dtype=bool)
        hashes, item_of = [], []
        for run in slices(pa.array(texts, type=pa.string())):
            data = LOWER[run.data]
            starts, ends, bounds = find_words(run, LOWER_WORD, data)
            hashes.append(span_hashes(data, starts, ends))
            item_of.append(run.first + np.repeat(np.arange(len(run)), np.diff(bounds)))
        words = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
        item = np.concatenate(item_of) if item_of else np.zeros(0, dtype=np.int64)
        self.vocabulary = np.unique(words)
        ids = (np.searchsorted(self.vocabulary, words) + 1).astype(np.int32)

        count = np.bincount(item, minlength=len(names))
        first = np.cumsum(count) - count
        size = np.minimum(count, window)[item]  # an item of fewer words is one window
        place = np.arange(len(item)) - first[item]
        begins = np.flatnonzero(place + size <= count[item])
        columns = np.zeros((len(begins), window), dtype=np.int32)
        for k in range(window):
            inside = k < size[begins]
            columns[inside, k] = ids[begins[inside] + k]
        self.columns, which = np.unique(columns, axis=0, return_inverse=True)
        which = which.reshape(-1)
        self.sizes = (self.columns > 0).sum(axis=1)
        # Of every window: the (item, place in the item) pairs it begins at.
        order = np.argsort(which, kind="stable")
        self.origin = np.stack([item[begins], place[begins]], axis=1)[order]
        self.from_ = np.searchsorted(which[order], np.arange(len(self.columns) + 1))


def _bound(column, low, high, value, right: bool) -> np.ndarray:
    """Binary search of many values, each in its own range of one sorted column."""
    low, high = low.copy(), high.copy()
    open_ = low < high
    while open_.any():
        middle = (low + high) >> 1
        at = column[np.minimum(middle, len(column) - 1)]
        below = (at <= value) if right else (at < value)
        low = np.where(open_ & below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)
        open_ = low < high
    return low


def occurrences(ids: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
    """All (place, window) of the tests' windows in ``ids``; 0 ends a text or is no test word."""
    none = np.zeros(0, dtype=np.int64)
    if not len(tests.columns):
        return none, none
    stops = np.append(np.flatnonzero(ids == 0), len(ids))
    known = np.flatnonzero(ids)
    run = stops[np.searchsorted(stops, known)] - known
    suffixes = known[run >= tests.sizes.min()]
    if not len(suffixes):
        return none, none
    padded = np.concatenate([ids, np.zeros(tests.window, dtype=ids.dtype)])
    order = np.lexsort([padded[suffixes + k] for k in range(tests.window - 1, -1, -1)])
    suffixes = suffixes[order]
    active = np.arange(len(tests.columns))
    low = np.zeros(len(active), dtype=np.int64)
    high = np.full(len(active), len(suffixes), dtype=np.int64)
    found_w, found_low, found_high = [], [], []
    for k in range(tests.window + 1):
        ended = tests.sizes[active] == k
        found_w.append(active[ended])
        found_low.append(low[ended])
        found_high.append(high[ended])
        active, low, high = active[~ended], low[~ended], high[~ended]
        if not len(active):
            break
        column, value = padded[suffixes + k], tests.columns[active, k]
        low, high = _bound(column, low, high, value, False), _bound(column, low, high, value, True)
        kept = low < high
        active, low, high = active[kept], low[kept], high[kept]
    window, low, high = (np.concatenate(x) for x in (found_w, found_low, found_high))
    size = high - low
    index = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return suffixes[index], np.repeat(window, size)


def _expand(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges behind each other, and which range each comes from."""
    size = end - begin
    source = np.repeat(np.arange(len(size)), size)
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum()), source


FOUND = (
    "doc_id long, text_key long, n_words long, spans array<int>, items array<string>,"
    " longest int, longest_item string, item_word int, doc_word int"
)


def _scan(tests: Tests):
    """Arrow function: rows (doc_id, text_key, text) to ``FOUND``."""

    def of_document(place: np.ndarray, window: np.ndarray):
        size = tests.sizes[window]
        order = np.argsort(place, kind="stable")
        begin, end = place[order], np.maximum.accumulate((place + size)[order])
        cut = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1]]))
        last = np.append(cut[1:], len(begin)) - 1
        spans = np.stack([begin[cut], end[last]], axis=1).reshape(-1)

        distinct = np.unique(window)
        index, _ = _expand(tests.from_[distinct], tests.from_[distinct + 1])
        items = np.unique(tests.origin[index, 0])
        names = sorted(set(tests.names[items[tests.named[items]]].tolist()))

        index, source = _expand(tests.from_[window], tests.from_[window + 1])
        item, at = tests.origin[index].T
        here = place[source]
        order = np.lexsort((here, here - at, item))
        item, at, here, size = item[order], at[order], here[order], size[source][order]
        new = np.ones(len(item), dtype=bool)
        new[1:] = (item[1:] != item[:-1]) | (here[1:] != here[:-1] + 1) | (at[1:] != at[:-1] + 1)
        begin = np.flatnonzero(new)
        length = np.append(begin[1:], len(item)) - begin + size[begin] - 1
        best = begin[int(np.argmax(length))]
        name = tests.names[item[best]] if tests.named[item[best]] else None
        return spans, names, (int(length.max()), name, int(at[best]), int(here[best]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.zeros(batch.num_rows, dtype=np.int64)
            spans = [None] * batch.num_rows
            items = [None] * batch.num_rows
            best = [(None,) * 4] * batch.num_rows
            for run in slices(batch.column(2)):
                data = LOWER[run.data]
                starts, ends, bounds = find_words(run, LOWER_WORD, data)
                counts[run.first : run.first + len(run)] = np.diff(bounds)
                if not len(starts) or not len(tests.vocabulary):
                    continue
                words = span_hashes(data, starts, ends)
                near = np.searchsorted(tests.vocabulary, words)
                near = np.minimum(near, len(tests.vocabulary) - 1)
                ids = np.where(tests.vocabulary[near] == words, near + 1, 0).astype(np.int32)
                # A zero behind each text keeps suffixes from running into the next one.
                row = np.repeat(np.arange(len(run)), np.diff(bounds))
                apart = np.zeros(len(ids) + len(run), dtype=np.int32)
                apart[np.arange(len(ids)) + row] = ids
                place, window = occurrences(apart, tests)
                if not len(place):
                    continue
                begins = bounds[:-1] + np.arange(len(run))
                of = np.searchsorted(begins, place, side="right") - 1
                order = np.argsort(of, kind="stable")
                for rows in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
                    doc = int(of[rows[0]])
                    at = run.first + doc
                    spans[at], items[at], best[at] = of_document(
                        place[rows] - begins[doc], window[rows]
                    )
            longest, item, item_word, doc_word = zip(*best) if best else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts),
                 pa.array(spans, type=pa.list_(pa.int32())),
                 pa.array(items, type=pa.list_(pa.string())),
                 pa.array(longest, type=pa.int32()), pa.array(item, type=pa.string()),
                 pa.array(item_word, type=pa.int32()), pa.array(doc_word, type=pa.int32())],
                names=["doc_id", "text_key", "n_words", "spans", "items", "longest",
                       "longest_item", "item_word", "doc_word"],
            )

    return scan


def blocks_of(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[Tests]:
    """The benchmark (item_id, text), block by block."""
    names: list[str | None] = []
    texts: list[str | None] = []
    held = 0
    for row in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        names.append(row[0])
        texts.append(row[1])
        held += len(row[1] or "")
        if held >= block_bytes:
            yield Tests(names, texts, window)
            names, texts, held = [], [], 0
    if names:
        yield Tests(names, texts, window)


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): hit words, matching items, longest match.

    ``longest`` is the longest verbatim match in words, of item ``longest_item`` from its word
    ``item_word`` on, at word ``doc_word`` of the document; null without a hit.
    """
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    )
    found = [source.mapInArrow(_scan(t), FOUND) for t in blocks_of(benchmark, window, block_bytes)]
    if not found:
        found = [source.mapInArrow(_scan(Tests([], [], window)), FOUND)]
    if len(found) == 1:
        whole = found[0]
        hit = F.expr(
            "aggregate(spans, 0, (a, x) -> x - a)"  # begin and end in turn: sum of end - begin
        )
    else:
        key = ["doc_id", "text_key"]
        parts = found[0].filter("spans is not null")
        for other in found[1:]:
            parts = parts.union(other.filter("spans is not null"))
        best = F.struct("longest", "longest_item", "item_word", "doc_word")
        merged = parts.dropDuplicates([*key, "longest_item", "spans"]).groupBy(*key).agg(
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.flatten(F.collect_list("items")).alias("items"),
            F.max(best).alias("best"),
        )
        left, right = found[0].alias("l"), merged.alias("r")
        whole = left.join(
            right,
            F.expr("l.doc_id <=> r.doc_id and l.text_key = r.text_key"), "left",
        ).select("l.doc_id", "l.n_words", "r.spans", "r.items", "r.best.*")
        hit = F.expr(
            "size(array_distinct(flatten(transform(sequence(0, size(spans) div 2 - 1),"
            " k -> sequence(spans[2 * k], spans[2 * k + 1] - 1)))))"
        )
    items = F.array_sort(F.array_distinct(F.coalesce("items", F.array().cast("array<string>"))))
    n_hit = F.when(F.col("spans").isNull(), F.lit(0)).otherwise(hit).cast("long")
    return whole.select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        "longest", "longest_item", "item_word", "doc_word",
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the contaminated ones, all columns kept. The test runs in the scan."""
    kept = docs
    position = docs.columns.index("text")
    for tests in blocks_of(benchmark, window, block_bytes):
        scan = _scan(tests)

        def drop(batches, scan=scan):
            for batch in batches:
                keys = pa.array(np.zeros(batch.num_rows, dtype=np.int64))
                narrow = pa.RecordBatch.from_arrays(
                    [keys, keys, batch.column(position)], names=["doc_id", "text_key", "text"]
                )
                (found,) = scan([narrow])
                yield batch.filter(found.column("spans").is_null())

        kept = kept.mapInArrow(drop, docs.schema)
    return kept
