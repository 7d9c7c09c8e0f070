"""Word counts of large groups of texts, and sums of word scores per text.

Words are runs of letters of the lower-cased text (anything beyond ASCII counts as a letter).
A table of word scores is sent to the tasks only after its rows were counted: up to
``SENT_BYTES`` it goes out as sorted arrays; a larger one is joined with the distinct words of each
text. Both ways add up the same numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.bytewords import byte_class, find_words, signed, slices, span_hashes
from tallyspan.storage import settle

LETTER = byte_class((0x61, 0x7A), (0x80, 0xFF))
SENT_BYTES = 64 << 20
# Different (group, word) pairs a task gathers before it hands on their counts.
FLUSH = 1 << 18


def hashed_words(column: pa.Array):
    """Per run of rows: (run, word starts, word ends, first word of each row, hashes)."""
    for rows in slices(column):
        # Lower-cased a run at a time, so that a batch is never held twice.
        text = pc.utf8_lower(column.slice(rows.first, len(rows)).cast(pa.large_string()))
        for run in slices(text, max(1, 2 * len(rows.data))):
            run.first += rows.first
            starts, ends, bounds = find_words(run, LETTER)
            yield run, starts, ends, bounds, span_hashes(run.data, starts, ends)


def word_counts(
    docs: DataFrame, group: Column, once: bool = False, spelled: bool = True
) -> DataFrame:
    """``(group, hash, n, word)``: how often each group of texts has each word.

    ``group`` is an integer of each row. With ``once`` a text counts a word once. Unless
    ``spelled``, the words themselves are left out.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged(parts):
            g, h, n, *w = (np.concatenate(p) for p in zip(*parts))
            order = np.lexsort((h, g))
            g, h, n = g[order], h[order], n[order]
            new = np.ones(len(g), dtype=bool)
            new[1:] = (g[1:] != g[:-1]) | (h[1:] != h[:-1])
            at = np.flatnonzero(new)
            return g[at], h[at], np.add.reduceat(n, at), *(x[order[at]] for x in w)

        def out(g, h, n, *w):
            return pa.RecordBatch.from_arrays(
                [pa.array(g), pa.array(signed(h)), pa.array(n),
                 *(pa.array(x.tolist(), type=pa.string()) for x in w)],
                names=["group", "hash", "n", "word"][: 3 + len(w)],
            )

        parts, held = [], 0
        for batch in batches:
            groups = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int32)
            for run, starts, ends, bounds, hashes in hashed_words(batch.column(0)):
                if not len(hashes):
                    continue
                row = np.repeat(np.arange(len(run)), np.diff(bounds))
                g = groups[run.first + row]
                order = np.lexsort((row, hashes, g))
                g, h, r = g[order], hashes[order], row[order]
                new = np.ones(len(g), dtype=bool)
                new[1:] = (g[1:] != g[:-1]) | (h[1:] != h[:-1])
                at = np.flatnonzero(new)
                if once:
                    fresh = new.copy()
                    fresh[1:] |= r[1:] != r[:-1]
                    n = np.add.reduceat(fresh.astype(np.int64), at)
                else:
                    n = np.diff(np.append(at, len(g)))
                part = (g[at], h[at], n)
                if spelled:
                    raw = run.data.tobytes()
                    where = order[at]
                    words = np.empty(len(at), dtype=object)
                    words[:] = [
                        raw[a:b].decode("utf-8", "replace")
                        for a, b in zip(starts[where].tolist(), ends[where].tolist())
                    ]
                    part += (words,)
                parts.append(part)
                held += len(at)
                if held >= FLUSH:
                    parts = [merged(parts)]
                    held = len(parts[0][0])
                    if held >= FLUSH // 2:
                        yield out(*parts[0])
                        parts, held = [], 0
        if parts:
            yield out(*merged(parts))

    return (
        docs.select(F.coalesce("text", F.lit("")).alias("text"), group.cast("int").alias("group"))
        .mapInArrow(count, "group int, hash long, n long" + ", word string" * spelled)
        .groupBy("group", "hash")
        .agg(F.sum("n").alias("n"), *[F.first("word").alias("word")] * spelled)
    )


class Scores:
    """Word scores as arrays sorted by hash."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray, other: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], values[order]
        self.other = other  # of a word without a row

    def of(self, hashes: np.ndarray) -> np.ndarray:
        distinct, which = np.unique(hashes, return_inverse=True)
        if not len(self.hashes):
            return np.broadcast_to(self.other, (len(hashes), len(self.other)))
        at = np.minimum(np.searchsorted(self.hashes, distinct), len(self.hashes) - 1)
        found = np.where(
            (self.hashes[at] == distinct)[:, None], self.values[at], self.other[None, :]
        )
        return found[which]


def sum_scores(docs: DataFrame, scores: DataFrame, other: list[float],
               keep: list[str], sent_bytes: int = SENT_BYTES) -> DataFrame:
    """The columns ``keep`` of every row, its number of words and its sums of word scores.

    ``scores`` has ``hash`` and ``values`` (an array as long as ``other``, which words without
    a row get). The result has ``words`` and ``sums`` beside ``keep``, and is
    written if the scores were sent, so that they need not be kept.
    """
    spark = docs.sparkSession
    width = len(other)
    source = docs.select(F.coalesce("text", F.lit("")).alias("text"), *keep)
    kept = ", ".join(f"`{name}` {kind}" for name, kind in source.select(*keep).dtypes)
    rest = np.array(other, dtype=np.float32)
    rows = scores.count()

    if rows * (8 + 4 * width) <= sent_bytes:
        # Checked above: at most ``sent_bytes``.
        found = scores.select("hash", *[F.col("values")[k].cast("float").alias(f"v{k}")
                                        for k in range(width)]).toArrow()
        values = [found.column(k + 1).to_numpy() for k in range(width)]
        table = Scores(
            found.column(0).to_numpy().view(np.uint64),
            np.stack(values, axis=1) if width else np.zeros((rows, 0), dtype=np.float32), rest,
        )
        del found, values
        shared = spark.sparkContext.broadcast(table)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words = np.zeros(batch.num_rows, dtype=np.int64)
                sums = np.zeros((batch.num_rows, width), dtype=np.float64)
                for run, _, _, bounds, hashes in hashed_words(batch.column(0)):
                    rows = slice(run.first, run.first + len(run))
                    counts = np.diff(bounds)
                    words[rows] = counts
                    full = np.flatnonzero(counts)
                    if len(full):
                        each = shared.value.of(hashes).astype(np.float64)
                        sums[run.first + full] = np.add.reduceat(each, bounds[full], axis=0)
                ends = np.arange(batch.num_rows + 1, dtype=np.int32) * width
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[1:], pa.array(words),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(sums.reshape(-1)))],
                    names=[*keep, "words", "sums"],
                )

        done = settle(source.mapInArrow(add, f"{kept}, words long, sums array<double>"), "sums")
        shared.destroy()  # else the tasks' Python processes hold it on
        return done

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        for batch in batches:
            for run, _, _, bounds, hashes in hashed_words(batch.column(0)):
                row = np.repeat(np.arange(len(run)), np.diff(bounds))
                order = np.lexsort((hashes, row))
                r, h = row[order], hashes[order]
                new = np.ones(len(r), dtype=bool)
                new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
                at = np.flatnonzero(new)
                n = np.diff(np.append(at, len(r)))
                # One row of no word per text, so that texts without words stay.
                every = np.arange(len(run))
                index = np.concatenate([every, r[at]])
                columns = [c.slice(run.first, len(run)).take(pa.array(index)) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(base + index),
                     pa.concat_arrays([pa.nulls(len(every), pa.int64()), pa.array(signed(h[at]))]),
                     pa.array(np.concatenate([np.zeros(len(every), dtype=np.int64), n]))],
                    names=[*keep, "_row", "hash", "_n"],
                )
                base += len(run)

    sums = [
        F.sum(F.when(F.col("_n") > 0, F.coalesce(F.col("values")[k], F.lit(other[k])).cast("float"))
              .cast("double") * F.col("_n"))
        for k in range(width)
    ]
    return (
        source.mapInArrow(explode, f"{kept}, _row long, hash long, _n long")
        .join(scores, "hash", "left")
        .groupBy("_row", *keep)
        .agg(F.sum("_n").alias("words"), F.array(*[F.coalesce(s, F.lit(0.0)) for s in sums]).alias("sums"))
        .drop("_row")
    )
