"""Repeated passages: words covered by a window that also starts in an earlier document.

Texts that stand whole under a smaller ``doc_id`` are set aside first: all their windows do, too.

1. *Sketch.* Every task hashes its windows into the cells of a count-min sketch with two rows
   and hands on its counted cells, packed and cut into blocks of the sketch. Blocks are merged
   where they meet, so partial sketches never reach the driver. Of the merged sketch only two
   bits a cell go on: "twice or more" and "very often". It has ``cells`` cells a row, four per
   expected window up to ``MAX_CELLS``, which bounds what is broadcast; beyond that more windows
   pass, none is lost.
2. *Exact pass.* Only windows estimated to occur twice or more are grouped, by 96 bits of hash.
   They travel packed by ranges of the hash, and a range is sorted in one task. Windows
   estimated to occur very often are left out of that and grouped by a plain aggregate whose
   result is joined back, which Spark combines in the map tasks and splits where a key is hot.
3. Each document gets the places of its windows that start in a smaller ``doc_id`` and drops
   the words they cover.

Null texts have no words. Rows that repeat a ``doc_id`` with the same text all come back with the
same result. Texts that share a ``doc_id`` are judged each by its own windows, none of them earlier than the
others. A null ``doc_id`` is neither smaller nor larger than any, so its windows count nowhere.
Extra columns of the input don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.bytewords import (
    NOT_SPACE,
    find_words,
    mixed,
    slices,
    span_hashes,
    window_hashes,
)
from tallyspan.llm.tables import SENT_IDS, partitions, small_side
from tallyspan.storage import settle

WINDOW = 13
BYTES_PER_WINDOW = 6
BLOCK = 1 << 20
MIN_CELLS = BLOCK
MAX_CELLS = 1 << 28
HOT = 20_000
# Windows a task gathers before it hands on what it has packed.
FLUSH = 1 << 19


def _windows(column: pa.Array, size: int, exact: bool = False):
    """Per run of rows: (first row, row of each window, its word place, hash, second hash)."""
    for texts in slices(column):
        starts, ends, bounds = find_words(texts, NOT_SPACE)
        words = span_hashes(texts.data, starts, ends)
        hashes = window_hashes(words, size)
        if not len(hashes):
            continue
        counts = np.maximum(np.diff(bounds) - size + 1, 0)
        row = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = bounds[row] + place
        second = None
        if exact:
            second = window_hashes(span_hashes(texts.data, starts, ends, 1), size, 1)[at]
        yield texts.first, row, place, hashes[at], second


def _cells(hashes: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The cell in either row of the sketch."""
    top = np.uint64(cells - 1)
    return hashes & top, mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)) & top


def _pack(cells: np.ndarray) -> bytes:
    """Sorted cells of one block as differences, in as few bytes each as all allow."""
    gaps = np.diff(cells, prepend=cells[:1])
    width = np.uint8 if gaps.max(initial=0) < 256 else np.uint16 if gaps.max() < 65536 else np.uint32
    return bytes([np.dtype(width).itemsize]) + np.uint32(cells[0]).tobytes() + gaps.astype(width).tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    gaps = np.frombuffer(blob, dtype=f"<u{blob[0]}", offset=5)
    return np.cumsum(gaps, dtype=np.int64) + int.from_bytes(blob[1:5], "little")


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[bytes]]]:
    """Rows (key, blob) sorted by key, as (key, its blobs); blobs are read one after another."""
    rows = ((key, blob) for batch in batches for key, blob in zip(batch.column(0).to_pylist(), batch.column(1)))
    for key, same in groupby(rows, key=itemgetter(0)):
        yield key, (blob.as_py() for _, blob in same)


class Sketch:
    """The merged sketch: which cells were met twice or more, and which very often."""

    def __init__(self, cells: int):
        self.cells = cells
        self.twice = np.zeros((2, cells // 8), dtype=np.uint8)
        self.often = [np.zeros(0, dtype=np.uint64)] * 2

    def repeated(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Masks: estimated to occur twice or more; of these, estimated to occur very often."""
        at = _cells(hashes, self.cells)
        seen = np.ones(len(hashes), dtype=bool)
        hot = np.ones(len(hashes), dtype=bool)
        for row in (0, 1):
            bit = self.twice[row][at[row] >> np.uint64(3)] >> (at[row] & np.uint64(7)).astype(np.uint8)
            seen &= (bit & 1).astype(bool)
            if len(self.often[row]):
                near = np.searchsorted(self.often[row], at[row])
                near = np.minimum(near, len(self.often[row]) - 1)
                hot &= self.often[row][near] == at[row]
            else:
                hot[:] = False
        return seen, seen & hot


def sketch(docs: DataFrame, cells: int, hot: int = HOT, size: int = WINDOW) -> Sketch:
    """Count the windows of ``docs`` (text) into a sketch of two rows of ``cells`` cells."""
    blocks = cells // BLOCK

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(parts):
            hashes = np.concatenate(parts)
            keys, blobs = [], []
            for row, at in enumerate(_cells(hashes, cells)):
                at = np.sort(at)
                cuts = np.searchsorted(at, np.arange(blocks + 1, dtype=np.uint64) * np.uint64(BLOCK))
                for block in np.flatnonzero(np.diff(cuts)):
                    keys.append(row * blocks + int(block))
                    inside = at[cuts[block] : cuts[block + 1]] - np.uint64(block * BLOCK)
                    blobs.append(_pack(inside.astype(np.uint32)))
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, type=pa.int32()), pa.array(blobs, type=pa.binary())],
                names=["key", "blob"],
            )

        parts, held = [], 0
        for batch in batches:
            for _, _, _, hashes, _ in _windows(batch.column(0), size):
                parts.append(hashes)
                held += len(hashes)
                if held >= FLUSH:
                    yield flush(parts)
                    parts, held = [], 0
        if held:
            yield flush(parts)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, blobs in _grouped(batches):
            counts = np.zeros(BLOCK, dtype=np.uint32)
            for blob in blobs:
                np.add.at(counts, _unpack(blob), 1)
            if (counts > 1).any():
                twice = np.packbits(counts > 1, bitorder="little").tobytes()
                often = np.flatnonzero(counts >= hot).astype(np.uint32).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key], type=pa.int32()), pa.array([twice]), pa.array([often])],
                    names=["key", "twice", "often"],
                )

    merged = settle(
        docs.select("text")
        .mapInArrow(count, "key int, blob binary")
        .repartition(partitions(docs.sparkSession), "key")
        .sortWithinPartitions("key")
        .mapInArrow(merge, "key int, twice binary, often binary"),
        "sketch",
    )  # written, so that blocks are merged side by side and fetched one after another
    # At most two bits for each of the sketch's cells, whatever the corpus.
    whole = Sketch(cells)
    often = ([], [])
    width = BLOCK // 8
    for r in merged.toLocalIterator():
        row, block = divmod(r["key"], blocks)
        whole.twice[row, block * width : (block + 1) * width] = np.frombuffer(r["twice"], np.uint8)
        cell = np.frombuffer(r["often"], dtype=np.uint32).astype(np.uint64)
        often[row].append(cell + np.uint64(block * BLOCK))
    whole.often = [np.sort(np.concatenate(o)) if o else whole.often[0] for o in often]
    return whole


def sketch_cells(text_bytes: int, most: int = MAX_CELLS) -> int:
    """Four cells per expected window, as a power of two between the bounds."""
    wanted = 4 * max(1, text_bytes // BYTES_PER_WINDOW)
    return min(most, max(MIN_CELLS, 1 << (wanted - 1).bit_length()))



def _variants(values: np.ndarray) -> bytes:
    """Which of a doc_id's texts is meant; nothing where every doc_id has one."""
    return values.astype("<i8").tobytes() if values.any() else b""


def _narrow(values: np.ndarray) -> bytes:
    """Numbers below 2**32 in as few bytes each as the largest one needs, with that width ahead."""
    most = int(values.max(initial=0))
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _entries(doc: np.ndarray, variant, place, h, g) -> bytes:
    """Windows in document order, column by column: 12 bytes of hash, and small differences."""
    order = np.lexsort((place, variant, doc))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (np.diff(doc[order]) != 0) | (np.diff(variant[order]) != 0)
    firsts = np.flatnonzero(new)
    counts = np.diff(np.append(firsts, len(order)))
    docs, variants = doc[order][firsts], variant[order][firsts]
    steps = np.diff(place[order], prepend=0)
    steps[firsts] = place[order][firsts]
    far = np.flatnonzero(steps > 255)
    head = np.array([len(order), len(docs), len(far)], dtype="<u4")
    return b"".join([
        head.tobytes(), docs.astype("<i8").tobytes(), h[order].astype("<u8").tobytes(),
        (g[order] >> np.uint64(32)).astype("<u4").tobytes(), far.astype("<u4").tobytes(),
        steps[far].astype("<u4").tobytes(), np.minimum(steps, 255).astype("u1").tobytes(),
        _narrow(counts), _variants(variants),
    ])


def _read(blob: bytes):
    n, docs, far = np.frombuffer(blob, dtype="<u4", count=3).tolist()
    at = 12
    out = []
    for kind, count in (("<i8", docs), ("<u8", n), ("<u4", n), ("<u4", far), ("<u4", far), ("u1", n)):
        out.append(np.frombuffer(blob, dtype=kind, count=count, offset=at))
        at += count * np.dtype(kind).itemsize
    names, h, g, where, steps, small = out
    counts = np.frombuffer(blob, dtype=f"<u{blob[at]}", count=docs, offset=at + 1).astype(np.int64)
    at += 1 + blob[at] * docs
    variants = np.frombuffer(blob, dtype="<i8", offset=at) if at < len(blob) else np.zeros(docs, np.int64)
    each = small.astype(np.int64)
    each[where] = steps
    total = np.cumsum(each)
    firsts = np.cumsum(counts) - counts
    place = total - np.repeat(total[firsts] - each[firsts], counts)
    return np.repeat(names, counts), np.repeat(variants, counts), place, h, g


def covered_places(docs: DataFrame, window: int, ranges: int, found: Sketch) -> tuple[DataFrame, Broadcast]:
    """``(doc_id, variant, place)`` of every window that also starts in a smaller ``doc_id``, and
    the sketch as it was sent, to be destroyed when the places are written."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(found)
    shift = np.uint64(64 - (ranges - 1).bit_length()) if ranges > 1 else None
    any_hot = all(len(o) for o in found.often)

    def scan(batches, hot: bool):
        for batch in batches:
            ids = batch.column(0)
            known = np.asarray(ids.is_valid())
            ids, variants = ids.fill_null(0).to_numpy(), batch.column(1).to_numpy()
            for first, row, place, h, g in _windows(batch.column(2), window, exact=True):
                seen, often = shared.value.repeated(h)
                keep = (often if hot else seen & ~often) & known[first + row]
                at = first + row[keep]
                yield ids[at], variants[at], place[keep], h[keep], g[keep]

    def cold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(parts):
            doc, variant, place, h, g = (np.concatenate(p) for p in zip(*parts))
            key = (h >> shift).astype(np.int64) if shift is not None else np.zeros(len(h), np.int64)
            order = np.argsort(key, kind="stable")
            cuts = np.flatnonzero(np.diff(key[order])) + 1
            keys, blobs = [], []
            for rows in np.split(order, cuts):
                keys.append(int(key[rows[0]]))
                blobs.append(_entries(doc[rows], variant[rows], place[rows], h[rows], g[rows]))
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, type=pa.int32()), pa.array(blobs, type=pa.binary())],
                names=["key", "blob"],
            )

        parts, held = [], 0
        for part in scan(batches, hot=False):
            parts.append(part)
            held += len(part[0])
            if held >= FLUSH:
                yield flush(parts)
                parts, held = [], 0
        if held:
            yield flush(parts)

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blobs in _grouped(batches):
            doc, variant, place, h, g = (np.concatenate(p) for p in zip(*map(_read, blobs)))
            order = np.lexsort((doc, g, h))
            h, g, doc, place, variant = h[order], g[order], doc[order], place[order], variant[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
            smallest = doc[new][np.cumsum(new) - 1]
            keep = doc > smallest
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[keep]), pa.array(variant[keep]), pa.array(place[keep].astype(np.int32))],
                names=["doc_id", "variant", "place"],
            )

    source = docs.select("doc_id", "variant", "text")
    places = (
        source.mapInArrow(cold, "key int, blob binary")
        .repartition(partitions(spark), "key")
        .sortWithinPartitions("key")
        .mapInArrow(group, "doc_id long, variant long, place int")
    )
    if not any_hot:
        return places, shared

    def hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, variant, place, h, g in scan(batches, hot=True):
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc), pa.array(variant), pa.array(place.astype(np.int32)),
                 pa.array(h.view(np.int64)), pa.array((g >> np.uint64(32)).astype(np.int64))],
                names=["doc_id", "variant", "place", "h", "g"],
            )

    rows = source.mapInArrow(hot, "doc_id long, variant long, place int, h long, g long")
    firsts = rows.groupBy("h", "g").agg(F.min("doc_id").alias("first"))
    return places.union(
        rows.join(firsts, ["h", "g"]).filter("doc_id > first").select("doc_id", "variant", "place")
    ), shared


def copies(docs: DataFrame) -> DataFrame:
    """``(doc_id, key, copied, several)`` of texts that also stand whole under a smaller doc_id, and of
    texts whose doc_id has others."""
    keys = settle(
        docs.filter("doc_id is not null and text is not null").select(
            "doc_id", F.xxhash64("text").alias("key"), F.hash("text").alias("other"),
            F.octet_length("text").alias("size"),
        ),
        "text-keys",
    )
    texts = keys.groupBy("key", "other", "size").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
    ).filter("first < last")
    copied = keys.join(texts, ["key", "other", "size"]).filter("doc_id > first").select(
        "doc_id", "key", F.lit(True).alias("copied"), F.lit(False).alias("several")
    )
    shared = keys.groupBy("doc_id").agg(F.min("key").alias("a"), F.max("key").alias("b")).filter("a < b")
    several = keys.join(shared, "doc_id", "left_semi").select(
        "doc_id", "key", F.lit(False).alias("copied"), F.lit(True).alias("several")
    )
    return copied.union(several).groupBy("doc_id", "key").agg(
        F.max("copied").alias("copied"), F.max("several").alias("several")
    )


_KEPT = "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string"


def _drop_words(window: int):
    """Arrow function: rows (doc_id, text, copied, places) to what is left of them."""

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept, digests = [], [], [], []
            texts = batch.column(1).cast(pa.large_binary())
            for text, copied, places in zip(texts, batch.column(2), batch.column(3)):
                words = (text.as_py() or b"").split()
                n = len(words)
                counts.append(n)
                if copied.as_py() and n >= window:  # its windows all start in the earlier copy
                    words = []
                elif places.is_valid:
                    at = places.values.to_numpy()
                    steps = np.zeros(n + 1, dtype=np.int64)
                    np.add.at(steps, at, 1)
                    np.add.at(steps, at + window, -1)
                    words = [words[k] for k in np.flatnonzero(np.cumsum(steps[:-1]) <= 0)]
                removed.append(n - len(words))
                line = b" ".join(words)
                kept.append(line)
                digests.append(hashlib.sha256(line).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, type=pa.int64()),
                 pa.array(removed, type=pa.int64()),
                 pa.array(kept, type=pa.large_binary()).cast(pa.large_string()).cast(pa.string()),
                 pa.array(digests, type=pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
            )

    return drop


def remove_repeats(docs: DataFrame, window: int = WINDOW, max_cells: int = MAX_CELLS,
                   hot: int = HOT, sent_ids: int = SENT_IDS) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept, kept_sha256)`` for every row of ``docs``.

    ``kept`` are the words that stay, joined by single spaces.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = settle(copies(docs), "copies").select(
        F.col("doc_id").alias("_doc"), F.col("key").alias("_key"), F.col("copied").alias("_copied"), "several"
    )
    none = F.lit(False)
    marked = docs.join(
        small_side(known, sent_ids),
        (F.col("doc_id") == F.col("_doc")) & (F.xxhash64("text") == F.col("_key")), "left",
    ).select(
        "doc_id", "text", F.coalesce("_copied", none).alias("copied"),
        F.when(F.coalesce("several", none), F.col("_key")).otherwise(F.lit(0)).cast("long").alias("variant"),
    )
    fresh = marked.filter("not copied").select("doc_id", "variant", "text")

    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    # Ranges of the hash that hold about half a million candidates each.
    ranges = 1 << max(0, (size // BYTES_PER_WINDOW >> 20)).bit_length()
    found = sketch(fresh, sketch_cells(size, max_cells), hot, window)
    places, sent = covered_places(fresh, window, ranges, found)
    per_doc = settle(
        places.groupBy("doc_id", "variant").agg(F.collect_list("place").alias("places")), "covered-places"
    )
    sent.destroy()  # the places are written, so no task needs it again

    touched = per_doc.select(F.col("doc_id").alias("_id"), F.col("variant").alias("_variant"))
    text = ["doc_id", "variant"]
    drop = _drop_words(window)
    if touched.count() > sent_ids:
        whole = marked.join(per_doc, text, "left").select("doc_id", "text", "copied", "places")
        return whole.mapInArrow(drop, _KEPT)
    # Only texts that lose words meet their places; the others are not moved.
    side = F.broadcast(touched)
    same = (F.col("doc_id") == F.col("_id")) & (F.col("variant") == F.col("_variant"))
    losing = (
        marked.filter("not copied").join(side, same, "left_semi").join(per_doc, text)
        .select("doc_id", "text", "copied", "places")
    )
    others = marked.filter("copied").union(
        marked.filter("not copied").join(side, same, "left_anti")
    ).select("doc_id", "text", "copied", F.lit(None).cast("array<int>").alias("places"))
    return losing.mapInArrow(drop, _KEPT).union(others.mapInArrow(drop, _KEPT))
