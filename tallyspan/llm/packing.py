"""Best-fit packing of token sequences with large items matched first.

1. Every text becomes token ids and an end mark; only what is longer than a sequence is cut.
   The last pieces are full, so the first one takes the remainder.
2. Packing needs the *number* of pieces of each length only. That table has at most one row
   per length (``capacity`` rows, whatever the corpus), and the plan is made from it: pieces
   above a third of the capacity are matched greedily, at most two a bin, the longest with
   the longest partner that fits; shorter pieces then go, longest first, to the
   fullest bin they fit in. Bins with equal content are handled as one entry with a count.
3. Pieces of one length are numbered without gathering them: position in the writing task,
   plus the pieces of that length in the tasks before. The plan gives every
   range of numbers its bins and offsets.

A null text packs as an empty one (its end mark alone); repeated rows are packed one by
one; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyspan.llm.bytewords import Texts, byte_class, slices, span_hashes
from tallyspan.storage import settle

CAPACITY = 1024
END = 2
MEMO_UNITS = 300_000
MEMO_LENGTH = 48
# The splitting pattern of this family of tokenizers, a fixed value.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

SLICE = 2 << 20

_SPACE = byte_class((0x20, 0x20), (0x0A, 0x0A))
_PRINTED = byte_class((0x21, 0x7E))
_LETTER = byte_class((0x41, 0x5A), (0x61, 0x7A))
_SIGN = byte_class((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
_LATIN = re.compile(rb"(?:[\x00-\x7f]|[\xc3-\xc8][\x80-\xbf])*")


def unit_starts(texts: Texts) -> np.ndarray:
    """Places where the tokenizer surely starts a new token.

    Its pattern lets white space only lead a token, so a space or line feed behind anything
    that is no white space starts one; so does a sign behind a letter. Behind other
    characters than those tested here texts are not cut, which only makes a unit longer.
    """
    data = texts.data
    one, two = np.zeros(len(data), dtype=bool), np.zeros(len(data), dtype=bool)
    one[1:] = _PRINTED[data[:-1]]
    two[2:] = (data[:-2] >= 0xC3) & (data[:-2] < 0xE0) & (data[1:-1] >= 0x80)
    start = _SPACE[data] & (one | two)
    letter = np.zeros(len(data), dtype=bool)
    letter[1:] = _LETTER[data[:-1]]
    start |= _SIGN[data] & letter
    start[texts.offsets[texts.offsets < len(data)]] = True
    return np.flatnonzero(start)


class Ids(dict):
    """Token ids of a unit of text as packed little-endian bytes, found when first asked for.

    Units of Latin letters go through the same merges in ``tiktoken``, which starts up faster
    per call; all others go through ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.merges = _same_merges(path)

    def __missing__(self, unit: bytes) -> bytes:
        if self.merges and (unit.isascii() or _LATIN.fullmatch(unit)):
            ids = self.merges.encode_ordinary(unit.decode())
        else:
            text = unit.decode("utf-8", "replace")
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(unit) <= MEMO_LENGTH:
            if len(self) >= MEMO_UNITS:
                self.clear()
            self[unit] = packed
        return packed

    def encode_all(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all rows in one array, and where each row's ids begin."""
        starts = unit_starts(texts)
        if not len(starts):
            return np.zeros(0, dtype="<u4"), np.zeros(len(texts) + 1, dtype=np.int64)
        ends = np.append(starts[1:], len(texts.data))
        _, first, which = np.unique(
            span_hashes(texts.data, starts, ends), return_index=True, return_inverse=True
        )
        raw = texts.data.tobytes()
        found = [self[raw[a:b]] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        ids = np.frombuffer(b"".join(found), dtype="<u4")
        sizes = np.array([len(x) for x in found], dtype=np.int64) // 4
        place = np.concatenate([[0], np.cumsum(sizes)])
        size = sizes[which]
        behind = np.concatenate([[0], np.cumsum(size)])
        index = np.repeat(place[which] - behind[:-1], size) + np.arange(behind[-1])
        return ids[index], behind[np.searchsorted(starts, texts.offsets)]


def _same_merges(path: str):
    """The tokenizer's merges as a ``tiktoken`` encoding, or None if ids don't follow their order."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    vocab, merges = model["vocab"], model["merges"]
    joined = ("".join(m) if isinstance(m, list) else m.replace(" ", "") for m in merges)
    if any(vocab.get(m) != 256 + k for k, m in enumerate(joined)):
        return None
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(printed)]
    letters = {chr(b): b for b in printed} | {chr(256 + k): b for k, b in enumerate(hidden)}
    ranks = {
        bytes(letters[c] for c in piece): rank
        for piece, rank in vocab.items()
        if rank < 256 + len(merges)
    }
    return tiktoken.Encoding(
        "merges", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


PIECES = (
    "doc_id long, piece int, start long, length int, ids_crc32 long, block int, place long"
)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """One row per piece, numbered by (length, ``block``, ``place``) within its task."""
    mark = np.asarray([end], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids(tokenizer)
        block = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            columns = tuple([] for _ in range(5))
            places = []
            docs_of = batch.column(0).to_pylist()
            for texts in slices(batch.column(1), SLICE):
                tokens, bounds = ids.encode_all(texts)
                for row in range(len(texts)):
                    packed = tokens[bounds[row] : bounds[row + 1]].tobytes() + mark
                    total = len(packed) // 4
                    at, stop, number = 0, total % capacity or capacity, 0
                    while at < total:
                        length = stop - at
                        crc = zlib.crc32(packed[4 * at : 4 * stop])
                        piece = (docs_of[texts.first + row], number, at, length, crc)
                        for column, value in zip(columns, piece):
                            column.append(value)
                        places.append(int(seen[length]))
                        seen[length] += 1
                        at, stop, number = stop, stop + capacity, number + 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            arrays = [pa.array(c, type=t) for c, t in zip(columns, types)]
            arrays += [
                pa.array(np.full(len(places), block, dtype=np.int32)),
                pa.array(places, type=pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "block", "place"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def match_large(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Bins of pieces above a third: (lengths, how many such bins)."""
    large = sorted((n for n in counts if 3 * n > capacity), reverse=True)
    left = {n: counts[n] for n in large}
    bins = []
    for n in large:
        while left[n]:
            partner = next((m for m in large if left[m] > (m == n) and m <= capacity - n), None)
            if partner is None:
                bins.append(([n], left[n]))
                left[n] = 0
            elif partner == n:
                pairs = left[n] // 2
                bins.append(([n, n], pairs))
                left[n] -= 2 * pairs
            else:
                pairs = min(left[n], left[partner])
                bins.append(([n, partner], pairs))
                left[n] -= pairs
                left[partner] -= pairs
    return bins


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """All bins, as ({length: pieces of it in one bin}, how many such bins)."""
    by_gap: dict[int, list[tuple[dict[int, int], int]]] = {}

    def put(content: dict[int, int], number: int, gap: int) -> None:
        if number:
            by_gap.setdefault(gap, []).append((content, number))

    for lengths, number in match_large(counts, capacity):
        content: dict[int, int] = {}
        for n in lengths:
            content[n] = content.get(n, 0) + 1
        put(content, number, capacity - sum(lengths))

    for n in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
        rest = counts[n]
        touched = []
        for gap in sorted(g for g in by_gap if g >= n and by_gap[g]):
            each = gap // n
            entries = by_gap[gap]
            while entries and rest:
                content, number = entries.pop()
                full = min(number, rest // each)
                if full:
                    touched.append(({**content, n: each}, full, gap - each * n))
                    rest -= full * each
                    number -= full
                if number and rest:  # fewer pieces than one more bin of this kind takes
                    touched.append(({**content, n: rest}, 1, gap - rest * n))
                    number -= 1
                    rest = 0
                if number:
                    entries.append((content, number))
            if not rest:
                break
        if rest:
            each = capacity // n
            if rest // each:
                touched.append(({n: each}, rest // each, capacity - each * n))
            if rest % each:
                touched.append(({n: rest % each}, 1, capacity - rest % each * n))
        for content, number, gap in touched:
            put(content, number, gap)
    return [entry for gap in sorted(by_gap) for entry in by_gap[gap]]


class Plan:
    """Which bin and offset the k-th piece of a length gets; arrays of a few thousand entries."""

    def __init__(self, bins: list[tuple[dict[int, int], int]]):
        ranges: dict[int, list[tuple[int, int, int, int]]] = {}
        used: dict[int, int] = {}
        first_bin = 0
        for content, number in bins:
            offset = 0
            for n in sorted(content, reverse=True):
                at = used.get(n, 0)
                ranges.setdefault(n, []).append((at, first_bin, offset, content[n]))
                used[n] = at + number * content[n]
                offset += n * content[n]
            first_bin += number
        self.ranges = {n: np.array(rows, dtype=np.int64) for n, rows in ranges.items()}

    def place(self, length: np.ndarray, number: np.ndarray):
        bins = np.zeros(len(length), dtype=np.int64)
        offsets = np.zeros(len(length), dtype=np.int64)
        order = np.argsort(length, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
            if not len(rows):
                continue
            n = int(length[rows[0]])
            table = self.ranges[n]
            entry = table[np.searchsorted(table[:, 0], number[rows], side="right") - 1]
            inside = number[rows] - entry[:, 0]
            bins[rows] = entry[:, 1] + inside // entry[:, 3]
            offsets[rows] = entry[:, 2] + inside % entry[:, 3] * n
        return bins, offsets


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Pack all ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens."""
    cut = settle(pieces(docs, tokenizer, capacity, end), "pieces")
    per_block = cut.groupBy("length", "block").agg(F.count("*").alias("_n"))
    earlier = (
        Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = per_block.select(
        "length", "block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    # One row per length, so at most ``capacity`` rows reach the driver.
    counts = {r["length"]: r["_n"] for r in cut.groupBy("length").agg(
        F.count("*").alias("_n")).collect()}
    plan = Plan(plan_bins(counts, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, offsets = plan.place(
                batch.column("length").to_numpy(), batch.column("_number").to_numpy()
            )
            kept = [batch.column(c) for c in ("doc_id", "piece", "start")]
            kept += [batch.column("length").cast(pa.int64()), batch.column("ids_crc32")]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(bins), pa.array(offsets)], names=names
            )

    numbered = cut.join(before, ["length", "block"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("place") + F.col("_before")).alias("_number"),
    )
    return numbered.mapInArrow(
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long,"
        " sequence_id long, offset long",
    )
