"""Personal data: exact formats as seeds, and what the seeds' contexts reveal beside them.

1. A scan finds the base spans (email, ip, card, phone) of every text, and *mentions*: every
   token with a digit or an at sign that no base span touches. A mention may be of the kinds its
   shape allows; one that allows none still speaks against the contexts it stands in.
2. Contexts are lexical patterns: the two words before, or the word on either side. Patterns
   and instances form a bipartite graph. In rounds, a pattern's confidence for a kind is the
   share of its instances known to be of that kind, each counted by its own
   confidence, and a mention takes the best confidence of its patterns. Patterns need
   ``SUPPORT`` different known instances and a confidence of ``CONFIDENCE``. Confidences are whole
   millionths and only rise, so rounds go on until none changes.
3. Mentions that stand in a pattern accepted in the last round and have its kind's shape are new
   spans. Base spans always stay.

Offsets are code points, ends exclusive. Null and empty texts have no spans. Repeated rows come
back repeated, but repeated instances of a pattern count once. The graph is joined and grouped in
Spark; patterns as frequent as any only ever meet as sums.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.tables import fresh_name
from tallyspan.storage import settle

KINDS = ("email", "ip", "card", "phone")
SUPPORT = 3
CONFIDENCE = 0.8
MILLION = 1_000_000

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_EDGE = ".,;:!?()[]{}<>\"'"
_CONTEXT = 120  # characters looked at on either side for context words


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0
    at = text.find("@")
    while at >= 0:
        # The part before the sign reaches as far back as its characters do.
        start = free + len(text[free:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
            at = text.find("@", free)
        else:
            free = at + 1
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of all base spans, in order; kinds by their place in ``KINDS``."""
    found = [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [part.lstrip("0") for part in m[0].split(".")]
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def shapes(token: str) -> int:
    """Bits of the kinds a token's form allows."""
    bits = 0
    digits = len(_DIGIT.findall(token))
    plain = re.fullmatch(r"[0-9().\-/]+", token) is not None
    name, sign, host = token.partition("@")
    if sign and name and host:
        bits |= 1
    if re.fullmatch(r"[0-9]+(\.[0-9]+){3}|[0-9A-Fa-f]*(:[0-9A-Fa-f]*){2,7}", token) and digits:
        bits |= 2
    if plain and 12 <= digits <= 19:
        bits |= 4
    if plain and 7 <= digits <= 15:
        bits |= 8
    return bits


def _key(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\x00".join(parts).encode(), 0) - (1 << 63)


def contexts(text: str, start: int, end: int) -> tuple[int, int]:
    """The two patterns a span stands in, as numbers; 0 where words are missing."""
    before = [w.strip(_EDGE).lower() for w in text[max(0, start - _CONTEXT) : start].split()[-2:]]
    after = [w.strip(_EDGE).lower() for w in text[end : end + _CONTEXT].split()[:1]]
    before = [_DIGIT.sub("0", w) for w in before if w]
    after = [_DIGIT.sub("0", w) for w in after if w]
    left = _key("before", *before) if len(before) == 2 else 0
    around = _key("around", before[-1], after[0]) if before and after else 0
    return left, around


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``(start, end, kinds allowed)`` of tokens with a digit or at sign outside base spans."""
    if "@" not in text and not _DIGIT.search(text):
        return []
    taken = sorted((a, b) for a, _, b in base)
    reach = np.maximum.accumulate([b for _, b in taken]) if taken else np.zeros(0)
    begins = np.array([a for a, _ in taken])
    found = []
    for m in _TOKEN.finditer(text):
        token = m[0]
        start = m.start() + len(token) - len(token.lstrip(_EDGE))
        token = token.strip(_EDGE)
        end = start + len(token)
        k = int(np.searchsorted(begins, end)) - 1 if len(begins) else -1
        if token and (k < 0 or reach[k] <= start):
            found.append((start, end, shapes(token)))
    return found


SCANNED = (
    "row long, doc_id long, text_key long,"
    " base array<struct<start:int,kind:int,stop:int>>,"
    " edges array<struct<pattern:long,instance:long,kind:int,shapes:int,start:int,stop:int>>"
)
_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32())])
_EDGES = pa.struct([
    ("pattern", pa.int64()), ("instance", pa.int64()), ("kind", pa.int32()),
    ("shapes", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()),
])


def scan(docs: DataFrame) -> DataFrame:
    """Base spans and graph edges of every row; ``kind`` is null on edges of mentions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            base, edges = [], []
            for value in batch.column(2):
                text = value.as_py() or ""
                spans = base_spans(text)
                base.append(spans)
                near = []
                seeds = [(a, b, kind, 0) for a, kind, b in spans]
                for a, b, kind, allowed in seeds + [
                    (a, b, None, s) for a, b, s in mentions(text, spans)
                ]:
                    instance = _key(text[a:b].lower())
                    for pattern in contexts(text, a, b):
                        if pattern:
                            near.append((pattern, instance, kind, allowed, a, b))
                edges.append(near)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + n)), batch.column(0), batch.column(1),
                 _structs(base, _SPAN), _structs(edges, _EDGES)],
                names=["row", "doc_id", "text_key", "base", "edges"],
            )
            row += n

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    ).mapInArrow(run, SCANNED)


def _structs(lists: list[list[tuple]], kind: pa.StructType) -> pa.Array:
    ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
    columns = list(zip(*(x for each in lists for x in each))) or [[] for _ in kind]
    values = pa.StructArray.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, kind)], fields=list(kind)
    )
    return pa.ListArray.from_arrays(pa.array(ends), values)


def accepted_patterns(edges: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE,
                      rounds: int | None = None) -> DataFrame:
    """``(pattern, kind, score)`` after scoring patterns and instances in turn.

    ``edges`` are distinct (pattern, instance, kind, shapes); ``kind`` is null for mentions.
    Without ``rounds``, until the accepted patterns and their scores stay as they are.
    """
    sizes = edges.groupBy("pattern").agg(F.countDistinct("instance").alias("size"))
    # Patterns without enough seeds can still gain them, but none without any instance more.
    sizes = sizes.filter(F.col("size") >= support)
    known = edges.filter("kind is not null").select("instance", "kind").distinct().withColumn(
        "score", F.lit(MILLION).cast("long")
    )
    open_ = edges.filter("kind is null").select("pattern", "instance", "shapes").distinct()
    links = edges.select("pattern", "instance").distinct()
    scores, before, done = known, None, 0
    while True:
        good = (
            links.join(scores, "instance")
            .groupBy("pattern", "kind").agg(F.sum("score").alias("weight"))
            .filter(F.col("weight") >= support * MILLION)
            .join(sizes, "pattern")
            .select("pattern", "kind", F.expr("weight div size").alias("score"))
            .filter(F.col("score") >= confidence * MILLION)
        )
        good = settle(good, "patterns")
        now = good.agg(F.count("*").alias("n"), F.sum("score").alias("s")).first()
        done += 1
        if now == before or not now["n"] or done == rounds:
            return good.withColumn("score", F.col("score") / MILLION)
        before = now
        allowed = F.expr("shiftright(shapes, kind) & 1 = 1")
        fresh = (
            open_.join(good, "pattern").filter(allowed)
            .groupBy("instance", "kind").agg(F.max("score").alias("score"))
        )
        fresh = settle(fresh, "instances")
        scores = known.union(fresh).groupBy("instance", "kind").agg(F.max("score").alias("score"))


def _names(column: str) -> F.Column:
    return F.expr(
        f"array_join(transform({column}, s -> concat_ws(':', element_at(array("
        + ", ".join(f"'{k}'" for k in KINDS)
        + "), s.kind + 1), s.start, s.stop)), ',')"
    )


def find(docs: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE,
         rounds: int | None = None) -> DataFrame:
    """One row per row of ``docs``: the base spans and all spans, in order.

    ``base`` and ``spans`` are arrays of (start, kind, stop).
    """
    scanned = settle(scan(docs), "personal-data")
    mentioned = scanned.select("row", F.explode("edges").alias("e")).select("row", "e.*")
    edges = settle(
        mentioned.select("pattern", "instance", "kind", "shapes").distinct(), "edges"
    )
    good = accepted_patterns(edges, support, confidence, rounds)
    added = (
        mentioned.filter("kind is null").drop("kind")
        .join(good, "pattern")
        .filter("shiftright(shapes, kind) & 1 = 1")
        .groupBy("row", "start", "stop")
        .agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind"))
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "kind", "stop")).alias("added"))
    )
    return scanned.join(added, "row", "left").select(
        "doc_id", "text_key", "base",
        F.when(F.col("added").isNull(), F.col("base"))
        .otherwise(F.array_sort(F.concat("base", F.coalesce("added", F.array()))))
        .alias("spans"),
    )


def report(docs: DataFrame, **settings) -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans written out."""
    return find(docs, **settings).select(
        "doc_id",
        *[
            F.expr(f"size(filter(base, s -> s.kind = {k}))").cast("long").alias(f"n_{name}")
            for k, name in enumerate(KINDS)
        ],
        F.sha2(_names("base"), 256).alias("base_sha256"),
        _names("spans").alias("spans"),
    )


def redact(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; ``n_chars`` follows."""
    spans = find(docs, **settings).filter(F.size("spans") > 0)
    # Rows with the same id and text have the same spans.
    spans = spans.select("doc_id", "text_key", "spans").dropDuplicates(["doc_id", "text_key"])
    left, right = docs.alias("l"), spans.alias("r")
    joined = left.join(
        right,
        F.expr("l.doc_id <=> r.doc_id and xxhash64(l.text) = r.text_key"), "left",
    ).select("l.*", F.col("r.spans").alias(fresh_name(docs, "_spans")))
    names = docs.columns
    position = names.index("text")

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for value, spans in zip(batch.column(position), batch.column(batch.num_columns - 1)):
                text = value.as_py()
                if text is not None and spans.is_valid:
                    parts, at = [], 0
                    for span in spans.as_py():
                        if span["stop"] > at:
                            parts += [text[at : max(at, span["start"])], f"<{KINDS[span['kind']].upper()}>"]
                            at = span["stop"]
                    text = "".join([*parts, text[at:]])
                texts.append(text)
            columns = list(batch.columns[:-1])
            columns[position] = pa.array(texts, type=columns[position].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    cleaned = joined.mapInArrow(replace, docs.schema)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(kind))
    return cleaned
