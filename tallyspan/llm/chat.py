"""Transcripts to chat turns: roles by a hidden Markov model, then one canonical rendering.

The hidden states are "a turn of this role begins here" and "it goes on", for every role. A
line shows a speaker marker or none, its length, whether it asks, and whether a break precedes it.
Start, transition and emission probabilities are smoothed counts over conversations whose
roles are known. Viterbi finds the likeliest states of all lines of a conversation together.

A conversation may hold any share of all rows. Its messages are numbered across tasks and cut into
blocks; a block's best path from every state to every state is a small matrix, and those
matrices are chained the same way, block of blocks by block of blocks, until few enough are left. Then
every block is decoded between the states fixed at its ends, which gives the path a single pass
would give (of equally likely paths, one).

Messages are ordered by (turn, text), nulls first. Equal messages of a conversation count once. A
null text has no lines and renders to nothing; an empty one is one empty line. Rows with a null
conv_id are one conversation. A line that starts a turn closes the turn before it; the last message
with lines closes the last turn.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.tables import partitions
from tallyspan.operators.ordered import number_rows
from tallyspan.storage import settle

ROLES = ("system", "user", "assistant")
BLOCK = 1024
SMOOTHING = 0.5
IMPOSSIBLE = -1e12
STATES = 2 * len(ROLES)  # 2 r: a turn of role r begins; 2 r + 1: it goes on
START = STATES

# Words speakers are marked with, fixed values of common transcript styles.
MARKS = {
    "system": ("system", "instruction", "instructions", "developer"),
    "user": ("user", "human", "customer", "question", "prompt", "q"),
    "assistant": ("assistant", "ai", "bot", "agent", "model", "answer", "response", "a"),
}
_MARK_OF = {word: k + 1 for k, role in enumerate(ROLES) for word in MARKS[role]}
_WORDS = "|".join(sorted(_MARK_OF, key=len, reverse=True))
_MARKER = re.compile(
    rf"\s{{0,8}}(?:#{{1,4}} {{0,2}}|\*\*|\[|<\|?|\()?({_WORDS})(?:\*\*|\]|\|?>|\))?(?: ?[:>] ?|(?<=[\]>)]) ?)",
    re.IGNORECASE,
)
_OTHER = re.compile(r"[A-Z][\w.-]{0,24}: ")
#: How many values each feature of a line has: marker, length, question, break.
FEATURES = (len(ROLES) + 2, 4, 2, 2)


def features(line: str, after_break: bool) -> tuple[int, int, int, int]:
    mark = _MARKER.match(line)
    marker = _MARK_OF[mark[1].lower()] if mark else FEATURES[0] - 1 if _OTHER.match(line) else 0
    size = 0 if not line.strip() else 1 if len(line) < 40 else 2 if len(line) < 200 else 3
    return marker, size, int(line.rstrip().endswith("?")), int(after_break)


def lines_of(text: str) -> list[tuple[str, tuple[int, int, int, int]]]:
    """Lines of a message with their features; a message's first line follows a break."""
    found, after_break = [], True
    for line in text.split("\n"):
        found.append((line, features(line, after_break)))
        after_break = not line.strip()
    return found


class Model:
    """Log probabilities: from each state (or the start) to each, and of each feature's value."""

    def __init__(self, moves: np.ndarray, emissions: list[np.ndarray]):
        self.moves, self.emissions = moves, emissions

    def emit(self, seen: tuple[int, ...]) -> np.ndarray:
        return sum(e[:, v] for e, v in zip(self.emissions, seen))

    def through(self, seen: list[tuple[int, ...]]) -> np.ndarray:
        """Best log probability from each state before the lines to each state at their end."""
        best = None
        for each in seen:
            if best is None:
                best = self.moves + self.emit(each)
            else:
                best = chain(best, self.moves[:STATES]) + self.emit(each)
        return best

    def path(self, seen: list[tuple[int, ...]], entry: int, leave: int | None) -> list[int]:
        """The best states of the lines from the state ``entry`` to ``leave`` (any if None)."""
        score, back = self.moves[entry] + self.emit(seen[0]), []
        for each in seen[1:]:
            ways = score[:, None] + self.moves[:STATES]
            back.append(ways.argmax(axis=0))
            score = ways.max(axis=0) + self.emit(each)
        states = [int(score.argmax()) if leave is None else leave]
        for step in reversed(back):
            states.append(int(step[states[-1]]))
        return states[::-1]


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Best way through two steps, the second from the state the first ends in."""
    return (left[:, :, None] + right[None, :STATES, :]).max(axis=1)


def _model(counts: dict[tuple[int, int, int], int]) -> Model:
    """From counts of (feature or -1 for moves, value or state before, state)."""
    moves = np.full((STATES + 1, STATES), IMPOSSIBLE)
    for before in range(STATES + 1):
        allowed = [s for s in range(STATES) if s % 2 == 0 or before in (s, s - 1)]
        total = sum(counts.get((-1, before, s), 0) + SMOOTHING for s in allowed)
        for s in allowed:
            moves[before, s] = log((counts.get((-1, before, s), 0) + SMOOTHING) / total)
    emissions = []
    for k, values in enumerate(FEATURES):
        table = np.zeros((STATES, values))
        for s in range(STATES):
            total = sum(counts.get((k, v, s), 0) + SMOOTHING for v in range(values))
            for v in range(values):
                table[s, v] = log((counts.get((k, v, s), 0) + SMOOTHING) / total)
        emissions.append(table)
    return Model(moves, emissions)


def learn(messages: DataFrame) -> Model:
    """A model of numbered messages (conv_id, position, text, role) whose roles are known."""
    place = F.array_position(F.array(*[F.lit(r) for r in ROLES]), F.lower("role")) - 1
    known = messages.filter("text is not null").withColumn("_r", place.cast("int")).filter("_r >= 0")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            for text, role in zip(batch.column(0), batch.column(1).to_pylist()):
                before = None
                for at, (_, seen) in enumerate(lines_of(text.as_py())):
                    state = 2 * role + (at > 0)
                    keys = [(k, v, state) for k, v in enumerate(seen)]
                    if before is not None:
                        keys.append((-1, before, state))
                    for key in keys:
                        totals[key] = totals.get(key, 0) + 1
                    before = state
        if totals:
            columns = [*zip(*totals), list(totals.values())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=pa.int64()) for c in columns], names=["k", "v", "s", "n"]
            )

    inside = known.select("text", "_r").mapInArrow(count, "k long, v long, s long, n long")
    # Moves from one message to the next: positions are dense, so the neighbour is a join away.
    ends = known.select(
        F.col("conv_id").alias("_c"), (F.col("position") + 1).alias("_p"),
        (2 * F.col("_r") + (F.instr("text", "\n") > 0).cast("int")).alias("_s"),
    )
    begins = known.join(
        ends, F.expr("conv_id <=> _c and position = _p"), "left"
    ).filter("_s is not null or position = 1").select(
        F.lit(-1).cast("long").alias("k"), F.coalesce("_s", F.lit(START)).cast("long").alias("v"),
        (2 * F.col("_r")).cast("long").alias("s"), F.lit(1).cast("long").alias("n"),
    )
    rows = inside.union(begins).groupBy("k", "v", "s").agg(F.sum("n").alias("n")).collect()
    return _model({(r["k"], r["v"], r["s"]): r["n"] for r in rows})  # states times feature values


def _groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, list]]:
    """Rows sorted by their first ``width`` columns, as (those columns, rows as tuples)."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and row[:width] != key:
                yield key, rows
                rows = []
            key = row[:width]
            rows.append(row[width:])
    if rows:
        yield key, rows


def _by_block(df: DataFrame, order: str) -> DataFrame:
    return df.repartition(partitions(df.sparkSession), "conv_id", "block").sortWithinPartitions(
        "conv_id", "block", order
    )


_ENDS = "conv_id {kind}, block long, entry int, leave int"


def _ends(matrices: DataFrame, size: int) -> DataFrame:
    """``(conv_id, block, entry, leave)``: the states around every block on the best path.

    ``matrices`` are (conv_id, block, ways) with blocks from 0 on, not necessarily all of them.
    """
    kind = dict(matrices.dtypes)["conv_id"]
    schema = _ENDS.format(kind=kind)
    over = matrices.withColumn("inner", F.col("block")).withColumn(
        "block", F.floor(F.col("block") / size).cast("long")
    ).select("conv_id", "block", "inner", "ways")

    def around(rows, entry, leave):
        """States around each of the rows (inner, ways), given those around them all."""
        steps = [np.array(ways).reshape(STATES + 1, STATES) for _, ways in rows]
        scores = [steps[0][entry]]
        for step in steps[1:]:
            scores.append((scores[-1][:, None] + step[:STATES]).max(axis=0))
        state = int(scores[-1].argmax()) if leave is None else leave
        found = []
        for at in range(len(rows) - 1, -1, -1):
            before = entry if at == 0 else int((scores[at - 1] + steps[at][:STATES, state]).argmax())
            found.append((rows[at][0], before, state))
            state = before
        return found

    def out(conv, found):
        return pa.RecordBatch.from_pylist(
            [{"conv_id": conv, "block": b, "entry": e, "leave": x} for b, e, x in found],
            schema=pa.schema([("conv_id", _arrow(kind)), ("block", pa.int64()),
                              ("entry", pa.int32()), ("leave", pa.int32())]),
        )

    if not (matrices.agg(F.max("block").alias("b")).first()["b"] or 0) >= size:
        def whole(batches):
            for (conv, _), rows in _groups(batches, 2):
                yield out(conv, around(rows, START, None))

        return _by_block(over, "inner").mapInArrow(whole, schema)

    def join(batches):
        for (conv, block), rows in _groups(batches, 2):
            total = None
            for _, ways in rows:
                step = np.array(ways).reshape(STATES + 1, STATES)
                total = step if total is None else chain(total, step)
            yield pa.RecordBatch.from_pylist(
                [{"conv_id": conv, "block": block, "ways": total.reshape(-1).tolist()}],
                schema=pa.schema([("conv_id", _arrow(kind)), ("block", pa.int64()),
                                  ("ways", pa.list_(pa.float64()))]),
            )

    upper = settle(
        _by_block(over, "inner").mapInArrow(
            join, f"conv_id {kind}, block long, ways array<double>"
        ), "block-matrices",
    )
    fixed = _ends(upper, size).withColumnRenamed("block", "_b").withColumnRenamed("conv_id", "_c")
    tied = over.join(fixed, F.expr("conv_id <=> _c and block = _b")).select(
        "conv_id", "block", "entry", "leave", "inner", "ways"
    )

    def within(batches):
        for (conv, _, entry, leave), rows in _groups(batches, 4):
            yield out(conv, around(rows, entry, leave))

    return _by_block(tied, "inner").mapInArrow(within, schema)


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def parse(messages: DataFrame, model: Model, block: int = BLOCK) -> DataFrame:
    """Turns of numbered messages (conv_id, turn, position, text).

    One row per message: ``states`` of its lines (a role's letter, upper case where a turn
    begins) and ``rendered``, its piece of the canonical text. The pieces of a conversation, in the
    order of ``position``, make up its rendering.
    """
    kind = dict(messages.dtypes)["conv_id"]
    placed = messages.select(
        "conv_id", F.floor((F.col("position") - 1) / block).cast("long").alias("block"),
        "position", F.col("turn").cast("long").alias("turn"), "text",
    )
    full = placed.filter("text is not null")
    blocks = full.groupBy("conv_id").agg(
        F.max("position").alias("_last"), F.max("block").alias("_blocks")
    )
    blocks = settle(blocks.withColumnRenamed("conv_id", "_c"), "conversations")
    tagged = placed.join(blocks, F.expr("conv_id <=> _c"), "left")
    long_ones = tagged.filter("text is not null and _blocks > 0").select(
        "conv_id", "block", "position", "text"
    )

    def matrices(batches):
        for (conv, number), rows in _groups(batches, 2):
            seen = [s for _, text in rows for _, s in lines_of(text)]
            yield pa.RecordBatch.from_pylist(
                [{"conv_id": conv, "block": number, "ways": model.through(seen).reshape(-1).tolist()}],
                schema=pa.schema([("conv_id", _arrow(kind)), ("block", pa.int64()),
                                  ("ways", pa.list_(pa.float64()))]),
            )

    ways = settle(
        _by_block(long_ones, "position").mapInArrow(
            matrices, f"conv_id {kind}, block long, ways array<double>"
        ), "block-matrices",
    )
    ends = _ends(ways, block).withColumnRenamed("conv_id", "_e").withColumnRenamed("block", "_b")
    bound = tagged.join(ends, F.expr("conv_id <=> _e and block = _b"), "left").select(
        "conv_id", "block", "position", "turn", "text", "entry", "leave", "_last"
    )

    def decode(batches):
        for (conv, _), rows in _groups(batches, 2):
            texts = [lines_of(r[2]) if r[2] is not None else [] for r in rows]
            seen = [s for lines in texts for _, s in lines]
            # A block that is its conversation's only one is tied to the start alone.
            entry, leave = next(((r[3], r[4]) for r in rows if r[3] is not None), (START, None))
            states = iter(model.path(seen, entry, leave) if seen else [])
            first = entry == START
            out = []
            for (position, turn, text, _, _, last), lines in zip(rows, texts):
                letters, parts = [], []
                for line, _ in lines:
                    state = next(states)
                    role = ROLES[state // 2]
                    if state % 2 == 0:
                        mark = _MARKER.match(line)
                        parts.append(("" if first else "<|im_end|>\n") + f"<|im_start|>{role}\n")
                        line = line[mark.end() :] if mark else line
                        letters.append(role[0].upper())
                    else:
                        letters.append(role[0])
                    first = False
                    parts.append(line + "\n")
                if last == position and lines:
                    parts.append("<|im_end|>\n")
                out.append({
                    "conv_id": conv, "turn": turn, "position": position, "n_lines": len(lines),
                    "states": "".join(letters), "rendered": "".join(parts),
                })
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("conv_id", _arrow(kind)), ("turn", pa.int64()), ("position", pa.int64()),
                ("n_lines", pa.int64()), ("states", pa.string()), ("rendered", pa.string()),
            ]))

    return _by_block(bound, "position").mapInArrow(
        decode, f"conv_id {kind}, turn long, position long, n_lines long, states string, rendered string"
    )


def numbered(messages: DataFrame) -> DataFrame:
    """Messages of each conversation in order, with a dense ``position`` from 1."""
    distinct = messages.dropDuplicates(["conv_id", "turn", "text"])
    return settle(
        number_rows(distinct, ["conv_id"], [F.col("turn"), F.col("text")]), "messages"
    )


def transcripts_to_turns(messages: DataFrame, learned: Column, block: int = BLOCK) -> DataFrame:
    """Parse all ``messages`` (conv_id, turn, text, role); roles are read where ``learned`` only."""
    rows = numbered(messages.select("conv_id", "turn", "text", "role"))
    model = learn(rows.filter(learned))
    return parse(rows, model, block)
