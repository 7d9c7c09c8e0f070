"""Transcripts of conversations that have closed, from a stream of their messages.

The messages of an open conversation wait in keyed state, a list that arriving batches append to; an
event-time timer closes the conversation ``gap`` after its last message, gives out its transcript in parts and
drops the messages. A key can hold several conversations, as pauses divide them, and late messages within
the watermark's delay may still join two of them. What is held and sorted at once are the open messages of
one key.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallyspan.operators.sessions import PART_TURNS, PLACEHOLDER
from tallyspan.streaming.usage import LATENESS

#: (event time in microseconds, turn, role, text)
Message = tuple[int, int, str | None, str | None]


def divided(messages: list[Message], gap: int) -> Iterator[list[Message]]:
    """Messages in order, cut where no message came for ``gap`` microseconds."""
    session: list[Message] = []
    for message in sorted(messages, key=lambda m: (m[0], m[1], m[2] or "", m[3] or "")):
        if session and message[0] - session[-1][0] >= gap:
            yield session
            session = []
        session.append(message)
    if session:
        yield session


class ClosedSessions(StatefulProcessor):
    """Messages of one key in, transcripts of its closed sessions out."""

    def __init__(self, gap: int, template: str, part_turns: int):
        self.gap, self.part_turns = gap, part_turns
        self.before, _, self.after = template.partition(PLACEHOLDER)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "at bigint, turn bigint, role string, text string")

    def _ends(self, session: list[Message]) -> int:
        """When a session closes, in milliseconds, not before its last microsecond."""
        return -(-(session[-1][0] + self.gap) // 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        for batch in rows:
            came = batch[["at", "turn", "role", "text"]].astype(object)
            came = came.where(came.notna(), None)
            # A message whose own session would be closed already comes too late.
            new = [(int(a), int(t or 0), r, x) for a, t, r, x in came.itertuples(index=False)
                   if -(-(int(a) + self.gap) // 1000) > mark]
            if new:
                self.open.appendList(new)
            for session in divided(new, self.gap):
                # The last message of any session is the last of its part of some batch, too.
                self.handle.registerTimer(self._ends(session))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        messages = list(map(tuple, self.open.get()))
        closed, still = [], []
        for session in divided(messages, self.gap):
            (closed if self._ends(session) <= mark else still).append(session)
        if not closed:
            return
        if still:
            self.open.put([m for session in still for m in session])
        else:
            self.open.clear()
        for session in closed:
            yield pd.DataFrame(self._parts(key[0], session), columns=[
                "session", "start", "end", "turns", "part", "transcript"])

    def _parts(self, key, session: list[Message]) -> list[tuple]:
        lines = [f"{role or ''}: {text or ''}" for _, _, role, text in session]
        cuts = range(0, len(lines), self.part_turns)
        found = []
        for part, at in enumerate(cuts):
            body = "\n".join(lines[at : at + self.part_turns])
            body = (self.before if part == 0 else "") + body
            body += self.after if part == len(cuts) - 1 else "\n"
            found.append((key, session[0][0], session[-1][0] + self.gap, len(lines), part, body))
        return found

    def close(self) -> None:
        pass


def stream_transcripts(
    source: DataFrame, gap_seconds: int, key: str = "session_id", template: str = PLACEHOLDER,
    delay: str = LATENESS, part_turns: int = PART_TURNS,
) -> DataFrame:
    """``(key, session_start, session_end, turns, part, transcript)`` of closed conversations.

    ``source``: (key, event_time, turn, role, text). The lines are those of ``render_transcript``, in order of
    (event_time, turn); parts put together in order are the transcript. Messages without a time or
    key are left out, and so are those that come when their conversation is closed already. Start the
    stream inside ``runs.keyed_state``.
    """
    seen = source.withColumn("_seen", F.col("event_time").cast("timestamp")).withWatermark("_seen", delay)
    messages = seen.filter(F.col("_seen").isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).cast("string").alias("session"),
        F.unix_micros(F.col("event_time").cast("timestamp")).alias("at"),
        F.col("turn").cast("bigint").alias("turn"), "role", "text",
    )
    closed = messages.groupBy("session").transformWithStateInPandas(
        ClosedSessions(gap_seconds * 1_000_000, template, part_turns),
        "session string, start bigint, end bigint, turns bigint, part bigint, transcript string",
        "append", "eventTime",
    )
    return closed.select(
        F.col("session").alias(key), F.timestamp_micros("start").alias("session_start"),
        F.timestamp_micros("end").alias("session_end"), "turns", "part", "transcript",
    )
