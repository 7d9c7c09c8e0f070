"""Sessions, traces, transcripts and prompt versions.

``turn`` is the message's number in its session (whole, unique, from 0). A
session may hold any share of all messages, so nothing here gathers a session:
ordered work runs in blocks of turns (``operators.ordered``), and a transcript
is delivered in parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.operators.ordered import (
    BLOCK_ROWS, next_value, number_rows, running_sums,
)
from tallyspan.storage import settle

PART_TURNS = 1000
PLACEHOLDER = "{{ conversation }}"


def spoken(conv: DataFrame) -> DataFrame:
    """User and assistant messages; system and tool messages are not history."""
    return conv.filter(F.col("role").isin("user", "assistant"))


def history_before_turn(conv: DataFrame) -> DataFrame:
    """Each message with its place in the session's history.

    The history a message was written against is the messages of its session
    whose ``history_len`` is smaller. Writing those lists out for every message
    would square the table, so they are kept as this length and looked up with
    ``history_messages`` where they are wanted.
    """
    history = running_sums(
        spoken(conv), ["session_id"], "turn",
        {"history_len": F.lit(1), "history_chars": F.length("text")},
    )
    return history.withColumns(
        {
            "history_len": F.col("history_len").cast("bigint"),
            "history_chars": F.col("history_chars").cast("bigint"),
        }
    )


def history_messages(conv: DataFrame, wanted: DataFrame) -> DataFrame:
    """The earlier messages of chosen turns, one row each.

    ``wanted`` holds ``(session_id, before_turn)``. Each wanted turn is repeated
    for the blocks of turns before it - once, for a session of ordinary length -
    so that the join key splits a long session.
    """
    block = F.floor(F.col("turn") / BLOCK_ROWS).cast("bigint")
    reach = F.floor(F.col("before_turn") / BLOCK_ROWS).cast("bigint")
    blocks = wanted.select(
        "session_id", "before_turn",
        F.explode(F.sequence(F.lit(0).cast("bigint"), reach)).alias("_block"),
    )
    return (
        spoken(conv)
        .withColumn("_block", block)
        .join(blocks, ["session_id", "_block"])
        .filter(F.col("turn") < F.col("before_turn"))
        .select("session_id", "before_turn", "turn", "role", "text")
    )


def last_turns(conv: DataFrame) -> DataFrame:
    """The last user message of every session."""
    return (
        conv.filter(F.col("role") == "user")
        .groupBy("session_id")
        .agg(F.max("turn").alias("before_turn"))
    )


def turn_pairs(conv: DataFrame) -> DataFrame:
    """A user message and the assistant reply right after it; no reply -> null."""
    following = next_value(
        spoken(conv), ["session_id"], "turn", F.struct("role", "text"), "_next"
    )
    return following.filter(F.col("role") == "user").select(
        "session_id", "turn", F.col("text").alias("request"),
        F.when(F.col("_next.role") == "assistant", F.col("_next.text")).alias("response"),
    )


def last_assistant(conv: DataFrame) -> DataFrame:
    """The last assistant message of each session that has text."""
    said = (F.col("role") == "assistant") & (F.coalesce("text", F.lit("")) != "")
    return conv.groupBy("session_id").agg(
        F.max_by(F.when(said, F.col("text")), F.when(said, F.col("turn"))).alias("answer"),
        F.max(F.when(said, F.col("turn"))).alias("turn"),
    )


def traces_by_time(traces: DataFrame) -> DataFrame:
    return traces.select("request_time", "request", "response").orderBy("request_time")


def render_transcript(
    conv: DataFrame, template: str = PLACEHOLDER, part_turns: int = PART_TURNS
) -> DataFrame:
    """The session's messages as text, set into the template.

    Delivered as parts of ``part_turns`` turns; put together in order of ``part``
    they are the transcript. A session of ordinary length is one part.
    """
    before, _, after = template.partition(PLACEHOLDER)
    parted = conv.withColumn("part", F.floor(F.col("turn") / part_turns).cast("bigint"))
    lines = F.transform(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))),
        # A message without a text keeps its line.
        lambda m: F.concat(
            F.coalesce(m["role"], F.lit("")), F.lit(": "), F.coalesce(m["text"], F.lit(""))
        ),
    )
    parts = parted.groupBy("session_id", "part").agg(F.array_join(lines, "\n").alias("body"))
    # First and last part come from two integers per session; the text of a long
    # session stays spread over its parts.
    ends = parted.groupBy("session_id").agg(
        F.min("part").alias("_first"), F.max("part").alias("_last")
    )
    first, last = F.col("part") == F.col("_first"), F.col("part") == F.col("_last")
    return parts.join(ends, "session_id").select(
        "session_id",
        "part",
        F.concat(
            F.when(first, F.lit(before)).otherwise(F.lit("")),
            "body",
            F.when(last, F.lit(after)).otherwise(F.lit("\n")),
        ).alias("transcript"),
    )


def session_rollup(conv: DataFrame) -> DataFrame:
    return conv.groupBy("session_id").agg(
        F.count("*").alias("messages"),
        F.count_if(F.col("role") == "user").alias("traces"),
        F.min("turn").alias("first_turn"),
        F.max("turn").alias("last_turn"),
    )


def search_traces(
    traces: DataFrame, run_id: str | None = None, metadata: dict[str, str] | None = None
) -> DataFrame:
    """Traces of one run and/or with the given metadata values."""
    if run_id is not None:
        traces = traces.filter(F.col("run_id") == run_id)
    for key, value in (metadata or {}).items():
        traces = traces.filter(F.col("metadata")[key] == value)
    return traces


def require_traces(sessions: DataFrame, traces: DataFrame) -> DataFrame:
    """Sessions asked for that have no trace."""
    return sessions.join(traces.select("session_id").distinct(), "session_id", "left_anti")


def span_counts(spans: DataFrame, types: tuple[str, ...] = ("TOOL", "CHAIN", "CHAT_MODEL")):
    """Number of spans of each type per trace."""
    return spans.groupBy("trace_id").agg(
        *[F.count_if(F.col("type") == kind).alias(f"{kind.lower()}_spans") for kind in types]
    )


def span_tree(spans: DataFrame) -> DataFrame:
    """Depth and root of every span, by doubling: after round n each span knows its
    ancestor 2^n levels up, so a tree of depth d takes log2(d) joins, not d.

    A span whose parent is not in the trace is a root. A span delivered more than once
    counts once, with the smallest parent named. Spans on a cycle never reach one: when a round resolves nothing, only those are left, with null.
    A parent with very many children is a skewed join key, which the adaptive
    skew join splits; the other side holds each span once.
    """
    spans = spans.groupBy("trace_id", "span_id").agg(F.min("parent_id").alias("parent_id"))
    ids = spans.select(
        "trace_id", F.col("span_id").alias("up"), F.lit(True).alias("_there")
    ).distinct()
    start = spans.select("trace_id", "span_id", F.col("parent_id").alias("up")).join(
        ids, ["trace_id", "up"], "left"
    )
    there = F.col("_there").isNotNull()
    state = settle(
        start.select(
            "trace_id", "span_id",
            F.when(there, F.col("up")).alias("up"),
            F.when(there, 1).otherwise(0).cast("bigint").alias("steps"),
            F.when(~there, F.col("span_id")).alias("root"),
        ),
        "spans",
    )
    open_before = None
    while True:
        still_open = state.filter(F.col("root").isNull()).count()
        if still_open in (0, open_before):
            break
        open_before = still_open
        above = state.select(
            "trace_id", F.col("span_id").alias("up"), F.col("up").alias("_up"),
            F.col("steps").alias("_steps"), F.col("root").alias("_root"),
        )
        unresolved = F.col("root").isNull()
        state = settle(
            state.join(above, ["trace_id", "up"], "left").select(
                "trace_id", "span_id",
                F.when(unresolved, F.col("_up")).alias("up"),
                (F.col("steps") + F.coalesce(F.when(unresolved, F.col("_steps")), F.lit(0)))
                .alias("steps"),
                F.coalesce("root", "_root").alias("root"),
            ),
            "spans",
        )
    return state.select(
        "trace_id", "span_id", F.when(F.col("root").isNotNull(), F.col("steps")).alias("depth"),
        "root",
    )


# -- prompts ----------------------------------------------------------------


def latest_prompt(registry: DataFrame, version: int | None = None) -> DataFrame:
    """Newest version of each prompt, or the pinned one."""
    if version is not None:
        return registry.filter(F.col("version") == version)
    newest = F.max_by(F.struct("template", "commit_message"), "version")
    return (
        registry.groupBy("name")
        .agg(F.max("version").alias("version"), newest.alias("_row"))
        .select("name", "version", "_row.template", "_row.commit_message")
    )


def append_prompt_version(registry: DataFrame, new: DataFrame, order: str) -> DataFrame:
    """The rows to append: each new text becomes the next version of its name."""
    current = registry.groupBy("name").agg(F.max("version").alias("_version"))
    numbered = number_rows(new, ["name"], [F.col(order)], position="_no")
    return numbered.join(current, "name", "left").select(
        "name",
        (F.coalesce(F.col("_version"), F.lit(0)) + F.col("_no")).cast("int").alias("version"),
        "template",
        "commit_message",
    )


def register_if_missing(registry: DataFrame, new: DataFrame) -> DataFrame:
    """The registry plus those prompts whose name it does not know yet.

    Of several new prompts of one name the first in order of the other columns is added.
    """
    others = [c for c in registry.columns if c != "name"]
    unknown = (
        new.join(registry.select("name"), "name", "left_anti")
        .groupBy("name").agg(F.min(F.struct(*others)).alias("_row"))
        .select("name", *[F.col("_row")[c].alias(c) for c in others])
    )
    return registry.unionByName(unknown)
