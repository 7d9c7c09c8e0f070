"""Scoring whole sessions and single answers.

Built-in scores are column expressions. ``judge_sessions`` and the factories at
the end take user functions. The built-in session scores are rule-based
stand-ins: they keep the contract of a model judge (session in, typed value and
reason out), not its judgement.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions import rules
from tallyspan.operators.ordered import next_value, running_sums
from tallyspan.operators.sessions import (
    PART_TURNS, PLACEHOLDER, render_transcript, session_rollup, spoken,
)

# The bands and labels of the built-in judges.
RETENTION = ("excellent", "good", "fair", "poor")
SEARCH_USE = ("necessary", "unnecessary", "skipped")

MERGE_FAN = 1024


# -- user-defined judges of whole sessions ----------------------------------


@dataclass(frozen=True)
class SessionJudge:
    """A judge of a whole session that reads it in order, part by part.

    ``read`` turns one part (a frame of turn, role, text in order) into a small
    JSON-able state, ``merge`` joins the states of two neighbouring stretches, and
    ``decide`` turns the state of the whole session into (value, reason). This is
    the shape of an aggregate function, so no session has to fit into one task.
    ``value_type`` is ``bool`` or the tuple of allowed labels.
    """

    name: str
    value_type: type | tuple[str, ...]
    read: Callable[[pd.DataFrame], object]
    merge: Callable[[object, object], object]
    decide: Callable[[object], tuple[object, str]]
    template: str = PLACEHOLDER

    @property
    def is_session_level(self) -> bool:
        return PLACEHOLDER in self.template

    def checked(self, value: object) -> str:
        if self.value_type is bool:
            if not isinstance(value, bool):
                raise ValueError(f"{self.name}: {value!r} is not a bool")
            return "true" if value else "false"
        if value not in self.value_type:
            raise ValueError(f"{self.name}: {value!r} is not one of {self.value_type}")
        return str(value)


def _groups(frames: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Rows sorted by ``keys`` as one frame per key, whichever batches they came in."""
    def goes_on(piece: pd.DataFrame) -> bool:
        pairs = zip(held[-1][keys].iloc[-1], piece[keys].iloc[0])
        return all(x == y or (pd.isna(x) and pd.isna(y)) for x, y in pairs)

    held: list[pd.DataFrame] = []
    for frame in frames:
        if frame.empty:
            continue
        codes = np.stack([pd.factorize(frame[key])[0] for key in keys])
        cuts = (np.flatnonzero((codes[:, 1:] != codes[:, :-1]).any(axis=0)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(frame)]):
            piece = frame.iloc[a:b]
            if a == 0 and held and goes_on(piece):
                held.append(piece)
                continue
            if held:
                yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
            held = [piece]
    if held:
        yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]


def _listed(groups: Iterable[list[tuple]], columns: Sequence[str]) -> Iterator[pd.DataFrame]:
    """The rows of many small lists in frames of a thousand or more."""
    rows: list[tuple] = []
    for group in groups:
        rows += group
        if len(rows) >= 1000:
            yield pd.DataFrame(rows, columns=columns, dtype=object)
            rows = []
    if rows:
        yield pd.DataFrame(rows, columns=columns, dtype=object)


def judge_sessions(
    conv: DataFrame, judges: Sequence[SessionJudge], part_turns: int = PART_TURNS
) -> DataFrame:
    """``(session_id, judge, value, reason)`` for every session and judge.

    Parts of at most ``part_turns`` turns are read in parallel, their states are
    merged ``MERGE_FAN`` at a time, and the merged states decide. Each step runs over sorted rows a batch
    at a time, as most sessions are a few rows.
    """
    unfit = [j.name for j in judges if not j.is_session_level]
    if unfit:
        raise ValueError(f"not session-level, the template lacks {PLACEHOLDER}: {unfit}")
    by_name = {judge.name: judge for judge in judges}
    state_type = "session_id string, judge string, part bigint, state string"
    state_columns = ["session_id", "judge", "part", "state"]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def states(turns: pd.DataFrame) -> list[tuple]:
            session, part = turns["session_id"].iat[0], turns["part"].iat[0]
            part = None if pd.isna(part) else int(part)
            if part is not None and turns["turn"].dtype.kind == "f":
                turns = turns.astype({"turn": "int64"})  # another part of the batch held a null
            return [(session, j.name, part, json.dumps(j.read(turns))) for j in judges]

        yield from _listed((states(turns) for turns in _groups(frames, ["session_id", "part"])), state_columns)

    def folded(frames: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[tuple]:
        """Each group's keys and its states merged in order; one state is held at a time."""
        last, whole = None, None
        for frame in frames:
            frame = frame[[*keys, "state"]].astype(object)
            for *key, state in frame.where(frame.notna(), None).itertuples(index=False, name=None):
                if last == key:
                    whole = by_name[key[1]].merge(whole, json.loads(state))
                    continue
                if last is not None:
                    yield (*last, whole)
                last, whole = key, json.loads(state)
        if last is not None:
            yield (*last, whole)

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        merged = folded(frames, ["session_id", "judge", "stretch"])
        yield from _listed(([(s, name, at, json.dumps(whole))] for s, name, at, whole in merged), state_columns)

    def decide(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def verdict(session, name: str, whole: object) -> list[tuple]:
            value, reason = by_name[name].decide(whole)
            return [(session, name, by_name[name].checked(value), reason)]

        yield from _listed((verdict(*row) for row in folded(frames, ["session_id", "judge"])),
                           ["session_id", "judge", "value", "reason"])

    def together(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
        return rows.repartition(*keys).sortWithinPartitions(*keys, F.col(order).asc_nulls_last())

    part = F.floor(F.col("turn") / part_turns).cast("bigint")
    turns = conv.select("session_id", "turn", "role", "text", part.alias("part"))
    states = together(turns, ["session_id", "part"], "turn").mapInPandas(read, state_type)
    stretch = F.floor(F.col("part") / MERGE_FAN).cast("bigint").alias("stretch")
    merged = together(
        states.select("*", stretch), ["session_id", "judge", "stretch"], "part"
    ).mapInPandas(merge, state_type)
    return together(merged, ["session_id", "judge"], "part").mapInPandas(
        decide, "session_id string, judge string, value string, reason string"
    )


def judge_transcripts(
    conv: DataFrame, name: str, template: str,
    ask: Callable[[str], tuple[bool, str]], part_turns: int = PART_TURNS,
) -> DataFrame:
    """``(session_id, judge, value, reason)`` of a judge that reads the filled template.

    ``ask`` gets the template with a part's transcript in its place and answers whether the part
    holds up, and why. A session holds up if all its parts do; the reason is that of its
    first part that does not, or else of its last one.
    """
    if PLACEHOLDER not in template:
        raise ValueError(f"not session-level, the template lacks {PLACEHOLDER}: {name}")

    @F.pandas_udf("good boolean, reason string")
    def judged(prompts: pd.Series) -> pd.DataFrame:
        answers = [ask(prompt) for prompt in prompts]
        return pd.DataFrame(answers, columns=["good", "reason"])

    parts = render_transcript(conv, template, part_turns).select(
        "session_id", "part", judged("transcript").alias("v")
    )
    bad = F.when(~F.col("v.good"), F.col("part"))
    return parts.groupBy("session_id").agg(
        F.lit(name).alias("judge"),
        F.bool_and("v.good").cast("string").alias("value"),
        F.coalesce(F.min_by("v.reason", bad), F.max_by("v.reason", "part")).alias("reason"),
    )


def evaluate_sessions(conv: DataFrame, judges: Sequence[SessionJudge]) -> DataFrame:
    """Every session with its number of traces and each judge's value and reason."""
    assessed = judge_sessions(conv, judges).withColumns(
        {"seq": F.lit(1), "justification": F.lit(None).cast("string")}
    )
    traces = session_rollup(conv).select("session_id", F.col("traces").alias("num_traces"))
    return traces.join(assessments_wide(assessed, [j.name for j in judges]), "session_id")


# -- built-in session scores ------------------------------------------------


def score_coherence(conv: DataFrame) -> DataFrame:
    """True if roles alternate, every user turn is answered and no reply is repeated."""
    talk = spoken(conv).select(
        "session_id", "turn", "role",
        F.when(F.col("role") == "assistant", F.sha2("text", 256)).alias("reply"),
    )
    flow = (
        next_value(talk, ["session_id"], "turn", F.struct("role"), "_next")
        .groupBy("session_id")
        .agg(
            F.count_if(F.col("_next.role") == F.col("role")).alias("broken"),
            F.count_if(
                (F.col("role") == "user") & ~F.col("_next.role").eqNullSafe("assistant")
            ).alias("unanswered"),
        )
    )
    # Counted per distinct reply first, so a reply given very often is one row.
    repeats = (
        talk.filter(F.col("reply").isNotNull())
        .groupBy("session_id", "reply")
        .agg(F.count("*").alias("n"))
        .groupBy("session_id")
        .agg(F.count_if(F.col("n") > 1).alias("repeated"))
    )
    faults = F.col("broken") + F.col("unanswered") + F.col("repeated")
    return (
        flow.join(repeats, "session_id", "left")
        .withColumn("repeated", F.coalesce("repeated", F.lit(0)))
        .select("session_id", "broken", "unanswered", "repeated", (faults == 0).alias("value"))
    )


def score_retention(conv: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Share of the constraint terms a user stated that the last reply takes up again.

    Only stated before that reply counts. Per session the work is one earliest
    turn per term and one latest reply, whatever its length.
    """
    found = F.array_intersect(rules.words(F.col("text")), F.array(*[F.lit(t) for t in terms]))
    rows = spoken(conv).select("session_id", "turn", "role", found.alias("found"))
    replied = F.col("role") == "assistant"
    first_said = {
        f"_t{i}": F.min(
            F.when((F.col("role") == "user") & F.array_contains("found", term), F.col("turn"))
        )
        for i, term in enumerate(terms)
    }
    per_session = rows.groupBy("session_id").agg(
        F.max(F.when(replied, F.col("turn"))).alias("_last"),
        F.max_by(F.when(replied, F.col("found")), F.when(replied, F.col("turn"))).alias("_reply"),
        *[column.alias(name) for name, column in first_said.items()],
    )
    stated = sum(
        [F.coalesce((F.col(n) < F.col("_last")).cast("int"), F.lit(0)) for n in first_said],
        F.lit(0),
    )
    kept = sum(
        [
            F.coalesce(
                ((F.col(n) < F.col("_last")) & F.array_contains("_reply", t)).cast("int"),
                F.lit(0),
            )
            for n, t in zip(first_said, terms)
        ],
        F.lit(0),
    )
    share = F.when(F.col("stated") == 0, 1.0).otherwise(F.col("kept") / F.col("stated"))
    band = (
        F.when(F.col("share") >= 1.0, RETENTION[0])
        .when(F.col("share") >= 0.75, RETENTION[1])
        .when(F.col("share") >= 0.5, RETENTION[2])
        .otherwise(RETENTION[3])
    )
    return (
        per_session.select("session_id", stated.alias("stated"), kept.alias("kept"))
        .withColumn("share", F.round(share, 6))
        .withColumn("value", band)
    )


def score_search_use(turns: DataFrame) -> DataFrame:
    """``skipped`` if any turn that needed a search had none, else ``unnecessary`` if
    any turn searched without need, else ``necessary``."""
    needs, did = F.col("needs_search"), F.col("searches") > 0
    return turns.groupBy("session_id").agg(
        F.when(F.bool_or(needs & ~did), SEARCH_USE[2])
        .when(F.bool_or(~needs & did), SEARCH_USE[1])
        .otherwise(SEARCH_USE[0])
        .alias("value")
    )


def user_intents(conv: DataFrame, table: Sequence[tuple[str, str]], default: str) -> DataFrame:
    """Every user turn with its place among the user turns and its classified intent."""
    asked = conv.filter(F.col("role") == "user")
    return running_sums(asked, ["session_id"], "turn", {"pos": F.lit(1)}).select(
        "session_id", "turn", F.col("pos").cast("int").alias("pos"),
        rules.first_label(F.col("text"), table, default).alias("intent"),
    )


def score_routing(turns: DataFrame, expected: DataFrame) -> DataFrame:
    """True if a session's intents are exactly the expected sequence."""
    wanted = expected.select(
        "session_id", F.posexplode("expected_intents").alias("pos", "expected")
    )
    return (
        turns.select("session_id", "pos", "intent")
        .join(wanted, ["session_id", "pos"], "full_outer")
        .groupBy("session_id")
        .agg(F.bool_and(F.col("intent").eqNullSafe(F.col("expected"))).alias("value"))
    )


# -- scores of single answers -----------------------------------------------


def eval_dataset(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """Questions with their answers and the expected facts as one text."""
    return questions.join(answers, "question_id").withColumn(
        "expected_response", F.array_join("expected_facts", "; ")
    )


def score_correctness(answer: Column, facts: Column) -> Column:
    """Share of the expected facts found in the answer."""
    low = F.lower(answer)
    hits = F.size(F.filter(facts, lambda f: low.contains(F.lower(f))))
    return F.when(F.size(facts) == 0, 1.0).otherwise(F.round(hits / F.size(facts), 6))


def score_relevance(question: Column, answer: Column) -> Column:
    """Cosine of the two sets of words, a stand-in for a model's relevance score."""
    asked, said = F.array_distinct(rules.words(question)), F.array_distinct(rules.words(answer))
    both = F.size(F.array_intersect(asked, said))
    size = F.sqrt(F.size(asked) * F.size(said))
    return F.when(size > 0, F.round(both / size, 6)).otherwise(0.0)


def score_safety(answer: Column, unsafe: Column | None = None) -> Column:
    """True if the answer holds no personal data, no injection phrase and nothing unsafe.

    ``unsafe``: what a classifier says of the answer (``flagged`` of ``policies.unsafe_flags``), besides
    the general rules.
    """
    by_rules = (
        rules.first_pii(answer).isNull()
        & ~rules.any_rule(answer, rules.INJECTION_RULES)
        & ~rules.any_rule(answer, rules.UNSAFE_RULES)
    )
    return by_rules if unsafe is None else by_rules & ~unsafe


def score_guidelines(
    df: DataFrame, answer: str, guidelines: Sequence[tuple[str, str]]
) -> DataFrame:
    """One bool per guideline, and whether all of them hold."""
    tests = {name: F.lower(F.col(answer)).rlike(pattern) for name, pattern in guidelines}
    every = F.forall(F.array(*[F.col(name) for name in tests]), lambda ok: ok)
    return df.withColumns(tests).withColumn("all_hold", every)


def eval_metrics(scores: DataFrame) -> DataFrame:
    """Mean of each scorer over the dataset."""
    return scores.groupBy("scorer").agg(
        F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean")
    )


def assessments_wide(assessments: DataFrame, judges: Sequence[str]) -> DataFrame:
    """One row per session with ``<judge>/value`` and ``<judge>/reason``.

    Judges are matched by their exact name. The reason falls back to the older
    justification and then to an empty text; of several assessments the earliest
    non-null one counts.
    """
    def first(column: str, judge: str) -> Column:
        here = (F.col("judge") == judge) & F.col(column).isNotNull()
        return F.min_by(F.when(here, F.col(column)), F.when(here, F.col("seq")))

    columns = []
    for judge in judges:
        columns.append(first("value", judge).alias(f"{judge}/value"))
        columns.append(
            F.coalesce(first("reason", judge), first("justification", judge), F.lit("")).alias(
                f"{judge}/reason"
            )
        )
    return assessments.groupBy("session_id").agg(*columns)


def expected_vs_actual(assessments: DataFrame, expected: DataFrame) -> DataFrame:
    """Judge values next to the scenario's expected ones; a missing value is a miss."""
    return expected.join(assessments, ["session_id", "judge"], "left").select(
        "session_id", "judge", "expected", F.col("value").alias("actual"),
        F.col("value").eqNullSafe(F.col("expected")).alias("match"),
    )


def routing_summary(log: DataFrame) -> DataFrame:
    """Query label, expected route by category, status and answer preview."""
    answer = F.col("response")
    return log.select(
        F.concat(F.substring("query", 1, 60), F.lit("...")).alias("query"),
        F.col("category").alias("expected_route"),
        "status",
        F.when(F.length(answer) > 150, F.concat(F.substring(answer, 1, 150), F.lit("...")))
        .otherwise(answer)
        .alias("preview"),
    )


# -- user functions ---------------------------------------------------------


def row_scorer(score: Callable[[str, str, str], float]):
    """A function of (question, answer, expectation) as a vectorised column function."""

    @F.pandas_udf("double")
    def scored(question: pd.Series, answer: pd.Series, expectation: pd.Series) -> pd.Series:
        rows = zip(question, answer, expectation)
        return pd.Series([float(score(q, a, e)) for q, a, e in rows], index=question.index)

    return scored


def predict(
    dataset: DataFrame, predict_fn: Callable[[pd.Series], pd.Series], column: str = "request"
) -> DataFrame:
    """Run a question -> answer function over a dataset, a batch at a time."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(answer=predict_fn(frame[column]))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dataset.schema.fields)
    return dataset.mapInPandas(batches, f"{fields}, answer string")
