"""Sessions with one very long conversation, span trees, prompt versions, scores."""

import pytest
from pyspark.sql import functions as F

from tallyspan import schemas
from tallyspan.operators import judges, sessions

CONV = "session_id string, turn bigint, role string, text string"


@pytest.fixture(scope="module")
def conv(spark):
    rows = [("s", 0, "system", "be brief"), ("s", 1, "user", "q1"), ("s", 2, "assistant", "a1"),
            ("s", 3, "user", "q2"), ("s", 4, "tool", "t"), ("s", 5, "assistant", "a2"),
            ("s", 6, "user", "q3"), ("one", 0, "user", "hi")]
    rows += [("long", i, "assistant" if i % 2 else "user", f"m{i}") for i in range(9000)]
    return spark.createDataFrame(rows, CONV).repartition(4)


def test_turn_pairs(conv):
    got = sessions.turn_pairs(conv).collect()
    short = {(r.turn, r.request): r.response for r in got if r.session_id == "s"}
    assert short == {(1, "q1"): "a1", (3, "q2"): "a2", (6, "q3"): None}
    long = {r.turn: r.response for r in got if r.session_id == "long"}
    assert long == {i: f"m{i + 1}" for i in range(0, 9000, 2)}


def test_history(conv):
    got = {(r.session_id, r.turn): r.history_len
           for r in sessions.history_before_turn(conv).collect()}
    assert [got["s", t] for t in (1, 2, 3, 5, 6)] == [0, 1, 2, 3, 4]
    assert all(got["long", i] == i for i in range(9000))
    last = sessions.history_messages(conv, sessions.last_turns(conv))
    assert last.filter("session_id = 'long'").count() == 8998
    assert [r.text for r in last.filter("session_id = 's'").orderBy("turn").collect()] == [
        "q1", "a1", "q2", "a2"]


def test_transcript_parts_make_up_the_whole(conv):
    template = "Read:\n{{ conversation }}\nValue?"
    got = sessions.render_transcript(conv, template, part_turns=700).orderBy("part").collect()
    whole = "".join(r.transcript for r in got if r.session_id == "long")
    lines = "\n".join(f"{'assistant' if i % 2 else 'user'}: m{i}" for i in range(9000))
    assert whole == f"Read:\n{lines}\nValue?"
    assert [r.transcript for r in got if r.session_id == "one"] == ["Read:\nuser: hi\nValue?"]
    assert max(r.transcript.count("\n") for r in got) <= 702


def test_last_assistant(spark):
    rows = [("s", 0, "assistant", "a"), ("s", 1, "assistant", ""), ("t", 0, "user", "q")]
    got = {r.session_id: r.answer
           for r in sessions.last_assistant(spark.createDataFrame(rows, CONV)).collect()}
    assert got == {"s": "a", "t": None}


def test_span_tree(spark):
    rows = [("t", "a", None, "AGENT", ""), ("t", "orphan", "gone", "TOOL", "")]
    rows += [("t", f"c{i}", "a" if i == 0 else f"c{i - 1}", "CHAIN", "") for i in range(300)]
    rows += [("t", f"w{i}", "a", "TOOL", "") for i in range(200)]
    rows += [("u", "a", "a2", "TOOL", ""), ("u", "a2", "a", "TOOL", "")]
    got = {(r.trace_id, r.span_id): (r.depth, r.root)
           for r in sessions.span_tree(spark.createDataFrame(rows, schemas.SPAN)).collect()}
    assert got["t", "a"] == (0, "a") and got["t", "orphan"] == (0, "orphan")
    assert all(got["t", f"c{i}"] == (i + 1, "a") for i in range(300))
    assert all(got["t", f"w{i}"] == (1, "a") for i in range(200))
    assert got["u", "a"] == got["u", "a2"] == (None, None)
    assert len(got) == len(rows)


def test_prompt_versions(spark):
    registry = spark.createDataFrame(
        [("a", 1, "x", "m"), ("a", 2, "y", "m"), ("b", 1, "z", "m")], schemas.PROMPT)
    assert {r.name: r.template for r in sessions.latest_prompt(registry).collect()} == {
        "a": "y", "b": "z"}
    assert sessions.latest_prompt(registry, version=1).count() == 2
    new = spark.createDataFrame(
        [("a", 1, "p", "c"), ("a", 2, "q", "c"), ("n", 3, "r", "c")],
        "name string, seq int, template string, commit_message string")
    got = sessions.append_prompt_version(registry, new, "seq").collect()
    assert {(r.name, r.version, r.template) for r in got} == {
        ("a", 3, "p"), ("a", 4, "q"), ("n", 1, "r")}
    more = spark.createDataFrame([("a", 9, "no", "m"), ("k", 1, "yes", "m")], schemas.PROMPT)
    assert {r.name for r in sessions.register_if_missing(registry, more).collect()} == {
        "a", "b", "k"}


def test_search_traces(spark):
    rows = [("t1", "r1", None, "", "", {}, {"trace.session": "s1"}),
            ("t2", "r2", None, "", "", {}, {"trace.session": "s1"}), ("t3", "r1", None, "", "", {}, {})]
    df = spark.createDataFrame(rows, schemas.TRACE)
    assert [r.trace_id for r in sessions.search_traces(df, run_id="r1").collect()] == ["t1", "t3"]
    both = sessions.search_traces(df, run_id="r1", metadata={"trace.session": "s1"})
    assert [r.trace_id for r in both.collect()] == ["t1"]


# -- scores -------------------------------------------------------------------


def test_coherence(spark):
    rows = [("good", 0, "user", "q"), ("good", 1, "assistant", "a"),
            ("open", 0, "user", "q"),
            ("twice", 0, "user", "q"), ("twice", 1, "assistant", "a"),
            ("twice", 2, "user", "r"), ("twice", 3, "assistant", "a"),
            ("pair", 0, "user", "q"), ("pair", 1, "user", "q"), ("pair", 2, "assistant", "a")]
    got = {r.session_id: (r.broken, r.unanswered, r.repeated, r.value)
           for r in judges.score_coherence(spark.createDataFrame(rows, CONV)).collect()}
    assert got == {"good": (0, 0, 0, True), "open": (0, 1, 0, False),
                   "twice": (0, 0, 1, False), "pair": (1, 1, 0, False)}


def test_retention(spark):
    rows = [("s", 0, "user", "I'm vegetarian, near River, on a budget"),
            ("s", 1, "assistant", "noted"),
            ("s", 2, "user", "and quiet"),
            ("s", 3, "assistant", "A quiet vegetarian place near River."),
            ("s", 4, "user", "vegan"), ("none", 0, "user", "hello")]
    terms = ["vegetarian", "river", "budget", "quiet", "vegan"]
    got = {r.session_id: (r.stated, r.kept, r.value)
           for r in judges.score_retention(spark.createDataFrame(rows, CONV), terms).collect()}
    assert got == {"s": (4, 3, "good"), "none": (0, 0, "excellent")}


def test_search_use(spark):
    rows = [("n", True, 1), ("n", False, 0), ("u", False, 2), ("u", True, 1), ("k", True, 0),
            ("k", False, 1)]
    df = spark.createDataFrame(rows, "session_id string, needs_search boolean, searches int")
    assert {r.session_id: r.value for r in judges.score_search_use(df).collect()} == {
        "n": "necessary", "u": "unnecessary", "k": "skipped"}


def test_routing(spark):
    turns = spark.createDataFrame(
        [("a", 0, "order"), ("a", 1, "smalltalk"), ("b", 0, "order"), ("c", 0, "order"),
         ("c", 1, "order")], "session_id string, pos int, intent string")
    expected = spark.createDataFrame(
        [("a", ["order", "smalltalk"]), ("b", ["order", "order"]), ("c", ["order"])],
        "session_id string, expected_intents array<string>")
    got = {r.session_id: r.value for r in judges.score_routing(turns, expected).collect()}
    assert got == {"a": True, "b": False, "c": False}


def test_assessments(spark):
    rows = [("s", 1, "coherence", None, None, None), ("s", 2, "coherence", "true", None, "old"),
            ("s", 3, "coherence", "false", "late", None), ("s", 1, "coherence_x", "no", "no", None),
            ("t", 1, "retention", "good", None, None)]
    df = spark.createDataFrame(
        rows, "session_id string, seq int, judge string, value string, reason string, "
              "justification string")
    got = {r.session_id: tuple(r)[1:]
           for r in judges.assessments_wide(df, ["coherence", "retention"]).collect()}
    assert got == {"s": ("true", "late", None, ""), "t": (None, "", "good", "")}
    expected = spark.createDataFrame(
        [("t", "retention", "good"), ("t", "coherence", "true")],
        "session_id string, judge string, expected string")
    matched = {r.judge: r.match for r in judges.expected_vs_actual(df, expected).collect()}
    assert matched == {"retention": True, "coherence": False}


def label_judge(value, value_type=("yes", "no"), template=sessions.PLACEHOLDER):
    return judges.SessionJudge(
        "order", value_type,
        read=lambda turns: {"first": int(turns["turn"].iloc[0]), "last": int(turns["turn"].iloc[-1]),
                            "ordered": bool(turns["turn"].is_monotonic_increasing), "n": len(turns)},
        merge=lambda a, b: {"first": a["first"], "last": b["last"], "n": a["n"] + b["n"],
                            "ordered": a["ordered"] and b["ordered"] and a["last"] < b["first"]},
        decide=lambda s: (value if s["ordered"] else "no", str(s["n"])),
        template=template,
    )


def test_judge_reads_a_long_session_in_order(conv):
    got = {r.session_id: (r.value, r.reason)
           for r in judges.judge_sessions(conv, [label_judge("yes")], part_turns=100).collect()}
    assert got == {"s": ("yes", "7"), "one": ("yes", "1"), "long": ("yes", "9000")}


def test_judge_contract(conv):
    with pytest.raises(Exception, match="is not one of"):
        judges.judge_sessions(conv, [label_judge("maybe")]).collect()
    with pytest.raises(Exception, match="is not a bool"):
        judges.judge_sessions(conv, [label_judge("yes", bool)]).collect()
    with pytest.raises(ValueError, match="not session-level"):
        judges.judge_sessions(conv, [label_judge("yes", template="no slot")])


def test_row_scores(spark):
    df = spark.createDataFrame(
        [("how many fires in 2024", "2024 saw 12 fires", ["2024", "Fires", "none"])],
        "q string, a string, facts array<string>")
    row = df.select(
        judges.score_correctness(F.col("a"), F.col("facts")).alias("c"),
        judges.score_relevance(F.col("q"), F.col("a")).alias("r"),
        judges.score_safety(F.col("a")).alias("s"),
    ).first()
    assert (row.c, row.r, row.s) == (round(2 / 3, 6), round(2 / 20**0.5, 6), True)
    rules = [("has_number", r"[0-9]"), ("names_protocol", "protocol")]
    held = judges.score_guidelines(df, "a", rules).first()
    assert (held.has_number, held.names_protocol, held.all_hold) == (True, False, False)


def test_a_message_without_text_keeps_its_line(spark):
    rows = [("s", 0, "user", "a"), ("s", 1, "assistant", None), ("s", 2, "user", "b")]
    conv = spark.createDataFrame(rows, "session_id string, turn bigint, role string, text string")
    row = sessions.render_transcript(conv, sessions.PLACEHOLDER).first()
    assert row.transcript == "user: a\nassistant: \nuser: b"


def test_repeated_spans_count_once(spark):
    rows = [("t", "1", None), ("t", "2", "1"), ("t", "3", "2"), ("t", "4", "3")]
    spans = spark.createDataFrame(rows + rows[1:3], "trace_id string, span_id string, parent_id string")
    got = sorted((r.span_id, r.depth, r.root) for r in sessions.span_tree(spans).collect())
    assert got == [("1", 0, "1"), ("2", 1, "1"), ("3", 2, "1"), ("4", 3, "1")]


def test_a_new_prompt_named_twice_is_added_once(spark):
    kind = "name string, version int, template string, commit_message string"
    known = spark.createDataFrame([("a", 1, "x", "m")], kind)
    new = spark.createDataFrame([("b", 1, "z", "m"), ("b", 1, "y", "m"), ("a", 1, "q", "m")], kind)
    got = sorted(tuple(r) for r in sessions.register_if_missing(known, new).collect())
    assert got == [("a", 1, "x", "m"), ("b", 1, "y", "m")]


def test_sessions_are_judged_many_at_a_time(spark):
    """Sessions, parts and states run on over batches; no group is sent to Python by itself."""
    rows = [(f"s{s}", t, "user" if t % 2 else "assistant", str(t)) for s in range(40) for t in range(s + 1)]
    rows += [(None, 0, "user", None), (None, 1, "assistant", "b"), ("s5", None, "assistant", "c"), ("s5", None, "user", "d")]
    conv = spark.createDataFrame(rows, "session_id string, turn bigint, role string, text string").repartition(3)
    order = judges.SessionJudge(
        "order", bool, lambda turns: [turns["turn"].tolist(), 1],
        lambda a, b: [a[0] + b[0], a[1] + b[1]],
        lambda s: (s[0] == sorted(s[0], key=lambda t: (t != t, t)), f"{len(s[0])} in {s[1]}"))
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        judged = judges.judge_sessions(conv, [order], part_turns=10)
        assert "FlatMapGroupsInPandas" not in judged._jdf.queryExecution().executedPlan().toString()
        got = {r.session_id: (r.value, r.reason) for r in judged.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    want = {f"s{s}": ("true", f"{s + 1} in {s // 10 + 1}") for s in range(40)}
    assert got.pop(None) == ("true", "2 in 1") and got.pop("s5")[1] == "8 in 2"
    want.pop("s5")
    assert got == want
