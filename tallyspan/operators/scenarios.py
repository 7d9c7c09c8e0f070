"""Scenario catalogues: expansion, ordering, numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.operators.lookups import label_default_join
from tallyspan.operators.ordered import first_n, number_rows


def _trimmed_prompt(prompt: Column) -> Column:
    """Common indentation of all non-blank lines removed, then outer blanks."""
    lines = F.split(prompt, "\n")
    filled = F.filter(lines, lambda line: F.length(F.trim(line)) > 0)
    indent = F.array_min(
        F.transform(filled, lambda line: F.length(line) - F.length(F.ltrim(line)))
    )
    cut = F.transform(
        lines,
        lambda line: F.when(F.length(F.trim(line)) == 0, "").otherwise(
            line.substr(F.coalesce(indent, F.lit(0)) + 1, F.length(line))
        ),
    )
    return F.regexp_replace(F.array_join(cut, "\n"), r"^\s+|\s+$", "")


def expand_task(tasks: DataFrame, labels: DataFrame) -> DataFrame:
    """Catalogue tuples -> scenario rows; ``labels`` holds each agent's display label."""
    named = label_default_join(
        tasks.withColumnRenamed("label", "task_label"),
        labels.select("agent", F.col("display_name").alias("agent_label")),
        "agent", "agent_label", "",
    )
    return named.select(
        F.format_string("clean_%s_%s", "agent", "task_id").alias("name"),
        "agent",
        "pos",
        F.array(
            F.struct(
                F.lit("user").alias("role"), _trimmed_prompt(F.col("prompt")).alias("content")
            )
        ).alias("messages"),
        F.lit("allowed").alias("expected_outcome"),
        F.lit("none").alias("guardrail_type"),
        F.format_string("Clean/%s: %s (%s)", "kind", "task_label", "agent_label").alias(
            "description"
        ),
    )


def flatten_groups(catalogue: DataFrame) -> DataFrame:
    """``map<group, array<struct<query, category>>>`` -> one row per query."""
    return catalogue.select(F.explode("groups").alias("group", "queries")).select(
        "group", F.inline("queries")
    )


def runnable_scenarios(scenarios: DataFrame, available: bool) -> DataFrame:
    """Leave out scenarios that need a backend which is not there."""
    needs = F.coalesce(F.col("requires_complaint_agent"), F.lit(False))
    return scenarios.filter(~needs | F.lit(available))


def cap_per_group(df: DataFrame, key: str, order: list[str], n: int | None = None) -> DataFrame:
    """First ``n`` rows of each group in catalogue order; all rows if ``n`` is None."""
    if n is None:
        return df
    return first_n(df, [key], [F.col(c) for c in order], n).drop("_rank")


def interleave(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Round-robin over the groups: every group's first row, then every second row, ...

    ``seq`` is the place in that order; groups may differ in length.
    """
    turns = number_rows(df, [key], [F.col(c) for c in order], position="_turn")
    return number_rows(turns, [], [F.col("_turn"), F.col(key)], position="seq").drop("_turn")


def session_ids(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``session-<scenario>-NNN`` with one counter per scenario, in data order."""
    numbered = number_rows(df, [key], [F.col(c) for c in order], position="_no")
    return numbered.withColumn(
        "session_id",
        F.concat(F.lit("session-"), F.col(key), F.lit("-"), F.format_string("%03d", "_no")),
    ).drop("_no")


def number_requests(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """1-based number of each request in its burst."""
    return number_rows(df, [key], [F.col(c) for c in order], position="request_num")
