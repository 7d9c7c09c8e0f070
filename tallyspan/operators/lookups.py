"""Scenario results: lookups, outcomes, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_POLICY = "—"


def _required(column: str, what: str) -> Column:
    return F.when(
        F.col(column).isNull(), F.raise_error(F.lit(f"scenario without a known {what}"))
    ).otherwise(F.col(column))


def scenario_agent_join(
    scenarios: DataFrame, agents: DataFrame, providers: DataFrame
) -> DataFrame:
    """Scenario -> agent -> provider -> model service; an unknown key is an error."""
    routed = scenarios.join(agents, "agent", "left").withColumn(
        "provider", _required("provider", "agent")
    )
    return routed.join(providers, "provider", "left").withColumn(
        "model_service", _required("model_service", "provider")
    )


def label_default_join(
    df: DataFrame, labels: DataFrame, key: str, label: str, default: str
) -> DataFrame:
    """Attach a label; keys without one get the default."""
    return df.join(labels.select(key, label), key, "left").withColumn(
        label, F.coalesce(F.col(label), F.lit(default))
    )


def blocked_only(results: DataFrame) -> DataFrame:
    return results.filter(F.lower("actual_outcome") == "blocked")


def pass_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.sum(F.col("pass").cast("int")).alias("passed"), F.count("*").alias("total")
    )


def pass_by_provider(results: DataFrame) -> DataFrame:
    return results.groupBy("provider").agg(
        F.count_if("pass").alias("passed"), F.count("*").alias("total")
    )


def blocks_by_policy(results: DataFrame) -> DataFrame:
    """Blocked rows per provider and policy.

    Counted in the same pass that reads the policy; filtering first would have the
    outcome, and with it the verdict, worked out twice.
    """
    return (
        results.groupBy("provider", F.coalesce("policy.name", F.lit(NO_POLICY)).alias("policy"))
        .agg(F.count_if(F.lower("actual_outcome") == "blocked").alias("blocks"))
        .filter(F.col("blocks") > 0)
    )


def burst_summary(burst: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Outcome counts of a burst; whatever is none of the three known ones is an error."""
    def hits(outcome: str) -> Column:
        return F.count_if(F.col("outcome") == outcome)

    known = hits("allowed") + hits("rate_limited") + hits("blocked")
    return burst.groupBy(*by).agg(
        hits("allowed").alias("allowed"),
        hits("rate_limited").alias("rate_limited"),
        hits("blocked").alias("blocked"),
        (F.count("*") - known).alias("errors"),
        F.count("*").alias("total"),
    )


def status_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count("*").alias("n"))


def results_summary(results: DataFrame) -> DataFrame:
    return results.select(
        F.col("description").alias("test"),
        "agent",
        F.coalesce("provider", F.lit("")).alias("provider"),
        F.upper("expected_outcome").alias("expected"),
        F.upper("actual_outcome").alias("actual"),
        F.coalesce("policy.name", F.lit(NO_POLICY)).alias("policy"),
        F.col("status").alias("http"),
        F.when(F.col("pass"), "PASS").otherwise("FAIL").alias("result"),
    )
