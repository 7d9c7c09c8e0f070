"""Content policies as column work.

The detectors of personal data, injections and keywords are patterns and rules; unsafe content is
judged by a classifier fitted on labelled texts. All keep the contract of a gateway's policies:
verdict, phase, reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions import rules
from tallyspan.functions.columns import bound
from tallyspan.operators.classifiers import TextClassifier, fit_classifier


def pii_findings(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per finding in the whole text."""
    return df.select(key, F.inline(rules.pii_array(F.col(text))))


def pii_verdict(text: Column, phase: str = "pre_call") -> Column:
    names = F.create_map(*[F.lit(x) for pair in rules.PII_NAMES.items() for x in pair])

    def verdict(finding: Column) -> Column:
        reason = F.concat(
            F.lit("Content contains "), names[finding["kind"]], F.lit(": "), finding["value"],
            F.lit("."),
        )
        return rules.deny("PII", phase, reason, finding.isNotNull())

    return bound(rules.first_pii(text), verdict)


def pii_block(df: DataFrame, text: str, phase: str = "pre_call") -> DataFrame:
    return df.withColumn("policy", pii_verdict(F.col(text), phase))


def pii_redact(df: DataFrame, text: str) -> DataFrame:
    """Every finding replaced by ``[KIND]`` instead of the request being denied."""

    def masked(value: Column, kind: str) -> Column:
        mask = F.lit(f"[{kind.upper()}]")
        if kind == "credit_card":
            # Only numbers that pass the check are masked, so each is looked up by itself.
            return F.aggregate(
                F.array_distinct(rules.pii_values(value, kind)),
                value,
                lambda acc, card: F.regexp_replace(acc, rules.standing_alone(card), mask),
            )
        replaced = F.regexp_replace(value, rules.PII_PATTERNS[kind], mask)
        return F.when(rules.may_hold(value, kind), replaced).otherwise(value)

    # One projection per kind: each works on the text the one before it left.
    for kind in rules.PII_PATTERNS:
        df = df.withColumn(text, masked(F.col(text), kind))
    return df


def injection_flags(
    df: DataFrame, text: str, table: Sequence[tuple[str, str]] = tuple(rules.INJECTION_RULES)
) -> DataFrame:
    flags = rules.matching_rules(F.col(text), table)
    return df.withColumn("flags", flags).withColumn("flagged", F.size("flags") > 0)


def unsafe_flags(df: DataFrame, text: str, classifier: TextClassifier) -> DataFrame:
    """Texts a fitted classifier finds unsafe; ``flags`` names the general rules they hit."""
    return classifier.flags(df, text)


def fit_unsafe(labelled: DataFrame, text: str, label: str, **how) -> TextClassifier:
    """The classifier of unsafe content, with the general rules among its features."""
    return fit_classifier(labelled, text, label, rules.UNSAFE_RULES, **how)


def confusion(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """Counts of every (actual, predicted) pair."""
    return df.groupBy(
        F.col(actual).cast("boolean").alias("actual"),
        F.col(predicted).cast("boolean").alias("predicted"),
    ).agg(F.count("*").alias("n"))


def keyword_verdict(text: Column, invalid: Sequence[str], topics: Sequence[str] = ()) -> Column:
    """Deny a listed keyword; with topics given, also deny a text naming none of them."""
    def reason(found: Column) -> Column:
        listed = F.array_sort(
            F.array_intersect(found, F.array(*[F.lit(w.lower()) for w in invalid]))
        )
        why = F.when(
            F.size(listed) > 0, F.concat(F.lit("invalid keyword: "), F.get(listed, F.lit(0)))
        )
        if topics:
            named = F.arrays_overlap(found, F.array(*[F.lit(w.lower()) for w in topics]))
            why = F.coalesce(why, F.when(~named, F.lit("no valid topic")))
        return why

    def verdict(why: Column) -> Column:
        return rules.deny("keywords", "pre_call", why, why.isNotNull())

    return bound(bound(rules.words(text), reason), verdict)


def keyword_policy(
    df: DataFrame, text: str, invalid: Sequence[str], topics: Sequence[str] = ()
) -> DataFrame:
    return df.withColumn("policy", keyword_verdict(F.col(text), invalid, topics))


def phase_policy(pairs: DataFrame, request: str = "request", response: str = "response"):
    """Check the request, then the response; the first denial wins and names its phase."""
    return pairs.withColumn(
        "policy",
        F.coalesce(
            pii_verdict(F.col(request), "pre_call"), pii_verdict(F.col(response), "post_call")
        ),
    )


def admitted_log(verdicts: DataFrame) -> DataFrame:
    """What reaches the request log: a request denied before the model was never sent."""
    return verdicts.filter(
        F.col("policy").isNull() | ~F.col("policy.phase").eqNullSafe(F.lit("pre_call"))
    )


def two_layer_outcome(df: DataFrame) -> DataFrame:
    """Denied by a policy, refused by the model itself, answered, or failed."""
    refused = F.lower("content").rlike(rules.REFUSAL)
    return df.withColumn(
        "layer",
        F.when(F.col("policy").isNotNull(), "policy_denied")
        .when(F.col("status") != 200, "failed")
        .when(refused, "model_refused")
        .otherwise("answered"),
    )
