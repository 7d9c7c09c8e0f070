"""Counting and summing questions over a fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.operators.logs import exact_percentiles


def money(column: str) -> Column:
    """Sum of amounts with two decimals, exact in any order of the rows."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


def count_where(fact: DataFrame, state: str, year: int) -> DataFrame:
    return fact.filter((F.col("state") == state) & (F.col("year") == year)).agg(
        F.count("*").alias("n")
    )


def sum_where(fact: DataFrame, disaster_type: str, year: int) -> DataFrame:
    """Total aid of one type and year; null where nothing matches."""
    return fact.filter(
        (F.col("disaster_type") == disaster_type) & (F.col("year") == year)
    ).agg(money("federal_aid_amount").alias("total_aid"))


def recent_facts(fact: DataFrame, since: int = 2024) -> DataFrame:
    return fact.filter(F.col("year") >= since)


def distinct_entities(fact: DataFrame, by: Sequence[str]) -> DataFrame:
    """Exact number of distinct ids; ids are spread over the tasks, not gathered per group."""
    return fact.groupBy(*by).agg(F.count_distinct("disaster_id").alias("disasters"))


def approx_entities(fact: DataFrame, by: Sequence[str], rsd: float = 0.02) -> DataFrame:
    return fact.groupBy(*by).agg(F.approx_count_distinct("disaster_id", rsd).alias("disasters"))


def sum_by_category(fact: DataFrame) -> DataFrame:
    return fact.groupBy("disaster_type").agg(
        F.sum("affected_population").alias("affected_population")
    )


def compare_by_state(fact: DataFrame, year: int) -> DataFrame:
    return (
        fact.filter(F.col("year") == year)
        .groupBy("state")
        .agg(money("federal_aid_amount").alias("total_aid"))
        .orderBy(F.col("total_aid").desc(), "state")
    )


def top_state(fact: DataFrame, severity: int = 5) -> DataFrame:
    """States with the most rows of a severity; ties are all kept."""
    per_state = (
        fact.filter(F.col("severity") == severity).groupBy("state").agg(F.count("*").alias("n"))
    )
    most = per_state.agg(F.max("n")).scalar()
    return per_state.filter(F.col("n") == most).orderBy("state")


def max_severity_state(fact: DataFrame, disaster_type: str | None = None) -> DataFrame:
    """State of the most severe record per type; then most people affected, then the id."""
    rows = fact if disaster_type is None else fact.filter(F.col("disaster_type") == disaster_type)
    rank = F.struct("severity", "affected_population", "disaster_id")
    return rows.groupBy("disaster_type").agg(
        F.max("severity").alias("severity"), F.max_by("state", rank).alias("state")
    )


def distinct_rows(fact: DataFrame, severity: int, year: int) -> DataFrame:
    return (
        fact.filter((F.col("severity") == severity) & (F.col("year") == year))
        .select("state", "disaster_type", "severity")
        .distinct()
        .orderBy("state")
    )


def location_timings(timings: DataFrame) -> DataFrame:
    """Per-location benchmark of a duration in whole days: count, median, 75th percentile."""
    return exact_percentiles(timings, ["location"], "duration", {"p50": 0.5, "p75": 0.75})


def late_vs_p75(timings: DataFrame) -> DataFrame:
    """Each order against its location's 75th percentile; above it a refund is due.

    The benchmark is one row per location; where it outgrows Spark's broadcast
    threshold, the adaptive skew join splits a location holding many orders.
    """
    bench = location_timings(timings).select("location", "p75")
    return timings.join(bench, "location").withColumn(
        "refund", F.col("duration") > F.col("p75")
    )


def order_overview(orders: DataFrame, items: DataFrame, order_id: int | None = None) -> DataFrame:
    """Status, items and total of one order, or of every order.

    Items are summed per order before the join, so an order with very many
    items never meets in one task; ``order_items`` lists them as rows.
    """
    if order_id is not None:
        orders = orders.filter(F.col("order_id") == order_id)
        items = items.filter(F.col("order_id") == order_id)
    per_order = items.groupBy("order_id").agg(
        F.count("*").alias("items"),
        F.sum("quantity").alias("quantity"),
        money("price").alias("items_total"),
    )
    return orders.select("order_id", "status", "total").join(per_order, "order_id", "left")


def order_items(orders: DataFrame, items: DataFrame, order_id: int | None = None) -> DataFrame:
    if order_id is not None:
        orders = orders.filter(F.col("order_id") == order_id)
        items = items.filter(F.col("order_id") == order_id)
    return items.join(orders.select("order_id", "status"), "order_id")


def order_timing(timings: DataFrame, order_id: int | None = None) -> DataFrame:
    """First and last event of an order and the days between them."""
    if order_id is not None:
        timings = timings.filter(F.col("order_id") == order_id)
    return timings.groupBy("order_id").agg(
        F.min("event_date").alias("first_event"),
        F.max("event_date").alias("last_event"),
        F.date_diff(F.max("event_date"), F.min("event_date")).alias("elapsed_days"),
    )


def entity_match(df: DataFrame, text: str, known: DataFrame, name: str) -> DataFrame:
    """Map free text onto known names: equal after trimming and lower-casing, else within
    two edits (nearest, then alphabetical).

    Two strings are within two edits only if deleting at most two characters from
    each can make them equal, so candidates come from an equality join on those
    shortened forms instead of comparing every text with every name. Each distinct
    text is matched once, whatever the number of rows holding it. Only texts as long as some
    name, give or take two characters, are shortened, so long texts cost nothing.
    """
    wanted = df.select(F.lower(F.trim(F.col(text))).alias("_text")).filter(
        F.col("_text").isNotNull()
    ).distinct()
    names = known.select(
        F.col(name).alias("_name"), F.lower(F.trim(F.col(name))).alias("_folded")
    ).distinct()
    exact = wanted.join(names, F.col("_text") == F.col("_folded")).groupBy("_text").agg(
        F.min("_name").alias("matched"), F.lit(0).alias("edits")
    )
    lengths = names.select(F.explode(F.sequence(
        F.length("_folded") - 2, F.length("_folded") + 2)).alias("_length")).distinct()
    near_length = wanted.withColumn("_length", F.length("_text")).join(
        lengths, "_length", "left_semi").drop("_length")
    left = near_length.join(exact, "_text", "left_anti").withColumn(
        "_key", F.explode(_shortened(F.col("_text")))
    )
    right = names.withColumn("_key", F.explode(_shortened(F.col("_folded"))))
    near = (
        left.join(right, "_key")
        .select("_text", "_name", "_folded")
        .distinct()
        .withColumn("edits", F.levenshtein("_text", "_folded"))
        .filter(F.col("edits") <= 2)
        .groupBy("_text")
        .agg(
            F.min_by("_name", F.struct("edits", "_name")).alias("matched"),
            F.min("edits").alias("edits"),
        )
    )
    found = exact.unionByName(near)
    keyed = df.withColumn("_text", F.lower(F.trim(F.col(text))))
    return keyed.join(found, "_text", "left").drop("_text")


def _shortened(text: Column) -> Column:
    """The text with zero, one or two characters left out."""
    def without_one(value: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(value), F.lit(1))),
            lambda i: F.concat(
                value.substr(F.lit(1), i - 1), value.substr(i + 1, F.length(value))
            ),
        )

    once = without_one(text)
    twice = F.flatten(F.transform(once, without_one))
    return F.array_distinct(F.concat(F.array(text), once, twice))
