"""Personal-data findings as a table function, for use in SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallyspan.functions.rules import pii_array_sql


def register(spark: SparkSession, name: str = "find_pii") -> None:
    """``name(text) -> (kind, value)``, one row per finding: a SQL function, inlined into the query's plan."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(content STRING) "
        "RETURNS TABLE(kind STRING, value STRING) "
        f"RETURN SELECT inline({pii_array_sql('content')})"
    )
