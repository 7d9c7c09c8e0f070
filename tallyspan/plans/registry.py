"""Collects the queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyspan.sources.bindings import CTE, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, over: str | None = None):
    """Register a function of ``Tables``; ``over`` names the derivation ``sql`` starts from."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(spark, folder))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            prefix = "" if over is None else CTE[over]
            ORACLES[name] = prefix + ("," if over and sql.lstrip().startswith("+") else "\n") + (
                sql.lstrip().lstrip("+")
            )
        return build

    return register
