"""Service configurations: policies, routing, log-table discovery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.schemas import SERVICE_CONFIG_BODY


def parse_configs(configs: DataFrame) -> DataFrame:
    """``(model_service, config JSON)`` -> ``(model_service, body struct)``."""
    return configs.select(
        "model_service", F.from_json("config", SERVICE_CONFIG_BODY).alias("body")
    )


def _log_table() -> Column:
    table = F.col("body.inference_table.table")
    marker = "tables/"
    at = F.locate(marker, table)
    rest = F.when(at > 0, F.expr("substring(body.inference_table.table, "
                                 "locate('tables/', body.inference_table.table) + 7)"))
    return F.coalesce(rest, table, F.lit(""))


def discover_log_tables(configs: DataFrame) -> DataFrame:
    """Service -> log table; services without one are left out."""
    return (
        parse_configs(configs)
        .select("model_service", _log_table().alias("log_table"))
        .filter(F.col("log_table") != "")
    )


def active_policies(configs: DataFrame) -> DataFrame:
    """One row per policy that is not deleted; the action defaults to ``block``."""
    policy = F.explode("body.service_policies").alias("policy")
    return (
        parse_configs(configs)
        .select("model_service", policy)
        .filter(~F.coalesce(F.col("policy.is_deleted"), F.lit(False)))
        .select(
            "model_service",
            F.col("policy.name").alias("name"),
            F.col("policy.options.phases").alias("phases"),
            F.coalesce(F.col("policy.options.action"), F.lit("block")).alias("action"),
        )
    )


def routed_model(configs: DataFrame, prefix: str = "system.ai.") -> DataFrame:
    """First destination's name without the catalogue prefix, ``''`` where there is none."""
    first = F.get(F.col("body.routing.destinations"), F.lit(0))["name"]
    return parse_configs(configs).select(
        "model_service",
        F.coalesce(F.replace(first, F.lit(prefix), F.lit("")), F.lit("")).alias("routed_model"),
    )


def _schema_of(name: Column) -> Column:
    return F.array_join(F.slice(F.split(name, r"\."), 1, 2), ".")


def schema_drift(configs: DataFrame) -> DataFrame:
    """Services whose log table lives in another ``catalog.schema`` than the service."""
    return (
        discover_log_tables(configs)
        .select(
            "model_service",
            _schema_of(F.col("model_service")).alias("service_schema"),
            _schema_of(F.col("log_table")).alias("table_schema"),
        )
        .filter(F.col("service_schema") != F.col("table_schema"))
    )


def missing_services(providers: DataFrame, tables: DataFrame) -> DataFrame:
    """Providers configured but without a log table."""
    return providers.join(tables, "model_service", "left_anti")


def covered_services(providers: DataFrame, tables: DataFrame) -> DataFrame:
    """Providers whose service has a log table."""
    return providers.join(tables, "model_service", "left_semi")


def service_settings(configs: DataFrame) -> DataFrame:
    """Rate limits and usage tracking of each service as they are configured."""
    return parse_configs(configs).select(
        "model_service", F.col("body.rate_limits").alias("rate_limits"),
        F.col("body.usage_tracking").alias("usage_tracking"),
    )


def service_limits(configs: DataFrame) -> DataFrame:
    """``(model_service, qpm, tpm)``: the lowest limits a minute of services that have both."""
    limits = F.from_json(
        "rate_limits", "array<struct<calls:bigint,tokens:bigint,renewal_period:string>>"
    )
    minute = F.filter(limits, lambda x: F.coalesce(x["renewal_period"], F.lit("minute")) == "minute")
    return (
        service_settings(configs)
        .select("model_service", F.array_min(F.transform(minute, lambda x: x["calls"])).alias("qpm"),
                F.array_min(F.transform(minute, lambda x: x["tokens"])).alias("tpm"))
        .filter("qpm is not null and tpm is not null")
    )
