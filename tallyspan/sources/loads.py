"""Typed loads, document loads, log tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def quote_name(name: str) -> str:
    """Backtick-quote every dotted part, so names with hyphens resolve."""
    parts = [part.strip("`") for part in name.split(".")]
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def ensure_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quote_name(schema)}")


def comment_table(spark: SparkSession, table: str, text: str) -> None:
    spark.sql(f"COMMENT ON TABLE {quote_name(table)} IS :text", args={"text": text})


def typed_fact(df: DataFrame) -> DataFrame:
    """The declared fact types; the ISO date string becomes a date."""
    casts = {
        "disaster_id": "string",
        "year": "int",
        "state": "string",
        "disaster_type": "string",
        "severity": "int",
        "affected_population": "bigint",
        "federal_aid_amount": "double",
        "declaration_date": "date",
    }
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in casts.items()])


def load_fact(df: DataFrame, table: str) -> DataFrame:
    """Cast and overwrite the managed fact table; returns it."""
    typed_fact(df).write.mode("overwrite").saveAsTable(quote_name(table))
    return df.sparkSession.table(quote_name(table))


def versioned_documents(df: DataFrame) -> DataFrame:
    """Documents with a content hash, the version a later snapshot is compared by.

    A null key is an error; duplicates are found by ``duplicate_keys``.
    """
    key = F.when(
        F.col("doc_id").isNull(), F.raise_error(F.lit("doc_id must not be null"))
    ).otherwise(F.col("doc_id"))
    return df.withColumn("doc_id", key).withColumn("content_hash", F.sha2("text", 256))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def load_documents(df: DataFrame, table: str) -> DataFrame:
    """Overwrite the document table; the key must be unique and not null."""
    if not duplicate_keys(df, "doc_id").isEmpty():
        raise ValueError("doc_id is not unique")
    versioned_documents(df).write.mode("overwrite").saveAsTable(quote_name(table))
    return df.sparkSession.table(quote_name(table))


def readback_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def read_log_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(quote_name(name))


def append_traces(df: DataFrame, table: str, batch: str | None = None) -> None:
    """Append traces to a table partitioned by day, so time filters skip whole days.

    With ``batch``, the name of what is appended, the table is partitioned by batch first, and appending a
    batch again replaces its own files and no others: after a failure the same call may be repeated.
    """
    spark, name = df.sparkSession, quote_name(table)
    rows = df.withColumn("day", F.to_date("request_time")).repartition(
        "day", F.pmod(F.xxhash64("trace_id"), F.lit(64))
    )
    if batch is None:
        rows.write.mode("append").partitionBy("day").saveAsTable(name)
    elif not spark.catalog.tableExists(name):
        rows.withColumn("batch", F.lit(batch)).write.partitionBy("batch", "day").saveAsTable(name)
    else:
        own = batch.replace("\\", "\\\\").replace("'", "\\'")
        own = own.replace("{", "{{").replace("}", "}}")
        columns = [c for c in spark.table(name).columns if c != "batch"]
        spark.sql(
            f"INSERT OVERWRITE TABLE {name} PARTITION (batch = '{own}', day) SELECT * FROM {{rows}}",
            rows=rows.select(*columns),
        )
