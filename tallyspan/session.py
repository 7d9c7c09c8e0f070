"""A local session for tests, checks and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(name: str, extra: dict[str, str] | None = None, cpus: str = "8") -> SparkSession:
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    }
    settings.update(extra or {})
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
