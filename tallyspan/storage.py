"""Where intermediate tables live, and how lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tallyspan-")


def _own_folder(spark: SparkSession) -> str:
    """What this application writes, below ``spark.checkpoint.dir``.

    The setting names storage every executor can reach. Only a local-mode
    session (one machine by definition) may go without it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/tallyspan/{spark.sparkContext.applicationId}"


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application; results read from them are gone, too."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet to shared storage and read it back.

    Used where a value must not change if a stage is run again (block ids of a
    range partitioning, rounds of an iteration). Columnar, so later passes read
    only the columns they need, and it survives the loss of any executor.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A column of word keys stays dictionary-encoded up to so many bytes of distinct ones in a file's row group.
KEY_OPTIONS = {"parquet.dictionary.page.size": str(16 << 20)}


def settle_keys(df: DataFrame, label: str) -> DataFrame:
    """``settle`` for lists of word keys, which are random numbers but come again and again."""
    path = shared_folder(df.sparkSession, label)
    df.write.mode("overwrite").options(**KEY_OPTIONS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
