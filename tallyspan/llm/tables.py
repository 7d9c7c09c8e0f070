"""Reading the given tables, and settings shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Ids sent to the tasks at most (about 50 MB); more of them are joined.
SENT_IDS = 1_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remainder(column: str, divisor: int) -> Column:
    """``crc32(value as text) mod divisor``; null for null."""
    return F.crc32(F.col(column).cast("string")) % divisor


def small_side(rows: DataFrame, most: int = SENT_IDS) -> DataFrame:
    """``rows`` of a few numbers each, to be sent to the tasks if they are few enough."""
    return F.broadcast(rows) if rows.count() <= most else rows


def text_keys() -> list[Column]:
    """``t`` and ``u``: 96 bits that tell the texts of rows apart."""
    return [F.xxhash64("text").alias("t"), F.hash("text").alias("u")]


def _in_keys(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    named = keys.select(*[F.col(c).alias(f"_key_{c}") for c in keys.columns]).distinct()
    named = small_side(named)
    same = (F.xxhash64(docs["text"]) == named["_key_t"]) & (F.hash(docs["text"]) == named["_key_u"])
    if "doc_id" in keys.columns:
        same &= docs["doc_id"].cast("long").eqNullSafe(named["_key_doc_id"])
    return docs.join(named, same, how)


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows of ``gone``: keys (t, u) of texts, or (doc_id, t, u) with nulls equal."""
    return _in_keys(docs, gone, "left_anti")


def only_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``without_rows`` drops."""
    return _in_keys(docs, kept, "left_semi")


def fresh_name(docs: DataFrame, wanted: str) -> str:
    """``wanted``, with marks behind it as long as ``docs`` has a column of that name."""
    taken = {c.lower() for c in docs.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
