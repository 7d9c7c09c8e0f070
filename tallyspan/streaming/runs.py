"""Running a stream over what has arrived so far."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

from tallyspan.storage import shared_folder


def drain(stream: DataFrame, label: str, keyed: bool = False) -> DataFrame:
    """Process all available input, append to Parquet, and return the rows written.

    ``keyed``: the stream has keyed state with timers (see ``keyed_state``).
    """
    path = shared_folder(stream.sparkSession, label)
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
    )
    with keyed_state(stream.sparkSession) if keyed else nullcontext():
        query = writer.start(f"{path}/rows")
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/rows")


def arrivals(
    spark: SparkSession, folder: str, pattern: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """The Parquet files of a folder as a stream, in order of arrival."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started here keep their state in the store that keyed state and timers need.

    A stream takes the setting when it starts and keeps it in its checkpoint; the session's own is put back.
    """
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(
        _PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
