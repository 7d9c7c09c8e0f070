"""A search index kept in step with a stream of document changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallyspan.operators.snapshots import write_index_batch


def incremental_index(
    changes: DataFrame, path: str, key: str = "doc_id", text: str = "text",
    sequence: str | None = None,
) -> StreamingQuery:
    """Index what changed since the last run and stop (a triggered sync).

    Only changed documents are read and indexed; deletions are entries of their
    own, and ``sequence`` orders the changes of a document within a batch. ``operators.snapshots.read_index`` gives the current state of
    ``path/entries``.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        write_index_batch(batch, f"{path}/entries", batch_id, key, text, sequence)

    return (
        changes.writeStream.foreachBatch(run)
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
