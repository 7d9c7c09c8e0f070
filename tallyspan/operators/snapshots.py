"""Differences between two snapshots of a document table, and an index kept in step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.operators.retrieval import word_keys
from tallyspan.storage import KEY_OPTIONS, settle

# Keys that are sent to the tasks at most.
SENT_KEYS = 1 << 20


def content_hash(*columns: str) -> Column:
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, *content: str) -> DataFrame:
    """``(key, change)``: inserted, updated or deleted rows; unchanged ones are left out.

    Keys are unique in each snapshot. Only the key and a hash of the content are shuffled.
    """
    before = old.select(key, content_hash(*content).alias("_old"))
    after = new.select(key, content_hash(*content).alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "inserted")
        .when(F.col("_new").isNull(), "deleted")
        .when(F.col("_old") != F.col("_new"), "updated")
    )
    return (
        before.join(after, key, "full_outer")
        .select(key, change.alias("change"))
        .filter(F.col("change").isNotNull())
    )


def changed_documents(old: DataFrame, new: DataFrame, key: str, text: str) -> DataFrame:
    """The diff with the new text of inserted and updated documents.

    The diff is written first. While few documents have changed, only their texts move; else all new ones do.
    """
    diff = settle(snapshot_diff(old, new, key, text), "snapshot-diff")
    arrived = F.col("change") != "deleted"
    changed = diff.filter(arrived).select(key).distinct()
    texts = new.select(key, text)
    if changed.limit(SENT_KEYS + 1).count() <= SENT_KEYS:
        texts = texts.join(F.broadcast(changed), key, "left_semi")
    with_text = diff.filter(arrived).join(texts, key, "left")
    return with_text.unionByName(diff.filter(~arrived).withColumn(text, F.lit(None).cast(dict(new.dtypes)[text])))


def write_index_batch(
    changes: DataFrame, path: str, batch_id: int, key: str, text: str,
    sequence: str | None = None,
) -> None:
    """Index one batch of changes in its own folder; running it again replaces that folder.

    ``sequence`` orders the changes of one document within a batch (a commit time or number).
    Without one a batch must hold one change per document.
    """
    order = F.col(sequence) if sequence else F.lit(0)
    (
        changes.select(
            key, "change", order.alias("sequence"),
            F.when(F.col("change") != "deleted", word_keys(F.col(text))).alias("terms"),
        )
        .write.mode("overwrite")
        .options(**KEY_OPTIONS)
        .parquet(f"{path}/batch={batch_id}")
    )


def read_index(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The index as of the newest batch: the latest entry of each document, deletions gone.

    Entries are ordered by batch and, within one, by their sequence. While the documents with several entries
    are few, only their entries are shuffled; else all are.
    """
    entries = spark.read.parquet(path)
    repeated = settle(entries.groupBy(key).count().filter("count > 1").select(F.col(key).alias("_key")), "repeated-keys")

    def latest(some: DataFrame) -> DataFrame:
        newest = F.max_by(F.struct("change", "terms"), F.struct("batch", "sequence"))
        return some.groupBy(key).agg(newest.alias("_entry")).select(key, "_entry.change", "_entry.terms")

    if repeated.limit(SENT_KEYS + 1).count() <= SENT_KEYS:
        same = F.col(key).eqNullSafe(F.col("_key"))
        single = entries.join(F.broadcast(repeated), same, "left_anti").select(key, "change", "terms")
        current = single.unionByName(latest(entries.join(F.broadcast(repeated), same, "left_semi")))
    else:
        current = latest(entries)
    return current.filter(F.col("change") != "deleted").select(key, "terms")
