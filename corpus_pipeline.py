"""Documents to packed sequences: the stages of a training-data pipeline in order.

Each stage gets all documents its predecessor kept, with the columns of ``documents``, and its
decisions take effect: toxic documents go, one document of each group of near duplicates stays,
documents with benchmark passages go, personal data are replaced in the texts, and the
texts that are left are packed into sequences. Every stage judges rows by their own texts, so rows
with a null doc_id are dropped like others, and other texts of a dropped row's doc_id stay; columns beyond
those of ``documents`` pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyspan.llm import decontaminate, packing, pii, simhash, toxicity
from tallyspan.llm.queries import tokenizer_path
from tallyspan.llm.tables import table
from tallyspan.storage import settle


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose toxicity score reaches the threshold."""
    return toxicity.ordinary(docs, table(spark, sf_dir, "labels"), unnamed=True)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each group of linked fingerprints.

    Of rows that repeat a doc_id within a group, one stays, and one of a group without any doc_id.
    """
    return simhash.first_of_each(docs, unnamed=True)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by the names of their kinds."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts and their places in the sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", without_toxic),
    ("simhash_near_dedup", without_near_duplicates),
    ("benchmark_decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("best_fit_packing", packed),
]

#: Scores, XXH64 fingerprints and token ids cannot be had from DuckDB; tests hold the stages
#: against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = settle(docs, name)
    return docs
