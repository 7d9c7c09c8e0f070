"""The queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.llm import (
    ann,
    chat,
    decontaminate,
    hard_negatives,
    langid,
    licenses,
    merkle,
    near_vectors,
    oracles,
    packing,
    pii,
    simhash,
    substrings,
    toxicity,
)
from tallyspan.llm.tables import remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_best_fit_packing")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path())


@query("op8_simhash_near_dedup")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query("op10_substring_dedup", oracles.SUBSTRINGS)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, folder, "documents")).drop("kept")


@query("op7_benchmark_decontamination", oracles.DECONTAMINATION)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.matches(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    ).drop("longest", "longest_item", "item_word", "doc_word")


@query("op9_personal_data")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(table(spark, folder, "documents"))


@query("op2_toxicity")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.predictions(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op3_language_id")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return langid.predictions(table(spark, folder, "documents"))


@query("op5_nearest_neighbours")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return ann.neighbours(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def document_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files: thousands, then sources are directories, and some files are licences.

    The tables hold no paths, so these are made from doc_id and source. Every document is a file.
    """
    docs = table(spark, folder, "documents")
    top = F.floor(F.col("doc_id") / 1000)
    path = (
        F.when(F.col("doc_id") % 1000 < 20, F.concat_ws("/", top, F.lit("LICENSE")))
        .when(F.col("doc_id") % 25 == 0, F.concat_ws("/", top, "source", F.lit("LICENSE.txt")))
        .otherwise(F.concat_ws("/", top, "source", F.concat("doc_id", F.lit(".txt"))))
    )
    return docs.select(F.col("doc_id").alias("file_id"), path.alias("path"), "text")


@query("op6_license_scan", oracles.LICENSES)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(document_files(spark, folder))


def transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as transcripts: one of three marker styles each, and no marker now and then."""
    turns = table(spark, folder, "conversations")
    style = F.coalesce(F.crc32(F.col("conv_id").cast("string")) % 3, F.lit(0))
    bare = F.crc32(F.concat_ws(":", F.col("conv_id").cast("string"), F.lit("t"), "turn")) % 5 == 0
    name = F.lower("role")
    marker = (
        F.when(bare | F.col("role").isNull(), F.lit(""))
        .when(style == 0, F.concat(F.initcap(name), F.lit(": ")))
        .when(style == 1, F.concat(F.lit("### "), name, F.lit(": ")))
        .otherwise(F.concat(F.lit("["), name, F.lit("] ")))
    )
    return turns.select("conv_id", "turn", "role", F.concat(marker, "text").alias("text"))


@query("op4_chat_formatting")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    learned = F.coalesce(remainder("conv_id", 3) != 1, F.lit(False))
    return chat.transcripts_to_turns(transcripts(spark, folder), learned)


@query("op11_merkle_manifest", oracles.MERKLE)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    even = F.coalesce(remainder("doc_id", 2) == 0, F.lit(False))
    return merkle.verified(table(spark, folder, "documents"), even)


@query("op12_hard_negatives", oracles.HARD_NEGATIVES)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    vectors = hard_negatives.whole_numbers(table(spark, folder, "embeddings"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.select("vec_id", label.alias("label"), "vector")
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


@query("op13_embedding_near_dedup")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, folder, "embeddings"))
