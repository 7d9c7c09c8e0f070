"""Toxicity from two Kneser-Ney models, one of toxic and one of ordinary texts.

Each class has the counts of its learned texts, each distinct text once and each word once per
text, since inserted expressions matter and copies don't. A word's probability is
``max(n - D, 0) / N + D * T / N * shared``, where N and T are the class's sum of counts and
number of words, and ``shared`` is the backoff both classes have in common: in how many
texts of either class the word goes on, among all such continuations. Rare expressions thus
get nearly the same probability from both models, and words seen by neither the same ratio.

A text is described by its length-normalised log-likelihood ratio, by the ratios of its words
above a few levels (a long text dilutes a mean, not these), and by its length. A logistic
regression turns this into a score; it is fitted on learned texts described by models that had not
counted them. Labels, lang, source and doc_id are never inputs of a score.

Null and empty texts get the score of a text without words. A doc_id with several labels is toxic if
one says so; labels without a value or document are ignored. If the calibration texts lack one of
the classes, fixed weights take the regression's place. Repeated rows come back repeated.
"""

from __future__ import annotations

from math import log

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.tables import remainder, small_side, text_keys, without_rows
from tallyspan.llm.wordscores import SENT_BYTES, sum_scores, word_counts
from tallyspan.storage import settle

DISCOUNT = 0.75
LEVELS = (2.0, 3.0, 4.0)
THRESHOLD = 0.3
FOLDS = 3
HELD_OUT = 2  # of the remainders by 4
# Used if there is nothing to calibrate on: no evidence scores low, one clear word high.
FALLBACK = ([0.5, 0.5, 1.0, 1.0, 0.0], -3.0)


def learned_rows(docs: DataFrame, labels: DataFrame, folds: Column) -> DataFrame:
    """``(doc_id, toxic, fold, t, u, copies)``: one document of each distinct labelled text.

    ``copies``: how often the document's row is there.
    """
    known = (
        labels.filter("toxic is not null and doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("fold", folds)
        .filter("fold is not null")
    )
    known = settle(known, "labels")
    texts = docs.select(
        "doc_id", F.xxhash64("text").alias("t"), F.hash("text").alias("u")
    ).groupBy("doc_id", "t", "u").agg(F.count("*").alias("copies")).join(small_side(known), "doc_id")
    return settle(
        texts.groupBy("t", "u").agg(
            F.min_by(F.struct("doc_id", "toxic", "fold", "copies"), "doc_id").alias("r")
        ).select("r.*", "t", "u"),
        "learned",
    )


def _labelled_texts(docs: DataFrame, learned: DataFrame) -> DataFrame:
    """One row of ``docs`` for each row of ``learned``: texts that stand there again, or other texts of a
    doc_id, teach nothing.
    """
    keyed = docs.select("doc_id", "text", *text_keys())
    rows = keyed.join(small_side(learned), ["doc_id", "t", "u"])
    if learned.filter("copies > 1").isEmpty():
        return rows
    again = rows.filter("copies > 1").dropDuplicates(["doc_id", "t", "u"])
    return rows.filter("copies = 1").union(again)


def ratios(counts: DataFrame) -> tuple[DataFrame, float]:
    """``(hash, ratio)`` of log-likelihoods from counts (group 0/1, hash, n); and of other words."""
    both = counts.groupBy("hash").agg(
        F.sum(F.when(F.col("group") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("group") == 0, F.col("n")).otherwise(0)).alias("plain"),
    )
    total = both.agg(
        F.sum("toxic").alias("n1"), F.sum("plain").alias("n0"),
        F.sum((F.col("toxic") > 0).cast("long")).alias("t1"),
        F.sum((F.col("plain") > 0).cast("long")).alias("t0"),
    ).first()
    if not total["n1"] or not total["n0"]:
        return both.select("hash", F.lit(0.0).alias("ratio")).limit(0), 0.0
    every = total["n1"] + total["n0"]

    def probability(count: str, n: int, types: int) -> Column:
        shared = (F.col("toxic") + F.col("plain")) / F.lit(float(every))
        seen = F.greatest(F.col(count) - F.lit(DISCOUNT), F.lit(0.0)) / F.lit(float(n))
        return seen + F.lit(DISCOUNT * types / n) * shared

    ratio = F.log(probability("toxic", total["n1"], total["t1"])) - F.log(
        probability("plain", total["n0"], total["t0"])
    )
    return both.select("hash", ratio.alias("ratio")), log(
        (total["t1"] / total["n1"]) / (total["t0"] / total["n0"])
    )


def _features() -> Column:
    above = [F.log1p(F.col("sums")[k + 1]) for k in range(len(LEVELS))]
    mean = F.col("sums")[0] / F.greatest(F.col("words"), F.lit(1))
    return F.array(mean, *above, F.log1p(F.col("words").cast("double")))


def _word_table(counts: DataFrame, left_out: int | None) -> tuple[DataFrame, list[float]]:
    """Scores of words from the counts of all folds but one, and those of any other word."""
    used = counts if left_out is None else counts.filter(F.col("fold") != left_out)
    table, other = ratios(used.groupBy("group", "hash").agg(F.sum("n").alias("n")))
    values = [F.col("ratio"), *[F.greatest(F.col("ratio") - t, F.lit(0.0)) for t in LEVELS]]
    return (
        settle(table.select("hash", F.array(*values).alias("values")), "word-ratios"),
        [other, *[max(other - t, 0.0) for t in LEVELS]],
    )


def score(docs: DataFrame, labels: DataFrame, folds: Column,
          sent_bytes: int = SENT_BYTES, keyed: bool = False) -> DataFrame:
    """``(doc_id, score)`` for every row of ``docs`` (doc_id, text); with its text's keys if ``keyed``.

    ``folds`` gives the fold, from 0 to ``FOLDS`` - 1, of a doc_id whose label may be learned from,
    and null for all others, whose labels are not looked at. The models count all folds. For the
    regression each learned text is described by models that left its own fold out.
    """
    keep = ["doc_id", "t", "u"] if keyed else ["doc_id"]
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", *(text_keys() if keyed else [])
    )
    learned = learned_rows(docs, labels, folds)
    rows = _labelled_texts(docs, learned)
    group = F.col("fold") * 2 + F.col("toxic")
    counts = word_counts(rows, group, once=True, spelled=False).select(
        F.floor(F.col("group") / 2).alias("fold"), (F.col("group") % 2).alias("group"), "hash", "n"
    )
    counts = settle(counts, "word-counts")

    training = None
    for fold in range(FOLDS):
        table, others = _word_table(counts, fold)
        part = sum_scores(
            rows.filter(F.col("fold") == fold), table, others, ["toxic"], sent_bytes
        ).select(
            array_to_vector(_features()).alias("features"), F.col("toxic").cast("double").alias("label")
        )
        training = part if training is None else training.union(part)
    training = settle(training, "calibration")
    seen = training.agg(F.min("label").alias("a"), F.max("label").alias("b")).first()
    if seen["a"] == 0.0 and seen["b"] == 1.0:
        model = LogisticRegression(regParam=1e-3, maxIter=50).fit(training)
        weights, intercept = [float(w) for w in model.coefficients], float(model.intercept)
    else:
        weights, intercept = FALLBACK
    table, others = _word_table(counts, None)
    features = _features()
    line = sum((features[k] * w for k, w in enumerate(weights)), F.lit(intercept))
    return sum_scores(docs, table, others, keep, sent_bytes).select(
        *keep, (1 / (1 + F.exp(-line))).alias("score")
    )


def _folds() -> Column:
    part = remainder("doc_id", 4)
    return F.when(part == 3, 2).when(part != HELD_OUT, part).cast("int")


def predictions(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Scores of all documents, learned without the labels of the held-out quarter."""
    scored = score(docs, labels, _folds())
    return scored.select(
        "doc_id", F.coalesce(remainder("doc_id", 4) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def ordinary(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
             unnamed: bool = False) -> DataFrame:
    """``docs`` without the rows whose own text's score reaches ``threshold``, all columns kept.

    A score depends on nothing but the text, so rows are dropped by text and other texts of the same
    doc_id stay. Rows without a doc_id are judged too if ``unnamed``, and all stay if not.
    """
    scored = score(docs, labels, _folds(), keyed=True).filter(F.col("score") >= threshold)
    if unnamed:
        return without_rows(docs, settle(scored.select("t", "u"), "flagged"))
    scored = scored.filter("doc_id is not null")
    return without_rows(docs, settle(scored.select("doc_id", "t", "u"), "flagged"))
