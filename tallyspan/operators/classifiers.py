"""A text classifier fitted on labelled rows, for policies that rules cannot word.

Features are the distinct words of the whole text, hashed, and which general rules it hits. A chi-squared
test keeps the ``WORDS`` hashes that tell the classes apart best, a logistic regression weighs them. The
threshold is the one of best F1 over all learned rows, each scored by a model that has not seen it: rows
are dealt into ``FOLDS`` by a hash of their text, and each fold is scored by a model of the others. The model itself is
then fitted on all. Every labelled row is learned from: counts are added up in the tasks that read them, so nothing but
sums, the kept hashes and at most 10^6 distinct scores comes to the driver. Scoring is one projection over any number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions import rules
from tallyspan.storage import settle

#: Parts of the labelled rows that are scored by a model of the others.
FOLDS = 3
FEATURES = 1 << 14
#: Leading bits of a text's hash by which labelled rows are counted.
HASH_BITS = 12
WORDS = 128
PENALTY = 0.01
_OWN = ["_words", "_rules", "_terms", "_kept", "_features", "_raw", "_probability", "_prediction"]


@dataclass(frozen=True)
class TextClassifier:
    """A fitted model with its threshold; a text at or above it is flagged."""

    model: PipelineModel
    table: tuple[tuple[str, str], ...]
    threshold: float

    def flags(self, df: DataFrame, text: str) -> DataFrame:
        """``df`` with ``score`` (0 to 1), the ``flags`` of the rules a text hits, and ``flagged``.

        A null text is scored like an empty one.
        """
        scored = self.model.transform(_prepared(df, text, self.table)).withColumns({
            "score": vector_to_array("_probability")[1],
            "flags": rules.matching_rules(F.coalesce(F.col(text), F.lit("")), self.table),
        })
        return scored.withColumn("flagged", F.col("score") >= self.threshold).drop(*_OWN)


def _prepared(df: DataFrame, text: str, table: Sequence[tuple[str, str]]) -> DataFrame:
    value = F.coalesce(F.col(text), F.lit(""))
    hits = [F.lower(value).rlike(pattern).cast("double") for _, pattern in table]
    hashing = HashingTF(inputCol="_words", outputCol="_terms", numFeatures=FEATURES, binary=True)
    return hashing.transform(df.withColumns({
        "_words": F.array_distinct(rules.words(value)),
        "_rules": array_to_vector(F.array(*hits) if hits else F.array(F.lit(0.0))),
    }))


def _telling(rows: DataFrame, label: str) -> list[int]:
    """The ``WORDS`` hashes of the largest chi-squared statistic. Its p-value would not do: it is 0 for all that tell
    the classes apart well, the sooner the more rows there are.
    """
    tested = ChiSquareTest.test(rows, "_terms", label, flatten=True).filter("degreesOfFreedom > 0")
    best = tested.orderBy(F.col("statistic").desc(), "featureIndex").limit(WORDS).collect()
    return sorted(r["featureIndex"] for r in best) or [0]


def _fit(rows: DataFrame, label: str, penalty: float) -> PipelineModel:
    return Pipeline(stages=[
        VectorSlicer(inputCol="_terms", outputCol="_kept", indices=_telling(rows, label)),
        VectorAssembler(inputCols=["_kept", "_rules"], outputCol="_features"),
        LogisticRegression(
            featuresCol="_features", labelCol=label, regParam=penalty, maxIter=20,
            rawPredictionCol="_raw", probabilityCol="_probability", predictionCol="_prediction",
        ),
    ]).fit(rows)


def _best_threshold(scores: DataFrame) -> float:
    """The score from which on flagging gives the best F1; above 1 if there is nothing to find."""
    counted = scores.groupBy("score").agg(F.count("*").alias("n"), F.sum("label").alias("hits")).toArrow()
    score, n, hits = (counted.column(c).to_numpy() for c in ("score", "n", "hits"))
    order = np.argsort(-score)
    flagged, hit = np.cumsum(n[order]), np.cumsum(hits[order])
    if not len(hit) or hit[-1] <= 0:
        return 1.1
    return float(score[order[np.argmax(2 * hit / (flagged + hit[-1]))]])


def _first_by_hash(given: DataFrame, most: int) -> DataFrame:
    """The first ``most`` distinct rows (text, label) by the hash of the text, text and label.

    One task gathers hashes and counts only; texts are gathered where they share the very last hash.
    """
    hashed = given.withColumn("_hash", F.xxhash64("text"))
    # Hashes up to the end of a bucket in which, or before which, there are enough of them.
    bucket = F.shiftright("_hash", 64 - HASH_BITS)
    sizes = hashed.select("_hash", "label").distinct().groupBy(bucket.alias("bucket")).count()
    before, last_bucket = 0, None
    for row in sizes.orderBy("bucket").collect():  # at most 2^HASH_BITS rows
        before, last_bucket = before + row["count"], row["bucket"]
        if before >= most:
            break
    near = hashed if before < most else hashed.filter(bucket <= last_bucket)
    rows = settle(near.distinct(), "labelled-texts")
    last = rows.select("_hash").orderBy("_hash").limit(most).agg(F.max("_hash")).first()[0]
    if last is None:
        return rows.drop("_hash")
    inside = rows.filter(F.col("_hash") < last)
    tied = rows.filter(F.col("_hash") == last).orderBy("text", "label")
    return inside.unionByName(tied.limit(max(most - inside.count(), 0))).drop("_hash")


def fit_classifier(
    labelled: DataFrame, text: str, label: str, table: Sequence[tuple[str, str]] = (),
    most: int | None = None, penalty: float = PENALTY,
) -> TextClassifier:
    """Learn ``label`` (1 or 0; rows without it are left out) from ``text`` and the rules of ``table``.

    Equal texts with equal labels count once. Without rows of both kinds nothing is ever flagged. All rows are
    learned from, unless a caller bounds them by ``most``; no registered query does.
    """
    table = tuple(table)
    given = labelled.select(
        F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(label).cast("double").alias("label")
    ).filter("label is not null")
    learned = given.distinct() if most is None else _first_by_hash(given, most)
    fold = F.pmod(F.xxhash64("text", F.lit(1)), F.lit(FOLDS)).cast("int")
    rows = settle(
        _prepared(learned, "text", table).select("label", "_terms", "_rules", fold.alias("_fold")), "labelled"
    )
    held = rows.select("_fold", "label").distinct().collect()  # two a fold
    scores = []
    for k in range(FOLDS):
        if len({r["label"] for r in held if r["_fold"] != k}) > 1:
            scored = _fit(rows.filter(F.col("_fold") != k), "label", penalty).transform(
                rows.filter(F.col("_fold") == k))
            scores.append(scored.select(F.round(vector_to_array("_probability")[1], 6).alias("score"), "label"))
    threshold = _best_threshold(reduce(DataFrame.union, scores)) if scores else 1.1
    if not held:
        nothing = labelled.sparkSession.createDataFrame([("", 0.0)], "text string, label double")
        rows = _prepared(nothing, "text", table)
    return TextClassifier(_fit(rows, "label", penalty), table, threshold)


def held_out_quality(flagged: DataFrame, actual: Column) -> DataFrame:
    """One row: rows judged, rows to find, and the recall and precision of ``flagged``."""
    hit = F.count_if(F.col("flagged") & actual)
    return flagged.agg(
        F.count("*").alias("judged"), F.count_if(actual).alias("toxic"),
        F.try_divide(hit, F.count_if(actual)).alias("recall"),
        F.try_divide(hit, F.count_if("flagged")).alias("precision"),
    )
