"""Language identification: known words first, shorter and shorter character n-grams else.

A word that the learned texts have is scored by the logarithm of its frequency in each language,
with additive smoothing. Any other word falls back to its character n-grams, from
``LONGEST`` characters (word ends marked) down: the longest length of which some n-gram is known
decides, and the word's score is the mean log frequency of its known n-grams of that length. All words of
all documents are scored once, as a table; a document adds up its words.

``und`` is given for texts that are null, hold no letter, or if no language was learned. Ties go
to the language first in order. Repeated rows come back repeated; null doc_ids are never learned
from. Text of any length is one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.bytewords import signed, slices, span_hashes
from tallyspan.llm.tables import remainder
from tallyspan.llm.wordscores import SENT_BYTES, sum_scores, word_counts
from tallyspan.storage import settle

SMOOTHING = 0.5
LONGEST = 4
UNDETERMINED = "und"


def _grams(words: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """All runs of ``size`` characters of ``^word$``: the word's place, and the run's hash."""
    marked = pc.binary_join_element_wise("^", words.cast(pa.string()), "$", "")
    found_word, found_hash = [], []
    for run in slices(marked):
        begins = np.flatnonzero((run.data & 0xC0) != 0x80)  # of characters in UTF-8
        if len(begins) < size:
            continue
        word = np.searchsorted(run.offsets, begins, side="right") - 1
        ends = np.append(begins, len(run.data))[size:]
        first = np.arange(len(begins) - size + 1)
        whole = word[first] == word[first + size - 1]
        starts, ends, word = begins[first][whole], ends[whole], word[first][whole]
        if size == 1:
            letter = (run.data[starts] != ord("^")) & (run.data[starts] != ord("$"))
            starts, ends, word = starts[letter], ends[letter], word[letter]
        found_word.append(run.first + word)
        found_hash.append(span_hashes(run.data, starts, ends))
    if not found_word:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    return np.concatenate(found_word), np.concatenate(found_hash)


def _gram_counts(known: DataFrame, each: list[str], longest: int) -> DataFrame:
    """``(size, gram, c0, c1, ...)`` of all n-grams of the known words, weighted by the counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.stack([c.to_numpy() for c in batch.columns[1:]])
            for size in range(1, longest + 1):
                word, gram = _grams(batch.column(0), size)
                if not len(gram):
                    continue
                order = np.argsort(gram, kind="stable")
                gram = gram[order]
                at = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
                sums = np.add.reduceat(counts[:, word[order]], at, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), size, dtype=np.int32)),
                     pa.array(signed(gram[at])), *map(pa.array, sums)],
                    names=["size", "gram", *each],
                )

    fields = ", ".join(f"{c} long" for c in each)
    return known.select("word", *each).mapInArrow(
        count, f"size int, gram long, {fields}"
    ).groupBy("size", "gram").agg(*[F.sum(c).alias(c) for c in each])


def _gram_rows(words: DataFrame, size: int) -> DataFrame:
    """``(hash, gram)`` of all n-grams of the words (hash, word)."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, gram = _grams(batch.column(1), size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(word)), pa.array(signed(gram))],
                names=["hash", "gram"],
            )

    return words.select("hash", "word").mapInArrow(explode, "hash long, gram long")


def _frequencies(languages: int, smoothing: float, totals: list[float], kinds: float) -> Column:
    """Log frequency in each language from the counts ``c0, c1, ...``."""
    return F.array(*[
        F.log((F.col(f"c{k}") + F.lit(smoothing)) / F.lit(totals[k] + smoothing * kinds))
        for k in range(languages)
    ])


def _totals(counts: DataFrame, languages: int) -> tuple[list[float], float]:
    row = counts.agg(
        F.count("*").alias("kinds"), *[F.sum(f"c{k}").alias(f"c{k}") for k in range(languages)]
    ).first()
    return [float(row[f"c{k}"] or 0) for k in range(languages)], float(row["kinds"])


def word_table(counts: DataFrame, languages: int, longest: int = LONGEST,
               smoothing: float = SMOOTHING) -> DataFrame:
    """``(hash, values)``: log scores of every word by language.

    ``counts`` are (group, hash, word, n), with group -1 for texts not learned from.
    """
    wide = counts.groupBy("hash").agg(
        F.first("word").alias("word"),
        *[F.sum(F.when(F.col("group") == k, F.col("n")).otherwise(0)).alias(f"c{k}")
          for k in range(languages)],
    )
    wide = settle(wide, "words")
    each = [f"c{k}" for k in range(languages)]
    learned = sum((F.col(c) for c in each), F.lit(0)) > 0
    known, unseen = wide.filter(learned), wide.filter(~learned)
    totals, kinds = _totals(known, languages)
    by_word = known.select("hash", _frequencies(languages, smoothing, totals, kinds).alias("values"))

    grams = settle(_gram_counts(known, each, longest), "grams")
    sizes = {
        r["size"]: r for r in grams.groupBy("size").agg(
            F.count("*").alias("kinds"), *[F.sum(c).alias(c) for c in each]
        ).collect()  # a row per n-gram length
    }
    # The longest n-grams first; a shorter length is tried for what they leave only.
    left = unseen.select("hash", "word")
    for size in sorted(sizes, reverse=True):
        row = sizes[size]
        values = _frequencies(
            languages, smoothing, [float(row[c]) for c in each], float(row["kinds"])
        )
        scored = grams.filter(F.col("size") == size).select("gram", values.alias("values"))
        found = settle(
            _gram_rows(left, size).join(scored, "gram").groupBy("hash").agg(
                F.array(*[F.avg(F.col("values")[k]) for k in range(languages)]).alias("values")
            ),
            "unseen-words",
        )
        by_word = by_word.union(found)
        left = left.join(found, "hash", "left_anti")
    return by_word


def identify(docs: DataFrame, learn: Column, longest: int = LONGEST,
             smoothing: float = SMOOTHING, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """``(doc_id, lang_pred, score)`` for every row of ``docs`` (doc_id, text, lang).

    Rows for which ``learn`` is true and ``lang`` is not null are learned from.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    learn = F.coalesce(learn & F.col("lang").isNotNull() & F.col("text").isNotNull(), F.lit(False))
    # The languages' names, which the result must hold one of per row.
    names = sorted(r[0] for r in docs.filter(learn).select("lang").distinct().collect())
    if not names:
        return docs.select(
            "doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score")
        )
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("lang")) - 1
    counts = settle(word_counts(docs, F.when(learn, place).otherwise(-1)), "word-counts")
    table = settle(word_table(counts, len(names), longest, smoothing), "word-scores")
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    lettered = docs.select("text", "doc_id", has_letter.alias("letters"))
    summed = sum_scores(lettered, table, [0.0] * len(names), ["doc_id", "letters"], sent_bytes)
    best = F.array_max("sums")
    known = F.col("letters") & (F.col("words") > 0)
    return summed.select(
        "doc_id",
        F.when(known, F.element_at(
            F.array(*[F.lit(n) for n in names]), F.array_position("sums", best).cast("int")
        )).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(known, 1 / F.aggregate(
            "sums", F.lit(0.0), lambda total, s: total + F.exp(s - best)
        )).otherwise(0.0).alias("score"),
    )


def predictions(docs: DataFrame) -> DataFrame:
    """Languages of all documents, learned without the held-out third."""
    fold = remainder("doc_id", 3)
    return identify(docs, fold != 1).select(
        "doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "lang_pred", "score",
    )
