"""Search against brute force; snapshots and the index kept in step."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspan.operators import retrieval, snapshots
from tallyspan.operators.facts import approx_entities, entity_match
from tallyspan.streaming.index import incremental_index

N, DIM = 800, 16


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(N, DIM)).astype(np.float32)
    rows[200:470] = rows[200]  # a third of all documents are copies
    return rows


@pytest.fixture(scope="module")
def docs(spark, vectors):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "doc_id bigint, embedding array<float>").repartition(6)


def best(vectors, query, k):
    v = vectors.astype(np.float64)
    scores = np.round(v @ query / np.linalg.norm(v, axis=1) / np.linalg.norm(query), 9)
    return sorted(range(len(v)), key=lambda i: (-scores[i], i))[:k]


@pytest.mark.parametrize("how", [{}, {"block": 3, "part_cells": 16 * 90}])
def test_question_doc_topk(spark, docs, vectors, how):
    queries = [vectors[5], vectors[200], vectors[7] + vectors[8], -vectors[9]] * 3
    rows = [(f"q{i}", [float(x) for x in q]) for i, q in enumerate(queries)]
    asked = spark.createDataFrame(rows, "question_id string, question array<double>")
    got = retrieval.question_doc_topk(asked, docs, 7, **how).collect()
    for name, query in rows:
        mine = sorted((r for r in got if r.question_id == name), key=lambda r: r.rank)
        assert [r.doc_id for r in mine] == best(vectors, np.asarray(query), 7), name


def test_similarity_topk_and_fewer_documents_than_k(docs, vectors):
    query = [float(x) for x in vectors[200]]
    got = retrieval.similarity_topk(docs, query, 5).orderBy("rank").collect()
    assert [r.doc_id for r in got] == [200, 201, 202, 203, 204]
    assert retrieval.similarity_topk(docs.filter("doc_id < 2"), query, 5).count() == 2
    assert retrieval.similarity_topk(docs.filter("doc_id < 0"), query, 5).count() == 0


def test_lsh_recall_and_fallback(docs, vectors):
    table = retrieval.lsh_table(docs).cache()
    hits = 0
    for i in range(20):
        query = vectors[i].astype(np.float64) + 0.3 * vectors[i + 30]
        got = {r.doc_id for r in retrieval.similarity_topk_lsh(table, list(query), 3).collect()}
        assert len(got) == 3
        hits += len(got & set(best(vectors, query, 3)))
    assert hits >= 48  # 80 % of 60
    few = table.filter("doc_id < 3")
    assert retrieval.similarity_topk_lsh(few, [1.0] * DIM, 3).count() == 3
    table.unpersist()


def test_centroids(docs, vectors):
    row = retrieval.centroids(docs.withColumn("g", F.lit(1)), "g", "embedding").first()
    assert np.allclose(row.centroid, vectors.astype(np.float64).mean(axis=0))


def brute_text(docs, questions, k):
    def words(text):
        return [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]

    counts = {i: {w: words(t).count(w) for w in words(t)} for i, t in docs}
    df = {}
    for c in counts.values():
        for w in c:
            df[w] = df.get(w, 0) + 1

    def weigh(c):
        v = {w: n * math.log((len(docs) + 1) / (df.get(w, 0) + 1)) for w, n in c.items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1
        return {w: x / norm for w, x in v.items()}

    vectors = {i: weigh(c) for i, c in counts.items()}
    out = {}
    for q, text in questions:
        mine = weigh({w: words(text).count(w) for w in words(text)})
        scores = {i: round(sum(mine.get(w, 0) * x for w, x in v.items()), 9)
                  for i, v in vectors.items()}
        out[q] = [i for i in sorted(scores, key=lambda i: (-scores[i], i)) if scores[i] > 0][:k]
    return out


def test_questions_without_words_find_nothing(spark):
    kind = "question_id bigint, question string"
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, ""), (4, "c")], "doc_id bigint, text string")
    none = retrieval.text_topk(spark.createDataFrame([], kind), docs, 2)
    assert none.count() == 0
    asked = spark.createDataFrame([(1, None), (2, ""), (3, "zzz"), (4, "b c")], kind)
    got = [(r.question_id, r.doc_id) for r in retrieval.text_topk(asked, docs, 2).collect()]
    assert sorted(got) == [(4, 1), (4, 4)]
    empty = spark.createDataFrame([], "question_id bigint, question array<double>")
    vectors = spark.createDataFrame([(1, [1.0])], "doc_id bigint, embedding array<double>")
    assert retrieval.question_doc_topk(empty, vectors, 2).count() == 0


@pytest.mark.parametrize("postings,leading,sent", [(1024, 8, 10**6), (4, 1, 0), (1, 2, 10**6)])
def test_text_topk(spark, postings, leading, sent):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 40)))) for i in range(120)]
    docs += [(200 + i, docs[3][1]) for i in range(60)]
    questions = [(i, " ".join(rng.choices(vocabulary + ["unseen"], k=4))) for i in range(6)]
    index = retrieval.text_index(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5), postings=postings, sent=sent)
    got = retrieval.search_index(
        spark.createDataFrame(questions, "question_id bigint, question string"), index, 4, leading=leading, sent=sent
    ).orderBy("question_id", "rank").collect()
    want = brute_text(docs, questions, 4)
    for q, _ in questions:
        assert [r.doc_id for r in got if r.question_id == q] == want[q]


def test_shut_lists_change_nothing(spark, monkeypatch):
    """A frequent word next to a rare one: few of the frequent word's postings are scored."""
    docs = [(i, "often " * (1 + i % 3) + f"own{i} filler{i % 7}") for i in range(600)]
    docs += [(1000 + i, "often rare") for i in range(4)] + [(2000 + i, f"other{i}") for i in range(40)]
    questions = [(0, "often rare"), (1, "often"), (2, "filler3 often rare own10")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    index = retrieval.text_index(frame, postings=16)
    asked = spark.createDataFrame(questions, "question_id bigint, question string")
    opened, whole = [], retrieval._scored
    monkeypatch.setattr(
        retrieval, "_scored", lambda pairs, *more: (opened.append(pairs.count()), whole(pairs, *more))[1])
    got = retrieval.search_index(asked, index, 4).orderBy("question_id", "rank").collect()
    want = brute_text(docs, questions, 4)
    for q, _ in questions:
        assert [r.doc_id for r in got if r.question_id == q] == want[q]
    assert opened[-1] < 300  # of 1,808 pairs that share a word
    assert index.blocks.groupBy("_word").count().agg(F.max("count")).first()[0] > 30


def test_no_posting_is_shuffled_and_few_pairs_are_kept(spark, monkeypatch):
    """What is written grows with the documents or with the answers, not with questions times documents."""
    written, whole = {}, retrieval.settle

    def settle(df, label):
        plan, done = df._jdf.queryExecution().executedPlan().toString(), whole(df, label)
        written[label] = (plan, done.count())
        return done

    monkeypatch.setattr(retrieval, "settle", settle)
    docs = [(i, f"all some{i % 2} own{i}" + " more" * (i % 30)) for i in range(400)] + [(7, "all again"), (None, "all none"), (900, "")]
    questions = [(i, f"all some1 own{i}") for i in range(1, 41, 2)] + [(1, "own5 all"), (None, "all")]
    index = retrieval.text_index(spark.createDataFrame(docs, "doc_id bigint, text string"), postings=64)
    got = retrieval.search_index(
        spark.createDataFrame(questions, "question_id bigint, question string"), index, 1).collect()
    assert index.documents == 403
    assert {(r.question_id, r.doc_id) for r in got} == {(i, i) for i in range(1, 41, 2)}
    assert "Exchange" not in written["posting-blocks"][0]
    assert max(n for label, (_, n) in written.items() if label in (
        "opened-postings", "found-documents", "question-documents")) < 1000  # of some 8,000 pairs


def test_plans_do_not_grow_with_the_questions(spark, docs):
    def nodes(count):
        rows = [(i, [float(i + 1)] + [1.0] * (DIM - 1)) for i in range(count)]
        asked = spark.createDataFrame(rows, "question_id int, question array<double>")
        plan = retrieval.question_doc_topk(asked, docs, 2)._jdf.queryExecution().executedPlan().toString()
        texts = spark.createDataFrame([(i, f"w{i}") for i in range(count)], "question_id int, question string")
        texts = retrieval.text_topk(texts, docs.select("doc_id", F.concat(F.lit("w"), "doc_id").alias("text")), 2)
        words = texts._jdf.queryExecution().executedPlan().toString()
        return [(p.count("MapInArrow"), p.count("Scan")) for p in (plan, words)]

    assert nodes(3) == nodes(2000)


def test_vectors_that_cannot_be_compared_take_no_part(spark):
    rows = [(1, [0.0, None]), (2, [float("nan"), 1.0]), (3, None), (4, []), (5, [float("inf"), 1.0]),
            (6, [-1.0, 0.0]), (7, [1.0, 0.1]), (8, [1.0, 0.0, 0.0]), (9, [0.0, 0.0])]
    docs = spark.createDataFrame(rows, "doc_id smallint, embedding array<double>")
    got = retrieval.similarity_topk(docs, [1.0, 0.0], 5).orderBy("rank").collect()
    assert [r.doc_id for r in got] == [7, 9, 6] and got[2].score == -1.0
    rough = retrieval.similarity_topk_lsh(retrieval.lsh_table(docs), [1.0, 0.0], 3).collect()
    assert {r.doc_id for r in rough} == {6, 7, 9}
    asked = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, None), (4, [float("nan")])],
                                  "question_id smallint, question array<double>")
    found = retrieval.question_doc_topk(asked, docs, 5).orderBy("question_id", "rank").collect()
    assert [(r.question_id, r.doc_id) for r in found] == [(1, 7), (1, 9), (1, 6), (2, 8)]


def test_benchmark_passages_are_found(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    items = spark.read.parquet(f"{tiny}/benchmark.parquet")
    # The passage counts as held if its first 60 characters occur in the document.
    top = retrieval.text_topk(
        items.withColumnsRenamed({"item_id": "question_id", "text": "question"}), docs, 3)
    named = items.select("item_id", F.substring("text", 1, 60).alias("head"))
    held = (
        top.join(docs.select("doc_id", "text"), "doc_id")
        .join(named, F.col("question_id") == F.col("item_id"))
        .filter(F.col("text").contains(F.col("head")))
    )
    planted = docs.select("text").collect()
    wanted = [r for r in named.collect() if any(r.head in d.text for d in planted)]
    assert held.select("question_id").distinct().count() >= 0.8 * len(wanted)


def test_entity_match(spark):
    known = spark.createDataFrame([("Texas",), ("Ohio",), ("Iowa",), ("New York",)], "name string")
    typed = [("  TEXAS ", "Texas", 0), ("Texs", "Texas", 1), ("Txeas", "Texas", 2),
             ("Ohia", "Ohio", 1), ("Iowo", "Iowa", 1), ("New  Yrk", "New York", 2),
             ("Utah", None, None), ("", None, None)]
    df = spark.createDataFrame([(t,) for t, _, _ in typed], "t string")
    got = {r.t: (r.matched, r.edits) for r in entity_match(df, "t", known, "name").collect()}
    assert got == {t: (m, e) for t, m, e in typed}


def test_approx_entities(spark):
    fact = spark.range(50000).select(
        F.col("id").alias("disaster_id"), (F.col("id") % 3 > 0).cast("string").alias("state"))
    got = {r.state: r.disasters for r in approx_entities(fact, ["state"]).collect()}
    assert abs(got["true"] - 33333) < 0.08 * 33333


def test_snapshot_diff_and_index(spark, tmp_path):
    schema = "doc_id bigint, text string"
    old = spark.createDataFrame([(1, "a b"), (2, "c"), (3, None)], schema)
    new = spark.createDataFrame([(1, "a b"), (2, "c d"), (3, "e"), (4, "f")], schema)
    diff = {r.doc_id: r.change
            for r in snapshots.snapshot_diff(old, new, "doc_id", "text").collect()}
    assert diff == {2: "updated", 3: "updated", 4: "inserted"}
    back = {r.doc_id: r.change
            for r in snapshots.snapshot_diff(new, old, "doc_id", "text").collect()}
    assert back == {2: "updated", 3: "updated", 4: "deleted"}

    path, changes = str(tmp_path / "index"), str(tmp_path / "changes")
    empty = spark.createDataFrame([], schema)
    for before, after in ((empty, old), (old, new), (new, old)):
        rows = snapshots.changed_documents(before, after, "doc_id", "text")
        rows.write.mode("append").parquet(changes)
        incremental_index(spark.readStream.schema(rows.schema).parquet(changes), path
                          ).awaitTermination()
        index = {r.doc_id: len(r.terms or [])
                 for r in snapshots.read_index(spark, f"{path}/entries", "doc_id").collect()}
        want = {r.doc_id: len((r.text or "").split()) for r in after.collect()}
        assert index == want


def test_changes_of_one_document_in_a_batch(spark, tmp_path):
    kind = "doc_id bigint, change string, text string, at bigint"
    rows = [(1, "inserted", "a b", 1), (1, "deleted", None, 2),
            (2, "deleted", None, 1), (2, "inserted", "c", 2), (3, "updated", "x y z", 5)]
    for n, order in enumerate((rows, rows[::-1])):
        path = str(tmp_path / f"index{n}")
        batch = spark.createDataFrame(order, kind)
        snapshots.write_index_batch(batch, path, 0, "doc_id", "text", sequence="at")
        got = {r.doc_id: len(r.terms) for r in snapshots.read_index(spark, path, "doc_id").collect()}
        assert got == {2: 1, 3: 3}


def test_long_texts_are_not_shortened(spark):
    known = spark.createDataFrame([("Texas",), ("Ohio",)], "name string")
    df = spark.createDataFrame([("x" * 20_000,), ("Texs",), (None,)], "t string")
    got = {r.matched for r in entity_match(df, "t", known, "name").collect()}
    assert got == {None, "Texas"}


@pytest.mark.parametrize("postings,leading,sent,weights", [
    (1024, 8, 10**6, 10**6), (4, 1, 10**6, 20), (4, 1, 0, 0)])
def test_one_search_writes_words_and_counts_only(spark, monkeypatch, postings, leading, sent, weights):
    """Questions' words and documents' weights are sent, or joined where they are too many, with the same answers."""
    written, keys, whole, whole_keys = {}, [], retrieval.settle, retrieval.settle_keys

    def settle(df, label):
        written[label] = df._jdf.queryExecution().executedPlan().toString()
        return whole(df, label)

    monkeypatch.setattr(retrieval, "settle", settle)
    monkeypatch.setattr(retrieval, "settle_keys", lambda df, label: (keys.append(label), whole_keys(df, label))[1])
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join([*rng.choices(vocabulary, k=rng.randrange(1, 40)), f"own{i}"])) for i in range(120)]
    docs += [(200 + i, docs[3][1]) for i in range(60)] + [(400 + i, "") for i in range(20)]
    questions = [(i, " ".join([*rng.choices(vocabulary + ["unseen"], k=4), f"own{7 * i}"])) for i in range(6)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    index = retrieval.text_index(frame, sent=weights, kept=False)
    got = retrieval.search_index(
        spark.createDataFrame(questions, "question_id bigint, question string"), index, 4,
        leading=leading, sent=sent, postings=postings).collect()
    want = brute_text(docs, questions, 4)
    for q, _ in questions:
        assert [r.doc_id for r in sorted(got, key=lambda r: r["rank"]) if r.question_id == q] == want[q]
    assert keys == ["word-counts"]
    assert ("word-vectors" in written) == (weights < 100)
    assert ("posting-blocks" in written) == (sent == 0)
    if sent:
        assert "Exchange" not in written["found-documents"]


def test_only_documents_with_several_entries_are_shuffled(spark, tmp_path, monkeypatch):
    """The same state, whether keys are sent or everything is grouped; null and repeated keys have one entry."""
    kind = "doc_id bigint, change string, text string, n int"
    first = [(i, "inserted", f"a b w{i}", 0) for i in range(50)] + [(None, "inserted", "x", 0), (None, "inserted", "x", 0)]
    second = [(1, "deleted", None, 0), (2, "updated", "c", 0), (2, "updated", "c d e", 1), (60, "inserted", "z", 0)]
    for n, rows in enumerate((first, second)):
        snapshots.write_index_batch(
            spark.createDataFrame(rows, kind), str(tmp_path / "entries"), n, "doc_id", "text", "n")
    repeated, whole = [], snapshots.settle
    monkeypatch.setattr(snapshots, "settle", lambda df, label: (repeated.append(whole(df, label)), repeated[-1])[1])
    states = []
    for most in (1 << 20, 0):
        monkeypatch.setattr(snapshots, "SENT_KEYS", most)
        index = snapshots.read_index(spark, str(tmp_path / "entries"), "doc_id")
        states.append({r.doc_id: len(r.terms) for r in index.collect()})
        assert ("LeftAnti" in index._jdf.queryExecution().optimizedPlan().toString()) == (most > 0)
    want = {i: 3 for i in range(50) if i not in (1, 2)} | {2: 3, 60: 1, None: 1}
    assert states == [want, want]
    assert sorted(str(r._key) for r in repeated[0].collect()) == ["1", "2", "None"]


def test_only_changed_texts_move(spark, monkeypatch):
    """Deleted, null and repeated keys as a left join of the diff gives them."""
    kind = "doc_id bigint, text string"
    old = spark.createDataFrame([(i, f"t{i}") for i in range(20)] + [(None, "n"), (30, "a"), (30, "a")], kind)
    new = spark.createDataFrame([(i, f"t{i}" if i % 5 else f"u{i}") for i in range(2, 20)]
                                + [(40, "new"), (41, None), (None, "m"), (30, "b")], kind)
    want = snapshots.snapshot_diff(old, new, "doc_id", "text").join(new, "doc_id", "left")
    for most in (1 << 20, 0):
        monkeypatch.setattr(snapshots, "SENT_KEYS", most)
        got = snapshots.changed_documents(old, new, "doc_id", "text")
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert {r.change for r in want.collect()} == {"inserted", "updated", "deleted"}
