"""Learned operators, neighbours, licences and the pipeline: accuracy, plain versions, odd cases."""

import itertools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyspan.llm import ann, chat, langid, licenses, simhash, toxicity, wordscores
from tallyspan.llm.queries import QUERIES, transcripts
from tallyspan.llm.tables import remainder
from tallyspan.storage import settle

SMALL = "/root/testdata/sf0.01"


def rest(value, divisor):
    return zlib.crc32(str(value).encode()) % divisor


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def labelled(spark):
    """Texts of invented words; toxic ones hold one of a few marked expressions."""
    random = np.random.default_rng(1)
    words = ["".join(random.choice(list("aeioubdklmnrst"), size=5)) for _ in range(600)]
    rows, labels = [], []
    for k in range(700):
        text = list(random.choice(words, size=int(random.integers(20, 60))))
        toxic = int(k % 5 == 0)
        if toxic:
            text.insert(3, str(random.choice(["vileword", "badterm", "nastyone"])))
        rows.append((k, " ".join(text), None))
        labels.append((k, toxic))
    rows += [(800, None, None), (801, "", None), (None, "badterm", None), (7, rows[7][1], None)]
    labels += [(5, None), (None, 1), (9999, 1), (1, 0)]
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4),
            spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels[:700]))


class TestToxicity:
    def test_held_out_texts(self, labelled):
        docs, labels, truth = labelled
        rows = toxicity.predictions(docs, labels).collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
        assert len(held) > 100 and all(rest(r["doc_id"], 4) == 2 for r in held)
        assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
        assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)
        empty = {r["score"] for r in rows if r["doc_id"] in (800, 801)}
        assert len(empty) == 1

    def test_copies_of_rows_and_other_texts_of_an_id_move_no_score(self, labelled, spark):
        docs, labels, _ = labelled
        once = {(r["doc_id"], round(r["score"], 9)) for r in toxicity.score(
            docs, labels, toxicity._folds()).collect()}
        more = docs.union(docs).union(docs.filter("doc_id < 50"))
        again = toxicity.score(more, labels, toxicity._folds()).collect()
        assert {(r["doc_id"], round(r["score"], 9)) for r in again} == once
        assert len(again) == more.count()
        # Of the rows of an id all texts are learned from, each as often as its distinct text is there.
        learned = toxicity.learned_rows(docs.select("doc_id", "text"), labels, toxicity._folds())
        rows = toxicity._labelled_texts(more.select("doc_id", "text"), toxicity.learned_rows(
            more.select("doc_id", "text"), labels, toxicity._folds()))
        assert rows.count() == learned.count() == learned.select("t", "u").distinct().count()

    def test_held_out_labels_do_not_matter(self, labelled):
        docs, labels, _ = labelled
        turned = labels.withColumn(
            "toxic", F.when(remainder("doc_id", 4) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
        scores = [{(r["doc_id"], round(r["score"], 9)) for r in toxicity.predictions(docs, x).collect()}
                  for x in (labels, turned)]
        assert scores[0] == scores[1]

    def test_ratios(self, spark):
        counts = spark.createDataFrame(
            [(1, 1, 4), (1, 2, 1), (0, 2, 3), (0, 3, 2)], "group int, hash long, n long")
        table, other = toxicity.ratios(counts)
        got = {r["hash"]: r["ratio"] for r in table.collect()}
        shared = {1: 4 / 10, 2: 4 / 10, 3: 2 / 10}
        for h, (t, p) in {1: (4, 0), 2: (1, 3), 3: (0, 2)}.items():
            toxic = max(t - 0.75, 0) / 5 + 0.75 * 2 / 5 * shared[h]
            plain = max(p - 0.75, 0) / 5 + 0.75 * 2 / 5 * shared[h]
            assert got[h] == pytest.approx(math.log(toxic / plain))
        assert other == pytest.approx(0.0)

    def test_one_class_or_nothing(self, labelled, nothing):
        docs, labels, _ = labelled
        few = labels.filter("toxic = 0")
        assert toxicity.predictions(docs, few).filter("predicted = 1").count() == 0
        assert toxicity.predictions(nothing, labels).count() == 0
        assert toxicity.predictions(docs, labels.limit(0)).count() == docs.count()

    def test_only_toxic_rows_go(self, labelled):
        docs, labels, _ = labelled
        wide = docs.withColumn("_gone", F.lit(1)).withColumn("score", F.lit("s"))
        kept = toxicity.ordinary(wide, labels)
        assert kept.columns == wide.columns
        flagged = toxicity.predictions(docs, labels).filter("predicted = 1 and doc_id is not null")
        assert kept.count() == docs.count() - flagged.count()
        assert kept.filter("doc_id is null").count() == 1

    def test_rows_go_by_their_own_texts(self, spark, labelled):
        docs, labels, truth = labelled
        clean = next(r["text"] for r in docs.collect() if r["doc_id"] == 1)
        more = spark.createDataFrame(
            [(2000, "vileword badterm nastyone", None), (2000, clean, None)], docs.schema)
        both = docs.union(more).union(spark.createDataFrame([(None, clean, None)], docs.schema))
        kept = toxicity.ordinary(both, labels, unnamed=True)
        assert [r["text"] for r in kept.filter("doc_id = 2000").collect()] == [clean]
        assert [r["text"] for r in kept.filter("doc_id is null").collect()] == [clean]
        kept = toxicity.ordinary(both, labels)
        assert [r["text"] for r in kept.filter("doc_id = 2000").collect()] == [clean]
        assert kept.filter("doc_id is null").count() == 2


def test_word_scores_join_like_sent_ones(spark):
    docs = spark.createDataFrame(
        [(1, "a b a c"), (2, ""), (3, None), (1, "a b a c"), (4, "Z É é 12 z")], "doc_id long, text string")
    counts = wordscores.word_counts(docs, F.lit(0))
    words = {r["word"]: r["n"] for r in counts.collect()}
    assert words == {"a": 4, "b": 2, "c": 2, "z": 2, "é": 2}
    table = counts.filter("word != 'c'").select(
        "hash", F.array(F.col("n").cast("double"), F.lit(1.0)).alias("values"))
    got = [
        sorted((r["doc_id"], r["words"], tuple(r["sums"])) for r in wordscores.sum_scores(
            docs, table, [0.5, 0.0], ["doc_id"], sent_bytes=most).collect())
        for most in (1 << 20, 0)
    ]
    assert got[0] == got[1]
    assert got[0][0] == (1, 4, (10.5, 3.0)) and got[0][2] == (2, 0, (0.0, 0.0))


class TestLanguages:
    def test_held_out_documents(self, spark):
        docs = spark.read.parquet(f"{SMALL}/documents.parquet")
        rows = QUERIES["op3_language_id"](spark, SMALL).collect()
        truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
        held = [r for r in rows if r["held_out"]]
        assert all(rest(r["doc_id"], 3) == 1 for r in held)
        assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)

    def test_unseen_words_fall_back(self, spark):
        rows = [(k, t, lang) for k, (t, lang) in enumerate(
            [("zaku zaki zakemo", "xx"), ("lorin lorat lorum", "yy")] * 6)]
        rows += [(100, "zakiru", "yy"), (101, "lorit", None), (102, "12 . !", "xx"), (103, None, "xx"),
                 (104, "", None), (105, "ок", None), (106, "。、", None), (None, "zaku", "yy")]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        for sent in (1 << 20, 0):
            got = {r["doc_id"]: r for r in langid.identify(
                docs, F.col("doc_id") < 100, sent_bytes=sent).collect()}
            assert got[100]["lang_pred"] == "xx" and got[101]["lang_pred"] == "yy"
            assert all(got[k]["lang_pred"] == "und" for k in (102, 103, 104, 106))
            assert got[105]["lang_pred"] in ("xx", "yy")
            assert all(0 <= r["score"] <= 1 for r in got.values()) and len(got) == len(rows)

    def test_nothing_learned(self, spark, nothing):
        assert langid.predictions(nothing).count() == 0
        docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
        assert [r["lang_pred"] for r in langid.predictions(docs).collect()] == ["und"]


class TestChat:
    MESSAGES = [
        ("a", 0, "system", "System: be short"), ("a", 1, "user", "User: what is it?"),
        ("a", 2, "assistant", "it is this\nand that"), ("a", 3, "user", "and why?"),
        ("a", 4, "assistant", "Assistant: because"), ("a", 4, "assistant", "Assistant: because"),
        ("b", None, "user", "### User: hello"), ("b", 1, "assistant", None), ("b", 2, None, "fine"),
        (None, 0, "user", "Human: no name"), ("c", 0, "user", ""),
    ] + [("long", k, "user" if k % 2 == 0 else "assistant",
          ("User: " if k % 2 == 0 else "Bot: ") * (k % 3 > 0) + f"line {k}" + "\nmore" * (k % 4)
          + "?" * (k % 2 == 0)) for k in range(70)]

    @pytest.fixture
    def messages(self, spark):
        return spark.createDataFrame(
            self.MESSAGES, "conv_id string, turn long, role string, text string").repartition(4)

    def test_blocks_give_one_best_path(self, messages):
        rows = chat.numbered(messages)
        model = chat.learn(rows)
        by = {}
        for r in rows.orderBy("position").collect():
            if r["text"] is not None:
                by.setdefault(r["conv_id"], []).extend(s for _, s in chat.lines_of(r["text"]))
        for block in (1024, 5, 2):  # 2: several levels of blocks
            got = {}
            for r in chat.parse(rows, model, block).orderBy("position").collect():
                got[r["conv_id"]] = got.get(r["conv_id"], "") + r["states"]
            for conv, seen in by.items():
                names = [c for role in chat.ROLES for c in (role[0].upper(), role[0])]
                best = model.path(seen, chat.START, None)
                mine = [names.index(c) for c in got[conv]]

                def worth(path):
                    steps = zip([chat.START, *path], path, seen)
                    return sum(model.moves[a, b] + model.emit(s)[b] for a, b, s in steps)

                assert worth(mine) == pytest.approx(worth(best))

    def test_path_is_the_best_of_all(self, messages):
        model = chat.learn(chat.numbered(messages))
        seen = [s for _, s in chat.lines_of("User: hi\nhow?\nBot: x\n\ny")][:4]
        every = itertools.product(range(chat.STATES), repeat=len(seen))

        def worth(path):
            return sum(model.moves[a, b] + model.emit(s)[b]
                       for a, b, s in zip([chat.START, *path], path, seen))

        assert worth(model.path(seen, chat.START, None)) == pytest.approx(max(map(worth, every)))

    def test_rendering(self, messages):
        rows = chat.numbered(messages)
        out = chat.parse(rows, chat.learn(rows)).orderBy("position").collect()
        text = "".join(r["rendered"] for r in out if r["conv_id"] == "a")
        assert text == (
            "<|im_start|>system\nbe short\n<|im_end|>\n<|im_start|>user\nwhat is it?\n<|im_end|>\n"
            "<|im_start|>assistant\nit is this\nand that\n<|im_end|>\n"
            "<|im_start|>user\nand why?\n<|im_end|>\n<|im_start|>assistant\nbecause\n<|im_end|>\n")
        assert len(out) == len(self.MESSAGES) - 1  # the repeated message counts once
        whole = "".join(r["rendered"] for r in out if r["conv_id"] == "b")
        assert whole.startswith("<|im_start|>user\nhello\n") and whole.endswith("<|im_end|>\n")

    def test_held_out_conversations(self, spark):
        truth = {(r["conv_id"], r["turn"]): r["role"][0].upper()
                 for r in transcripts(spark, SMALL).collect()}
        rows = [r for r in QUERIES["op4_chat_formatting"](spark, SMALL).collect()
                if rest(r["conv_id"], 3) == 1]
        good = sum(r["states"][:1] == truth[r["conv_id"], r["turn"]] for r in rows)
        assert len(rows) > 100 and good >= 0.95 * len(rows)

    def test_empty(self, spark):
        none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
        assert chat.transcripts_to_turns(none, F.lit(True)).count() == 0


class TestNeighbours:
    @staticmethod
    def plain(rows, every, count=5):
        good = {}
        for name, vector in rows:
            if name is None or not vector or any(x is None or not math.isfinite(x) for x in vector):
                continue
            if any(vector) and len(vector) == 16:
                v = np.array(vector, dtype=np.float64)
                v = v / np.abs(v).max()
                good[name] = v / np.linalg.norm(v)
        found = {}
        for q in good:
            if q % every == 0:
                best = sorted((-round(float(good[q] @ v), 12), n) for n, v in good.items() if n != q)
                found[q] = [(n, -s) for s, n in best[:count]]
        return found

    def test_against_brute_force(self, spark):
        random = np.random.default_rng(2)
        centres = random.normal(size=(12, 16))
        rows = [(k, [float(np.float32(x)) for x in centres[k % 12] + 0.3 * random.normal(size=16)])
                for k in range(400)]
        hot = rows[40][1]
        rows += [(500 + k, hot) for k in range(200)] + [(3, rows[3][1])]
        rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [1.0] * 15 + [float("nan")]),
                 (904, [None] * 16), (None, hot), (905, [1.0, 2.0]), (906, [float("inf")] * 16),
                 (910, [1e200 * x for x in hot])]
        vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn(
            "score", F.lit(1)).repartition(5)
        want = self.plain(rows, 10)
        for part in (ann.PART, 20):
            got = {}
            for r in ann.neighbours(vectors, F.col("vec_id") % 10 == 0, part=part).collect():
                got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
            assert got.keys() == want.keys()
            hit = total = 0
            for q, found in got.items():
                found.sort()
                assert [f[0] for f in found] == list(range(1, 6)) and q not in [f[1] for f in found]
                assert [f[2] for f in found] == sorted((f[2] for f in found), reverse=True)
                hit += len({f[1] for f in found} & {n for n, _ in want[q]})
                total += 5
            assert hit >= 0.9 * total
            # All of a class tie, so these are its smallest ids.
            assert [f[1] for f in got[540]] == [40, 500, 501, 502, 503]
            assert [f[1] for f in got[500]] == [40, 501, 502, 503, 504]

    def test_recall_on_the_given_vectors(self, spark):
        rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
        units = np.array([r["embedding"] for r in rows], dtype=np.float64)
        units /= np.linalg.norm(units, axis=1, keepdims=True)
        place = {r["vec_id"]: k for k, r in enumerate(rows)}
        got = ann.neighbours(spark.read.parquet(f"{SMALL}/embeddings.parquet"),
                             F.col("vec_id") % 10 == 0).collect()
        hit = 0
        for r in got:
            near = units @ units[place[r["query_id"]]]
            assert r["score"] == pytest.approx(near[place[r["vec_id"]]], abs=1e-12)
            near[place[r["query_id"]]] = -2
            hit += r["score"] >= np.sort(near)[-5] - 1e-12
        assert len(got) == 5 * len({r["query_id"] for r in got}) and hit >= 0.9 * len(got)

    def test_isolated_queries_find_five(self, spark):
        random = np.random.default_rng(12)
        centres = random.normal(size=(3, 64))
        rows = [(k, (centres[k % 3] + 0.01 * random.normal(size=64)).tolist()) for k in range(400)]
        rows += [(1000 + k, random.normal(size=64).tolist()) for k in range(6)]
        vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = ann.neighbours(vectors, F.col("vec_id") % 4 <= 1).groupBy("query_id").count().collect()
        assert len(got) == sum(k % 4 <= 1 for k, _ in rows)
        assert {r["count"] for r in got} == {5}

    def test_each_length_is_searched(self, spark):
        random = np.random.default_rng(4)
        rows = [(k, random.normal(size=8).tolist()) for k in range(120)]
        rows += [(1000 + k, random.normal(size=4).tolist()) for k in range(60)] + [(2000, [1.0])]
        vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = ann.neighbours(vectors, F.col("vec_id") % 50 == 0).collect()
        lists = {}
        for r in got:
            lists.setdefault(r["query_id"], []).append(r["vec_id"])
        assert lists.keys() == {0, 50, 100, 1000, 1050}
        for q, found in lists.items():
            assert len(found) == 5 and all((q < 1000) == (n < 1000) for n in found)

    def test_two_hashes_a_table(self, spark):
        random = np.random.default_rng(6)
        centres = random.normal(size=(12, 16))
        rows = [(k, (centres[k % 12] + 0.3 * random.normal(size=16)).tolist()) for k in range(400)]
        vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        want = self.plain(rows, 10)
        got = ann.neighbours(vectors, F.col("vec_id") % 10 == 0, hashes=2).collect()
        assert len(got) == 5 * len(want)
        hit = sum(r["vec_id"] in {n for n, _ in want[r["query_id"]]} for r in got)
        assert hit >= 0.9 * len(got)

    @pytest.mark.parametrize("hashes", [1, 2])
    def test_probes_are_the_nearest_buckets(self, hashes):
        random = np.random.default_rng(9)
        index = ann.Index(6, hashes)
        asked, units = (ann._units(random.normal(size=(20, 6))) for _ in range(2))
        total = np.zeros((20, 1))
        for k in range(hashes):
            side = index._rotated(asked, 1, k)
            total = (total[:, :, None] + side[:, None, :]).reshape(20, -1)
        for count in (1, 3, 40, index.buckets):
            found = index.probes(asked, 1, count)
            best = -np.sort(-total, axis=1)[:, :count]
            assert np.allclose(np.take_along_axis(total, found, axis=1), best)
            assert all(len(set(row)) == len(row) for row in found.tolist())
        mine = total[np.arange(20), index.bucket(units, 1)]
        assert (index.ranks(asked, units, 1) == (total > mine[:, None] + 1e-12).sum(axis=1) + 1).all()

    def test_few_vectors(self, spark):
        none = spark.createDataFrame([], "vec_id long, embedding array<float>")
        assert ann.neighbours(none, F.lit(True)).count() == 0
        two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>")
        got = {(r[0], r[1], r[2]) for r in ann.neighbours(two, F.lit(True)).collect()}
        assert got == {(0, 1, 1), (1, 1, 0)}


class TestLicenses:
    def test_headers_files_and_directories(self, spark):
        rows = [
            (1, "a/LICENSE", "MIT License\nReleased under the MIT License.\nmore words"),
            (2, "a/b/c/x.py", "nothing"), (3, "a/b/c/COPYING", "Licensed under CC BY 4.0."),
            (4, "a/b/c/d/y.py", "no licence words"), (5, "a/b/z.py", None), (6, "q/y.py", "text"),
            (7, "a/b/c/own.py", "# Licensed under the Apache License, Version 2.0\ncode"),
            (7, "a/b/c/own.py", "# Licensed under the Apache License, Version 2.0\ncode"),
            (8, None, "All rights reserved."), (9, None, None), (10, "top.py", ""),
            (11, "a/license.md", "the public should license this under some version of it"),
            (12, "a/b/LICENSE.txt", "no such thing " * 2000),
        ]
        files = spark.createDataFrame(rows, "file_id long, path string, text string").withColumn(
            "key", F.lit(1))
        got = {r["file_id"]: (r["license"], r["origin"], r["from_dir"])
               for r in licenses.scan(files).collect()}
        assert licenses.scan(files).count() == len(rows)
        assert got[1] == ("MIT", "text", None) and got[3] == ("CC-BY-4.0", "text", None)
        assert got[2] == ("CC-BY-4.0", "directory", "a/b/c") == got[4]
        assert got[5] == ("MIT", "directory", "a") == got[11] == got[12]
        assert got[7] == ("Apache-2.0", "text", None) and got[8] == ("Proprietary", "text", None)
        assert got[6] == got[9] == got[10] == (None, None, None)

    def test_filter_loses_nothing(self):
        counted = licenses._template_counts(licenses.TEMPLATES)
        random = np.random.default_rng(4)
        words = sorted({t for _, _, c in counted for t in c})
        weight = {t: float(random.uniform(1, 12)) for t in words}
        telling = licenses._telling_terms(counted, weight, 0.6)
        for _ in range(3000):
            line = set(random.choice(words, size=int(random.integers(1, 12))))
            norm = math.sqrt(sum(weight[t] ** 2 for t in line))
            for _, _, c in counted:
                size = math.sqrt(sum((n * weight[t]) ** 2 for t, n in c.items()))
                dot = sum(weight[t] * c[t] * weight[t] for t in line if t in c)
                assert dot / norm / size < 0.6 or line & telling

    def test_empty(self, spark):
        none = spark.createDataFrame([], "file_id long, path string, text string")
        assert licenses.scan(none).count() == 0


def test_one_row_of_each_group_of_near_copies(spark):
    random = np.random.default_rng(8)
    words = ["".join(random.choice(list("aeioubdklmnrst"), size=6)) for _ in range(3000)]
    a, b, c, d = (" ".join(random.choice(words, size=300)) for _ in range(4))
    rows = [(None, a, "1"), (None, a, "2"), (None, a, "3"), (7, b, "4"), (7, c, "5"), (9, c, "6"),
            (8, b, "7"), (5, d, "8"), (5, d, "9"), (None, d, "10")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, t string").repartition(3)
    kept = simhash.first_of_each(docs, unnamed=True)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(None, a), (7, b), (7, c), (5, d)], key=str)
    assert simhash.first_of_each(docs).filter("doc_id is null").count() == 4


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "simhash_near_dedup", "benchmark_decontamination",
                            "personal_data", "best_fit_packing"]
    odd = spark.createDataFrame(
        [(10**6, None, None, None, None), (10**6 + 1, "", "en", "s", 0), (None, "x y", "en", "s", 3)],
        docs.schema)
    left = docs.union(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, left, SMALL)
        assert kept.columns == docs.columns and 0 < kept.count() <= left.count()
        if name == "simhash_near_dedup":
            prints = simhash.near_duplicates(left)
            firsts = prints.filter("doc_id = component_id or doc_id is null").count()
            assert kept.count() == firsts
        left = settle(kept, name)
    packed = corpus_pipeline.packed(spark, left, SMALL)
    assert packed.select("doc_id").distinct().count() == left.select("doc_id").distinct().count()
