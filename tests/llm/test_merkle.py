"""The Merkle manifest against a plain tree, its proofs, and odd rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tallyspan.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
ODD = [
    (3, "a\nb", "en", "s1", 3), (1, None, "en", "s1", None), (2, "", None, "s1", 0),
    (4, "naïve\n名前", "fr", None, 8), (None, "no id", "en", None, 5), (5, "x", "en", "Z", 1),
    (6, "same", "en", "z", 4), (6, "same", "en", "z", 4), (6, "other\n", "en", "z", 6),
    (None, None, None, None, None), (7, "long " * 30_000, "de", "é", 150_000),
    *[(100 + k, f"row {k}\n", "en", "many", k) for k in range(400)],
]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}"
               for v in (doc_id, source, lang, n_chars, text)])


def tree(leaves):
    nodes, at = list(leaves), list(range(len(leaves)))
    paths = [[] for _ in leaves]
    while len(nodes) > 1:
        for path, i in zip(paths, at):
            start = i - i % 3
            path.append(("".join(nodes[start:i]), "".join(nodes[i + 1 : start + 3])))
        nodes = [h(*nodes[k : k + 3]) for k in range(0, len(nodes), 3)]
        at = [i // 3 for i in at]
    return nodes[0], paths


def tampered(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    lower = {}
    for source in order:
        own = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        lower[source] = (own, *tree([leaf(r, r[1]) for r in own]))
    root, upper = tree([lower[s][1] for s in order])
    found = []
    for source, over in zip(order, upper):
        own, subroot, paths = lower[source]
        for row, path in zip(own, paths):
            text = row[1].replace("\n", "") if tampered(row[0]) and row[1] else row[1]
            folded = leaf(row, text)
            for left, right in path + over:
                folded = h(left, folded, right)
            proof = h(*[left + right for left, right in path + over])
            found.append((row[0], leaf(row, row[1]), subroot, root, proof, folded, folded == root))
    return sorted(found, key=repr)


def even():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))


def results(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("levels", [2, 8])
def test_rows_follow_the_plain_tree(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3**levels)
    docs = spark.createDataFrame(ODD, SCHEMA).repartition(5)
    assert results(merkle.verified(docs, even())) == plain(ODD)


@pytest.mark.parametrize("count", [1, 3, 10, 28])
def test_small_sources(spark, monkeypatch, count):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    rows = [(k, f"t\n{k}", "en", "only", k) for k in range(count)]
    assert results(merkle.verified(spark.createDataFrame(rows, SCHEMA), even())) == plain(rows)


def test_many_sources_need_storeys_too(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    rows = [(k, "t", "en", f"s{k % 100}", k) for k in range(230)]
    assert results(merkle.verified(spark.createDataFrame(rows, SCHEMA), even())) == plain(rows)


def test_only_changed_rows_fail(spark):
    rows = {r["doc_id"]: r for r in merkle.verified(spark.createDataFrame(ODD, SCHEMA), even()).collect()}
    for doc_id, text, *_ in ODD:
        if doc_id not in (6, None):
            assert rows[doc_id]["verified"] == (not (tampered(doc_id) and text and "\n" in text))


def test_proof_of_a_row_folds_to_the_root_outside_spark(spark):
    for row in merkle.manifest(spark.createDataFrame(ODD, SCHEMA)).filter("source = 'many'").collect():
        done = row["leaf"]
        for step in row["path"]:
            done = h(step["left"].hex(), done, step["right"].hex())
        assert done == row["root"]


def test_empty_table(spark):
    assert merkle.verified(spark.createDataFrame([], SCHEMA), even()).collect() == []


def test_other_columns_play_no_part(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    more = docs.withColumns({c: F.lit("x") for c in (
        "leaf", "given", "tree", "n", "idx", "item", "path", "root", "block", "position", "digest", "l0")})
    assert results(merkle.verified(more, even())) == plain(ODD)
