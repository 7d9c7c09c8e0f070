"""Operators on documents against plain versions of the same definitions, and their odd cases."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyspan.llm import decontaminate, packing, pii, simhash, substrings
from tallyspan.llm.bytewords import LOWER_WORD, NOT_SPACE, find_words, slices, span_hashes
from tallyspan.llm.queries import QUERIES, tokenizer_path

pa = pytest.importorskip("pyarrow")

LONG = " ".join(f"w{k % 977}x{k % 31}" for k in range(30_000))
ODD = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"),
    (2, "alpha BETA  gamma\tdelta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"),
    (2, "alpha BETA  gamma\tdelta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"),
    (3, None), (4, ""), (5, " \n\t "), (None, "no id here"), (None, None),
    (6, "naïve café — x y 12 名前 テキスト"), (7, LONG), (8, LONG + " tail"), (9, "one two three"),
    (10, "x " * 400), (11, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"),
]


@pytest.fixture(scope="module")
def docs(spark, tiny):
    rows = [(r["doc_id"] + 100, r["text"]) for r in
            spark.read.parquet(f"{tiny}/documents.parquet").limit(120).collect()]
    schema = "doc_id long, text string"
    data = ODD + rows
    frame = spark.createDataFrame(data, schema).repartition(5)
    return frame.selectExpr(
        "doc_id", "text", "1 as fp", "'x' as places", "2 as _gone", "3 as spans", "4 as _place", "5 as hash"
    ), data


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_words_of_bytes():
    texts = ["a bc\n d", "", None, "é  名前 x1", "ab", "cd"]
    for table, pattern in ((NOT_SPACE, r"[^\x20\x09-\x0D]+"),
                           (LOWER_WORD, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        found, hashes = [], {}
        for limit in (1, 1 << 20):
            found = []
            for run in slices(pa.array(texts), limit):
                starts, ends, bounds = find_words(run, table)
                for row in range(len(run)):
                    words = [bytes(run.data[starts[k]:ends[k]]).decode()
                             for k in range(bounds[row], bounds[row + 1])]
                    found.append(words)
                for a, b, h in zip(starts, ends, span_hashes(run.data, starts, ends)):
                    assert hashes.setdefault(bytes(run.data[a:b]), h) == h
            assert found == [re.findall(pattern, t or "") for t in texts]
        assert len(set(hashes.values())) == len(hashes)


class TestPacking:
    def test_ids_equal_the_tokenizer(self):
        ids = packing.Ids(tokenizer_path())
        texts = ["a  b\n\n c  d  ", "don't we'LL  'tis", "x　y   z", "日本語 テキスト, 中文。 é× a",
                 "\x1c.\x1d a\x85b", " lead", "", None, "12 34,5 a1b2 _x_ foo_bar 's",
                 "tab\tx \r\n y", "naïve—dash … ÿ'd À.b", "<|endoftext|> x", "ﬁ ² ½ x² y½.  z",
                 "q" * 5000, LONG]
        got = []
        for run in slices(pa.array(texts)):
            tokens, bounds = ids.encode_all(run)
            got += [tokens[bounds[k]:bounds[k + 1]].tolist() for k in range(len(run))]
        want = [ids.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert got == want

    def test_sequences(self, docs):
        frame, data = docs
        rows = packing.pack(frame, tokenizer_path(), capacity=64).collect()
        ids = packing.Ids(tokenizer_path()).tokenizer
        want = []
        for doc, text in data:
            tokens = ids.encode(text or "", add_special_tokens=False).ids + [2]
            first = len(tokens) % 64 or 64
            cuts = [0, *range(first, len(tokens) + 1, 64)]
            for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
                crc = zlib.crc32(np.array(tokens[a:b], dtype="<u4").tobytes())
                want.append((str(doc), n, a, b - a, crc))
        assert sorted((str(r[0]), *r[1:5]) for r in rows) == sorted(want)
        by = {}
        for r in rows:
            by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for parts in by.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 64

    @pytest.mark.parametrize("seed", range(6))
    def test_plan_is_about_best_fit(self, seed):
        random = np.random.default_rng(seed)
        lengths = random.integers(1, 101, size=600) if seed % 2 else random.integers(20, 60, size=500)
        counts = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True))}
        bins = packing.plan_bins(counts, 100)
        placed = {}
        for content, number in bins:
            assert sum(n * c for n, c in content.items()) <= 100
            assert sum(c for n, c in content.items() if 3 * n > 100) <= 2
            for n, c in content.items():
                placed[n] = placed.get(n, 0) + c * number
        assert placed == counts
        gaps = []
        for n in sorted(lengths, reverse=True):
            fit = [g for g in gaps if g >= n]
            if fit:
                gaps.remove(min(fit))
                gaps.append(min(fit) - n)
            else:
                gaps.append(100 - n)
        assert sum(c for _, c in bins) <= 1.03 * len(gaps) + 1

    def test_empty(self, nothing):
        assert packing.pack(nothing, tokenizer_path()).count() == 0


class TestSimHash:
    @staticmethod
    def plain(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
        lines = [" ".join(words[k:k + 4]) for k in range(len(words) - 3)] or (
            [" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in lines]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    @staticmethod
    def roots(prints, radius=4):
        names = list(range(len(prints)))

        def find(x):
            while names[x] != x:
                x = names[x]
            return x

        for i in range(len(prints)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= radius:
                    a, b = find(i), find(j)
                    names[max(a, b)] = min(a, b)
        return [find(k) for k in range(len(prints))]

    def test_against_all_pairs(self, docs):
        frame, data = docs
        prints = [self.plain(t) for _, t in data]
        roots = self.roots(prints)
        first = {}
        for (doc, _), root in zip(data, roots):
            if doc is not None:
                first[root] = min(first.get(root, doc), doc)
        want = [(str(d), f"{p:016x}", str(first.get(r))) for (d, _), p, r in zip(data, prints, roots)]
        got = [(str(r[0]), r[1], str(r[2])) for r in simhash.near_duplicates(frame).collect()]
        assert sorted(got) == sorted(want)

    @pytest.mark.parametrize("tile,count", [(4096, 10), (7, 10), (7, 10**9), (50, 10**14)])
    def test_tiles_and_bands_lose_nothing(self, spark, tile, count):
        random = np.random.default_rng(3)
        prints = []
        for _ in range(25):
            at = int(random.integers(0, 1 << 62))
            for _ in range(int(random.integers(1, 14))):
                prints.append(at)
                for bit in random.integers(0, 64, size=int(random.integers(0, 5))):
                    at ^= 1 << int(bit)
        prints = sorted(set(prints))
        frame = spark.createDataFrame(
            [(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
        from tallyspan.llm.components import components

        links = simhash.links(frame, count, tile=tile)
        found = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in components(links).collect()}
        roots = self.roots(prints)
        got = {}
        for p, root in zip(prints, roots):
            got.setdefault(root, set()).add(found.get(p, p))
        assert all(len(x) == 1 for x in got.values())
        assert len({min(x) for x in got.values()}) == len(got)

    def test_one_of_each_stays(self, docs):
        frame, data = docs
        kept = simhash.first_of_each(frame)
        assert kept.columns == frame.columns
        got = sorted(str(r["doc_id"]) for r in kept.collect())
        rows = simhash.near_duplicates(frame).collect()
        want = sorted(
            {str(r["doc_id"]) for r in rows if r["doc_id"] is not None
             and r["doc_id"] == r["component_id"]}
        ) + ["None"] * sum(r["doc_id"] is None for r in rows)
        assert got == sorted(want)

    def test_empty(self, nothing):
        assert simhash.near_duplicates(nothing).count() == 0
        assert simhash.first_of_each(nothing).count() == 0


class TestDecontaminate:
    ITEMS = [
        (1, "gamma delta epsilon zeta eta theta iota kappa lambda mu nu"),
        (12, "Gamma, delta. EPSILON zeta eta theta iota kappa lambda mu nu"),
        (2, "one two three"), (3, None), (4, "..."), (5, "not in any text at all, I hope so now"),
        (None, "café"), (6, "w5x5 w6x6"),
    ]

    @staticmethod
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))

    def plain(self, text, items):
        words = self.words(text)
        hit, names = [False] * len(words), set()
        for name, item in items:
            tokens = self.words(item)
            size = min(10, len(tokens))
            for j in range(len(tokens) - size + 1 if tokens else 0):
                for k in range(len(words) - size + 1):
                    if words[k:k + size] == tokens[j:j + size]:
                        hit[k:k + size] = [True] * size
                        if name is not None:
                            names.add(str(name))
        line = ",".join(sorted(names))
        return (len(words), sum(hit), len(names), hashlib.sha256(line.encode()).hexdigest(), any(hit))

    @pytest.mark.parametrize("block", [1 << 20, 30])
    def test_against_plain_search(self, spark, docs, block):
        frame, data = docs
        items = spark.createDataFrame(self.ITEMS, "item_id long, text string")
        got = decontaminate.matches(frame, items, block_bytes=block).collect()
        want = [(str(d), *self.plain(t, self.ITEMS)) for d, t in data]
        assert sorted((str(r[0]), *r[1:6]) for r in got) == sorted(want)
        kept = decontaminate.clean(frame, items, block_bytes=block)
        assert kept.columns == frame.columns
        assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
            w[0] for w in want if not w[-1])

    def test_longest_match(self, spark):
        docs = spark.createDataFrame([(1, "x y " + " ".join(f"t{k}" for k in range(40)) + " z")],
                                     "doc_id long, text string")
        items = spark.createDataFrame(
            [(7, "a b c " + " ".join(f"t{k}" for k in range(5, 30))),
             (8, " ".join(f"t{k}" for k in range(12)))], "item_id long, text string")
        row = decontaminate.matches(docs, items).first()
        assert (row["longest"], row["longest_item"], row["item_word"], row["doc_word"]) == (25, "7", 3, 7)
        assert row["n_hit"] == 30 and row["n_items"] == 2

    def test_empty(self, spark, nothing):
        items = spark.createDataFrame([], "item_id long, text string")
        assert decontaminate.matches(nothing, items).count() == 0
        one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
        assert [r["n_hit"] for r in decontaminate.matches(one, items).collect()] == [0]


class TestPersonalData:
    PATTERNS = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    )

    def plain(self, text):
        found = []
        for kind, (name, pattern) in enumerate(self.PATTERNS):
            for m in re.finditer(pattern, text):
                digits = re.sub("[^0-9]", "", m[0])
                luhn = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(digits[::-1]))
                if (name == "ip" and any(int(x) > 255 for x in m[0].split("."))) or (
                    name == "card" and not (12 <= len(digits) <= 19 and luhn % 10 == 0)
                ) or (name == "phone" and not 9 <= len(digits) <= 15):
                    continue
                found.append((m.start(), kind, m.end()))
        return sorted(found)

    def test_base_spans_on_random_texts(self):
        random = np.random.default_rng(5)
        letters = np.array(list("a1@.+- (2)9%_0\né4"))
        for _ in range(20_000):
            text = "".join(random.choice(letters, size=random.integers(0, 30)))
            assert pii.base_spans(text) == self.plain(text), text

    def test_contexts_find_what_formats_miss(self, spark):
        rows = [(k, f"some words mail me: u{k}.x@host{k}.example.org and go on") for k in range(8)]
        rows += [(50, "again mail me: root@localhost and go on"),
                 (51, "but see note root@localhost here"),
                 (52, "mail me: nothing of that shape 12"), (53, None), (54, "")]
        found = {r["doc_id"]: r for r in pii.report(
            spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert found[50]["spans"] == "email:15:29" and found[50]["n_email"] == 0
        assert all(found[k]["n_email"] == 1 for k in range(8))
        # The second round knows the instance, but not its other context.
        assert found[51]["spans"] == "" and found[52]["spans"] == ""
        assert found[53]["spans"] == "" and found[53]["base_sha256"] == hashlib.sha256(b"").hexdigest()

    def test_rounds_go_on_until_nothing_changes(self, spark):
        # Pattern k holds the mentions of level k - 1 and k; seeds stand in pattern 1 only.
        rows = [(1, k, 0, 0) for k in range(40)]
        for level in range(1, 7):
            fresh = range(1000 * level, 1000 * level + 8 // level)
            rows += [(level, k, None, 1) for k in fresh]
            rows += [(level + 1, k, None, 1) for k in fresh]
        edges = spark.createDataFrame(rows, "pattern long, instance long, kind int, shapes int")
        got = {r["pattern"] for r in pii.accepted_patterns(edges, 1, 0.3).collect()}
        early = {r["pattern"] for r in pii.accepted_patterns(edges, 1, 0.3, rounds=3).collect()}
        assert early < got and max(got) > 3

    def test_report_and_redaction(self, spark, docs):
        frame, data = docs
        extra = [(900, "call +1 (555) 123-4567 or 4111 1111 1111 1111, 10.0.0.1"), (901, "é a@b.cd")]
        more = frame.select("doc_id", "text", "spans").union(
            spark.createDataFrame([(*e, 3) for e in extra], "doc_id long, text string, spans int"))
        data = data + extra
        want = []
        for doc, text in data:
            spans = self.plain(text or "")
            line = ",".join(f"{self.PATTERNS[k][0]}:{a}:{b}" for a, k, b in spans)
            want.append((str(doc), *[sum(s[1] == k for s in spans) for k in range(4)],
                         hashlib.sha256(line.encode()).hexdigest()))
        assert sorted((str(r[0]), *r[1:6]) for r in pii.report(more).collect()) == sorted(want)
        clean = pii.redact(more)
        assert clean.columns == more.columns and clean.count() == len(data)
        texts = {r["doc_id"]: r["text"] for r in clean.collect()}
        assert texts[900] == "call <PHONE> or <CARD>, <IP>" and texts[901] == "é <EMAIL>"
        assert texts[3] is None and texts[7] == LONG

    def test_empty(self, nothing):
        assert pii.report(nothing).count() == 0 and pii.redact(nothing).count() == 0


class TestSubstrings:
    @staticmethod
    def plain(data, size):
        first = {}
        for doc, text in data:
            words = spaced(text)
            for k in range(len(words) - size + 1 if doc is not None else 0):
                key = tuple(words[k:k + size])
                first[key] = min(first.get(key, doc), doc)
        found = []
        for doc, text in data:
            words = spaced(text)
            gone = [False] * len(words)
            for k in range(len(words) - size + 1 if doc is not None else 0):
                if first[tuple(words[k:k + size])] < doc:
                    gone[k:k + size] = [True] * size
            kept = " ".join(w for w, g in zip(words, gone) if not g)
            found.append((str(doc), len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
        return sorted(found)

    @pytest.mark.parametrize("size,hot,ids", [(13, 20_000, 10**6), (3, 4, 10**6), (3, 4, 0), (1, 20_000, 0)])
    def test_against_plain_search(self, docs, size, hot, ids):
        frame, data = docs
        got = substrings.remove_repeats(frame, window=size, hot=hot, sent_ids=ids)
        assert sorted((str(r[0]), r[1], r[2], r[4]) for r in got.collect()) == self.plain(data, size)

    def test_packing_of_windows(self):
        random = np.random.default_rng(0)
        for n in (1, 50, 5000):
            doc = random.integers(-5, 60, size=n)
            place = random.integers(0, 100_000, size=n)
            h = random.integers(0, 1 << 63, size=n).astype(np.uint64)
            g = random.integers(0, 1 << 63, size=n).astype(np.uint64)
            for texts in (1, 3):
                variant = random.integers(0, texts, size=n)
                got = substrings._read(substrings._entries(doc, variant, place, h, g))
                want = sorted(zip(doc, variant, place, h, g >> np.uint64(32)))
                assert sorted(zip(*got)) == want

    def test_texts_of_one_doc_id_lose_their_own_words_only(self, spark):
        random = np.random.default_rng(3)
        shared, alone = (" ".join(f"{c}{k}" for k in random.integers(0, 10**6, size=40)) for c in "ab")
        data = [(1, shared), (2, shared[2:]), (2, alone), (2, shared), (3, alone), (3, alone), (3, "b"),
                (None, shared), (2, None)]
        frame = spark.createDataFrame(data, "doc_id long, text string").withColumns(
            {c: F.lit(1) for c in ("variant", "several", "_doc", "copied")})
        for ids in (10**6, 0):
            got = substrings.remove_repeats(frame, sent_ids=ids)
            assert sorted((str(r[0]), r[1], r[2], r[4]) for r in got.collect()) == self.plain(data, 13)

    def test_empty(self, nothing):
        assert substrings.remove_repeats(nothing).count() == 0


def test_queries_are_registered():
    assert {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES} == set(range(1, 14))
