"""Collocations and their automata against brute force, and odd inputs."""

import collections
import random
import re

import numpy as np
import pytest

from sessionloom.llm import collocations
from sessionloom.llm.transducer import CountTransducer, summed
from sessionloom.session import Staging

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, phrase string, f int, `range` string, `a.b` int"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least, top=2000, percent=80):
    count, total = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, 5):
                count[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in count.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = collections.Counter()
        for p, a in candidates.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    longer[p[i : i + n]] = max(longer[p[i : i + n]], a)
        best = []
        for p, a in candidates.items():
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if 100 * longer[p] < percent * a:
                best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def mined(spark, rows, partitions=4, **options):
    docs = spark.createDataFrame([(i, t, x, "p", 1, "r", 2) for i, (x, t) in enumerate(rows)], DOCS).repartition(partitions)
    return sorted(tuple(r) for r in collocations.mine(docs, Staging(spark, "t"), **options).collect())


def prose(seed, count=300):
    rng, rows = random.Random(seed), []
    vocabulary = [f"{c}{i}" for c in "abcéñ" for i in range(30)] + ["the"] * 60 + ["of"] * 30 + ["|"] * 9
    fixed = ["New York city", "as soon as possible", "of the of the", "x x x x x", "In The End\tof it", "once upon a time there was"]
    for _ in range(count):
        words = []
        for _ in range(rng.randint(0, 60)):
            words.append(rng.choice(fixed) if rng.random() < 0.2 else rng.choice(vocabulary) + rng.choice(["", "", "", ",", ".", "\n", "!?", " ", "\t"]))
        rows.append((rng.choice(["en", "en", "en", "de", None, "und", ""]), " ".join(words)))
    return rows


@pytest.mark.parametrize("sizes", [(10 ** 6, 10 ** 6, 10 ** 6), (400, 150, 20), (60, 40, 3)])
def test_collocations_equal_brute_force(spark, sizes):
    """In one range, and in many ranges whose boundaries part frequent phrases, with shards that end inside texts."""
    rows = prose(sum(sizes))
    range_words, shard_words, questions = sizes
    found = mined(spark, rows, least=4, top=150, range_words=range_words, shard_words=shard_words, questions=questions)
    want = brute(rows, 4, 150)
    assert found == want and len(want) > 200


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = collocations.mine(docs, Staging(spark, "t"), range_words=20_000, shard_words=9_000).collect()
    assert sorted(map(tuple, found)) == brute([(r["lang"], r["text"]) for r in docs.collect()], 30)


def test_odd_rows(spark):
    long = "a b c " * 200_000 + "q" * 3_000_000
    rows = [("en", None), ("en", ""), ("en", " .,;\n\t"), ("en", long), ("x", "hot " * 70), ("x", None), ("de", "É é\x00 \x1c É é\x00 \x1c " * 20),
            ("y z\n", "p q. p q! " * 20), ("en", "w" * 100 + " " + "v" * 100 + ". "), *[("k", "same row here")] * 40,
            *[("tie", "b c. a b. " * 15)] * 2, *[("long", f"{'w' * 99}{i % 2} {'v' * 99}{i % 3} end") for i in range(200)]]
    for options in ({}, {"range_words": 5_000, "shard_words": 2_000, "questions": 2}):
        assert mined(spark, rows, **options) == brute(rows, 30)
    assert mined(spark, rows[:3]) == [] and mined(spark, [(None, "a")], 1) == []
    empty = spark.createDataFrame([], DOCS)
    assert collocations.mine(empty, Staging(spark, "t")).count() == 0


def test_counts_beyond_64_bits_are_exact(spark):
    a = 3_000_000_000_000_000
    counts = spark.createDataFrame([("en", "a b", 2, a)], "lang string, phrase string, size int, f long")
    parts = spark.createDataFrame([("en", "a b", 1, "l", 9_000_000_000_000_000_000), ("en", "a b", 1, "r", 9_000_000_000_000_000_001)],
                                  "lang string, phrase string, k int, side string, f long")
    r = collocations.scored(counts, parts).first()
    assert r["score"] == 2_000_000 * a // 18_000_000_000_000_000_001


def random_automaton(rng, words, count):
    phrases = [tuple(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(count)]
    return phrases, CountTransducer.of(phrases, [1] * count, 4)


def spelled(t):
    rows, counts = t.rows()
    return {tuple(t.words[i - 1] for i in r if i): int(c) for r, c in zip(rows.tolist(), counts)}


def test_automata_hold_unite_and_compose_counts():
    rng = random.Random(3)
    words = [bytes([c]) * rng.randint(1, 3) for c in range(97, 107)]
    (p, x), (q, y) = (random_automaton(rng, words[:n], 600) for n in (6, 10))
    assert spelled(x) == collections.Counter(p)
    again = CountTransducer.load(x.dump())
    assert spelled(again) == spelled(x)
    both = CountTransducer.union([x.dump(), y.dump()], 4)
    want = collections.Counter(p) + collections.Counter(q)
    assert spelled(both) == want
    starts = collections.Counter(s[:k] for s in p + q for k in range(1, len(s) + 1))
    rare = (words[9], words[9])
    assert dict(both.prefixes(20, {rare, (b"none", b"such")})) == {s: n for s, n in starts.items() if n >= 20 or len(s) == 1 or s == rare}
    rows, counts, asked = both.compose(x)
    assert {tuple(x.words[i - 1] for i in r if i): (int(c), int(a)) for r, c, a in zip(rows.tolist(), counts, asked)} == {
        s: (want[s], n) for s, n in spelled(x).items()}
    none = CountTransducer.union([], 4)
    assert spelled(none) == {} and list(none.prefixes(1)) == [] and len(both.compose(none)[1]) == 0


def test_equal_tails_are_one_state():
    heads = [bytes([c]) for c in range(97, 117)]
    t = CountTransducer.of([(h, b"x", b"y", b"z") for h in heads], [1] * len(heads), 4)
    assert [len(f) for f in t.fans] == [1, 20, 20, 1, 1]
    assert t.totals()[0].tolist() == [20]


def test_sums_of_rows_wider_than_one_key():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 3, (500, 5)).astype(np.int32) * 70_000
    got, counts = summed(rows, np.ones(500, np.int64), 200_000)
    want = collections.Counter(map(tuple, rows.tolist()))
    assert list(map(tuple, got.tolist())) == sorted(want) and counts.tolist() == [want[r] for r in sorted(want)]
