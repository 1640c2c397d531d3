"""The operators that look at the whole corpus, against brute force, and odd inputs."""

import collections
import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F, types as T

import corpus_pipeline
from sessionloom.llm import chat, dedup_exact, fingerprints, mixing, near_dedup, queries, simhash, warc
from sessionloom.llm.common import map_text, tables, working
from sessionloom.llm.components import components
from sessionloom.session import Staging

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, `a.b` int, row int, key string"


def docs_of(spark, rows):
    """Documents with extra columns whose names clash with working columns."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "d", 1, 2, "k") for i, t, s in rows], DOCS)


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute_groups(rows, size=5):
    sets = {i: shingles(t, size) for i, t, _ in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.6:
            words[at] = f"new{rng.randrange(10 ** 6)}"
        elif kind < 0.8:
            del words[at]
        else:
            words.insert(at, f"w{rng.randrange(30)}")
    return words


def clustered(seed, clusters=3, members=60):
    """Dense clusters around an original, with copies on both sides of the limit, derived clusters and truncations."""
    rng, rows = random.Random(seed), []
    for c in range(clusters):
        base = [f"c{c}_{rng.randrange(400)}" for _ in range(150)]
        derived = edited(rng, base, 9)
        for _ in range(members):
            kind = rng.random()
            words = (edited(rng, base, rng.randint(0, 9)) if kind < 0.6 else edited(rng, derived, rng.randint(0, 7)) if kind < 0.8
                     else base[: rng.randint(90, 150)] if kind < 0.9 else base[:70] + [f"x{rng.randrange(10 ** 6)}" for _ in range(60)])
            rows.append(" ".join(words))
    rng.shuffle(rows)
    return [(i * 3, t, "s") for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_brute_force_in_dense_clusters(spark, seed):
    rows = clustered(seed)
    found = near_dedup.groups(docs_of(spark, rows), Staging(spark, "t")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_groups(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


@pytest.mark.parametrize("seed", [4, 5])
def test_members_of_many_sizes_under_one_hub(spark, seed):
    """Cuts and extensions of one text, all of different sizes, and a variant that shares its extras but is far from the hub."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(10 ** 6)}" for _ in range(240)]
    extra = [f"e{rng.randrange(10 ** 6)}" for _ in range(200)]
    rows = [base[: 120 + i % 120] + [f"x{seed}_{i}_{j}" for j in range(i % 37)] for i in range(130)]
    rows += [base[:150] + edited(rng, extra[: 60 + i], rng.randint(0, 3)) for i in range(80)]  # a variant
    rows += [base[i:] for i in range(0, 100, 3)] + [base[:90] + base[150 + i :] for i in range(30)]
    rng.shuffle(rows)
    rows = [(i, " ".join(w), "s") for i, w in enumerate(rows)]
    found = near_dedup.groups(docs_of(spark, rows).repartition(4), Staging(spark, "t")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_groups(rows)


def test_a_variant_of_a_hub_is_not_listed_in_pairs(spark, monkeypatch):
    """2,000 members of many sizes, most of them variants that share their extras: few pairs are tried per member."""
    base, variant = [f"b{i}" for i in range(300)], [f"v{i}" for i in range(200)]
    texts = [base[: 200 + i % 100] + [f"p{i}"] for i in range(600)] + [base[:200] + variant[: 100 + i % 100] + [f"o{i}"] for i in range(1400)]
    rows = [(i, " ".join(t), "s") for i, t in enumerate(texts)]
    tried, plain = {}, near_dedup.NearDuplicates._likely

    def counted(self, name, pairs):
        pairs = self.stage.put(f"{name}_tried", pairs)
        tried[name] = pairs.count()
        return plain(self, name, pairs)

    monkeypatch.setattr(near_dedup.NearDuplicates, "_likely", counted)
    found = near_dedup.groups(docs_of(spark, rows).repartition(4), Staging(spark, "t")).collect()
    assert len({r["component_id"] for r in found}) <= 2
    assert sum(tried.values()) < 60 * len(rows)


def test_near_duplicates_at_the_limit_and_odd_rows(spark):
    words = [f"w{i}" for i in range(49)]  # 45 shingles of five words
    nine = " ".join(words[:-5] + ["p", "q", "r", "s", "t"])  # 40 in common of 50
    less = " ".join(["z"] + words[1:-5] + ["p", "q", "r", "s", "t"])
    rows = [(1, " ".join(words), "s"), (2, nine, "s"), (3, less, "s"), (5, "Two words", "s"), (4, "two\tWORDS ", "s"), (6, "", "s"),
            (7, None, "s"), (8, "", "s"), (9, " \n", "s"), (11, "x " * 30_000, "s"), (10, "x " * 29_000, "s"), (12, "two words", None)]
    found = near_dedup.groups(docs_of(spark, rows + [(None, "two words", "s"), (5, "Two words", "s")]), Staging(spark, "t")).collect()
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"], r["kept"]) for r in found)
    want = brute_groups(rows)
    want_rows = [(i, *want[i], want[i][1] == i) for i in want] + [(-1, 1, None, True), (5, *want[5], False)]
    assert got == sorted(want_rows, key=lambda r: r[0])
    assert want[2][1] == 1
    kept = near_dedup.dedup(docs_of(spark, rows), Staging(spark, "t"))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i in want if want[i][1] == i)
    assert kept.columns == docs_of(spark, rows).columns
    assert near_dedup.groups(docs_of(spark, rows).limit(0), Staging(spark, "t")).count() == 0


def test_rows_of_one_id_are_one_node(spark):
    rng = random.Random(8)
    a, b, c, d = (" ".join(f"{x}{rng.randrange(10 ** 6)}" for _ in range(80)) for x in "abcd")
    near = a.replace(a.split()[40], "changed")
    # 5 copies 3 and has B; 6 copies 1 and 2, so they are one; 9 is near to 3 and has D; 20 copies 4 and is empty once
    rows = [(3, a), (5, a), (5, b), (8, b), (1, c), (2, "alone here"), (6, c), (6, "Alone here"), (9, near), (9, d), (10, d), (4, "x y z"),
            (20, "X y z"), (20, ""), (30, "of its own")]
    docs = docs_of(spark, [(i, t, "s") for i, t in rows])
    found = near_dedup.groups(docs.repartition(3), Staging(spark, "t")).collect()
    want = {3: 3, 5: 3, 8: 3, 9: 3, 10: 3, 1: 1, 2: 1, 6: 1, 4: 4, 20: 4, 30: 30}
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in found) == sorted((i, want[i], want[i] == i) for i, _ in rows)
    kept = near_dedup.dedup(docs, Staging(spark, "t"))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted((i, t) for i, t in rows if want[i] == i)


def test_minima_and_maxima_estimate_the_similarity():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(60):
        common, own = rng.integers(0, 1 << 63, 300, dtype=np.uint64), rng.integers(0, 1 << 63, (2, 60), dtype=np.uint64)
        x, y = (np.unique(np.concatenate([common, o])) for o in own)
        errors.append((near_dedup.signature(x) == near_dedup.signature(y)).mean() - 300 / 420)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    frame = spark.createDataFrame(edges, "u long, v long")
    found = {r["node"]: r["root"] for r in components(frame, Staging(spark, "t"), "c").collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}, 201: 200}
    assert components(frame.limit(0), Staging(spark, "t"), "c").count() == 0


# exact dedup

@pytest.mark.parametrize("counters", [2, 4096])
def test_exact_groups_equal_brute_force(spark, counters):
    rng = random.Random(counters)
    rows = [(i, rng.choice(["hot", "HOT", "hot", f"t{rng.randrange(40)}", None, "", "É", "é"]), "s") for i in range(600)]
    rows += [(None, "hot", "s"), (3, "rep", "s"), (3, "rep", "s"), (2, "REP", "s"), (None, "only", "s")]
    lowered = collections.defaultdict(list)
    for i, t, _ in rows:
        lowered["".join(c.lower() if c.isascii() else c for c in t or "")].append(i)
    found = dedup_exact.groups(docs_of(spark, rows).repartition(7), Staging(spark, "t"), counters).collect()
    by_digest = collections.defaultdict(list)
    for r in found:
        by_digest[bytes(r["digest"])].append(r)
    assert len(found) == len(rows) and len(by_digest) == len(lowered)
    for text, ids in lowered.items():
        group = by_digest[hashlib.sha256(text.encode()).digest()]
        top = max((i for i in ids if i is not None), default=None)
        assert {r["keep_id"] for r in group} == {top} and {r["group_size"] for r in group} == {len(ids)}
        assert [r["doc_id"] for r in group if r["kept"]] == [top]
    kept = dedup_exact.dedup(docs_of(spark, rows), Staging(spark, "t"), counters)
    assert kept.columns == docs_of(spark, rows).columns
    assert kept.count() == len(lowered)
    assert dedup_exact.dedup(docs_of(spark, rows).limit(0), Staging(spark, "t")).count() == 0


def test_one_survivor_for_every_input_order(spark):
    """Rows that agree in id and text but not elsewhere: the same one stays, whatever the partitions."""
    rows = [(i % 3, "Same TEXT" if i % 2 else "same text", f"src{i}") for i in range(60)] + [(None, "same", f"src{i}") for i in range(20)]
    rows += [(9, "hot", "s")] * 30
    kept = []
    for parts in (3, 5, 8):
        random.Random(parts).shuffle(rows)
        kept.append(sorted(map(tuple, dedup_exact.dedup(docs_of(spark, rows).repartition(parts), Staging(spark, "t")).collect()), key=str))
    assert kept[0] == kept[1] == kept[2]
    assert [(r[0], r[1].lower()) for r in kept[0]] == [(2, "same text"), (9, "hot"), (None, "same")]
    nested = docs_of(spark, rows).withColumn("m", F.create_map(F.lit("k"), F.col("source")))
    assert dedup_exact.dedup(nested, Staging(spark, "t")).count() == 3


def test_misra_gries_finds_every_frequent_value(spark):
    rng = random.Random(9)
    values = [b"a"] * 300 + [b"b"] * 200 + [str(rng.random()).encode() for _ in range(1000)]
    rng.shuffle(values)
    frame = spark.createDataFrame([(bytearray(v),) for v in values], "v binary").repartition(5)
    found = {bytes(r["v"]) for r in dedup_exact.frequent(frame, "v", Staging(spark, "t"), 10).collect()}
    assert {b"a", b"b"} <= found and len(found) <= 20


# mixing

def test_seats_equal_highest_quotients(spark):
    rng = random.Random(2)
    parts = [("g", f"p{i}", float(rng.choice([1, 5, 40, 400]) * rng.random()), 300) for i in range(30)]
    frame = spark.createDataFrame([(g, n, v, 300, 10 ** 6) for g, n, v, _ in parts], "g string, name string, votes double, seats long, room long")
    found = {r["name"]: r["quota"] for r in mixing.apportioned(frame, ["g"], ["name"]).collect()}
    whole = mixing.apportioned_over_all(frame.drop("g").repartition(5), "name", Staging(spark, "t"))
    assert {r["name"]: r["quota"] for r in whole.collect()} == found
    quotients = sorted(((-v / (2 * j - 1), n) for _, n, v, _ in parts for j in range(1, 301)))[:300]
    want = collections.Counter(n for _, n in quotients)
    assert {n: q for n, q in found.items() if q} == dict(want)


def test_mix_reaches_its_targets_and_handles_odd_rows(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randint(1, 300), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(400)]
    rows += [(1000, "w " * 5, "tiny"), (1001, None, "b"), (1002, "", "empty"), (None, "w w w", "a"), (7, "w " * 9, "b"), (7, "w " * 9, "b")]
    docs = docs_of(spark, rows)
    sized = Staging(spark, "t").put("s", docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), "source", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"))
        .fillna(0, ["size"]))
    plan = mixing.Mix(sized, Staging(spark, "t"), shard_tokens=5000)
    found = plan.with_targets(plan.taken(sized)).collect()
    assert len(found) == len(rows)
    taken, size, target = collections.Counter(), collections.Counter(), {}
    for r in found:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        size[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
    assert abs(sum(target.values()) - sum(size.values())) < 1e-6
    for s in target:
        assert target[s] <= 3 * size[s] and abs(taken[s] - target[s]) <= 4 * mixing.BLOCK_TOKENS
    again = mixing.Mix(sized.repartition(5), Staging(spark, "t"), shard_tokens=5000)
    assert sorted(map(str, again.with_targets(again.taken(sized)).collect())) == sorted(map(str, found))
    out = mixing.mixed(docs, F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), Staging(spark, "t"))
    assert out.columns == docs.columns and out.count() > 0
    empty = mixing.mixed(docs.limit(0), F.lit(1).cast("long"), Staging(spark, "t"))
    assert empty.count() == 0


def test_a_source_value_per_document(spark):
    """3,000 sources, most of one document and many without words: targets by the plain rule, no window over all of them."""
    rng = random.Random(13)
    rows = [(i, "w " * rng.choice([0, 0, 1, 5, 60]), f"s{i}") for i in range(3000)] + [(5000 + i, "w " * 40, "hot") for i in range(1500)]
    rows += [(9000 + i, None, "hot") for i in range(500)] + [(9900, "w " * 7, None)]
    docs = docs_of(spark, rows).repartition(6)
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    sized = Staging(spark, "t").put("s", docs.select(F.col("doc_id").cast("string").alias("doc_id"), "source", words.alias("size")))
    plan = mixing.Mix(sized, Staging(spark, "t"))
    found = plan.with_targets(plan.taken(sized)).collect()
    size = collections.Counter()
    for _, t, s in rows:
        size[s] += (t or "").count("w")
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    open_, left, want = set(order), sum(size.values()), {}
    while True:
        share = left / max(1, sum(weight[s] for s in open_))
        full = [s for s in open_ if 3 * size[s] < share * weight[s]]
        if not full:
            break
        for s in full:
            want[s], left = 3.0 * size[s], left - 3 * size[s]
            open_.discard(s)
    want |= {s: min(3.0 * size[s], share * weight[s]) for s in open_}
    assert len(found) == len(rows) and all(abs(r["target"] - want[r["source"]]) < 1e-6 for r in found)
    assert all(r["taken"] == 0 for r in found if r["size"] == 0)
    hot = sum(r["taken"] for r in found if r["source"] == "hot")
    assert abs(hot - want["hot"]) <= 4 * mixing.BLOCK_TOKENS


def test_whole_documents_reach_the_targets_of_every_source(spark):
    rng = random.Random(11)
    length = lambda: rng.choice([rng.randint(1, 40), rng.randint(300, 900), rng.randint(2000, 4000)])
    rows = [(i, "w " * length(), "hot" if i % 2 else f"s{i % 14}") for i in range(700)]
    rows += [(i, "w " * length(), "more") for i in [None] * 60 + [9000] * 60] + [(i, "w " * 1500, "one size") for i in range(9001, 9121)]
    docs, words = docs_of(spark, rows), F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    goal = {r["source"]: r for r in mixing.targets(docs.select("source", words.alias("size"))).collect()}
    assert goal["hot"]["target"] < 0.4 * goal["hot"]["source_size"]
    longest = collections.Counter()
    for _, t, s in rows:
        longest[s] = max(longest[s], t.count("w"))
    stage = Staging(spark, "t")
    out = stage.put("out", mixing.mixed(docs, words, stage))
    said = {r["source"]: r["words"] for r in out.groupBy("source").agg(F.sum(words).alias("words")).collect()}
    for s, r in goal.items():
        assert abs(said.get(s, 0) - r["target"]) <= longest[s] + 4 * mixing.BLOCK_TOKENS, s
    again = mixing.mixed(docs.repartition(5), words, Staging(spark, "t"))
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


# fingerprints

def bag(text):
    return collections.Counter((text or "").encode().lower().split())


def same_samples(x, y):
    return sum(a == b for a, b in zip(*(map("".join, zip(*[iter(c)] * fingerprints.DIGITS)) for c in (x, y)))) / fingerprints.SAMPLES


def test_fingerprints_against_generalised_jaccard(spark):
    """The whole table: edited texts exactly, both likenesses against the exact similarity of whole word counts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.orderBy(F.desc("doc_id")).collect()
    found = {r["doc_id"]: r for r in queries.op10_weighted_fingerprints(spark, SF).collect()}
    plain = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(docs).collect()}
    assert len(found) == len(rows)
    off = {"near_edited": [], "near_next": []}
    for i, r in enumerate(rows):
        text, following = r["text"] or "", rows[(i + 1) % len(rows)]
        other = following["text"] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + other[:half]
        got = found[r["doc_id"]]
        assert got["n_chars"] == len(text) and got["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert got["fingerprint"] == plain[r["doc_id"]]
        assert got["near_edited"] == same_samples(got["fingerprint"], got["edited_fingerprint"])
        assert got["near_next"] == same_samples(got["fingerprint"], found[following["doc_id"]]["fingerprint"])
        for name, against in (("near_edited", changed), ("near_next", other)):
            x, y = bag(text), bag(against)
            off[name].append(got[name] - sum((x & y).values()) / max(1, sum((x | y).values())))
    for errors in off.values():
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.12


def test_edited_texts_have_the_fingerprints_of_texts(spark):
    """What is listed once for a text and its edited text gives the same samples as either on its own."""
    rng = random.Random(12)
    bits = ["the", "The", "of", "é\U0001f600", "x" * 40, " ", "  ", "\n", "\t ", "a b", "."]
    rows = [(i, rng.choice(["", " "]).join(rng.choices(bits, k=rng.randint(0, 40)))) for i in range(150)] + [(200, None), (201, ""), (202, " \n "), (203, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = sorted(rows, reverse=True)
    changed = []
    for i, (doc_id, text) in enumerate(order):
        text, other = text or "", order[(i + 1) % len(order)][1] or ""
        changed.append((doc_id, text[: len(text) - len(text) // 2] + other[: len(text) // 2]))
    want = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(spark.createDataFrame(changed, "doc_id long, text string")).collect()}
    assert {r["doc_id"]: r["edited_fingerprint"] for r in fingerprints.compared(docs).collect()} == want


@pytest.mark.parametrize("per_range", [1, 3, 2000])
def test_successors_and_odd_rows(spark, monkeypatch, per_range):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", per_range)
    rows = [(5, "a b c"), (9, ""), (9, "x"), (2, None), (None, "tail é"), (40_000_000_000, "A b C"), (-7, " \n"), (5, "a b c"), (6, "w " * 9000)]
    hashes = {r["t"]: r["h"] for r in spark.createDataFrame([(t or "",) for _, t in rows], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1] or ""], r[1] or ""))  # ties follow the hash of their text
    found = fingerprints.compared(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    prints = {r["doc_id"]: r["fingerprint"] for r in found}
    assert prints[5] == prints[40_000_000_000] and prints[-7] == prints[2] == "0" * 6 * fingerprints.SAMPLES
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)]
        half = len(text) // 2
        want = hashlib.sha256((text[: len(text) - half] + (following[1] or "")[:half]).encode()).hexdigest()
        assert want in [r["edited_sha256"] for r in found if r["doc_id"] == doc_id]
    one = fingerprints.compared(spark.createDataFrame([(1, "alone here")], "doc_id long, text string")).collect()
    assert one[0]["near_next"] == 1.0
    assert fingerprints.compared(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert fingerprints.fingerprints(docs_of(spark, [(1, "a b c", "s")])).collect()[0]["fingerprint"] == prints[5]


# archives

def test_archives_round_trip(spark):
    pages = spark.createDataFrame(
        [(i, f"http://e.org/{i}", f"<p>{'body ' * (i % 50)}{i % 40}</p>", "clash") for i in range(300)]
        + [(900, "a\nb", None, "c"), (901, None, "", "c"), (None, "u", "", "c"), (1, "http://e.org/1", "<p>body 1</p>", "c"), (950, "é", "é" * 90_000, "c")],
        "page_id long, url string, html string, digest string")
    manifest = warc.write(pages, Staging(spark, "t"), archive_bytes=20_000)
    assert manifest.count() > 3 and manifest.agg(F.sum("records")).first()[0] == 305
    found = warc.read(manifest).collect()
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    first = {}
    for i, p in rows:
        if i is not None:
            first[p] = min(first.get(p, 10 ** 9), i)
    assert len(found) == len(rows)
    want = sorted((-1 if i is None else i, len(p), warc.base32_sha1(p), None if i == first[p] else first[p]) for i, p in rows)
    assert sorted((-1 if r["page_id"] is None else r["page_id"], r["payload_bytes"], r["payload_digest"], r["refers_to"]) for r in found) == want
    stored = {r["page_id"]: bytes(r["payload"]) for r in found if r["record_type"] == "response"}
    assert all(stored[i] == p for i, p in rows if first[p] == i)
    small = warc.read(warc.write(pages, Staging(spark, "t"), min_bytes=10)).filter("page_id = 901").first()
    assert small["record_type"] == "response"
    assert warc.write(pages.limit(0), Staging(spark, "t")).count() == 0


def test_an_archive_starts_with_its_dictionary(tmp_path):
    import io
    import struct

    records = [warc.record(i, f"http://e.org/{i}", f"<html><body>{'some words ' * 30}{i}</body></html>".encode(), None) for i in range(400)]
    parts = list(warc.compress(records))
    magic, size = struct.unpack("<II", parts[0][:8])
    assert magic == warc.DICTIONARY_MAGIC and size == len(parts[0]) - 8 and len(parts) == 401
    assert list(warc.decompress(io.BytesIO(b"".join(parts)))) == records
    assert sum(map(len, parts[1:])) < 0.6 * sum(len(p) for p in warc.compress(records[:1])) * 400
    with pytest.raises(ValueError):
        list(warc.decompress(io.BytesIO(b"".join(parts)[:-5])))


# chat

def test_events_fold_into_final_messages(spark):
    events = [
        (1, 0, 0, "open", "user", ""), (1, 0, 1, "delta", None, "He"), (1, 0, 2, "delta", None, "llo"), (1, 0, 3, "edit", None, "Hi"),
        (1, 0, 4, "delta", None, "!"), (1, 1, 0, "open", "assistant", "x"), (1, 1, 1, "regenerate", None, None), (1, 1, 2, "delta", None, "A"),
        (1, 1, 3, None, None, "B"), (1, 2, 0, "open", "user", "gone"), (1, 2, 5, "delete", None, None), (2, 0, 0, "delete", None, None),
        (None, 0, 0, "open", None, None), (3, 0, None, "open", "user", "first"), (3, 0, 1, "delta", None, "+"), (3, 0, 1, "delta", None, "+")]
    random.Random(1).shuffle(events)
    log = spark.createDataFrame(events, "conv_id long, turn long, seq long, kind string, role string, text string")
    found = {(r["conv_id"], r["turn"]): (r["role"], r["text"]) for r in chat.fold(log.withColumn("events", F.lit(1))).collect()}
    assert found == {(1, 0): ("user", "Hi!"), (1, 1): ("assistant", "AB"), (None, 0): ("", ""), (3, 0): ("user", "first++")}
    assert chat.format_log(log.limit(0)).count() == 0


def test_formatting_reads_back_exactly(spark):
    rng = random.Random(3)
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "<", "[", "/s>", "<\\/s>", "[\\INST]", "\n", "é", "a ", "<|im_end|>", "</s>\n", "\\n",
            "\x00", "\x01", "s>", "\U0001f600"]
    roles = ["user", "assistant", "sys\ntem", "[INST] x", "\\n", "", None, "</s>", "\x00\x01"]
    rows = [(c, t, rng.choice(roles), "".join(rng.choices(bits, k=rng.randint(0, 12)))) for c in range(300) for t in range(rng.randint(1, 4))]
    rows.append((900, 0, "assistant", "long " * 20_000))
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_log(chat.as_log(turns, 3)).withColumns({
        "turns": chat.parse(F.col("formatted")), "loss": chat.under_mask(F.col("formatted"), F.col("loss_mask"))}).collect()
    said, loss = collections.defaultdict(list), collections.defaultdict(str)
    for c, _, role, text in rows:
        said[c].append((role or "", text))
        loss[c] += text if role == "assistant" else ""
    assert len(made) == len(said)
    for r in made:
        assert [(t["role"], t["text"]) for t in r["turns"]] == said[r["conv_id"]] and r["loss"] == loss[r["conv_id"]]
        for first, rest in chat.CONTROLS[:4]:
            marks = len(said[r["conv_id"]]) if rest in ("s>", "/s>") else sum(role != "assistant" for role, _ in said[r["conv_id"]])
            assert r["formatted"].count(first + rest) == marks


def test_rows_that_share_a_turn_stay_messages(spark, folder):
    import duckdb

    long, other = "a" * 1300 + "</s>", "b" * 1300
    rows = [(1, 1, "user", "hello")] * 2 + [(1, 2, "assistant", "yes")] * 3 + [(2, 1, "user", long), (2, 1, "assistant", other), (2, 0, "user", "x")]
    rows += [(3, None, "assistant", "late"), (3, 5, "user", "soon"), (4, None, "user", long), (4, None, "user", long), (4, None, "user", "c"),
             (5, 1, None, None), (5, 1, "", ""), (None, None, "user", "p"), (None, None, "user", "p")]
    random.Random(4).shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_log(chat.as_log(turns.repartition(5))).withColumns({
        "turns": chat.parse(F.col("formatted")), "loss": chat.under_mask(F.col("formatted"), F.col("loss_mask"))}).collect()
    said = collections.defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or "")):
        said[c].append((role or "", text or ""))
    assert {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in made} == said
    assert {r["conv_id"]: r["loss"] for r in made} == {c: "".join(t for r, t in v if r == "assistant") for c, v in said.items()}

    # the SQL counts rows; where no two different rows share a turn it names one order
    turns.coalesce(1).write.parquet(f"{folder}/conversations.parquet")
    found = {r["conv_id"]: tuple(r) for r in queries.op6_chat_format(spark, folder).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
    want = {r[0]: tuple(r) for r in con.execute(queries.ORACLES["op6_chat_format"]).fetchall()}
    assert {c: (r[1], r[3], r[5]) for c, r in found.items()} == {c: (r[1], r[3], r[5]) for c, r in want.items()}
    assert all(found[c] == want[c] for c in (-1, 1, 3, 5, None))


# pipeline

def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage, kept = Staging(spark, "t"), {}
    now = docs
    for name, step in corpus_pipeline.STAGES:
        before = now
        now = stage.put(name, step(spark, now, SF))
        kept[name] = now
        if name != "encode":
            assert now.columns == docs.columns, name
        if name == "exact_dedup":
            texts = collections.defaultdict(list)
            for r in before.collect():
                texts["".join(c.lower() if c.isascii() else c for c in r["text"] or "")].append(r["doc_id"])
            assert sorted(r["doc_id"] for r in now.collect()) == sorted(map(max, texts.values()))
        if name == "near_dedup":
            want = brute_groups([(r["doc_id"], r["text"], None) for r in before.collect()])
            assert sorted(r["doc_id"] for r in now.collect()) == sorted(i for i, (_, root) in want.items() if root == i)
    assert kept["language"].count() >= 0.99 * docs.count()
    assert now.count() == kept["mix"].count()
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, now.collect()))


def test_pipeline_stages_take_odd_documents(spark):
    rows = [(1, "the cat sat on the mat with a hat", "a"), (None, "the dog ran over the hill and away", None), (3, None, "b"), (4, "", "b"),
            (5, "1 2 3 !!", "a"), (1, "the cat sat on the mat with a hat", "a"), (6, "long words here " * 9000, "c")]
    stage = Staging(spark, "t")
    for now in (docs_of(spark, rows), docs_of(spark, rows).limit(0), docs_of(spark, rows[2:4])):
        for name, step in corpus_pipeline.STAGES:
            now = stage.put(name, step(spark, now, SF))
            stage = Staging(spark, "t")
        assert "n_tokens" in now.columns


CLASHING = (
    "digest", "row", "size", "shard", "copies", "__id", "ids", "key", "rid", "rep", "n", "bands", "bytes", "term", "weight", "range", "place", "side", "kind",
    "spot", "taken", "src", "fp", "hub", "root", "__digest", "__source", "__size", "__copies", "__whole", "lang_pred", "score", "a.b", "c`d",
)


def test_stages_give_python_small_batches_whoever_evaluates_them(spark, monkeypatch):
    docs = spark.range(0, 2500, 1, 1).selectExpr("id AS doc_id", "'some words' AS text", "'en' AS lang", "'web' AS source")

    @F.arrow_udf("boolean")
    def small(texts: pa.Array) -> pa.Array:
        return pa.array([len(texts) <= 1000] * len(texts), pa.bool_())

    def sizes(batches):
        for batch in batches:
            ids = pa.array([b"0000" * batch.num_rows] * batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), ids], names=["doc_id", "source", "ids"])

    monkeypatch.setattr(corpus_pipeline.language, "learned", lambda docs: None)
    monkeypatch.setattr(corpus_pipeline.language, "accepted", lambda docs, model: docs.filter(small("text")))
    monkeypatch.setattr(corpus_pipeline.bpe, "encode", lambda docs, *a, **b: docs.mapInArrow(sizes, "doc_id long, source string, ids binary"))
    assert corpus_pipeline.identify_language(spark, docs, SF).count() == 2500
    assert corpus_pipeline.encode_documents(spark, docs, SF).agg(F.max("n_tokens")).first()[0] <= 1000


def test_stages_bound_the_bytes_of_python_batches(spark, monkeypatch):
    docs = spark.range(0, 2000, 1, 1).selectExpr("id AS doc_id", "repeat('some words ', 1000) AS text", "'en' AS lang", "'web' AS source")

    @F.arrow_udf("boolean")
    def small(texts: pa.Array) -> pa.Array:
        return pa.array([len(texts) <= 200] * len(texts), pa.bool_())

    def sizes(batches):
        for batch in batches:
            ids = pa.array([b"0000" * batch.num_rows] * batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), ids], names=["doc_id", "source", "ids"])

    monkeypatch.setattr(corpus_pipeline.language, "learned", lambda docs: None)
    monkeypatch.setattr(corpus_pipeline.language, "accepted", lambda docs, model: docs.filter(small("text")))
    monkeypatch.setattr(corpus_pipeline.bpe, "encode", lambda docs, *a, **b: docs.mapInArrow(sizes, "doc_id long, source string, ids binary"))
    assert corpus_pipeline.identify_language(spark, docs, SF).count() == 2000
    assert corpus_pipeline.encode_documents(spark, docs, SF).agg(F.max("n_tokens")).first()[0] <= 200


def test_results_come_back_in_small_batches(spark):
    docs = spark.range(0, 300, 1, 1).selectExpr("id", "if(id % 3 = 0, null, repeat('x', int(id) * 1000)) AS text")
    fields = [T.StructField("n", T.LongType()), T.StructField("together", T.LongType())]
    made = map_text(docs, fields, lambda: lambda texts: [[len(t) for t in texts], [sum(map(len, texts)) if len(texts) > 1 else 0] * len(texts)])
    found = made.select("id", "n", "together").collect()
    assert sorted((r["id"], r["n"]) for r in found) == [(i, i * 1000 if i % 3 else 0) for i in range(300)]
    assert max(r["together"] for r in found) <= 1 << 17
    assert map_text(docs.limit(0), fields, lambda: lambda texts: [[], []]).count() == 0


def test_workers_keep_the_tables_of_one_operator_only():
    made = []

    def build(source):
        made.append(source)
        return source.upper()

    assert working(lambda: tables(build, "a")) == working(lambda: tables(build, "a")) == "A" and made == ["a"]
    assert working(lambda: tables(build, "b") + tables(build, "c")) == "BC"
    working(lambda: None)
    assert working(lambda: tables(build, "a")) == "A" and made == ["a", "b", "c", "a"]


def test_texts_need_not_come_back_from_python(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, None, "y")], "`doc.id` long, text string, source string")
    made = map_text(docs, [T.StructField("n", T.LongType())], lambda: lambda texts: [[len(t) for t in texts]], keep=False)
    assert made.columns == ["doc.id", "source", "n"]
    assert sorted(map(tuple, made.collect())) == [(1, "x", 3), (2, "y", 0)]


def test_columns_with_clashing_names_pass_through(spark):
    texts = ["the cat sat on the mat today again", "The cat sat on the mat today again", "a dog ran over that hill and away home", "eine katze liegt auf dem tisch dort", None, ""]
    rows = [(i, texts[i % 6] and texts[i % 6] + f" {i % 12}", ["en", "de", None][i % 3], f"s{i % 3}", 1, *(f"{c}{i}" for c in CLASHING)) for i in range(40)]
    quoted = ", ".join(f"`{c.replace('`', '``')}` string" for c in CLASHING)
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {quoted}")
    plain = docs.select("doc_id", "text")
    for make in (lambda d: near_dedup.groups(d, Staging(spark, "t")), lambda d: dedup_exact.groups(d, Staging(spark, "t")),
                 lambda d: simhash.groups(d, Staging(spark, "t")), lambda d: fingerprints.compared(d)):
        assert sorted(map(str, make(docs).drop("row").collect())) == sorted(map(str, make(plain).drop("row").collect()))
    now = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        before = {tuple(r) for r in now.collect()}
        now = Staging(spark, "t").put(name, step(spark, now, SF))
        assert now.columns == docs.columns and {tuple(r) for r in now.collect()} <= before, name


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


# archives on a cluster

def test_archive_paths():
    assert warc.arrow_uri("file:/x/y") == warc.arrow_uri("file:///x/y") == warc.arrow_uri("/x/y") == "/x/y"
    assert warc.arrow_uri("s3a://bucket/x") == warc.arrow_uri("s3n://bucket/x") == "s3://bucket/x"
    assert warc.arrow_uri("hdfs://host:1/x") == "hdfs://host:1/x"
    assert warc.checked("file:/x", "local[2]") == "file:/x" and warc.checked("hdfs://h/x", "yarn") == "hdfs://h/x"
    for master in ("yarn", "spark://host:7077", "k8s://https://host"):
        with pytest.raises(ValueError):
            warc.checked("file:/x", master)


def test_archives_of_a_bare_path_and_their_readers(spark, folder, monkeypatch):
    assert warc.qualified(spark, folder) == f"file:{folder}"
    rows = [(i, f"http://e/{i}", "one payload of a third of all pages" if i % 3 == 0 else f"page {i} " * 20) for i in range(900)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    manifest = warc.write(pages, Staging(spark, "t"), archive_bytes=4_000)
    archives = manifest.count()
    assert archives > 20 and all(r["path"].startswith("file:/") for r in manifest.collect())
    monkeypatch.setattr(warc, "READERS", 7)
    found = warc.read(manifest)
    assert found.rdd.getNumPartitions() <= 7
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in found.collect()}
    assert got == {i: ("revisit", 0) if i % 3 == 0 and i else ("response", None) for i in range(900)}


def some_pages(spark, n=60):
    rows = [(i, f"http://e/{i}", f"page {i % 50} " * 40) for i in range(n)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def located(found):
    return {r["page_id"]: (r["record_type"], r["refers_to"], r["payload"] and bytes(r["payload"]).decode()) for r in found.collect()}


SOME = {i: ("revisit", i - 50, None) if i >= 50 else ("response", None, f"page {i} " * 40) for i in range(60)}


def test_archives_in_a_store_that_only_spark_opens(spark, folder):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.archives.link./shared", f"file://{folder}")
    with Staging(spark, "t") as stage:
        stage.path = "viewfs://archives/shared/t"
        manifest = warc.write(some_pages(spark), stage, archive_bytes=4_000)
        assert manifest.count() > 3 and all(r["path"].startswith("viewfs://archives/") for r in manifest.collect())
        assert located(warc.read(manifest)) == SOME


def test_archives_of_a_bare_path_on_a_cluster(spark, monkeypatch):
    """A bare path may be mounted on every machine: it is as good for archives as for the staged tables."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    assert located(warc.read(warc.write(some_pages(spark), Staging(spark, "t"), archive_bytes=4_000))) == SOME


def test_archive_files_and_their_counts(spark):
    manifest = warc.write(some_pages(spark), Staging(spark, "t"), archive_bytes=4_000).collect()
    for r in manifest:
        with open(r["path"].removeprefix("file:"), "rb") as file:
            data = file.read()
        records = list(warc.decompress(pa.BufferReader(data)))
        assert (r["records"], r["raw_bytes"], r["stored_bytes"]) == (len(records), sum(map(len, records)), len(data))
        assert data.endswith(warc.END.encode()) and all(map(warc.parse, records))
    assert sum(r["records"] for r in manifest) == 60


def test_lost_archives_are_an_error(spark, monkeypatch):
    import os

    manifest = warc.write(some_pages(spark), Staging(spark, "t"), archive_bytes=4_000)
    path = manifest.first()["path"]
    assert 0 < len(located(warc.read(manifest.filter(F.col("path") == path)))) < 60  # of some archives only
    os.remove(path.removeprefix("file:"))
    with pytest.raises(FileNotFoundError):
        warc.read(manifest)
    files = warc._files
    monkeypatch.setattr(warc, "_files", lambda *a: files(*a).limit(2))  # the driver's part of a folder that is not shared
    with pytest.raises(ValueError, match="executors share"):
        warc.write(some_pages(spark), Staging(spark, "t"), archive_bytes=4_000)
