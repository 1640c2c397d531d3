"""SimHash links and centroid clusters against brute force, and odd inputs."""

import hashlib
import itertools
import math
import random

import numpy as np
import pytest
import xxhash

from sessionloom.llm import centroids, queries, simhash
from sessionloom.session import Staging

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, fp long, `a.b` int, rep string, key string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "r", "k") for i, t in rows], DOCS)


def plain_simhash(text, size=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, distance=4):
    """Smallest doc_id reachable, of (doc_id, fingerprint) rows; rows of one doc_id are one node."""
    root = {i: i for i, _ in nodes}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, x), (j, y) in itertools.combinations(nodes, 2):
        if (x ^ y).bit_count() <= distance:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root}


def test_every_four_positions_contain_a_triple():
    assert len(simhash.TRIPLES) == 20
    assert all(any(set(t) < set(q) for t in simhash.TRIPLES) for q in simhash.QUADS)


def test_fingerprints_of_texts():
    rng = random.Random(1)
    texts = ["", " \n\t", "One", "one TWO three", "a b c d", "É é A a É", "x " * 9000, "the \x0b same\x0c the same the same",
             *(" ".join(rng.choice("abcdefg") * rng.randint(1, 9) for _ in range(rng.randint(1, 400))) for _ in range(40))]
    assert [simhash.fingerprint(t) for t in texts] == [plain_simhash(t) for t in texts]


def test_whole_table_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    nodes = [(r["doc_id"], plain_simhash(r["text"])) for r in rows]
    want = plain_components(nodes)
    found = queries.op12_simhash_near_dedup(spark, SF).collect()
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found) == sorted((i, f"{x:016x}", want[i]) for i, x in nodes)
    assert len(set(want.values())) < len(want)


class FromNumbers(simhash.SimHashGraph):
    """A graph whose fingerprints are given."""

    def __init__(self, spark, nodes, crowd):
        self.stage, self.crowd = Staging(spark, "t"), crowd
        signed = [(i, x - (1 << 64) if x >> 63 else x) for i, x in nodes]
        self.drawn = self.stage.put("drawn", spark.createDataFrame(signed, "doc_id long, fp long").repartition(5))
        known = self.drawn.filter("doc_id is not null")
        self.nodes = self.stage.put("nodes", known.groupBy("fp").agg({"doc_id": "min"}).withColumnRenamed("min(doc_id)", "rep"))


def flipped(rng, x, bits):
    for b in rng.sample(range(64), bits):
        x ^= 1 << b
    return x


@pytest.mark.parametrize("crowd", [1024, 6, 2])
def test_links_in_crowded_postings_equal_brute_force(spark, crowd):
    """A dense family, chains at the limit, one bit in each of four bytes, and postings of every size."""
    rng = random.Random(crowd)
    centre, nodes = rng.getrandbits(64), []
    for _ in range(120):
        nodes.append(flipped(rng, centre, rng.randint(0, 5)))
    for _ in range(12):
        x = rng.getrandbits(64)
        nodes += [x, x ^ 0x0101010100000000, x ^ 0x0000000080808080, x ^ 0xF, x ^ 0x1F00, flipped(rng, x, 4), flipped(rng, x, 5)]
    x = rng.getrandbits(64)
    for _ in range(10):  # a chain whose ends are far apart
        x = flipped(rng, x, 4)
        nodes.append(x)
    head = rng.getrandbits(32)
    nodes += [head << 32 | rng.getrandbits(32) for _ in range(40)]  # a posting of four bytes without links
    nodes = [(3 * i, x) for i, x in enumerate(nodes)]
    found = FromNumbers(spark, nodes, crowd).groups().collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == plain_components(nodes)


def test_simhash_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (3, text.upper()), (9, "alone here"), (9, text), (7, None), (4, ""), (8, " \n"), (11, "two words"), (11, "two words"),
            (12, "other"), (9, "other"), (20, "x " * 50_000), (21, "x " * 49_000)]
    found = simhash.groups(docs_of(spark, [*rows, (None, text), (None, "only here")]).repartition(3), Staging(spark, "t")).collect()
    nodes = [(i, plain_simhash(t)) for i, t in rows]
    want = plain_components(nodes)
    assert want[12] == want[9] == 3 and want[8] == 4 and want[21] == 20
    got = sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found if r["doc_id"] is not None)
    assert got == sorted((i, f"{x:016x}", want[i]) for i, x in nodes)
    assert {r["component_id"] for r in found if r["doc_id"] is None} == {None}
    assert simhash.groups(docs_of(spark, rows).limit(0), Staging(spark, "t")).count() == 0


# centroid clusters

VECTORS = "vec_id long, embedding array<float>, cluster string, `v.d` int, n int"


def plain_clusters(rows, k, rounds):
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 4 and all(x is not None and math.isfinite(x) for x in v)]
    spot = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    centres = [v for _, v in sorted(kept, key=lambda r: (spot(r[0]), r[1]))[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min(range(len(centres)), key=lambda c: (far(v, centres[c]), c))
    for _ in range(rounds):
        at = [near(v) for _, v in kept]
        for c in range(len(centres)):
            mine = [v for (_, v), a in zip(kept, at) if a == c]
            if mine:
                centres[c] = [sum(x) // len(mine) for x in zip(*mine)]
    out = [(i, near(v), far(v, centres[near(v)])) for i, v in kept]
    return [(i, c, d, sum(x[2] for x in out if x[1] == c), sum(x[2] for x in out),
             hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()) for i, c, d in out]


def clustered(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, "c", 1, 2) for i, v in rows], VECTORS).repartition(4)
    found = centroids.cluster(frame, Staging(spark, "t"), dimensions=4, **options)
    return [tuple(r) for r in found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()]


def by_text(rows):
    return sorted(map(str, rows))


def test_clusters_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(c % 3, 0.3), rng.gauss(0, 1), rng.choice([0.0, 0.5, -0.5]), float(c)]) for i, c in enumerate(rng.choices(range(6), k=300))]
    rows += [(900, [1.0, 2.0, 3.0]), (901, [1.0, None, 0.0, 0.0]), (902, [math.nan, 0.0, 0.0, 0.0]), (903, [math.inf, 0.0, 0.0, 0.0]),
             (904, None), (905, []), (7, rows[7][1]), (7, [0.0, 0.0, 0.0, 0.0]), (None, [0.1, 0.1, 0.1, 0.1]), (906, [1e30, 0.0, 0.0, 0.0])]
    want = plain_clusters([r for r in rows if r[0] != 906], 8, 3)
    assert by_text(clustered(spark, rows, centroids=8)) == by_text(want)


def test_ties_equal_vectors_and_few_rows(spark):
    same = [(i, [0.25, 0.25, 0.25, 0.25]) for i in range(40)]  # all centroids are one point
    assert by_text(clustered(spark, same, centroids=5)) == by_text(plain_clusters(same, 5, 3))
    square = [(i, [float(x), float(y), 0.0, 0.0]) for i, (x, y) in enumerate(itertools.product([-1, 0, 1], repeat=2))]
    assert by_text(clustered(spark, square, centroids=4, rounds=2)) == by_text(plain_clusters(square, 4, 2))
    few = square[:3]
    assert by_text(clustered(spark, few, centroids=16)) == by_text(plain_clusters(few, 16, 3))
    assert clustered(spark, few[:0] or [(1, None)]) == []


def test_bounds_never_exceed_distances_and_spare_work():
    rng = np.random.default_rng(6)
    centres = rng.integers(-400, 400, (16, 64))
    x = np.concatenate([centres[rng.integers(0, 16, 4000)] + rng.integers(-30, 30, (4000, 64)), centres, centres * 1000])
    pivots = centroids.Pivots(centres[:5])
    cached = pivots.distances(x)
    low = pivots.bounds(cached, pivots.distances(centres))
    true = np.sqrt(np.stack([centroids.squared(x, c) for c in centres], axis=1).astype(float))
    assert (low * (1 - centroids.SLACK) <= true).all()
    best, distance, tried = centroids.nearest(x, cached, centres, pivots)
    assert (best == true.argmin(axis=1)).all() and (distance == centroids.squared(x, centres[best])).all()
    assert tried < 0.5 * true.size
