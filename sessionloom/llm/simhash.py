"""Near-duplicate documents by SimHash, found through an inverted index over byte positions.

A fingerprint has 64 bits, eight bytes. Two fingerprints at ``distance`` 4 or less differ in at
most four bytes, so they agree in at least four of the eight positions. That is the count filter:
pairs are tallied by shared positional bytes, those that reach four are verified bit by bit.

1. One pass over the texts makes the fingerprints; a bit is set if it is set in over half of the
   shingles' XXH64 values, repeats included. Equal fingerprints are one node of the graph, known
   by its smallest doc_id, so copies are never expanded.
2. The index. A posting holds the fingerprints that agree in the bytes of a few positions. Any
   four of eight positions contain one of 20 fixed triples (a Turan system), so a pair that
   reaches the count meets in a posting of three bytes: 20 entries per fingerprint instead of
   the pairs of single-byte postings, which hold 1/256 of all fingerprints each.
3. In a posting of up to ``CROWD`` fingerprints the pairs are tallied and verified in numpy, a
   bounded number at a time, and only a spanning forest of the verified links leaves the task.
4. A larger posting is split by a fourth position (pairs that reach the count share one), and
   its postings of four bytes are worked off the same way.
5. What is larger even then is linked exactly without pairs: two fingerprints are at a distance
   of at most 4 just if some value is within 2 bits of both, so every fingerprint lists the
   2,081 values around it, and all that list a value are linked to the smallest of them.
6. Connected components of the links.

So nothing is capped and no group has to fit one task: the work is linear in the number of
fingerprints, times CROWD at most.

Defined results: words as in ``common.WORD``, A-Z lower-cased; fewer words than a shingle make
one shingle of all of them; a text that is null or has no words has fingerprint zero and is
linked like any other. Rows that share a doc_id are one node, linked by any of their texts. A
row without doc_id has a fingerprint, but no component and no links. An empty table gives no
rows. Columns other than doc_id and text do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sessionloom.llm.common import col, map_text
from sessionloom.llm.components import components
from sessionloom.operators.skew import fits_broadcast, salted_left_join
from sessionloom.session import Staging

SHINGLE_WORDS, SEED = 4, 42
DISTANCE, MATCHES, BYTES = 4, 4, 8
#: Fingerprints of a posting whose pairs are tallied; larger postings are split.
CROWD = 1024
#: Shingles hashed and pairs tallied at once; bounds the memory of long texts and full postings.
CHUNK, PAIRS = 4096, 1 << 19

_PARTS = ((0, 1, 2), (3, 4, 5), (6, 7))
#: Triples of positions within one part, or two of a part and one of the next: every four positions contain one.
TRIPLES = [t for t in combinations(range(BYTES), 3) if any(
    len(set(t) & set(p)) == 3 or (len(set(t) & set(p)) == 2 and len(set(t) & set(q)) == 1)
    for p, q in zip(_PARTS, _PARTS[1:] + _PARTS[:1]))]
QUADS = list(combinations(range(BYTES), 4))


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text as an unsigned number."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle_words, len(words))
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts, stops = np.concatenate(([0], stops[: len(words) - size])).tolist(), (stops[size - 1 :] - 1).tolist()
    hashed, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        some = [hashed(joined[a:b], SEED) for a, b in zip(starts[at : at + CHUNK], stops[at : at + CHUNK])]
        bits = np.unpackbits(np.array(some, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp`` of every document; ``fp`` has the fingerprint's 64 bits as a signed long."""
    def make():
        return lambda texts: [[np.uint64(fingerprint(t, shingle_words)).astype(np.int64) for t in texts]]

    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).cast("string").alias("text"))
    return map_text(rows, [T.StructField("fp", T.LongType())], make).drop("text")


def posting_key(fp: Column, which: int, positions: tuple[int, ...]) -> Column:
    """One long from the number of a set of positions and the bytes there."""
    key = F.lit(which).cast("long")
    for p in positions:
        key = F.shiftleft(key, 8).bitwiseOR(F.shiftrightunsigned(fp, 8 * p).bitwiseAND(F.lit(255)))
    return key


def _pairs(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of all pairs inside consecutive groups of these sizes, about ``PAIRS`` at a time."""
    ends = np.cumsum(sizes)
    after = np.repeat(ends, sizes) - np.arange(int(ends[-1]) if len(ends) else 0) - 1  # how many of its group follow
    until = np.concatenate(([0], np.cumsum(after)))
    at = 0
    while at < len(after):
        to = max(at + 1, int(np.searchsorted(until, until[at] + PAIRS, "right")) - 1)
        left = np.repeat(np.arange(at, to), after[at:to])
        yield left, left + 1 + np.arange(len(left)) - np.repeat(until[at:to] - until[at], after[at:to])
        at = to


def linked(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs share enough positional bytes and, of those, differ in few enough bits."""
    differ = x ^ y
    shared = (differ.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
    out = shared >= MATCHES
    out[out] = np.bitwise_count(differ[out]) <= DISTANCE
    return out


def forest(u: np.ndarray, v: np.ndarray, nodes: int) -> np.ndarray:
    """For every node the smallest node it is connected with."""
    label = np.arange(nodes)
    while True:
        least, new = np.minimum(label[u], label[v]), label.copy()
        np.minimum.at(new, u, least)
        np.minimum.at(new, v, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges ``u, v`` that connect the linked members of every posting of a batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        members = batch.column(0)
        sizes = np.diff(members.offsets.to_numpy().astype(np.int64))
        flat = members.flatten()
        fp = flat.field(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        rep = flat.field(1).to_numpy(zero_copy_only=False).astype(np.int64)
        label = np.arange(len(fp))
        for x, y in _pairs(sizes):
            near = linked(fp[x], fp[y])
            x, y = label[x[near]], label[y[near]]
            apart = x != y
            if apart.any():  # what is joined already is not joined again
                label = forest(x[apart], y[apart], len(fp))[label]
        own = np.flatnonzero(label != np.arange(len(fp)))
        yield pa.RecordBatch.from_pydict({"u": pa.array(rep[own], pa.int64()), "v": pa.array(rep[label[own]], pa.int64())})


def _around() -> list[int]:
    """The 2,081 patterns of at most two bits, as signed longs."""
    ones = [1 << i for i in range(64)]
    masks = [0, *ones, *(a | b for a, b in combinations(ones, 2))]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


class SimHashGraph:
    """The steps of one run; every intermediate table is staged."""

    def __init__(self, docs: DataFrame, stage: Staging, shingle_words: int = SHINGLE_WORDS, crowd: int = CROWD,
                 doc_id: str = "doc_id", text: str = "text"):
        self.stage, self.crowd = stage, crowd
        self.drawn = stage.put("drawn", fingerprints(docs, shingle_words, doc_id, text))
        known = self.drawn.filter("doc_id is not null")
        self.nodes = stage.put("nodes", known.groupBy("fp").agg(F.min("doc_id").alias("rep")))

    def groups(self) -> DataFrame:
        """``doc_id, fp, component_id``, one row per document."""
        root = components(self.links(), self.stage, "links")
        rooted = salted_left_join(self.nodes, root.withColumnRenamed("node", "rep"), ["rep"], ["fp"])
        rooted = rooted.select("fp", F.coalesce("root", "rep").alias("root"))
        found = salted_left_join(self.drawn, rooted, ["fp"], ["doc_id"])
        return found.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("root")).alias("component_id"))

    def links(self) -> DataFrame:
        """Edges ``u, v`` between nodes, by doc_id; they connect what is linked."""
        postings = [posting_key(F.col("fp"), i, t) for i, t in enumerate(TRIPLES)]
        small, large = self._postings("triples", self.nodes.select("fp", "rep", F.explode(F.array(*postings)).alias("key")))
        found = [small, self._same_id()]
        if large is not None:
            finer = [F.array(*[posting_key(F.col("fp"), QUADS.index(q), q) for q in QUADS if set(t) < set(q)]) for t in TRIPLES]
            which = F.shiftrightunsigned("key", 24).cast("int")
            quads = large.select("fp", "rep", F.explode(F.element_at(F.array(*finer), which + 1)).alias("key")).distinct()
            small, large = self._postings("quads", quads)
            found.append(small)
            if large is not None:
                found.append(self._by_midpoints(large.select("fp", "rep").distinct()))
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return self.stage.put("links", out.distinct())

    def _postings(self, name: str, entries: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """Links of the postings that are not crowded, and the entries of those that are."""
        crowded = self.stage.put(f"{name}_crowded", entries.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > self.crowd).select("key"))
        none = crowded.isEmpty()
        wanted = F.broadcast(crowded) if none or fits_broadcast(crowded) else crowded
        rest = entries if none else entries.join(wanted, "key", "left_anti")
        held = rest.groupBy("key").agg(F.collect_list(F.struct("fp", "rep")).alias("members")).filter(F.size("members") > 1)
        links = self.stage.put(f"{name}_links", held.select("members").mapInArrow(_links, "u long, v long").distinct())
        return links, None if none else entries.join(wanted, "key", "left_semi")

    def _by_midpoints(self, nodes: DataFrame) -> DataFrame:
        near = self.stage.put("near", nodes.select("rep", F.explode(F.transform(
            F.lit(_around()), lambda m: m.bitwiseXOR(F.col("fp")))).alias("value")))
        least = near.groupBy("value").agg(F.min("rep").alias("v"), F.max("rep").alias("last")).filter("v < last").drop("last")
        return near.join(least, "value").filter("rep <> v").select(F.col("rep").alias("u"), "v").distinct()

    def _same_id(self) -> DataFrame:
        """Edges from a doc_id whose rows have several fingerprints to those fingerprints' nodes."""
        several = self.drawn.filter("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b"))
        several = self.stage.put("several", several.filter("a < b").select("doc_id"))
        wanted = F.broadcast(several) if fits_broadcast(several) else several
        found = self.drawn.join(wanted, "doc_id", "left_semi").distinct().join(self.nodes, "fp")
        return found.filter("doc_id <> rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v")).distinct()


def groups(docs: DataFrame, stage: Staging, shingle_words: int = SHINGLE_WORDS, **options) -> DataFrame:
    """``doc_id, fingerprint, component_id``: 16 hex digits, and the smallest doc_id reachable over links."""
    found = SimHashGraph(docs, stage, shingle_words, **options).groups()
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
