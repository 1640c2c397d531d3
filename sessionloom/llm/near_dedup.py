"""Near-duplicate documents by min-max MinHash.

Every permutation gives two values of a document's shingle set, its minimum and its maximum.
Either collides between two sets with a probability equal to their Jaccard similarity, so 75
permutations make a signature of 150 values at half the hash evaluations. Five values make a
band (bands of minima and of maxima are separate): a pair at similarity 0.8 shares one of the
30 bands with probability 1 - 7e-6, a pair at 0.3 with 7 percent.

1. One pass over the texts makes each document's set size, band keys, one byte per signature
   value, and a 128-bit hash of its word sequence. That narrow table is staged.
2. Documents with one word sequence form a class, represented by its smallest id (salted
   join, so that a class with a third of all rows is no one task's work). Only
   representatives go on.
3. A bucket of up to ``SMALL`` documents is tried in full. A larger one has a hub, its member
   that shares most buckets with others, and all are tried against the hub: as many pairs as
   rows. Confirmed links give components.
4. Pairs of a large bucket of which one end is not linked to the hub are still open where
   their components differ. Against a hub h of size H every member x of size n has the exact
   number m of h's shingles it lacks and its extras, the shingles h lacks. Whoever is linked to
   x has 0.8 n of its shingles in common with it, and at most H - m of those are h's, so x shares
   0.8 n - (H - m) of its extras at least. Where that is one or more, a pair shares one of the
   rarest extras of either (the first e - need + 1 of e, in the order of their frequency under
   the hub). First everyone is tried against one member per (hub, extra), which connects
   variants that share their extras without listing their pairs; then what is still apart
   meets by an equi-join on (hub, extra). Pairs that need no extra in common are small against
   the hub; they follow from the distinct sizes under (hub, size class), as linked sizes differ by a
   quarter at most. All are tried in full, so no pair that shares a bucket is left undecided
   unless its ends are connected already. There is no cap.
5. A pair is tried by its signature bytes (75 of 150 have to agree; a pair at 0.8 has 120 on
   average, with a deviation of 5), then by the whole shingle sets (64-bit hashes), which
   alone decide.

Defined results: a text without words (null, empty, blank) has the empty set and is linked
with nothing; fewer words than a shingle make one shingle of all of them. Rows that share a
doc_id are one node of the graph, linked by any of their texts, and stay or go together; equal
rows have equal results. A null doc_id is linked with nothing, its component is null and it is kept. An
empty table gives no rows. Columns other than doc_id and text do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sessionloom.llm.common import all_columns, col, free_names, map_text
from sessionloom.llm.components import components
from sessionloom.operators.skew import fits_broadcast, salted_left_join
from sessionloom.session import Staging

PERMUTATIONS, ROWS = 75, 5
VALUES = 2 * PERMUTATIONS
AGREE = VALUES // 2
#: Shingles permuted at once; bounds the memory that a very long text needs.
CHUNK = 4096
REMEMBERED = 50_000
PERCENT = 80
#: Buckets up to this size are tried in full.
SMALL = 8

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_FACTOR = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2)
_BAND = _RANDOM.integers(0, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    """Words of the text with A-Z lower-cased; ``bytes`` knows just the six breaks and A-Z."""
    return text.encode("utf-8", "replace").lower().split()


class WordHashes(dict):
    """64-bit hashes of words, forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_set(words: list[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        out = out * _STEP + h[i : len(h) - size + 1 + i]
    return np.unique(_mixed(out))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima, then maxima, of the set under every permutation."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for start in range(0, len(shingles), CHUNK):
        moved = _FACTOR[:, None] * shingles[None, start : start + CHUNK] + _SHIFT[:, None]
        low, high = np.minimum(low, moved.min(axis=1)), np.maximum(high, moved.max(axis=1))
    return np.concatenate([low, high])


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band's own factors keep the bands apart."""
    return _mixed((_mixed(sig) * _BAND).reshape(-1, ROWS).sum(axis=1, dtype=np.uint64)).astype(np.int64)


def sketches(docs: DataFrame, shingle_words: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n, seq, bands, bytes`` of every document; the last three null without words."""
    fields = [
        T.StructField("n", T.LongType()), T.StructField("seq", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("bytes", T.BinaryType()),
    ]

    def make():
        hashes = WordHashes()

        def work(texts):
            n, seq, bands, low = [], [], [], []
            for t in texts:
                words = words_of(t)
                shingles = shingle_set(words, shingle_words, hashes)
                n.append(len(shingles))
                if not words:
                    seq.append(None), bands.append(None), low.append(None)
                    continue
                sig = signature(shingles)
                seq.append(xxhash.xxh3_128_digest(b" ".join(words)))
                bands.append(band_keys(sig))
                low.append(_mixed(sig).astype(np.uint8).tobytes())
            return [n, seq, bands, low]

        return work

    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).cast("string").alias("text"))
    return map_text(rows, fields, make, keep=False)


def shingle_sets(rows: DataFrame, shingle_words: int) -> DataFrame:
    """``rid, shingles`` of ``rid, text``."""

    def make():
        hashes = WordHashes()
        return lambda texts: [[shingle_set(words_of(t), shingle_words, hashes).astype(np.int64) for t in texts]]

    return map_text(rows, [T.StructField("shingles", T.ArrayType(T.LongType()))], make, keep=False)


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs ``a, b`` whose signature bytes agree often enough."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, VALUES) for i in (2, 3))
        near = pa.array((x == y).sum(axis=1) >= AGREE)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], names=["a", "b"])


class NearDuplicates:
    """The steps of one run; every intermediate table is staged."""

    def __init__(self, docs: DataFrame, stage: Staging, shingle_words: int = 5, percent: int = PERCENT,
                 doc_id: str = "doc_id", text: str = "text"):
        self.texts = docs.select(col(doc_id).cast("long").alias("rid"), col(text).cast("string").alias("text"))
        self.stage, self.shingle_words, self.percent = stage, shingle_words, percent
        drawn = stage.put("sketches", sketches(docs, shingle_words, doc_id, text))
        several = (
            drawn.filter("seq is not null and doc_id is not null").groupBy("seq")
            .agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")).filter("rep < last").select("seq", "rep")
        )
        self.classed = stage.put("classed", salted_left_join(drawn, several, ["seq"], ["doc_id"]).select(
            "doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep"), "bands", "bytes"))
        self.reps = self.classed.filter("doc_id = rep and bands is not null").select(F.col("rep").alias("rid"), "n", "bands", "bytes")

    def groups(self) -> DataFrame:
        """``doc_id, n_shingles, component_id, kept``, one row per document."""
        crowded = self._crowded()
        x, y = (crowded.filter(F.col("members") <= SMALL).select("key", F.col("rid").alias(p)) for p in "ab")
        direct = self._likely("direct", x.join(y, "key").filter("a < b").select("a", "b").distinct())
        stars = self._stars(crowded)
        ids = direct.select(F.explode(F.array("a", "b")).alias("rid")).unionByName(stars.select(F.explode(F.array("hub", "rid")).alias("rid")))
        self.sets = self._sets(self.stage.put("ids", ids.distinct()))
        stars = self._measured(stars)
        links = self.stage.put("links", self._confirmed(direct).unionByName(
            stars.filter("linked").select(F.col("hub").alias("u"), F.col("rid").alias("v"))).unionByName(self._same_id()))
        labels = components(links, self.stage, "first")
        members = self._open(stars, labels)
        if not members.isEmpty():
            keys = self._keys(members)
            for name, pairs in (("led", self._led), ("open", self._undecided)):
                labels = self._joined(name, labels, pairs(keys, members, labels))
        found = salted_left_join(
            self.classed.select("doc_id", "n", "rep"), labels.withColumnRenamed("node", "rep"), ["rep"], ["doc_id"])
        root = F.coalesce("root", "rep")
        return found.select(
            "doc_id", F.col("n").alias("n_shingles"), root.alias("component_id"),
            F.coalesce(F.col("doc_id") == root, F.lit(True)).alias("kept"),
        )

    def _same_id(self) -> DataFrame:
        """Edges ``u, v`` from a doc_id whose rows are in several classes to the classes' representatives."""
        several = self.classed.filter("doc_id is not null").groupBy("doc_id").agg(F.min("rep").alias("r"), F.max("rep").alias("s"))
        several = self.stage.put("several", several.filter("r < s").select("doc_id"))
        wanted = F.broadcast(several) if fits_broadcast(several) else several
        found = self.classed.filter("rep <> doc_id").select("doc_id", "rep").join(wanted, "doc_id", "left_semi")
        return found.select(F.col("doc_id").alias("u"), F.col("rep").alias("v")).distinct()

    def _crowded(self) -> DataFrame:
        """``key, rid, members`` of the buckets with two or more representatives."""
        banded = self.reps.select("rid", F.explode("bands").alias("key"))
        sizes = banded.groupBy("key").agg(F.count("*").alias("members"), F.min("rid").alias("r"), F.max("rid").alias("s"))
        shared = salted_left_join(banded, sizes.filter("r < s").drop("r", "s"), ["key"], ["rid"])
        return self.stage.put("crowded", shared.filter("members is not null"))

    def _stars(self, crowded: DataFrame) -> DataFrame:
        """``hub, rid``: every member of a large bucket with the bucket's hub."""
        scores = crowded.groupBy("rid").agg(F.sum("members").alias("score"))
        large = crowded.filter(F.col("members") > SMALL).join(scores, "rid")
        hubs = large.groupBy("key").agg(F.max_by("rid", F.struct(F.col("score"), -F.col("rid"))).alias("hub"))
        return self.stage.put("stars", salted_left_join(large, hubs, ["key"], ["rid"]).filter("rid <> hub").select("hub", "rid").distinct())

    def _sets(self, ids: DataFrame) -> DataFrame:
        """``rid, shingles`` of the documents that are compared; moves texts only if their ids cannot be broadcast."""
        wanted = F.broadcast(ids) if fits_broadcast(ids) else ids
        return self.stage.put("sets", shingle_sets(self.texts.join(wanted, "rid", "left_semi"), self.shingle_words))

    def _similar(self, both: Column, size: Column) -> Column:
        """Whether sets with ``both`` in common and ``size`` elements together, common ones twice, are linked."""
        return both * 100 >= (size - both) * self.percent

    def _measured(self, stars: DataFrame) -> DataFrame:
        """Stars with the hub's size, what the member lacks of it, its extras, and whether the two are linked."""
        hubs = self.sets.select(F.col("rid").alias("hub"), F.col("shingles").alias("hub_set"))
        pairs = salted_left_join(stars, hubs, ["hub"], ["rid"]).join(self.sets, "rid")
        pairs = pairs.select("hub", "rid", F.size("hub_set").alias("whole"), F.size("shingles").alias("own"),
                             F.array_except("shingles", "hub_set").alias("extras"))
        both = F.col("own") - F.size("extras")
        return self.stage.put("measured", pairs.withColumns({
            "lacks": F.col("whole") - both, "more": F.size("extras"), "linked": self._similar(both, F.col("whole") + F.col("own"))}).drop("own"))

    def _joined(self, name: str, labels: DataFrame, pairs: DataFrame) -> DataFrame:
        """The components after these pairs have been tried."""
        more = self.stage.put(f"{name}_links", self._confirmed(self._likely(name, pairs)))
        if more.isEmpty():
            return labels
        return components(labels.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more), self.stage, f"{name}_graph")

    @staticmethod
    def _rooted(rows: DataFrame, labels: DataFrame) -> DataFrame:
        """Add the component of every ``rid``."""
        of = labels.select(F.col("node").alias("rid"), "root")
        return rows.join(of, "rid", "left").withColumn("root", F.coalesce("root", "rid"))

    def _open(self, stars: DataFrame, labels: DataFrame) -> DataFrame:
        """Members of the hubs whose members are in several components, with the extras they share with a linked one at least."""
        placed = self.stage.put("placed", self._rooted(stars, labels))
        mixed = placed.groupBy("hub").agg(F.min("root").alias("r"), F.max("root").alias("s")).filter("r < s").select("hub", F.lit(True).alias("mixed"))
        own = F.col("whole") - F.col("lacks") + F.col("more")
        least = F.ceil(own * self.percent / 100 - 1e-9) - (F.col("whole") - F.col("lacks"))
        found = salted_left_join(placed.drop("root"), mixed, ["hub"], ["rid"]).filter("mixed").drop("mixed")
        return self.stage.put("members", found.withColumns({"own": own, "least": least}).filter("least <= more"))

    def _keys(self, members: DataFrame) -> DataFrame:
        """``hub, extra`` of the rarest extras of every member, as many as it takes to meet all that it can be linked to."""
        each = members.select("hub", "rid", F.explode("extras").alias("extra"))
        common = each.groupBy("hub", "extra").agg(F.count("*").alias("times")).filter("times > 1")
        ranked = salted_left_join(each, common, ["hub", "extra"], ["rid"]).groupBy("hub", "rid").agg(
            F.array_sort(F.collect_list(F.struct(F.coalesce("times", F.lit(1)).alias("times"), "extra"))).alias("ranked"))
        head = F.slice("ranked", F.lit(1), (F.col("more") - F.greatest(F.col("least"), F.lit(1)) + 1).cast("int"))
        rows = members.filter("more > 0").drop("extras").join(ranked, ["hub", "rid"])
        rows = rows.select("hub", "rid", "linked", "whole", "lacks", "more", F.explode(head).alias("x"))
        return self.stage.put("keys", rows.filter("x.times > 1").select("*", "x.extra").drop("x"))

    def _led(self, keys: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs ``a, b`` of one member per (hub, extra) with the others, where those are in several components."""
        rows = self._rooted(keys.select("hub", "extra", "rid"), labels)
        leads = rows.groupBy("hub", "extra").agg(F.min("rid").alias("lead"), F.min("root").alias("r"), F.max("root").alias("s"))
        found = salted_left_join(rows, leads.filter("r < s").drop("r", "s"), ["hub", "extra"], ["rid"]).filter("rid <> lead")
        return found.select(F.least("rid", "lead").alias("a"), F.greatest("rid", "lead").alias("b")).distinct()

    def _undecided(self, keys: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs ``a, b`` under one hub, in different components, that can still be linked."""
        apart = "x_root <> y_root and (y_linked or x_rid < y_rid)"
        what = ("rid", "root", "linked", "lacks", "more")

        def side(p: str, rows: DataFrame, *names: str, also: tuple[str, ...] = ()) -> DataFrame:
            return rows.select("hub", *also, *[F.col(n).alias(f"{p}_{n}") for n in names])

        # what needs extras in common meets by one of them, under keys that still hold several components
        rows = self._rooted(keys, labels)
        several = rows.groupBy("hub", "extra").agg(F.min("root").alias("r"), F.max("root").alias("s")).filter("r < s").select("hub", "extra")
        rows = self.stage.put("apart", rows.join(several, ["hub", "extra"], "left_semi"))
        x, y = side("x", rows.filter("not linked"), *what, also=("extra", "whole")), side("y", rows, *what, also=("extra",))
        fits = self._needed() <= F.least("x_more", "y_more")
        tried = x.join(y, ["hub", "extra"]).filter(F.expr(apart) & fits).select("hub", "x_rid", "y_rid").distinct()
        given = tried.join(side("x", members, "rid", "extras", "lacks", "more", also=("whole",)), ["hub", "x_rid"])
        given = given.join(side("y", members, "rid", "extras", "lacks", "more"), ["hub", "y_rid"])
        sharing = given.filter(F.size(F.array_intersect("x_extras", "y_extras")) >= self._needed())

        # what needs none: both ends are small against the hub, and of sizes a quarter apart at most
        bare = self._rooted(members.filter("least <= 0").drop("extras"), labels).withColumn("class", F.floor(F.log("own") / F.lit(math.log(100 / min(self.percent, 99)))).cast("int"))
        near = F.explode(F.array(*[F.col("class") + i for i in (-1, 0, 1)]))
        sizes = bare.groupBy("hub", "class", "whole", "lacks", "more").agg(F.bool_or(~F.col("linked")).alias("loose"))
        meets = side("x", sizes.filter("loose"), "lacks", "more", also=("class", "whole")).join(
            side("y", sizes.withColumn("class", near), "lacks", "more", also=("class",)), ["hub", "class"]).filter(self._needed() <= 0)
        both = (
            meets.select("hub", "x_lacks", "x_more", "y_lacks", "y_more")
            .join(side("x", bare.filter("not linked"), "rid", "root", "lacks", "more"), ["hub", "x_lacks", "x_more"])
            .join(side("y", bare, *what), ["hub", "y_lacks", "y_more"]).filter(apart)
        )
        both = sharing.select("x_rid", "y_rid").unionByName(both.select("x_rid", "y_rid"))
        return both.select(F.least("x_rid", "y_rid").alias("a"), F.greatest("x_rid", "y_rid").alias("b")).distinct()

    def _needed(self) -> Column:
        """Extras that members of these sizes have in common at least if they are linked; none if not positive.

        Linked sets have at least p / (100 + p) of their two sizes' sum in common, and of the
        hub's shingles at most ``whole - max(lacks)``.
        """
        size = F.col("whole") * 2 - F.col("x_lacks") + F.col("x_more") - F.col("y_lacks") + F.col("y_more")
        return F.ceil(size * self.percent / (100 + self.percent) - 1e-9) - (F.col("whole") - F.greatest("x_lacks", "y_lacks"))

    def _likely(self, name: str, pairs: DataFrame) -> DataFrame:
        """The pairs ``a, b`` whose sizes allow a link and whose signature bytes agree often enough."""
        a, b = (self.reps.select(F.col("rid").alias(p), F.col("n").alias(f"{p}_n"), F.col("bytes").alias(f"{p}_bytes")) for p in "ab")
        sized = pairs.join(a, "a").join(b, "b").filter(f"100 * least(a_n, b_n) >= {self.percent} * greatest(a_n, b_n)")
        return self.stage.put(name, sized.select("a", "b", "a_bytes", "b_bytes").mapInArrow(_agreeing, "a long, b long").distinct())

    def _confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose whole sets are similar enough, as edges ``u, v``."""
        x, y = (self.sets.select(F.col("rid").alias(p), F.col("shingles").alias(f"{p}_set")) for p in "ab")
        both = F.size(F.array_intersect("a_set", "b_set"))
        close = self._similar(both, F.size("a_set") + F.size("b_set"))
        return pairs.join(x, "a").join(y, "b").filter(close).select(F.col("a").alias("u"), F.col("b").alias("v"))


def groups(docs: DataFrame, stage: Staging, shingle_words: int = 5, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: the component is the smallest doc_id reachable over links."""
    return NearDuplicates(docs, stage, shingle_words, percent).groups()


def dedup(docs: DataFrame, stage: Staging, shingle_words: int = 5, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose id is its component's smallest, with all their columns."""
    dropped = stage.put("dropped", groups(docs, stage, shingle_words, percent).filter("not kept").select("doc_id").distinct())
    if fits_broadcast(dropped):
        dropped = F.broadcast(dropped)
    (id_,) = free_names(docs, "__id")
    rows = docs.withColumn(id_, col("doc_id").cast("long"))
    return rows.join(dropped, rows[id_] == dropped["doc_id"], "left_anti").select(*all_columns(docs))
