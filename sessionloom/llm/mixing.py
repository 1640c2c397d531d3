"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

1. A narrow aggregate measures every source. Sources in code-point order, null last, weigh
   1, 2, 3, repeating, and share the mix size; a target stops at ``most`` times its source's
   size and the excess goes to the others by weight. With the sources in the order of
   limit / weight that is one running sum, no loop.
2. Each source is dealt into shards of about ``shard_tokens`` by a hash of the document id; a
   shard's documents in hash order are one stream of tokens, cut into blocks of
   ``block_tokens``. Blocks are numbers, never rows.
3. All blocks of the mix go to sources by highest quotients target / (2 j - 1), and each
   source's quota to its shards in the same way: integer quotas per shard. Only quotients
   near the cut are made, at most some seven per source or shard.
4. A shard with quota q of k blocks takes each block q div k times, and q mod k blocks once
   more: every k/(q mod k)-th one from a seeded phase on, in the seeded order of documents.
   What a document gives follows from its offset in the stream alone.

The hot source is split into shards by its size, so no window sees more than a shard; rows
are shuffled once, by (source, shard), and rows without words not at all. What is ordered over
all sources (weights, limits, quotients) is sorted by range, with running sums per range and
the sums before it, so a source value per document is no one task's work either. A source's
own shards are ordered together. Reruns agree: nothing depends on partitioning or arrival order.

Defined results: a null or empty text has size 0 and gives nothing; a null source is a source
of its own, a null doc_id hashes like the empty text; repeated rows are separate documents
that share a place in the order, so which of them gives more is open, but not the multiset
of results. An empty table gives no rows. Other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sessionloom.llm.common import all_columns, col, free_names
from sessionloom.operators.skew import fits_broadcast, salted_left_join
from sessionloom.session import Staging

BLOCK_TOKENS, SHARD_TOKENS, MOST, SEED = 32, 2_000_000, 3, "mix-1"
#: Fractions of a document are whole numbers of this many bits.
WHOLE_BITS = 30


def seeded(text: Column, seed: str) -> Column:
    """60 bits of the MD5 of seed and text: the same number on any engine."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), text).cast("binary")), 1, 15), 16, 10).cast("long")


def running(df: DataFrame, order: list[Column], sums: dict[str, Column], stage: Staging, name: str) -> DataFrame:
    """Add sums over all rows up to each one, itself included, in one order of all rows; staged.

    Rows are sorted by range. A task sums up one range, and the sums of the ranges before it,
    one row per range, are broadcast.
    """
    rows = stage.put(name, df.orderBy(*order).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    whole = rows.groupBy("_range").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    offsets = whole.select("_range", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before_{n}") for n in sums])
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumns({n: F.sum(c).over(inside) for n, c in sums.items()}).join(F.broadcast(offsets), "_range")
    return found.withColumns({n: F.col(n) + F.col(f"_before_{n}") for n in sums}).drop("_range", *[f"_before_{n}" for n in sums])


def targets(sized: DataFrame, most: int = MOST, stage: Staging | None = None) -> DataFrame:
    """``source, source_size, weight, target`` of rows ``source, size``; one row per source."""
    stage = stage or Staging(sized.sparkSession, "targets")
    by_name = [F.col("source").isNull(), F.col("source")]
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = running(per, by_name, {"weight": F.lit(1)}, stage, "sources_by_name")
    per = per.withColumn("weight", (F.col("weight") - 1) % 3 + 1).withColumn("_limit", F.col("source_size") * most)
    filled = running(per, [F.col("source_size") / F.col("weight"), *by_name], {"_full": F.col("_limit"), "_gone": F.col("weight")}, stage, "sources_by_limit")
    whole = filled.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()  # of all sources
    full, gone = F.col("_full") - F.col("_limit"), F.col("_gone") - F.col("weight")
    levelled = stage.put("levels", filled.withColumn("_level", (F.lit(whole["s"]) - full) / (F.lit(whole["w"]) - gone)))
    level = levelled.agg(F.max("_level").alias("level")).first()["level"]
    target = F.least(F.col("_limit").cast("double"), F.lit(level).cast("double") * F.col("weight"))
    return levelled.select("source", "source_size", "weight", target.alias("target"))


def _bounds(votes: Column, all_votes: Column, several: Column) -> dict[str, Column]:
    """Between ``_low`` and ``_high`` lies the quota of a part."""
    scaled = votes / all_votes * F.col("seats")
    slack = (several * 3 + 8) / F.greatest(F.col("seats"), F.lit(1))
    v = F.coalesce(scaled, F.lit(0.0))
    return {
        "_low": F.least(F.col("room"), F.greatest(F.lit(0), F.floor(v * (1 - slack)) - 1)),
        "_high": F.least(F.col("room"), F.ceil(v * (1 + slack)) + 1),
    }


def apportioned_over_all(parts: DataFrame, name: str, stage: Staging) -> DataFrame:
    """``apportioned`` with all parts in one group, however many; ``parts`` is staged."""
    whole = parts.agg(F.count("*").alias("n"), F.sum("votes").alias("v")).first()
    sized = stage.put("bounds", parts.withColumns(_bounds(F.col("votes"), F.lit(whole["v"]).cast("double"), F.lit(whole["n"]))))
    taken = sized.agg(F.coalesce(F.sum("_low"), F.lit(0)).alias("low")).first()["low"]
    tried = sized.filter("_high > _low and votes > 0").select(
        name, (F.col("seats") - F.lit(taken)).alias("_open"), "votes", F.explode(F.sequence(F.col("_low") + 1, F.col("_high"))).alias("_j"))
    order = [(F.col("votes") / (F.col("_j") * 2 - 1)).desc(), F.col(name), F.col("_j")]
    won = running(tried, order, {"_rank": F.lit(1)}, stage, "quotients").filter("_rank <= _open")
    won = won.groupBy(name).agg(F.count("*").alias("_won"))
    return sized.join(won, name, "left").withColumn("quota", F.col("_low") + F.coalesce("_won", F.lit(0))).drop("_low", "_high", "_won")


def apportioned(parts: DataFrame, within: list[str], name: list[str]) -> DataFrame:
    """Sainte-Lague: add ``quota``, the integer share of each part in the ``seats`` of its group.

    ``parts`` has a share ``votes`` (double), the group's ``seats`` and the part's ``room``.
    Ties go to the part that sorts first by ``name``.
    """
    group = Window.partitionBy(*within)
    several = F.count("*").over(group)
    sized = parts.withColumns({"_all": F.sum("votes").over(group), "_several": several})
    sized = sized.withColumns(_bounds(F.col("votes"), F.col("_all"), F.col("_several"))).drop("_all", "_several")
    key = [*within, *name]
    tried = sized.withColumn("_open", F.col("seats") - F.sum("_low").over(group)).filter("_high > _low and votes > 0")
    tried = tried.select(*key, "votes", "_open", F.explode(F.sequence(F.col("_low") + 1, F.col("_high"))).alias("_j"))
    best = Window.partitionBy(*within).orderBy((F.col("votes") / (F.col("_j") * 2 - 1)).desc(), *name, "_j")
    won = tried.withColumn("_rank", F.row_number().over(best)).filter("_rank <= _open")
    won = won.groupBy(*key).agg(F.count("*").alias("_won"))
    return sized.join(won, key, "left").withColumn("quota", F.col("_low") + F.coalesce("_won", F.lit(0))).drop(
        "_low", "_high", "_won")


class Mix:
    """The plan of one mix; ``sized`` is staged and has ``doc_id`` (text), ``source``, ``size``."""

    def __init__(self, sized: DataFrame, stage: Staging, block_tokens: int = BLOCK_TOKENS,
                 shard_tokens: int = SHARD_TOKENS, most: int = MOST, seed: str = SEED):
        self.stage, self.block, self.seed, self.most = stage, block_tokens, seed, most
        per = targets(sized, most, stage).withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_tokens)))
        self.sources = stage.put("sources", per.withColumn("src", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))))
        self.quotas = self._quotas(sized)

    def placed(self, rows: DataFrame) -> DataFrame:
        """Add ``src`` and ``shard`` to rows with ``doc_id, source``."""
        small = self.sources.select("src", "shards")
        keyed = rows.withColumn("src", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
        if fits_broadcast(small):
            joined = keyed.join(F.broadcast(small), "src")
        else:
            joined = salted_left_join(keyed, small, ["src"], ["doc_id"])
        spot = seeded(F.coalesce("doc_id", F.lit("")), self.seed)
        return joined.withColumns({"spot": spot, "shard": spot % F.col("shards")}).drop("shards")

    def _quotas(self, sized: DataFrame) -> DataFrame:
        """``src, shard, tokens, blocks, quota, phase`` and the source's columns, one row per shard."""
        shards = self.placed(sized).groupBy("src", "shard").agg(F.sum("size").alias("tokens")).filter("tokens > 0")
        shards = self.stage.put("shards", shards.withColumn("blocks", F.ceil(F.col("tokens") / self.block)))
        per = shards.groupBy("src").agg(F.sum("blocks").alias("own")).join(
            self.sources.select("src", "source_size", "target"), "src")
        per = per.withColumns({"votes": F.col("target") / F.col("source_size") * F.col("own"), "room": F.col("own") * self.most})
        per = self.stage.put("votes", per)
        total = per.agg(F.floor(F.coalesce(F.sum("votes"), F.lit(0.0)) + 1e-6).alias("total")).first()["total"]
        seats = self.stage.put("source_quotas", apportioned_over_all(per.withColumn("seats", F.lit(total).cast("long")), "src", self.stage))
        parts = shards.join(seats.select("src", "own", F.col("quota").alias("seats")), "src").withColumns({
            "votes": F.col("blocks").cast("double"), "room": F.col("blocks") * self.most})
        dealt = apportioned(parts, ["src"], ["shard"])
        phase = seeded(F.concat("src", F.lit("/"), F.col("shard").cast("string")), self.seed) % F.col("blocks")
        return self.stage.put("quotas", dealt.select("src", "shard", "blocks", "quota", phase.alias("phase")))

    def taken(self, rows: DataFrame) -> DataFrame:
        """Add ``taken`` to rows with ``doc_id, source, size`` and whatever else."""
        wordless = rows.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
        return self._taken(rows.filter("size > 0")).drop("src", "shard", "spot").unionByName(wordless)

    def whole(self, rows: DataFrame) -> DataFrame:
        """Add ``copies``, how often a document comes whole, to rows with ``doc_id, source, size`` above 0."""
        order = Window.partitionBy("src", "shard").orderBy("size", "spot", "doc_id", "taken")
        part = F.floor((F.col("taken") % F.col("size")) * (1 << WHOLE_BITS) / F.col("size"))
        phase = seeded(F.concat("src", F.lit("/"), F.col("shard").cast("string")), f"{self.seed}/whole") % (1 << WHOLE_BITS)
        dealt = self._taken(rows).withColumns({"part": part, "phase": phase})
        end = F.sum("part").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("phase")
        more = F.shiftright("end", WHOLE_BITS) - F.shiftright(F.col("end") - F.col("part"), WHOLE_BITS)
        made = dealt.withColumn("end", end).withColumn("copies", F.floor(F.col("taken") / F.col("size")) + more)
        return made.drop("src", "shard", "spot", "part", "phase", "end")

    def _taken(self, rows: DataFrame) -> DataFrame:
        placed = self.placed(rows).join(self.quotas, ["src", "shard"], "left")
        order = Window.partitionBy("src", "shard").orderBy("spot", "doc_id", "size")
        end = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
        placed = placed.withColumn("end", end)
        extra, blocks, block = F.col("quota") % F.col("blocks"), F.col("blocks"), F.lit(self.block)

        def chosen(j: Column) -> Column:  # of the first j blocks
            return F.floor((j * extra + F.col("phase")) / blocks)

        def before(x: Column) -> Column:  # tokens taken once more of the first x
            j = F.floor(x / block)
            return block * chosen(j) + (x - j * block) * (chosen(j + 1) - chosen(j))

        once_more = before(F.col("end")) - before(F.col("end") - F.col("size"))
        taken = F.floor(F.col("quota") / blocks) * F.col("size") + once_more
        return placed.withColumn("taken", F.coalesce(taken, F.lit(0))).drop("blocks", "quota", "phase", "end")

    def with_targets(self, rows: DataFrame) -> DataFrame:
        """Add ``source_size`` and ``target`` to rows with ``source``."""
        small = self.sources.select("src", "source_size", "target")
        keyed = rows.withColumn("src", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
        if fits_broadcast(small):
            return keyed.join(F.broadcast(small), "src").drop("src")
        return salted_left_join(keyed, small, ["src"], ["doc_id"]).drop("src")


def mixed(docs: DataFrame, size: Column, stage: Staging, **options) -> DataFrame:
    """The documents of the mix, with all their columns.

    A document comes floor(taken / size) times, and once more with the remaining fraction as
    its chance: the fractions of a shard's documents, in the order of size, are one running
    sum from a seeded phase on, and a document comes once more where the sum passes a whole
    number. So every document has its expected copies, and the words of a shard differ from
    what the mix takes by less than its longest document. Places in the order decide, not
    ids: null and repeated ids are spread like others.
    """
    doc_id, source, size_, copies = free_names(docs, "__id", "__source", "__size", "__copies")
    given = docs.withColumns({doc_id: col("doc_id").cast("string"), source: col("source").cast("string"), size_: size})
    sized = stage.put("sized", given.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(size_).alias("size")))
    plan = Mix(sized, stage, **options)
    rows = given.filter(F.col(size_) > 0).select(
        F.struct(*all_columns(docs)).alias("row"), F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(size_).alias("size"))
    out = plan.whole(rows).withColumn(copies, F.col("copies").cast("int")).filter(F.col(copies) > 0)
    return out.select(F.explode(F.array_repeat("row", F.col(copies))).alias("row")).select("row.*")
