"""Exact dedup with a heavy-hitter split.

Texts are compared by the SHA-256 of the text lower-cased from A to Z only. The digests are
staged once, narrow; everything after reads that table.

1. Every task runs a Misra-Gries summary of ``counters`` counters over its digests. The
   summaries' counts are added up. They never add up to more than all rows n, so at most
   2 * counters digests reach n / (2 * counters): a proven bound for what is collected and
   broadcast. A digest with more than 1.5 n / counters rows always reaches it, because a
   summary undercounts by at most its rows / (counters + 1).
2. The heavy digests' exact size and winner come from one map-side-combined aggregate over
   their rows (verified winners). The result is broadcast, and their rows get their winner
   without a shuffle.
3. The remaining digests have at most 1.5 n / counters rows each and take an ordinary
   shuffle by digest.

Defined results: null counts as the empty text, and all such rows are one group. The row
with the largest doc_id stays; a null doc_id is below every other. Rows that agree in text
and doc_id are one document listed twice: of them the row with the largest hash over all its
columns stays (then the largest by its columns, in order), so the survivor does not depend on
the order or the partitions of the input; columns that hold maps are not compared. An empty table gives no
rows. Other columns of the input do not matter and may have any name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sessionloom.llm.common import all_columns, ascii_lower, col, free_names, utf8, whole_text
from sessionloom.operators.dedup import holds_map
from sessionloom.operators.skew import fits_broadcast
from sessionloom.session import Staging

#: Counters of a summary; bounds what is broadcast to twice as many digests.
COUNTERS = 4096


def digest(text: str = "text"):
    return F.unhex(F.sha2(utf8(ascii_lower(whole_text(text))), 256))


def frequent(digests: DataFrame, column: str, stage: Staging, counters: int = COUNTERS) -> DataFrame:
    """Misra-Gries: the values of ``column`` whose summed counts reach n / (2 * counters)."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        seen = 0
        for batch in batches:
            seen += batch.num_rows
            held.update(batch.column(0).to_pylist())
            if len(held) > counters:  # lower all by the largest count that does not fit
                least = sorted(held.values(), reverse=True)[counters]
                held = Counter({k: v - least for k, v in held.items() if v > least})
        values, counts = [*held.keys(), None], [*held.values(), seen]
        yield pa.RecordBatch.from_pydict({"v": pa.array(values, pa.binary()), "c": pa.array(counts, pa.int64())})

    held = digests.select(column).mapInArrow(summary, "v binary, c long")
    counted = stage.put("counted", held.groupBy("v").agg(F.sum("c").alias("c")))
    rows = counted.filter("v is null").first()["c"]  # at null: all rows
    return counted.filter((F.col("c") * (2 * counters) >= rows) & F.col("v").isNotNull()).select(F.col("v").alias(column))


def groups(docs: DataFrame, stage: Staging, counters: int = COUNTERS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One narrow row per document: ``doc_id, digest, keep_id, group_size, kept``."""
    rows = stage.put("digests", docs.select(
        col(doc_id).cast("long").alias("doc_id"), digest(text).alias("digest"), F.monotonically_increasing_id().alias("row"),
    ))
    heavy = stage.put("heavy", frequent(rows, "digest", stage, counters))
    first = F.max(F.struct(F.col("doc_id"), F.col("row")))
    winners = F.broadcast(
        rows.join(F.broadcast(heavy), "digest", "left_semi").groupBy("digest")
        .agg(first.alias("first"), F.count("*").alias("group_size"))
    )
    by_digest = Window.partitionBy("digest")
    of_heavy = rows.join(winners, "digest")
    of_others = (
        rows.join(F.broadcast(heavy), "digest", "left_anti")
        .withColumns({"first": first.over(by_digest), "group_size": F.count("*").over(by_digest)})
    )
    return of_heavy.unionByName(of_others).select(
        "doc_id", "digest", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("first.row") == F.col("row")).alias("kept"),
    )


def dedup(docs: DataFrame, stage: Staging, counters: int = COUNTERS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Losers are removed by an anti-join on their narrow keys: broadcast if ``fits_broadcast``
    has counted them, else shuffled. A document listed twice keeps one row.
    """
    found = stage.put("groups", groups(docs, stage, counters, doc_id, text))
    key, id_ = free_names(docs, "__digest", "__id")
    keyed = docs.withColumns({key: digest(text), id_: col(doc_id).cast("long")})
    losers = stage.put("losers", found.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", "digest").distinct())
    if fits_broadcast(losers):
        losers = F.broadcast(losers)
    same = (F.col(key) == losers["digest"]) & F.col(id_).eqNullSafe(losers["doc_id"])
    left = keyed.join(losers, same, "left_anti")
    twice = stage.put("twice", found.filter(~F.col("kept") & F.col("doc_id").eqNullSafe(F.col("keep_id")))
                      .select(F.col("digest").alias("d")).distinct())
    if twice.isEmpty():
        return left.select(*all_columns(docs))
    listed_twice = F.col(key) == twice["d"]
    copies = left.join(twice, listed_twice, "left_semi")
    plain = [f.name for f in docs.schema.fields if not holds_map(f.dataType)]
    place = F.struct(F.xxhash64(*[col(c) for c in plain]), *[col(c) for c in plain])
    (whole,) = free_names(copies, "__whole")
    once = copies.groupBy(key).agg(F.max_by(F.struct(*all_columns(copies)), place).alias(whole)).select(f"{whole}.*")
    return left.join(twice, listed_twice, "left_anti").unionByName(once).select(*all_columns(docs))
