"""Partitioned Parquet sinks."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from sessionloom.operators.dedup import content_hash
from sessionloom.operators.shape import add_ymd
from sessionloom.operators.skew import SLOT, SLOTS, fits_broadcast, salted_left_join
from sessionloom.session import Staging

#: Rows that are worth a file of their own in a bounded write.
ROWS_PER_FILE = 1_000_000
#: Rows that one task joins and writes where files are not bounded.
ROWS_PER_TASK = 250_000
_SLOT, _SLOTS, _PICK = SLOT, SLOTS, "_pick"


def partition_slots(rows: DataFrame, by: list[str] | tuple[str, ...], max_files: int, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """``by`` and the number of files every partition gets: one per ``rows_per_file`` rows, ``max_files`` at most."""
    wanted = F.ceil(F.count(F.lit(1)) / rows_per_file)
    return rows.groupBy(*by).agg(F.least(wanted, F.lit(max_files)).cast("int").alias(_SLOTS))


def with_slots(df: DataFrame, slots: DataFrame, by: list[str] | tuple[str, ...], pick_by: list[str] | None = None) -> DataFrame:
    """Give every row its file, ``_slot``, within its partition.

    The slot is taken from ``pick_by`` or else from the whole row, so a retried task gives
    every row the same one. A partition that ``slots`` does not list is one file.
    """
    pick = F.xxhash64(*pick_by) if pick_by else content_hash(df)
    picked = df.withColumn(_PICK, pick)
    if fits_broadcast(slots):
        small = F.broadcast(slots.withColumnsRenamed({c: f"_s_{c}" for c in by}))
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in by])
        found = picked.join(small, same, "left").drop(*[f"_s_{c}" for c in by])
    else:
        found = salted_left_join(picked, slots, list(by), [_PICK])
    slot = F.pmod(F.col(_PICK), F.coalesce(_SLOTS, F.lit(1)))
    return found.withColumn(_SLOT, slot.cast("int")).drop(_PICK, _SLOTS)


def write_partitions(
    df: DataFrame, path: str, by: list[str] | tuple[str, ...], refresh: str = "touched", max_files: int | None = None,
    slots: DataFrame | None = None, pick_by: list[str] | None = None,
    seen: tuple[Observation, list[Column]] | None = None, only: Column | None = None, aside: tuple[str, ...] = (),
    deal_by: list[str] | None = None, finish: Callable[[DataFrame], DataFrame] | None = None,
    is_dealt: bool = False,
) -> None:
    """Write Parquet partitioned by ``by``.

    ``refresh="touched"`` replaces only the partitions that ``df`` has rows for,
    ``"all"`` the whole table. Rows are rebalanced by partition first: few files per
    small partition, while a partition that holds much of the data is split between
    tasks. ``max_files`` bounds the files of every partition: rows are dealt to at most so many
    slots per partition, and a slot is one task's, which AQE may merge with others but not
    split. How many slots a partition gets follows from its rows; ``slots`` is a
    ``partition_slots`` result that is known already (more rows than are written do no harm), else the rows are
    counted in a pass over the ``by`` columns. ``pick_by`` columns (a stored row number) deal
    the rows out, and are not written; without them rows that are equal share a slot.
    ``finish`` is applied to the rows once they are dealt out, for row-local columns that need not be
    shuffled; rows are dealt by ``deal_by`` then (``slots`` too), columns that tell the partitions apart.
    ``is_dealt`` rows come from a join by ``skew.Deal`` and are not shuffled again; its slots bound the files.
    """
    deal = list(deal_by or by)
    if refresh not in ("touched", "all"):
        raise ValueError(f"unknown refresh: {refresh}")
    if max_files is not None and max_files < 1:
        raise ValueError("max_files has to be 1 or more")
    if only is not None:
        bare = [c for c in df.columns if c not in (*by, *deal, *aside, *(pick_by or []))]
        df = df.withColumns({c: F.when(only, F.col(c)) for c in bare})
    if is_dealt:
        dealt = df
    elif max_files:
        if slots is None:  # staged, as it is asked for more than once
            slots = Staging(df.sparkSession, "slots").put("slots", partition_slots(df, deal, max_files))
        dealt = with_slots(df, slots, deal, pick_by).repartition(*deal, _SLOT).drop(_SLOT)
    else:
        dealt = df.hint("rebalance", *[F.col(c) for c in deal])
    if finish is not None:
        dealt = finish(dealt)
    if seen is not None:
        dealt = dealt.observe(seen[0], *seen[1])
    if only is not None:
        dealt = dealt.filter(only)
    writer = dealt.drop(*(pick_by or []), *aside).write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if refresh == "touched" else "static")
    if max_files:
        writer = writer.option("maxRecordsPerFile", 0)  # a session's own limit would split a slot's file
    writer.partitionBy(*by).parquet(path)


def clear_partitions(spark: SparkSession, path: str, partitions: list[dict[str, str]]) -> None:
    """Remove partition folders in one step, for days that a re-run leaves without rows."""
    sc = spark.sparkContext
    for partition in partitions:
        folder = sc._jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *[f"{k}={v}" for k, v in partition.items()]]))
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def append_audit(df: DataFrame, path: str) -> None:
    """Append audit rows, partitioned by run date."""
    add_ymd(df, "run_date").write.mode("append").partitionBy("year", "month", "day").parquet(path)
