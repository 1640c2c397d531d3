"""Salting that follows the data: keys are split only as far as their rows need it.

Every row of the large side gets one of ``SALTS`` salts from its own content. A
map-side-combined aggregate remembers, per key, which salts occur (a 64-bit
mask), and the small side is repeated for exactly those. A key with one row
keeps one copy; a key with a third of all rows is spread over all salts.
No hot-key list, threshold or broadcast is involved.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sessionloom.functions.times import local_time

SALTS = 64
SALT = "_salt"
_MASK, _LOW, _HIGH = "_salt_mask", "_salt_low", "_salt_high"


def with_salt(df: DataFrame, by: list[str]) -> DataFrame:
    """Add the salt, a pure function of ``by``: a retried task gives every row the same one."""
    return df.withColumn(SALT, F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int"))


def salt_marks() -> list[Column]:
    """Aggregates that remember the salts of a group."""
    return [
        F.bit_or(F.expr(f"shiftleft(1L, {SALT})")).alias(_MASK),
        F.min(SALT).alias(_LOW),
        F.max(SALT).alias(_HIGH),
    ]


def spread(df: DataFrame) -> DataFrame:
    """One row per salt that occurs in the group."""
    occurring = F.expr(
        f"if({_LOW} = {_HIGH}, array({_LOW}), "
        f"filter(sequence({_LOW}, {_HIGH}), i -> (shiftright({_MASK}, i) & 1L) = 1L))"
    )
    return df.withColumn(SALT, F.explode(occurring)).drop(_MASK, _LOW, _HIGH)


def copies_made() -> Column:
    """How many rows ``spread`` makes of a row."""
    return F.bit_count(_MASK)


def fits_broadcast(df: DataFrame, copies: Column | None = None, max_rows: int = 500_000, max_bytes: int = 256 << 20) -> bool:
    """Whether ``df``, every row taken ``copies`` times, is small enough to broadcast.

    Rows are counted first; a staged table answers that from its footers or one narrow
    column. Their bytes are measured only if the rows are few enough.
    """
    times = F.lit(1) if copies is None else copies
    if df.agg(F.coalesce(F.sum(times), F.lit(0)).alias("rows")).first()["rows"] > max_rows:
        return False
    width = F.octet_length(F.to_json(F.struct("*")))
    return df.agg(F.coalesce(F.sum(times * width), F.lit(0)).alias("bytes")).first()["bytes"] <= max_bytes


def salts_in(big: DataFrame, on: list[str], by: list[str]) -> DataFrame:
    """The salts that ``big`` uses under each key, one row per key."""
    return with_salt(big, by).groupBy(*on).agg(*salt_marks())


def salted_left_join(
    big: DataFrame, small: DataFrame, on: list[str], by: list[str], where: Column | None = None, hint: str | None = None
) -> DataFrame:
    """``big`` LEFT JOIN ``small`` on equal ``on`` and ``where``; one hot key of ``big`` uses many tasks.

    ``small`` carries the key columns under their own names and no other name of ``big``.
    """
    copies = spread(small.join(salts_in(big, on, by), on, "inner"))
    return left_join(with_salt(big, by), copies, [*on, SALT], where, hint).drop(SALT)


#: Hash buckets that rows are counted in by ``crowded_hashes``, and the rows of one that share a salt at least.
HASHES, ROWS_PER_SALT = 4096, 100_000
_HASH, _DEAL = "_hash", "_deal"


def _hash_of(on: list[str]) -> Column:
    return F.pmod(F.xxhash64(*on), F.lit(HASHES)).cast("int")


def crowded_hashes(big: DataFrame, on: list[str], rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Hash buckets of the ``on`` keys with many rows, and over how many salts those are dealt; at most a quarter of ``HASHES`` rows.

    A bucket has at least the rows of each of its keys. Counting takes ``HASHES`` rows per task, whatever
    the number of keys; stage the result, as a join asks for it on both sides.
    """
    counts = big.groupBy(_hash_of(on).alias(_HASH)).agg(F.count(F.lit(1)).alias("_rows"))
    share = counts.agg(F.greatest(F.lit(rows_per_salt), 4 * F.sum("_rows") / HASHES)).scalar()
    deal = F.least(F.lit(SALTS), F.ceil(F.col("_rows") / share)).cast("int")
    return counts.select(_HASH, deal.alias(_DEAL)).filter(F.col(_DEAL) > 1)


SLOT, SLOTS = "_slot", "_slots"


@dataclass(frozen=True)
class Deal:
    """Rows are dealt out by ``by`` and a slot: ``slots`` (broadcast) says how many slots every ``by`` has. One of them is the local ``date``.

    A join whose both sides are dealt out alike leaves its rows where they can be written, without another shuffle.
    """

    by: list[str]
    slots: DataFrame
    zone: str

    def out(self, df: DataFrame, hashed: list[str]) -> DataFrame:
        found = df.join(F.broadcast(self.slots), self.by, "left")
        slot = F.pmod(F.xxhash64(*hashed), F.coalesce(SLOTS, F.lit(1))).cast("int")
        return found.withColumn(SLOT, slot).drop(SLOTS).repartition(*self.by, SLOT)

    def dated(self, df: DataFrame, first: Column, last: Column) -> DataFrame:
        """``df`` once per local date that the epoch seconds ``first`` to ``last`` touch, a day at most."""
        dates = [local_time(F.timestamp_seconds(s).cast("timestamp_ntz"), self.zone).cast("date") for s in (first, last)]
        return df.withColumn("date", F.explode(F.array_distinct(F.array(*dates))))

    def left_join(self, big: DataFrame, small: DataFrame, on: list[str], hashed: list[str], where: Column | None = None) -> DataFrame:
        keys = [*on, *[c for c in [*self.by, SLOT] if c not in on]]
        return left_join(self.out(big, hashed), self.out(small, hashed), keys, where).drop(SLOT)


def dealt_left_join(
    big: DataFrame, small: DataFrame, on: list[str], by: list[str], crowded: DataFrame, hashed: list[str] | None = None,
    where: Column | None = None, deal: Deal | None = None,
) -> DataFrame:
    """``salted_left_join`` that salts the keys in ``crowded`` hash buckets only, so the keys of ``big`` are not shuffled to look for hot ones.

    ``crowded`` is a ``crowded_hashes`` result for the ``hashed`` columns, which are all of ``on`` or some of them.
    With a ``deal`` the joined rows are dealt out by it; ``small`` has its columns too then.
    """
    deals = F.broadcast(crowded)

    def dealt(df: DataFrame) -> DataFrame:
        return df.withColumn(_HASH, _hash_of(hashed or on)).join(deals, _HASH, "left")

    salt = F.coalesce(F.pmod(F.xxhash64(*by), F.col(_DEAL)), F.lit(0)).cast("int")
    rows = dealt(big).withColumn(SALT, salt).drop(_HASH, _DEAL)
    salts = F.sequence(F.lit(0), F.coalesce(F.col(_DEAL), F.lit(1)) - 1)
    copies = dealt(small).withColumn(SALT, F.explode(salts)).drop(_HASH, _DEAL)
    if deal is not None:
        return deal.left_join(rows, copies, [*on, SALT], [*(hashed or on), SALT], where).drop(SALT)
    return left_join(rows, copies, [*on, SALT], where).drop(SALT)


def left_join(
    big: DataFrame, small: DataFrame, on: list[str], where: Column | None = None, hint: str | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Left join on equal names plus a residual condition, key columns taken from ``big``.

    ``null_safe`` lets null keys meet null keys.
    """
    right = small.withColumnsRenamed({c: f"_r_{c}" for c in on})
    if hint:
        right = right.hint(hint)
    cond = where if where is not None else F.lit(True)
    for c in on:
        same = F.col(c).eqNullSafe(F.col(f"_r_{c}")) if null_safe else F.col(c) == F.col(f"_r_{c}")
        cond = same & cond
    return big.join(right, cond, "left").drop(*[f"_r_{c}" for c in on])
