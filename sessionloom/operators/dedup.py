"""Removing repeated records by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sessionloom.operators.skew import left_join, salted_left_join


def holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(holds_map(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return holds_map(dtype.elementType)
    return isinstance(dtype, (T.MapType, T.VariantType))


def content_hash(df: DataFrame, ignore: tuple[str, ...] = ()) -> Column:
    """Order among rows that tie on everything else; equal hashes mean equal rows."""
    return F.xxhash64(*[f.name for f in df.schema.fields if f.name not in ignore and not holds_map(f.dataType)])


def _first_per_id(df: DataFrame, by: list[str], order_by: list[str], ignore: tuple[str, ...]) -> DataFrame:
    ordered = Window.partitionBy(*by).orderBy(*order_by, content_hash(df, ignore))
    return df.withColumn("_rank", F.row_number().over(ordered)).filter(F.col("_rank") == 1).drop("_rank")


def duplicate_ids(df: DataFrame, id: str, keys: list[str] | None = None) -> DataFrame:
    """Ids that occur more than once, with ``copies``; reads the key columns only."""
    return (
        df.filter(F.col(id).isNotNull())
        .groupBy(*(keys or []), id)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def losers(rows: DataFrame, id: str, order_by: list[str], keys: list[str], row: str, repeated: DataFrame) -> DataFrame:
    """``keys`` and ``row`` of all rows but the first per id, by ``order_by`` and then ``row``.

    ``row`` numbers the rows within ``keys`` and is stored with them, so the survivor is the same
    whenever it is asked for. ``rows`` needs no other columns; only rows of ``repeated`` ids
    (from ``duplicate_ids``) are shuffled, an id with many copies is spread over many tasks.
    """
    by = [*keys, id]
    place = F.struct(*order_by, row)
    copied = rows.join(repeated.select(*by), by, "left_semi")
    first = copied.groupBy(*by).agg(F.min(place).alias("_first"))
    return salted_left_join(copied, first, by, [row]).filter(place != F.col("_first")).select(*keys, row)


_CHUNK, _BITS = "_chunk", "_bits"


def first_bits(rows: DataFrame, id: str, order_by: list[str], keys: list[str], row: str) -> DataFrame:
    """Bitmaps of the rows that come first among their id, by ``order_by`` and then ``row``: one per ``keys`` and 32,768 numbers.

    One narrow shuffle, combined before it, finds them; a bitmap takes an eighth of a byte per row. Rows without an id have no bit.
    """
    first = rows.filter(F.col(id).isNotNull()).groupBy(*keys, id).agg(F.min(F.struct(*order_by, row)).alias("_first"))
    number = F.col(f"_first.{row}")
    return first.groupBy(*keys, F.bitmap_bucket_number(number).alias(_CHUNK)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(_BITS))


def keep_first(rows: DataFrame, id: str, keys: list[str], row: str, bits: DataFrame) -> DataFrame:
    """The rows with a bit in ``first_bits``, for which ``skew.fits_broadcast`` holds, and those without an id; no row is shuffled."""
    numbered = rows.withColumn(_CHUNK, F.bitmap_bucket_number(F.col(row)))
    found = left_join(numbered, F.broadcast(bits), [*keys, _CHUNK])
    place = F.bitmap_bit_position(F.col(row)).cast("int")
    byte = F.conv(F.hex(F.substring(_BITS, F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.getbit(F.coalesce(byte, F.lit(0)), place % 8)
    return found.filter(F.col(id).isNull() | (bit == 1)).select(*rows.columns)


def dedup(
    df: DataFrame, id: str, order_by: list[str], keys: list[str] | None = None, repeated: DataFrame | None = None,
    ignore: tuple[str, ...] = (),
) -> DataFrame:
    """Keep the first row per id by ``order_by``; rows without an id are all kept.

    Rows without an id bypass the shuffle. Copies of one id are cut to one row per task
    before the shuffle, as Spark pushes the rank limit below the exchange. ``repeated``,
    a ``duplicate_ids`` result for which ``skew.fits_broadcast`` holds, limits the shuffle to the rows
    that have copies at all. Ties are broken by content, without the columns in ``ignore``.
    """
    by = [*(keys or []), id]
    if repeated is not None:
        ids = F.broadcast(repeated.select(*by))
        alone, copied = (df.join(ids, by, how).select(*df.columns) for how in ("left_anti", "left_semi"))
        return alone.unionByName(_first_per_id(copied, by, order_by, ignore))
    known = _first_per_id(df.filter(F.col(id).isNotNull()), by, order_by, ignore)
    return known.unionByName(df.filter(F.col(id).isNull()))
