"""Reading raw tables through any Spark format, with filters that reach the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sessionloom.config import Source, TableSpec, Tenant
from sessionloom.functions.times import epoch_ms
from sessionloom.operators.shape import coerce_timestamp, stringify


class Unreadable(RuntimeError):
    """A raw table could not be read."""


def read_table(spark: SparkSession, source: Source, tenant: Tenant, spec: TableSpec) -> DataFrame:
    """Scan one tenant's raw table with the spec's source-level type fixes."""
    names = {"prefix": tenant.prefix, "suffix": spec.suffix}
    reader = spark.read.format(source.format).options(**source.options)
    if source.name_option:
        reader = reader.option(source.name_option, "{prefix}_{suffix}".format(**names))
    try:
        df = reader.load(source.location.format(**names)) if source.location else reader.load()
        columns = df.columns  # resolves the schema now, so that a missing table fails here
    except Exception as e:
        raise Unreadable(str(e)) from e
    for path in spec.coerce_times:
        df = coerce_timestamp(df, path)
    return stringify(df, [c for c in spec.force_string if c in columns])


def time_window(df: DataFrame, c: str, lo: Column, hi: Column, encoding: str = "time", iso_text: bool = False) -> DataFrame:
    """Half-open time filter on the raw column, ``lo`` and ``hi`` being UTC literals.

    The column is compared in its own type, so the predicate is pushed to the scan.
    Text columns are left to the check after parsing; with ``iso_text`` they are compared as
    text first, with dates a day wider on each side (offsets reach 18 hours), which keeps
    every ISO-8601 text that can lie in the window.
    """
    dtype = df.schema[c].dataType
    if encoding == "epoch_ms":
        value, kind = epoch_ms(F.col(c), dtype), F.unix_millis
        lo, hi = (kind(b.cast("timestamp")) for b in (lo, hi))
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        value = F.col(c)
        lo, hi = lo.cast(dtype), hi.cast(dtype)
    elif iso_text and isinstance(dtype, T.StringType):
        value = F.col(c)
        lo, hi = (F.date_add(b.cast("date"), n).cast("string") for b, n in ((lo, -1), (hi, 2)))
    else:
        return df
    return df.filter((value >= lo) & (value < hi))


def date_range(df: DataFrame, lo: str, hi: str, c: str = "date") -> DataFrame:
    """Inclusive range of days."""
    return df.filter(F.col(c).between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))
