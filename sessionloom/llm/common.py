"""Small helpers the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words are runs of anything but these six characters.
BREAK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def col(name: str) -> Column:
    """A column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def all_columns(df: DataFrame) -> list[Column]:
    return [col(c) for c in df.columns]


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for working columns that no column of ``df`` has, compared without case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def whole_text(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def utf8(text: Column) -> Column:
    return text.cast("binary")


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_tables: dict[tuple, object] = {}
_asked: set[tuple] = set()


def tables(build: Callable, source: str):
    """``build(source)``, kept in this worker from task to task until ``map_text`` works there for another operator."""
    key = (build, source)
    _asked.add(key)
    if key not in _tables:
        _tables[key] = build(source)
    return _tables[key]


def working(make: Callable):
    """``make()``; tables that it has not asked for leave this worker's memory."""
    _asked.clear()
    work = make()
    for key in _tables.keys() - _asked:
        del _tables[key]
    return work


def map_text(
    df: DataFrame,
    fields: list[T.StructField],
    make: Callable[[], Callable[[list[str]], list[list]]],
    text: str = "text",
    slice_rows: int = 256,
    keep: bool = True,
    slice_bytes: int = 1 << 17,
) -> DataFrame:
    """Append columns computed in Python from whole texts, in Arrow batches and without a shuffle.

    ``make`` runs once per task and returns a function from texts (null: empty) to one list of
    values per field; what it takes from ``tables`` is kept for the worker's next task. A batch
    is worked off in slices of at most ``slice_rows`` texts and, if more than one, ``slice_bytes``
    bytes of them, so that a task never holds more results, nor Spark larger batches of them.
    Without ``keep`` the texts themselves do not come back.
    """
    at = df.columns.index(text)
    back = [i for i in range(len(df.columns)) if keep or i != at]
    made_of = [*(df.schema.fields[i] for i in back), *fields]
    plain = [f"c{i}" for i in range(len(df.columns) + len(fields))]  # mapInArrow cannot take names with dots
    held = [T.StructField(n, f.dataType) for n, f in zip(plain, made_of)]
    types = [_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = working(make)
        for batch in batches:
            for part in _slices(batch, at, slice_rows, slice_bytes):
                made = work([t or "" for t in part.column(at).to_pylist()])
                columns = [*(part.column(i) for i in back), *(pa.array(v, type=t) for v, t in zip(made, types))]
                yield pa.RecordBatch.from_arrays(columns, names=plain[: len(columns)])

    return df.toDF(*plain[: len(df.columns)]).mapInArrow(run, T.StructType(held)).toDF(*(f.name for f in made_of))


def _slices(batch: pa.RecordBatch, at: int, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """Parts of at most so many rows, and so many bytes of column ``at`` unless one row has more."""
    start = held = 0
    for i, n in enumerate(pc.binary_length(batch.column(at)).to_pylist()):
        n = n or 0
        if i > start and (i - start == rows or held + n > size):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def _arrow_type(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow_type(t.elementType))
    if isinstance(t, T.StructType):
        return pa.struct([pa.field(f.name, _arrow_type(f.dataType)) for f in t.fields])
    return {
        "string": pa.string(), "binary": pa.binary(), "bigint": pa.int64(), "int": pa.int32(),
        "double": pa.float64(), "float": pa.float32(), "boolean": pa.bool_(),
    }[t.simpleString()]
