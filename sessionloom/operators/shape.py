"""Schema operators: flatten, stringify, rename, cast and complete columns. All are row-local."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sessionloom.functions.times import local_time, utc_time, ymd

NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


class MissingColumns(ValueError):
    """A table lacks columns that its spec needs."""


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def flatten_struct(df: DataFrame, name: str = "body") -> DataFrame:
    """Replace struct ``name`` by its fields; a frame without it is returned as it is."""
    dtype = _types(df).get(name)
    if not isinstance(dtype, T.StructType):
        return df
    clash = sorted(set(dtype.fieldNames()) & (set(df.columns) - {name}))
    if clash:
        raise ValueError(f"fields of {name} collide with columns: {', '.join(clash)}")
    return df.select("*", f"{name}.*").drop(name)


def text_of(c: Column, dtype: T.DataType) -> Column:
    """JSON text of a nested value; strings stay, other atomics are cast."""
    if isinstance(dtype, T.StringType):
        return c
    return F.to_json(c) if isinstance(dtype, NESTED) else c.cast("string")


def stringify(df: DataFrame, cols: list[str] | tuple[str, ...]) -> DataFrame:
    """Turn the columns of ``cols`` that exist into text."""
    types = _types(df)
    return df.withColumns({c: text_of(F.col(c), types[c]) for c in cols if c in types})


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns that exist; two columns with one new name are an error."""
    present = {old: new for old, new in names.items() if old in df.columns}
    final = [present.get(c, c) for c in df.columns]
    clash = sorted({c for c in final if final.count(c) > 1})
    if clash:
        raise ValueError(f"rename gives more than one column named: {', '.join(clash)}")
    return df.withColumnsRenamed(present)


def ensure_columns(df: DataFrame, wanted: dict[str, T.DataType | str]) -> DataFrame:
    """Add missing columns as typed nulls."""
    missing = {c: t for c, t in wanted.items() if c not in df.columns}
    return df.withColumns({c: F.lit(None).cast(t) for c, t in missing.items()})


def require_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fail before planning when a needed column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumns("Column not found: " + ", ".join(missing))
    return df


def enforce_schema(df: DataFrame, casts: dict[str, T.DataType]) -> DataFrame:
    """Cast known columns; a value that does not fit gives null instead of failing the job."""
    types = _types(df)
    changes = {c: F.col(c).try_cast(t) for c, t in casts.items() if c in types and types[c] != t}
    return df.withColumns(changes)


def _without_void(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.NullType):
        return T.StringType()
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _without_void(f.dataType), f.nullable) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_without_void(dtype.elementType), dtype.containsNull)
    if isinstance(dtype, T.MapType):
        return T.MapType(_without_void(dtype.keyType), _without_void(dtype.valueType), dtype.valueContainsNull)
    return dtype


def fix_void(df: DataFrame) -> DataFrame:
    """Give void columns, also those inside nested types, the string type."""
    fixed = {c: (t, _without_void(t)) for c, t in _types(df).items()}
    return df.withColumns({c: F.col(c).cast(new) for c, (old, new) in fixed.items() if old != new})


def coerce_timestamp(df: DataFrame, path: str) -> DataFrame:
    """Parse the text field at dotted ``path`` as a timestamp; other types and missing fields stay."""
    head, *inner = path.split(".")
    dtype = _types(df).get(head)
    for name in inner:
        if not isinstance(dtype, T.StructType) or name not in dtype.fieldNames():
            return df
        dtype = dtype[name].dataType
    if not isinstance(dtype, T.StringType):
        return df
    parsed = F.try_to_timestamp(F.col(path))
    return df.withColumn(head, F.col(head).withField(".".join(inner), parsed) if inner else parsed)


def event_time(df: DataFrame, c: str, zone: str = "UTC", encoding: str = "time") -> DataFrame:
    """Add ``event_timestamp_utc``, ``event_timestamp_local`` and the local ``date``."""
    utc = utc_time(F.col(c), _types(df)[c], encoding)
    return (
        df.withColumn("event_timestamp_utc", utc)
        .withColumn("event_timestamp_local", local_time(F.col("event_timestamp_utc"), zone))
        .withColumn("date", F.to_date("event_timestamp_local"))
    )


def localize(
    df: DataFrame, cols: list[str] | tuple[str, ...], zone: str, encodings: dict[str, str] | None = None
) -> DataFrame:
    """Add ``<c>_utc`` and ``<c>_local`` for each time column that exists."""
    types, how = _types(df), encodings or {}
    utc = {c: utc_time(F.col(c), types[c], how.get(c, "time")) for c in cols if c in types}
    return df.withColumns({f"{c}_utc": v for c, v in utc.items()}).withColumns(
        {f"{c}_local": local_time(F.col(f"{c}_utc"), zone) for c in utc}
    )


def finalize_times(df: DataFrame, cols: list[str] | tuple[str, ...]) -> DataFrame:
    """Promote ``<c>_local`` to ``<c>`` and drop the raw and UTC twins."""
    promoted = {f"{c}_local": c for c in ("event_timestamp", *cols) if f"{c}_local" in df.columns}
    twins = [n for c in promoted.values() for n in (c, f"{c}_utc")]
    return df.drop(*twins).withColumnsRenamed(promoted)


def add_ymd(df: DataFrame, date: str = "date") -> DataFrame:
    """Add the partition columns ``year``, ``month`` and ``day``."""
    return df.withColumns(ymd(F.col(date)))


def union_tenants(frames: list[DataFrame]) -> DataFrame:
    """Union by name; a column whose type differs between frames becomes text in all of them."""
    seen: dict[str, set[str]] = {}
    for df in frames:
        for name, dtype in _types(df).items():
            if not isinstance(dtype, T.NullType):
                seen.setdefault(name, set()).add(dtype.simpleString())
    mixed = [name for name, kinds in seen.items() if len(kinds) > 1]
    level = [stringify(df, mixed) for df in frames]
    while len(level) > 1:  # pairwise, so that the plan of many tenants stays shallow
        pairs = [level[i:i + 2] for i in range(0, len(level), 2)]
        level = [p[0].unionByName(p[1], allowMissingColumns=True) if len(p) > 1 else p[0] for p in pairs]
    return level[0]
