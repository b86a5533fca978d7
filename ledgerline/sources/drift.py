"""Column types that change from file to file: wider types, and a column for values that still do not fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources.tables import Lake

RESCUED = "_rescued"
#: Whole numbers beyond this are not exact as doubles.
EXACT = 2**53
_SIMPLE = (T.LongType, T.DoubleType, T.BooleanType, T.TimestampType, T.StringType)


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds values of both: whole numbers fit doubles, and text holds everything."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    return T.DoubleType() if {type(a), type(b)} == {T.LongType, T.DoubleType} else T.StringType()


def widened(known: T.StructType, seen: T.StructType) -> T.StructType:
    """The known columns with types that hold the seen ones too, then the new columns."""
    new = {f.name: f.dataType for f in seen.fields}
    fields = [T.StructField(f.name, wider(f.dataType, new.get(f.name, f.dataType)), True) for f in known.fields]
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in seen.fields if f.name not in known.names])


def as_text(schema: T.StructType) -> T.StructType:
    """The schema to read files with so that no value is lost: simple columns as text."""
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, _SIMPLE) else f.dataType, True) for f in schema.fields])


def fitted(value: Column, kind: T.DataType) -> Column:
    """The text as a value of the type, NULL where it is none or where it would not stay what it is."""
    if isinstance(kind, T.DoubleType):
        whole = value.try_cast("decimal(38,0)")
        # A whole number stays whole as text; "1.5" is none, so it is judged as a double alone.
        inexact = F.coalesce((F.abs(whole) > F.lit(EXACT)) & ~F.contains(value, F.lit(".")) & ~F.lower(value).contains("e"), F.lit(False))
        return F.when(~inexact, value.try_cast(kind))
    return value.try_cast(kind)


def _not_back(name: str, kind: T.DataType):
    return lambda k, v: (k != F.lit(name)) | fitted(v, kind).isNull()


def _map(entries: Column) -> Column:
    made = F.map_from_entries(entries)
    return F.when(F.size(made) > 0, made)


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns read as text in their types; values that do not fit are NULL there and kept in ``_rescued``.

    ``_rescued`` maps the column's name to the text, and is NULL for rows that fit. Other columns are carried.
    """
    simple = [f for f in schema.fields if isinstance(f.dataType, _SIMPLE) and not isinstance(f.dataType, T.StringType)]
    kinds = {f.name: f.dataType for f in simple}
    out = [fitted(F.col(f"`{c}`"), kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns]
    lost = [
        F.when(F.col(f"`{f.name}`").isNotNull() & fitted(F.col(f"`{f.name}`"), f.dataType).isNull(), F.struct(F.lit(f.name).alias("key"), F.col(f"`{f.name}`").alias("value")))
        for f in simple
    ]
    none = F.lit(None).cast("map<string,string>")
    rescued = _map(F.filter(F.array(*lost), lambda x: x.isNotNull())) if lost else none
    return df.select(*out, rescued.alias(RESCUED))


def settle(lake: Lake, name: str, schema: T.StructType) -> T.StructType:
    """Bring a stored table to the schema's wider types, and rescued values back that fit by now.

    A column is rewritten at most twice in its life, to doubles and to text, in one pass for all columns that change.
    Whole numbers that doubles would not keep make the column text. Returns the schema that came of it.
    """
    if not lake.exists(name):
        return schema
    df = lake.read(name)
    old = {f.name: f.dataType for f in df.schema.fields}
    # Never narrower than what is stored: a column may have been text for want of a value.
    kinds = {f.name: wider(old[f.name], f.dataType) if f.name in old else f.dataType for f in schema.fields}
    changed = [c for c in old if c in kinds and old[c] != kinds[c]]
    settled = lambda: T.StructType([T.StructField(f.name, kinds[f.name], True) for f in schema.fields])
    if not changed:
        return settled()
    risky = [c for c in changed if isinstance(old[c], T.LongType) and isinstance(kinds[c], T.DoubleType)]
    if risky:
        top = df.agg(*[F.max(F.abs(F.col(f"`{c}`").cast("decimal(20,0)"))).alias(str(k)) for k, c in enumerate(risky)]).first()
        kinds |= {c: T.StringType() for k, c in enumerate(risky) if top[k] is not None and top[k] > EXACT}
    kept = F.col(RESCUED) if RESCUED in old else F.lit(None).cast("map<string,string>")
    out, left = [], kept
    for c in df.columns:
        if c not in changed:
            out.append(F.col(f"`{c}`"))
            continue
        back = fitted(kept[F.lit(c)], kinds[c])
        out.append(F.coalesce(F.col(f"`{c}`").cast(kinds[c]), back).alias(c))
        left = F.map_filter(left, _not_back(c, kinds[c]))
    out = [x for x, c in zip(out, df.columns) if c != RESCUED] + [F.when(F.size(left) > 0, left).alias(RESCUED)]
    lake.overwrite(name, df.select(*out))
    return settled()


def rescued_counts(df: DataFrame) -> DataFrame:
    """(column, values): how many values of each column stand in ``_rescued``."""
    names = df.select(F.explode(F.map_keys(RESCUED)).alias("column"))
    return names.groupBy("column").agg(F.count(F.lit(1)).alias("values"))
