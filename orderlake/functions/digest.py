"""A digest of a whole row, nested values included (operators A9, S9).

Maps have no order and cannot be compared in Spark, so a full-row dedupe of a table with a
map column fails.  Here every map becomes its entries sorted by key, at any depth, the row
becomes JSON text, and the text its SHA-256.  Equal rows have equal digests: a null value, an
empty array and an array of nulls differ; entries of a map in another order do not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Timestamps in full, so that rows that differ in microseconds differ.
_FORMAT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
           "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _holds_map(kind.elementType)


def canonical(value: Column, kind: T.DataType) -> Column:
    """``value`` with every map as an array of its entries, sorted by key."""
    if not _holds_map(kind):
        return value
    if isinstance(kind, T.MapType):
        entries = F.array_sort(F.map_entries(value), lambda a, b: F.when(a["key"] < b["key"], -1).otherwise(1))
        return F.transform(entries, lambda e: F.struct(
            e["key"].alias("key"), canonical(e["value"], kind.valueType).alias("value")))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: canonical(x, kind.elementType))
    fields = [canonical(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def row_digest(schema: T.StructType, skip: tuple[str, ...] = ()) -> Column:
    """SHA-256 of the columns of ``schema`` but those in ``skip``, by position in name order."""
    fields = sorted((f for f in schema.fields if f.name not in skip), key=lambda f: f.name)
    values = [canonical(F.col(f"`{f.name}`"), f.dataType).alias(f"c{i}") for i, f in enumerate(fields)]
    text = F.to_json(F.struct(*values), _FORMAT) if values else F.lit("")
    return F.sha2(text.cast("binary"), 256)


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Full-row dedupe (A9) of a table with columns of any type, maps included; which of several
    equal rows stays cannot be told."""
    return df.withColumn("__digest", row_digest(df.schema)).dropDuplicates(["__digest"]).drop("__digest")
