"""One schema for the stored rows of a table and a new batch (operator S9).

Columns are matched by name, ignoring case; the stored spelling stays.  The result has every
stored column, in stored order, then the new ones of the batch.  A column that one side lacks
is null there.  Types may differ where every value of one fits the other (``WIDER``); structs,
arrays and maps are matched field by field.  Everything else is refused, with all the columns
at fault, before a row is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types whose every value the key's type can be widened to without loss.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "float", "double"),
    "smallint": ("int", "bigint", "float", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}


class SchemaConflict(ValueError):
    """Stored and new types of a column that no common type holds."""


def _by_name(schema: T.StructType) -> dict[str, T.StructField]:
    out: dict[str, T.StructField] = {}
    for f in schema.fields:
        if f.name.lower() in out:
            raise SchemaConflict(f"two columns are named {f.name}")
        out[f.name.lower()] = f
    return out


def common_type(stored: T.DataType, new: T.DataType, at: str, faults: list[str]) -> T.DataType:
    """The type that holds both; faults are collected under the path ``at``."""
    if isinstance(stored, T.StructType) and isinstance(new, T.StructType):
        return common_schema(stored, new, at, faults)
    if isinstance(stored, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(common_type(stored.elementType, new.elementType, f"{at}[]", faults))
    if isinstance(stored, T.MapType) and isinstance(new, T.MapType):
        if stored.keyType != new.keyType:
            faults.append(f"{at}: map keys {stored.keyType.simpleString()} and {new.keyType.simpleString()}")
        return T.MapType(stored.keyType, common_type(stored.valueType, new.valueType, f"{at}{{}}", faults))
    if isinstance(stored, T.DecimalType) and isinstance(new, T.DecimalType):
        scale = max(stored.scale, new.scale)
        whole = max(stored.precision - stored.scale, new.precision - new.scale)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    if isinstance(stored, T.NullType) or isinstance(new, T.NullType):
        return new if isinstance(stored, T.NullType) else stored
    a, b = stored.simpleString(), new.simpleString()
    if a == b or a in WIDER.get(b, ()):
        return stored
    if b in WIDER.get(a, ()):
        return new
    faults.append(f"{at}: {a} is stored, {b} comes")
    return stored


def common_schema(stored: T.StructType, new: T.StructType, at: str = "", faults: list[str] | None = None) -> T.StructType:
    """Stored fields in their order, then the new ones, all nullable; raises on conflicts when called
    without ``faults``."""
    found: list[str] = [] if faults is None else faults
    coming = _by_name(new)
    fields = []
    for name, field in _by_name(stored).items():
        other = coming.pop(name, None)
        kind = field.dataType if other is None else \
            common_type(field.dataType, other.dataType, f"{at}.{field.name}".lstrip("."), found)
        fields.append(T.StructField(field.name, kind, True))
    fields += [T.StructField(f.name, f.dataType, True) for f in coming.values()]
    if faults is None and found:
        raise SchemaConflict("columns that cannot be reconciled: " + "; ".join(found))
    return T.StructType(fields)


def _shaped(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` of type ``have`` as type ``want``, one that ``common_type`` gave."""
    if have == want:
        return value
    if isinstance(want, T.StructType):
        given = _by_name(have)
        fields = [(_shaped(value.getField(given[f.name.lower()].name), given[f.name.lower()].dataType, f.dataType)
                   if f.name.lower() in given else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: _shaped(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType):
        return F.transform_values(value, lambda _, x: _shaped(x, have.valueType, want.valueType))
    return value.cast(want)


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` with the columns and types of a ``common_schema``; columns they lack are null."""
    given = _by_name(rows.schema)
    return rows.select(*(
        (_shaped(F.col(f"`{given[f.name.lower()].name}`"), given[f.name.lower()].dataType, f.dataType)
         if f.name.lower() in given else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields))
