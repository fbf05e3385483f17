"""Bronze reading and document parsing (operators S1 and S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

from orderlake.functions.scalars import evaluated_once
from orderlake.sources.schema import BRONZE_DDL, ORDER_DOCUMENT_DDL, order_document_schema

DOCUMENT_COLUMN = "orderDetails"
#: Most records in a file of JSON lines; some 10 KB each before compression.
RECORDS_PER_FILE = 50_000


def read_documents(spark: SparkSession, path: str, infer_schema: bool = False) -> DataFrame:
    """Read newline-delimited JSON bronze records.

    By default the outer record schema is declared (``orderDetails STRING``), which skips
    the schema-inference pass over all input files; ``infer_schema=True`` gives the
    inferred behaviour for ad-hoc files.
    """
    reader = spark.read if infer_schema else spark.read.schema(BRONZE_DDL)
    return reader.json(path)


def parse_json_column(df: DataFrame, column: str, schema: str = ORDER_DOCUMENT_DDL,
                      options: dict[str, str] | None = None) -> DataFrame:
    """Replace a JSON text column by its typed struct (S3), in place.

    Permissive: null text gives a null struct, malformed text a struct of nulls, a field
    of the wrong type a null field.
    """
    return df.withColumn(column, F.from_json(F.col(column), schema, options or {}))


def _drop_paths(dtype: DataType, paths: set[tuple[str, ...]]) -> DataType:
    if isinstance(dtype, ArrayType):
        return ArrayType(_drop_paths(dtype.elementType, paths), dtype.containsNull)
    if isinstance(dtype, MapType):
        return MapType(dtype.keyType, _drop_paths(dtype.valueType, paths),
                       dtype.valueContainsNull)
    if isinstance(dtype, StructType):
        fields = []
        for f in dtype.fields:
            if (f.name,) in paths:
                continue
            sub = {p[1:] for p in paths if len(p) > 1 and p[0] == f.name}
            fields.append(StructField(f.name, _drop_paths(f.dataType, sub) if sub
                                      else f.dataType, f.nullable))
        return StructType(fields)
    return dtype


def _keep_paths(dtype: DataType, paths: set[tuple[str, ...]]) -> DataType:
    if isinstance(dtype, ArrayType):
        return ArrayType(_keep_paths(dtype.elementType, paths), dtype.containsNull)
    if isinstance(dtype, StructType):
        fields = []
        for f in dtype.fields:
            sub = {p[1:] for p in paths if p[0] == f.name}
            if sub:
                fields.append(f if () in sub else StructField(f.name, _keep_paths(f.dataType, sub), f.nullable))
        return StructType(fields)
    return dtype


def document_schema(fields: list[str] | None = None, skip: list[str] | None = None,
                    only: list[str] | None = None) -> StructType:
    """The document schema cut to the top-level ``fields`` a reader needs, minus nested
    ``skip`` paths (``"items.components"``), or to the nested paths ``only``: the JSON parser then
    skips the other subtrees instead of building them, which is column pruning at the JSON source."""
    schema = order_document_schema()
    if only is not None:
        schema = _keep_paths(schema, {tuple(p.split(".")) for p in only})
    if fields is not None:
        wanted = set(fields)
        schema = StructType([f for f in schema.fields if f.name in wanted])
    if skip:
        schema = _drop_paths(schema, {tuple(p.split(".")) for p in skip})
    return schema


def parse_documents(bronze: DataFrame, column: str = DOCUMENT_COLUMN,
                    fields: list[str] | None = None,
                    skip: list[str] | None = None, keep: list[str] | None = None,
                    only: list[str] | None = None) -> DataFrame:
    """Bronze rows -> one row per document, document fields as columns, behind the columns ``keep`` of the rows.

    All 53 fields by default; with ``fields`` / ``skip`` / ``only`` just what a reader needs is
    parsed (see ``document_schema``).  Each document is parsed once, also where arrays of it are
    exploded (``evaluated_once``).
    """
    schema = document_schema(fields, skip, only) if (fields or skip or only) else ORDER_DOCUMENT_DDL
    keep = keep or []
    text = evaluated_once(F.col(column))
    return bronze.select(*keep, F.from_json(text, schema).alias(column)).select(*keep, f"{column}.*")


def write_bronze(bronze: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write bronze rows as JSON lines (one ``{"orderDetails": "..."}`` record per order), compressed; a file of
    that kind is read by one task, so none gets more than ``RECORDS_PER_FILE``."""
    bronze.write.mode(mode).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).json(path)
