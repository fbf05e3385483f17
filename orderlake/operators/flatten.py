"""Flattening steps for nested documents (operators G1-G4, P2, P4, P5, F3).

Every step is a plain DataFrame transformation, so chains of them compose with
``DataFrame.transform`` and stay inside Catalyst: each explode is one ``Generate`` node,
projections collapse, and nested-field pruning reaches the JSON parser and the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def explode_inner(df: DataFrame, column: str, source: str | Column | None = None) -> DataFrame:
    """One row per array element (G1); a null or empty array loses the row."""
    return df.withColumn(column, F.explode(_c(source if source is not None else column)))


def explode_outer(df: DataFrame, column: str, source: str | Column | None = None) -> DataFrame:
    """One row per array element (G2); a null or empty array keeps one row with null."""
    return df.withColumn(column, F.explode_outer(_c(source if source is not None else column)))


def explode_map(df: DataFrame, column: str, key_name: str, value_name: str,
                outer: bool = True) -> DataFrame:
    """One row per map entry as two columns (G3), the map column dropped.

    Outer: a null or empty map keeps one row with null key and value; a null value is
    kept as a null value.
    """
    gen = F.explode_outer if outer else F.explode
    return df.select("*", gen(F.col(column)).alias(key_name, value_name)).drop(column)


def explode_chain(df: DataFrame, columns: list[str], outer: bool = True) -> DataFrame:
    """Successive explodes of sibling arrays (G4): rows multiply as the product of sizes."""
    step = explode_outer if outer else explode_inner
    for column in columns:
        df = step(df, column)
    return df


def expand(df: DataFrame, struct_column: str, rename: dict[str, str] | None = None,
           keep: bool = False) -> DataFrame:
    """Replace a struct column by one column per field.

    A null struct gives null in every field column.  ``rename`` maps field -> new name,
    for fields whose name would clash with an existing column.
    """
    rename = rename or {}
    fields = df.schema[struct_column].dataType.fieldNames()
    others = [F.col(f"`{c}`") for c in df.columns if keep or c != struct_column]
    expanded = [F.col(f"`{struct_column}`").getField(f).alias(rename.get(f, f)) for f in fields]
    return df.select(*others, *expanded)


def drop_names(df: DataFrame, *names: str) -> DataFrame:
    """Drop every column of each name (P5): case-insensitive, missing names ignored."""
    return df.drop(*names)


def drop_all_null(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Keep rows with at least one non-null column."""
    return df.dropna(how="all", subset=subset)
