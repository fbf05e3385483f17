"""Scalar expressions used by the gold tables (X1-X6), all built-in and codegen-friendly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_between(end: str | Column, start: str | Column) -> Column:
    """Calendar days from ``start`` to ``end`` (X1); null if either side is null."""
    return F.datediff(F.col(end) if isinstance(end, str) else end,
                      F.col(start) if isinstance(start, str) else start)


def flag(condition: Column) -> Column:
    """1 where ``condition`` holds, else 0; a null condition gives 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def try_ratio_pct(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` as double; null instead of an error when ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)


def evaluated_once(value: Column) -> Column:
    """``value`` unchanged, behind a condition that always holds but that the optimizer must not repeat or move.

    Without it a costly expression is written out wherever its column is used: inside a JSON parse (whose
    argument is then evaluated without generated code), and in the filters that an inner explode adds below itself.
    """
    return F.when(F.spark_partition_id() >= 0, value)
