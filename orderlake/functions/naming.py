"""Column naming: camelCase / PascalCase to snake_case (operator P1)."""

from __future__ import annotations

import re
from collections import defaultdict

from pyspark.sql import DataFrame

# The two rewrite patterns, applied in this order, then lower-casing.
# 1. a capital followed by lower-case letters gets an underscore before it;
# 2. a lower-case letter or digit followed by a capital gets an underscore between.
_WORD_START = re.compile(r"(.)([A-Z][a-z]+)")
_CASE_BREAK = re.compile(r"([a-z0-9])([A-Z])")


def to_snake_case(name: str) -> str:
    """``orderId`` -> ``order_id``; ``lockTTL`` -> ``lock_ttl``; ``first_Name`` -> ``first__name``."""
    name = _WORD_START.sub(r"\1_\2", name)
    name = _CASE_BREAK.sub(r"\1_\2", name)
    return name.lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename every top-level column to snake_case in a single projection.

    Raises ``ValueError`` when two different names would end up equal (``aB`` and ``a_b``),
    instead of silently producing an ambiguous column.
    """
    old = df.columns
    new = [to_snake_case(c) for c in old]
    sources: dict[str, set[str]] = defaultdict(set)
    for o, n in zip(old, new):
        sources[n].add(o)
    clashes = {n: sorted(s) for n, s in sources.items() if len(s) > 1}
    if clashes:
        raise ValueError(f"snake_case rename collides: {clashes}")
    return df.toDF(*new)
