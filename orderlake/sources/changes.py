"""What a save changes: inserted, updated, unchanged and removed rows (operators S7, S9).

Old and new rows of the keys (or groups) that a batch names are compared by a digest of the
row; the load date does not count as a change.  Rows are signed: +1 for a row that comes, -1
for one that goes, 0 for one that stays, so that additive totals can follow a table
(``operators.maintained``) without reading what did not change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.digest import row_digest

KIND, SIGN = "change_kind", "change_sign"
LOAD_DATE = "load_date"


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool, prefix: str = "__src_"):
    """Condition that the keys of ``left`` equal the prefixed keys of ``right``."""
    cond = None
    for k in keys:
        a, b = left[k], right[f"{prefix}{k}"]
        part = a.eqNullSafe(b) if null_safe else a == b
        cond = part if cond is None else cond & part
    return cond


def prefixed(rows: DataFrame, keys: list[str], prefix: str = "__src_") -> DataFrame:
    return rows.select(*[F.col(f"`{k}`").alias(f"{prefix}{k}") for k in keys])


def compare(old: DataFrame, new: DataFrame, keys: list[str], skip: tuple[str, ...] = (LOAD_DATE,)) -> DataFrame:
    """Signed rows that turn ``old`` into ``new``, both of one schema, with ``change_kind`` and
    ``change_sign``.

    ``old`` holds the stored rows of the keys in question, ``new`` those to be stored.  Equal rows are
    matched one to one, so repeated rows count as often as they come; of a matched pair the new
    row is given.  What is left over is ``updated`` where the key (nulls equal each other) has
    rows on both sides, else ``inserted`` or ``removed``.  Without keys nothing is updated.
    """
    digest = row_digest(new.schema, skip)
    names = new.columns
    sides = old.withColumn("__side", F.lit(-1)).unionByName(new.withColumn("__side", F.lit(1))) \
        .withColumn("__digest", digest)
    # how many copies of each row stand on each side; counts are combined before the shuffle
    copies = sides.groupBy("__digest", *keys).agg(
        F.count_if(F.col("__side") < 0).alias("__was"), F.count_if(F.col("__side") > 0).alias("__is"),
        F.max_by(F.struct(*names), "__side").alias("__row"))
    left_over = F.col("__is") - F.col("__was")
    signed = copies.withColumn("__net", left_over).withColumn("__stay", F.least("__is", "__was"))
    if keys:
        both = signed.groupBy(*keys).agg(F.max(F.col("__net") > 0).alias("__comes"), F.max(F.col("__net") < 0).alias("__goes"))
        changed = both.where("__comes and __goes").select(*keys)
        right = prefixed(changed, keys).withColumn("__paired", F.lit(True))
        signed = signed.join(right, same_keys(signed, right, keys, True), "left") \
            .drop(*(f"__src_{k}" for k in keys))
    else:
        signed = signed.withColumn("__paired", F.lit(None).cast("boolean"))
    paired = F.coalesce("__paired", F.lit(False))
    kind = F.when(paired, "updated").when(F.col("__net") > 0, "inserted").otherwise("removed")
    turn = signed.where("__net <> 0").select(
        "__row", kind.alias(KIND), F.signum("__net").cast("int").alias(SIGN), F.abs("__net").alias("__times"))
    stay = signed.where("__stay > 0").select(
        "__row", F.lit("unchanged").alias(KIND), F.lit(0).alias(SIGN), F.col("__stay").alias("__times"))
    times = F.explode(F.sequence(F.lit(1), F.col("__times").cast("int")))
    return turn.union(stay).select("*", times.alias("__copy")).select("__row.*", KIND, SIGN)
