"""Running totals inside groups of any size.

A window function hands a whole group to one task.  ``running`` deals the rows out by range
of (group, order) instead, so a group that holds a third of all rows spans many tasks; each
task carries totals along its sorted rows, and what a group had in earlier tasks is added
from a table with one row per task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.common import staged


def running(df: DataFrame, group: str, order: list[str], sums: list[str] = (), xors: list[str] = (),
            label: str = "running", prepare=None, prepared: T.StructType | None = None) -> DataFrame:
    """``df`` with ``<name>_before`` for each long column in ``sums`` and ``xors``: the sum (exclusive
    or) of that column over the rows of the same group that stand earlier in ``order``.

    ``group`` is a column without nulls; nulls in ``order`` come first.  Rows that are equal in
    ``order`` get different places, in any order; they may share one task, so give an order
    that tells rows apart.  ``prepare`` maps each sorted record batch to batches of the columns
    ``prepared`` (``group`` among them) before the totals are taken, where values are made in the
    same pass.  The result is staged.
    """
    values = [*sums, *xors]
    fields = (prepared or df.schema).fields
    columns = [f.name for f in fields]
    names = [*columns, "__part"]
    made = [f"{v}_before" for v in values]
    schema = T.StructType([*fields, T.StructField("__part", T.IntegerType()),
                           *(T.StructField(m, T.LongType()) for m in made),
                           T.StructField("__last", T.BooleanType())])

    def scan(batches):
        held, key_now, totals = None, None, None
        for batch in _prepared(batches, prepare):
            n = batch.num_rows
            if held is not None:
                yield _marked(held, False)
            key = batch.column(group)
            new = np.ones(n, bool)
            new[1:] = pc.not_equal(key.slice(1), key.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            new[0] = totals is None or key[0].as_py() != key_now
            begins = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            goes_on = np.cumsum(new) == 0
            befores, after = [], []
            for i, v in enumerate(values):
                x = batch.column(v).to_numpy(zero_copy_only=False).astype(np.int64)
                if i < len(sums):
                    before = np.cumsum(x) - x
                    before = before - before[begins]
                    before[goes_on] += totals[i] if totals else 0
                    after.append(int(before[-1] + x[-1]))
                else:
                    before = np.bitwise_xor.accumulate(x) ^ x
                    before = before ^ before[begins]
                    before[goes_on] ^= totals[i] if totals else 0
                    after.append(int(before[-1] ^ x[-1]))
                befores.append(pa.array(before, pa.int64()))
            key_now, totals = key[n - 1].as_py(), after
            held = pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *befores],
                                              [*names, *made])
        if held is not None:
            yield _marked(held, True)

    ranged = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order) \
        .withColumn("__part", F.spark_partition_id())
    rows = staged(ranged.mapInArrow(scan, schema), label)

    # one row per task: what the last group of the task has so far; the next task goes on from it
    so_far = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)
    lasts = rows.where("__last").select(
        group, F.lead("__part").over(Window.orderBy("__part")).alias("__next"), "__part",
        *((F.col(m) + F.col(v) if v in sums else F.col(m).bitwiseXOR(F.col(v))).alias(f"__{m}")
          for v, m in zip(values, made)))
    offsets = lasts.select(
        F.col(group).alias("__group"), F.col("__next"),
        *((F.sum(f"__{m}") if v in sums else F.bit_xor(f"__{m}")).over(so_far).alias(f"__{m}")
          for v, m in zip(values, made))).where("__next is not null")
    # as many rows as tasks wrote the staged table
    joined = rows.join(F.broadcast(offsets), (F.col("__part") == F.col("__next"))
                       & (F.col(group) == F.col("__group")), "left")
    zero = F.lit(0).cast("long")
    return joined.select(*columns, *(
        (F.col(m) + F.coalesce(f"__{m}", zero) if v in sums
         else F.col(m).bitwiseXOR(F.coalesce(f"__{m}", zero))).alias(m) for v, m in zip(values, made)))


def _prepared(batches, prepare):
    for batch in batches:
        if batch.num_rows:
            if prepare is None:
                yield batch
            else:
                part = batch.column("__part")
                for made in prepare(batch.drop_columns(["__part"])):
                    yield made.append_column("__part", part[:made.num_rows])


def _marked(batch: pa.RecordBatch, last: bool) -> pa.RecordBatch:
    marks = np.zeros(batch.num_rows, bool)
    marks[-1] = last
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks)], [*batch.schema.names, "__last"])
