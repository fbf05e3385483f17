"""Sharding by a two-pass external shuffle (operator 1).

Pass 1 scatters the records over buckets of bounded size with a seeded hash of the record.
Pass 2 brings each bucket into memory, puts it in a fixed order, shuffles it with
Fisher-Yates seeded by the bucket's number, and writes it.  Buckets in order, each in its
shuffled order, are one random permutation of all records; cutting it into equal ranges
gives shards whose row counts differ by one at most (law ``rows``).

The permutation depends on the records, the seed and the number of buckets only, not on
the order in which tasks run, so a task that is run again writes the same rows.

Cases: a null text has size 8; null or repeated doc_ids and equal texts are records like any
other (rows that are equal in all of doc_id and text share a bucket); an empty table gives an
empty result; other columns travel with their row, under their own names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.common import parts_for, scratch

#: Bytes (text plus 8 a record) that a bucket holds on average.
BUCKET_BYTES = 16 << 20


def record_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + F.lit(8).cast("long")


def shuffle_to(docs: DataFrame, path: str, seed: int = 17, doc_id: str = "doc_id",
               text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write the shuffled records to ``path`` and return them: the columns of ``docs`` plus
    ``shuffle_bucket`` and ``shuffle_at`` (place in the bucket, from 0)."""
    spark = docs.sparkSession
    clash = {"shuffle_bucket", "shuffle_at"} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are taken by the result")
    total = docs.agg(F.sum(record_size(text))).first()[0] or 0
    buckets = parts_for(total, bucket_bytes, least=1)
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)), F.lit(buckets)).cast("int")
    schema = T.StructType([*docs.schema.fields, T.StructField("shuffle_bucket", T.IntegerType()),
                           T.StructField("shuffle_at", T.LongType())])
    names = docs.columns
    keyed = docs.withColumn("shuffle_bucket", bucket).withColumn(
        "__order", F.xxhash64(F.lit(seed + 1), F.col(doc_id), F.col(text)))

    def shuffle(key, rows):
        number = key[0].as_py()
        fixed = np.argsort(rows.column("__order").to_numpy(), kind="stable")
        dealt = np.random.Generator(np.random.PCG64([seed, number])).permutation(len(fixed))
        rows = rows.select(names).take(pa.array(fixed[dealt]))
        return rows.append_column("shuffle_bucket", pa.array(np.full(len(fixed), number, np.int32))) \
            .append_column("shuffle_at", pa.array(np.arange(len(fixed))))

    keyed.groupBy("shuffle_bucket").applyInArrow(shuffle, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def shard(shuffled: DataFrame, shards: int) -> DataFrame:
    """Shuffled records plus ``shard`` and ``slot`` (gapless from 0 in a shard).

    The only step over all buckets is a running sum over one count per bucket.
    """
    counts = shuffled.groupBy("shuffle_bucket").count()
    before = Window.orderBy("shuffle_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shuffle_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    total = shuffled.agg(F.count("*")).scalar()
    placed = shuffled.join(starts, "shuffle_bucket").withColumn("__total", total)
    # rank * shards stays a whole number: integer division, no rounding
    placed = placed.withColumn("shard", F.expr(
        f"cast((__start + shuffle_at) * {shards}L div __total as int)"))
    first = F.expr(f"(shard * __total + {shards - 1}L) div {shards}L")
    return placed.withColumn("slot", F.col("__start") + F.col("shuffle_at") - first) \
        .drop("__start", "__total")


def shard_documents(docs: DataFrame, shards: int, seed: int = 17) -> DataFrame:
    """Both passes in the shared folder; see ``shuffle_to`` and ``shard``."""
    return shard(shuffle_to(docs, scratch(docs.sparkSession, "shuffled"), seed), shards)


def write_shards(docs: DataFrame, shards: int, path: str, seed: int = 17) -> None:
    """One folder per shard, ``shard=<n>``, rows with their ``slot``."""
    shard_documents(docs, shards, seed).drop("shuffle_bucket", "shuffle_at") \
        .write.partitionBy("shard").parquet(path)
