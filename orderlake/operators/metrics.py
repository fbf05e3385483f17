"""Aggregates attached to detail rows (operators W1-W7, J5, P9, A8).

Three shapes, which differ only in how a null key is treated:

* ``add_partition_metric``: the value over all rows that share the key, like
  ``agg(...).over(Window.partitionBy(key))``; rows with a null key form their own group.
* ``add_group_metric``: ``groupBy(key).agg(...)`` left-joined back on the key; a null key
  never matches, so its rows get a null metric.
* ``add_global_metrics``: one aggregate over all rows, repeated on every row (as scalar
  subqueries, no join).

None of them uses a window.  A whole-partition window sends every row of a key to one
task, and status, channel or payment method have a handful of values, so one task would
get a third of the table.  Here the aggregate is computed with map-side partial
aggregation (a hot key collapses to one row per input partition before the shuffle), and
the small per-key result is joined back.  The join-back side is written to the session's
checkpoint folder and read back, so the planner sees its real file size: below
``spark.sql.autoBroadcastJoinThreshold`` it is broadcast and the detail rows are not
shuffled at all; above it the join is a sort-merge join that AQE splits when a key is
skewed.
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.session import ensure_checkpoint_dir


#: Compression of stored tables: smaller than the default by a third or more, for little more time.
CODEC = "zstd"


def _as_list(keys: str | list[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def materialize(df: DataFrame, label: str = "table",
                bucket_by: list[str] | None = None,
                prepartitioned: bool = False, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing the
    upstream plan) and gives the optimizer exact sizes for the join strategy.

    With ``bucket_by`` the files are a bucketed table (as many buckets as the session's
    shuffle partitions), registered in the catalog under a unique name: reading it back
    gives a scan that is already hash-partitioned on those columns, so later joins,
    deduplications and aggregates keyed by them need no shuffle.  When ``df`` is already
    hash-partitioned on the same columns into that many partitions, each task writes a
    single bucket file.  Otherwise the rows are first hash-partitioned on the bucket
    columns (Spark drops that shuffle when the input is a scan of a table bucketed the
    same way), so the write never produces a file per bucket per task;
    ``prepartitioned=True`` states that the caller already partitioned the rows so.
    ``partition_by`` names a column with few values (the last one), whose rows are kept in folders of their own.
    """
    spark = df.sparkSession
    tag = uuid.uuid4().hex
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/orderlake/{label}-{tag}"
    if not bucket_by:
        _partitioned(df.write, partition_by).mode("overwrite").option("compression", CODEC).parquet(path)
        return spark.read.parquet(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not prepartitioned:
        df = df.repartition(buckets, *bucket_by)
    name = f"{_staging_database(spark)}.{label.replace('-', '_')}_{tag}"
    with _unsorted_writes(spark):
        (_partitioned(df.write, partition_by).mode("overwrite").format("parquet")
         .option("compression", CODEC).option("path", path)
         .bucketBy(buckets, *bucket_by).saveAsTable(name))
    return spark.table(name)


def _partitioned(writer, column: str | None):
    return writer.partitionBy(column) if column else writer


@contextlib.contextmanager
def _unsorted_writes(spark):
    """Let a task hold the files of several buckets open, so that its rows, all of one bucket as a rule, are
    not sorted by bucket (and spilled) first.  Beyond that many buckets Spark sorts the rest."""
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "4")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


STAGING_DATABASE = "orderlake_stage"


def _staging_database(spark) -> str:
    """A catalog database for stored intermediate tables, located in the checkpoint
    folder (so nothing is written to the session's default warehouse)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {STAGING_DATABASE} "
              f"LOCATION '{root}/orderlake/{STAGING_DATABASE}.db'")
    return STAGING_DATABASE


def attach_metrics(df: DataFrame, agg: DataFrame, keys: str | list[str],
                   null_safe: bool = False, write: bool = True) -> DataFrame:
    """Left-join per-key metrics ``agg`` (one row per key) back onto ``df``."""
    keys = _as_list(keys)
    tmp = {k: f"__key_{i}" for i, k in enumerate(keys)}
    right = agg.select(*[F.col(k).alias(tmp[k]) for k in keys],
                       *[c for c in agg.columns if c not in keys])
    if write:
        right = materialize(right, "metric")
    cond = None
    for k in keys:
        part = (df[k].eqNullSafe(right[tmp[k]]) if null_safe else df[k] == right[tmp[k]])
        cond = part if cond is None else cond & part
    return df.join(right, cond, "left").drop(*tmp.values())


def add_partition_metric(df: DataFrame, keys: str | list[str], write: bool = True,
                         **aggs: Column) -> DataFrame:
    """Per-key aggregates on every row; a null key is a group of its own (window semantics)."""
    keys = _as_list(keys)
    agg = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return attach_metrics(df, agg, keys, null_safe=True, write=write)


def add_group_metric(df: DataFrame, keys: str | list[str], write: bool = True,
                     **aggs: Column) -> DataFrame:
    """Per-key aggregates joined back on the key; rows with a null key get null."""
    keys = _as_list(keys)
    agg = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)) \
        .groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return attach_metrics(df, agg, keys, null_safe=False, write=write)


def add_key_metrics(df: DataFrame, keys: str | list[str], window: dict[str, Column] | None = None,
                    joined: dict[str, Column] | None = None, write: bool = True) -> DataFrame:
    """Partition metrics and group metrics on the same key from one aggregate and one join.

    ``window`` metrics keep a value for the null-key group, ``joined`` metrics are null
    there, exactly as if each had been attached separately.
    """
    keys = _as_list(keys)
    window, joined = window or {}, joined or {}
    agg = df.groupBy(*keys).agg(*[c.alias(n) for n, c in {**window, **joined}.items()])
    out = attach_metrics(df, agg, keys, null_safe=True, write=write)
    if joined:
        any_null = None
        for k in keys:
            any_null = F.col(k).isNull() if any_null is None else any_null | F.col(k).isNull()
        out = out.select(*[F.when(any_null, F.lit(None)).otherwise(F.col(c)).alias(c)
                           if c in joined else F.col(f"`{c}`") for c in out.columns])
    return out


def global_metrics(df: DataFrame, **aggs: Column) -> DataFrame:
    """All global aggregates in one pass, one row."""
    return df.agg(*[c.alias(n) for n, c in aggs.items()])


def add_global_metrics(df: DataFrame, **aggs: Column) -> DataFrame:
    """Global aggregates repeated on every row (P9), without any join.

    Each aggregate is a scalar subquery (``DataFrame.scalar``): Spark merges the
    subqueries over the same input into one aggregate, runs it once (partial aggregates
    per task, one row to the driver-side subquery result) and inlines the values into
    the projection.  An empty input gives typed nulls.
    """
    return df.select("*", *[df.agg(c).scalar().alias(n) for n, c in aggs.items()])


def distinct_count_with_null(column: str) -> Column:
    """Number of distinct values, null counted as one more value.

    Same as ``select(c).distinct().count()``; ``count_distinct`` alone skips null.
    """
    c = F.col(column)
    return F.count_distinct(c) + F.coalesce(F.max(F.when(c.isNull(), 1).otherwise(0)), F.lit(0))
