"""The medallion run: flat test tables -> bronze documents -> silver tables -> gold tables.

Bronze (the JSON text of each order document) is parsed for the document fields that the
wanted silver tables read; the JSON parser skips every other subtree.  One silver table is
built straight from that parse.  For several at once the parsed documents are stored as
nested parquet first, and each table reads only its own sub-document from there (nested
schema pruning reaches the parquet scan).  Silver tables are stored in turn, as the source
pipeline stores them before the gold step reads them.  Stored layers live under the session's checkpoint folder
(``spark.checkpoint.dir`` on a cluster): a lost executor re-reads files instead of
re-running the JSON parse, and the planner knows each table's real size.

Within one session the stored layers are reused: all queries over the same input folder
share one build of each silver table.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.operators.metrics import materialize
from orderlake.plans.silver import (BUILDERS, DIGEST, MAY_REPEAT, READS, digested_items, document_reads,
                                    items_may_repeat, repeats_marked, silver_table)
from orderlake.sources.documents import COPIES, ORDER_KEY, bronze_from_dir, keyed_bronze_from_dir
from orderlake.sources.ingest import parse_documents

_LOCK = threading.RLock()
_CACHE: dict[tuple[str, str], dict[str, DataFrame]] = {}


def _layer(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _CACHE.setdefault((spark.sparkContext.applicationId, sf_dir.rstrip("/")), {})


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows (lazy): one per order, the JSON document in ``orderDetails``."""
    return bronze_from_dir(spark, sf_dir)


def parsed(spark: SparkSession, sf_dir: str, *tables: str, only: list[str] | None = None) -> DataFrame:
    """Parsed documents (lazy) with the fields that the silver ``tables`` read, or of these the paths ``only``."""
    fields, skip = document_reads(tables)
    return parse_documents(bronze(spark, sf_dir), fields=fields, skip=skip, only=only)


def documents(spark: SparkSession, sf_dir: str, *tables: str) -> DataFrame:
    """Parsed documents with the fields that the silver ``tables`` read (all by default), stored once per
    session and input folder."""
    with _LOCK:
        layer, tables = _layer(spark, sf_dir), tables or tuple(BUILDERS)
        label = f"__documents__{','.join(sorted(tables))}"
        if label not in layer:
            # The documents come out of the build hash-partitioned on the order id text
            # into the session's shuffle partitions (``build_keyed_bronze``): one file per bucket.
            docs = parsed(spark, sf_dir, *tables)
            if "items" in tables:
                docs = docs.withColumn(MAY_REPEAT, items_may_repeat())
            docs = materialize(docs, "documents", bucket_by=["orderId"], prepartitioned=True)
            layer[label] = repeats_marked(docs) if "items" in tables else docs
        return layer[label]


def _stored_documents(spark: SparkSession, sf_dir: str, name: str) -> DataFrame | None:
    for label, docs in _layer(spark, sf_dir).items():
        if label.startswith("__documents__") and name in label.removeprefix("__documents__").split(","):
            return docs
    return None


def _stored_as(layer: dict[str, DataFrame], name: str, columns: tuple[str, ...] | None) -> str:
    """The label of a silver table in a layer: with all columns where it is stored so, else with ``columns``."""
    return name if columns is None or name in layer else f"{name}({','.join(columns)})"


def silver(spark: SparkSession, sf_dir: str, name: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """A stored silver table (snake_case columns); with ``columns`` all its rows, but stored with these columns
    only."""
    with _LOCK:
        layer = _layer(spark, sf_dir)
        label = _stored_as(layer, name, columns)
        if label not in layer:
            docs = _stored_documents(spark, sf_dir, name)
            if docs is None:
                layer[label] = _from_build(spark, sf_dir, name, columns)
            else:
                layer[label] = _store(silver_table(docs, name), name, columns)
        return layer[label] if columns is None else layer[label].select(*columns)


def _store(table: DataFrame, name: str, columns: tuple[str, ...] | None, direct: bool = False,
           partition_by: str | None = None) -> DataFrame:
    keys = ["order_id"] if "order_id" in table.columns else None
    return materialize(table.select(*columns) if columns else table, f"silver-{name}", bucket_by=keys,
                       prepartitioned=direct, partition_by=partition_by)


def _from_build(spark: SparkSession, sf_dir: str, name: str, columns: tuple[str, ...] | None) -> DataFrame:
    """A silver table made in one pass from the document build; rows stay in the partition of their order id."""
    fields, skip = READS[name]
    docs = parse_documents(keyed_bronze_from_dir(spark, sf_dir), fields=fields, skip=skip, keep=[ORDER_KEY, COPIES])
    if name != "items":
        return _store(silver_table(docs, name), name, columns, direct=True)
    # the rows that may equal others are compared once they are stored: few as a rule
    rows = digested_items(docs.withColumn(
        MAY_REPEAT, items_may_repeat() | F.col("orderId").isNull() | (F.col(COPIES) > 1)))
    columns = columns or tuple(c for c in rows.columns if c not in (DIGEST, MAY_REPEAT))
    stored = _store(rows, name, (*columns, DIGEST, MAY_REPEAT), direct=True, partition_by=MAY_REPEAT)
    sure, rest = stored.where(~F.col(MAY_REPEAT)).select(*columns), stored.where(MAY_REPEAT)
    if rest.isEmpty():
        return sure
    return sure.unionByName(_store(rest.dropDuplicates([DIGEST]), name, columns))


def silver_set(spark: SparkSession, sf_dir: str, *names: str, for_gold: bool = False) -> dict[str, DataFrame]:
    """Silver tables; ``for_gold`` stores of some the columns that gold reads (``GOLD_COLUMNS``)."""
    columns = GOLD_COLUMNS if for_gold else {}
    with _LOCK:
        layer = _layer(spark, sf_dir)
        missing = [n for n in names if _stored_as(layer, n, columns.get(n)) not in layer
                   and _stored_documents(spark, sf_dir, n) is None]
        if len(missing) > 1:  # parsed once for all of them
            documents(spark, sf_dir, *missing)
        return {n: silver(spark, sf_dir, n, columns.get(n)) for n in names}


def gold1_inputs(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Inputs of the order summary (all by default), deduplicated and stored once per session."""
    from orderlake.plans.summary import prepare_inputs
    with _LOCK:
        layer, names = _layer(spark, sf_dir), names or GOLD1_INPUTS
        missing = [n for n in names if f"__gold1__{n}" not in layer]
        # The stored items table is build_items' output, deduplicated already.
        made = prepare_inputs(silver_set(spark, sf_dir, *missing, for_gold=True), already_unique=("items",))
        layer |= {f"__gold1__{n}": df for n, df in made.items()}
        return {n: layer[f"__gold1__{n}"] for n in names}


#: What gold reads of a wide silver table; its rows are all there, made and deduplicated with all columns.
GOLD_COLUMNS = {"items": ("order_id", "unique_id", "product_id", "items_quantity", "selling_price", "list_price")}
GOLD1_INPUTS = ("orders", "payment", "shipping_data", "items", "cancellation",
                "client_profile")
GOLD2_INPUTS = ("orders", "items", "client_profile")
