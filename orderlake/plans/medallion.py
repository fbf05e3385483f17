"""End-to-end jobs: bronze -> silver tables -> gold tables, saved in the catalog.

The two jobs of the source pipeline, as functions instead of notebooks with widgets:

* ``bronze_to_silver``: parse the bronze documents once and save every silver table with
  ``save_with_merge``: keyed upsert for tables with one row per order; for tables with several
  rows per order the rows of the batch's orders are replaced (an order that comes without items
  loses those it had) and all others stay; rates and benefits have no order id, so their rows
  are appended, under the batch's name if it has one;
* ``silver_to_gold``: read the saved silver tables back from the catalog (S2), build the
  order summary and the KPI table, and save both (replacement: neither has a unique key).
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from orderlake.operators.metrics import materialize
from orderlake.plans.kpi import kpi_table
from orderlake.plans.silver import (BUILDERS, DOCUMENT_FIELDS, DOCUMENT_SKIP, MAY_REPEAT, document_reads,
                                    items_may_repeat, repeats_marked, silver_table)
from orderlake.plans.summary import order_summary
from orderlake.sources import rejects
from orderlake.sources.ingest import parse_documents
from orderlake.sources.upsert import save_with_merge
from orderlake.sources.versions import PART

# Tables with one row per order are merged on the order id.
ONE_ROW_PER_ORDER = ("orders", "client_profile", "store_preferences", "client_preferences",
                     "cancellation")

#: Silver tables that are saved at one time.
SAVES_AT_ONCE = 4

GOLD_TABLES = {"order_summary": "gold_order_summary", "kpi_table": "gold_kpi"}


def bronze_to_silver(bronze: DataFrame, lake_path: str, database: str,
                     tables: tuple[str, ...] | None = None,
                     load_date: dt.date | None = None, batch: str | None = None,
                     quarantine: bool = False, changes: bool = False,
                     parts: int | None = None) -> dict[str, DataFrame]:
    """Save the silver tables built from ``bronze`` (rows with an ``orderDetails`` column).

    The documents are parsed once (cut to the fields the tables read) and stored in
    the checkpoint folder, since every table reads them.  ``batch`` names the load: rows that are appended
    replace those of an earlier load of that name.  With ``quarantine`` documents without an order
    id go to the table ``rejects`` instead of leaving rows of nulls.  ``changes`` stores what each save
    changed; ``parts`` as in ``save_with_merge``.
    """
    lake = f"{lake_path.rstrip('/')}/silver"
    saved, names = {}, tables or tuple(BUILDERS)
    marks = {MAY_REPEAT: items_may_repeat()} if "items" in names else {}
    if quarantine:
        checked = materialize(rejects.parse_checked(bronze, fields=DOCUMENT_FIELDS, skip=DOCUMENT_SKIP)
                              .withColumns(marks), "documents")
        saved["rejects"] = save_with_merge(rejects.rejected(checked), f"{lake}/rejects", database, "rejects",
                                           ["document_digest"], load_date)
        docs = rejects.kept(checked)
    else:
        fields, skip = document_reads(names)
        docs = materialize(parse_documents(bronze, fields=sorted({"orderId", *fields}), skip=skip)
                           .withColumns(marks), "documents")
    if marks:
        docs = repeats_marked(docs)

    def save(name: str) -> DataFrame:
        rows = silver_table(docs, name)
        keys = ["order_id"] if name in ONE_ROW_PER_ORDER else None
        by_order = not keys and "order_id" in rows.columns
        return save_with_merge(rows, f"{lake}/{name}", database, name, keys, load_date,
                               replace_by=["order_id"] if by_order else None,
                               groups=docs.select("orderId").distinct() if by_order else None,
                               append=not keys and not by_order, batch=batch,
                               parts=parts if keys or by_order else None, changes=changes)

    # the tables do not depend on each other, and their small jobs leave cores idle
    with ThreadPoolExecutor(SAVES_AT_ONCE) as pool:
        return saved | dict(zip(names, pool.map(inheritable_thread_target(bronze.sparkSession)(save), names)))


def read_silver(spark: SparkSession, database: str, *names: str) -> dict[str, DataFrame]:
    """Saved silver tables by name (S2), without the columns of the save path."""
    return {n: spark.table(f"{database}.{n}").drop("load_date", PART) for n in names}


def silver_to_gold(spark: SparkSession, lake_path: str, database: str,
                   load_date: dt.date | None = None) -> dict[str, DataFrame]:
    """Build and save both gold tables from the saved silver tables."""
    silver = read_silver(spark, database, "orders", "payment", "shipping_data", "items",
                         "cancellation", "client_profile")
    built = {"order_summary": order_summary(silver),
             "kpi_table": kpi_table(silver, load_date)}
    return {key: save_with_merge(df, f"{lake_path.rstrip('/')}/gold/{GOLD_TABLES[key]}",
                                 database, GOLD_TABLES[key], None, load_date)
            for key, df in built.items()}
