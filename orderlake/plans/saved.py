"""Registered queries that read files back and save tables.

Each query writes to a folder of its own under the checkpoint folder and returns what the
stored table holds afterwards.  Two queries over one set of saved tables share it within a
session.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.functions.digest import drop_duplicate_rows
from orderlake.functions.naming import snake_case_columns
from orderlake.plans import layers as L
from orderlake.plans import maintained
from orderlake.plans import oracle as O
from orderlake.plans.medallion import bronze_to_silver, silver_to_gold
from orderlake.session import ensure_checkpoint_dir
from orderlake.sources import rejects
from orderlake.sources.ingest import parse_documents, read_documents, write_bronze
from orderlake.sources.upsert import read_changes, save_with_merge, with_load_date
from orderlake.streaming import load_new_files

FIRST_LOAD = dt.date(2023, 12, 31)
SECOND_LOAD = dt.date.fromisoformat(O.FIXED_LOAD_DATE)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Query, str]] = {}

_LOCK = threading.RLock()
_SAVED: dict[tuple[str, str, str], dict[str, DataFrame]] = {}


def _register(name: str, sql: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def _folder(spark: SparkSession, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/orderlake/{label}-{uuid.uuid4().hex}"


def _lake(spark: SparkSession, label: str) -> tuple[str, str]:
    """A new lake folder and a database located in it."""
    folder = _folder(spark, label)
    database = f"orderlake_{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder}/{database}.db'")
    return folder, database


def _once(spark: SparkSession, sf_dir: str, label: str, build) -> dict[str, DataFrame]:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), label)
    with _LOCK:
        if key not in _SAVED:
            _SAVED[key] = build(*_lake(spark, label))
        return _SAVED[key]


@_register("json_lines_scan", O.with_silver("orders") + """
SELECT order_id, status, CAST(value AS BIGINT) AS value FROM s_orders""")
def q_json_lines_scan(spark, sf_dir):
    path = _folder(spark, "json_lines")
    write_bronze(L.bronze(spark, sf_dir), path)
    docs = parse_documents(read_documents(spark, path), fields=["orderId", "status", "value"])
    return snake_case_columns(docs).select("order_id", "status",
                                           F.col("value").cast("bigint").alias("value"))


@_register("save_first_load", O.with_silver("orders") + f"""
SELECT order_id, status, CAST(value AS BIGINT) AS value, DATE '{FIRST_LOAD}' AS load_date
FROM s_orders""")
def q_save_first_load(spark, sf_dir):
    folder, database = _lake(spark, "first_load")
    rows = L.silver(spark, sf_dir, "orders").select(
        F.col("order_id").alias("orderId"), "status", F.col("value").cast("bigint").alias("value"))
    return save_with_merge(rows, f"{folder}/orders", database, "orders", ["orderId"], FIRST_LOAD)


_PARTIES = f"""
WITH old AS (
  SELECT CASE WHEN s_acctbal >= 0 THEN s_suppkey * 40 END AS party_id, s_name AS party_name,
    s_acctbal AS account_balance, DATE '{FIRST_LOAD}' AS load_date FROM supplier),
new AS (
  SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END AS party_id, c_name AS party_name,
    c_acctbal AS account_balance, DATE '{SECOND_LOAD}' AS load_date FROM customer)"""


def _parties(spark: SparkSession, sf_dir: str, table: str, prefix: str, key) -> DataFrame:
    """Rows (partyId, partyName, accountBalance); a party in debt has no id."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(F.when(F.col(f"{prefix}_acctbal") >= 0, key).alias("partyId"),
                     F.col(f"{prefix}_name").alias("partyName"),
                     F.col(f"{prefix}_acctbal").alias("accountBalance"))


@_register("save_merge", _PARTIES + """
SELECT old.* FROM old ANTI JOIN new ON old.party_id = new.party_id
UNION ALL SELECT * FROM new""")
def q_save_merge(spark, sf_dir):
    """Kept, changed and inserted rows, and null keys on both sides."""
    folder, database = _lake(spark, "merge")
    old = _parties(spark, sf_dir, "supplier", "s", F.col("s_suppkey") * 40)
    new = _parties(spark, sf_dir, "customer", "c", F.col("c_custkey"))
    save_with_merge(old, f"{folder}/parties", database, "parties", "partyId", FIRST_LOAD)
    return save_with_merge(new, f"{folder}/parties", database, "parties", "partyId", SECOND_LOAD)


#: The first load holds the orders created before the end of 1998, the second those since
#: the start of that year: the orders of 1998 come twice.
_LOADED = f"""CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN DATE '{FIRST_LOAD}'
  ELSE DATE '{SECOND_LOAD}' END AS load_date"""


def _incremental(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    def build(folder, database):
        bronze = L.bronze(spark, sf_dir)
        created = F.get_json_object("orderDetails", "$.creationDate")
        tables = ("orders", "items")
        bronze_to_silver(bronze.where(created < "1999"), folder, database, tables, FIRST_LOAD)
        return bronze_to_silver(bronze.where(created >= "1998"), folder, database, tables,
                                SECOND_LOAD)
    return _once(spark, sf_dir, "incremental", build)


@_register("incremental_load_orders", O.with_silver("orders") + f"""
SELECT s.*, {_LOADED} FROM s_orders s JOIN orders o ON s.order_id = CAST(o.o_orderkey AS VARCHAR)""")
def q_incremental_load_orders(spark, sf_dir):
    return _incremental(spark, sf_dir)["orders"]


@_register("incremental_load_items", O.with_silver("items") + f"""
SELECT s.*, {_LOADED} FROM s_items s JOIN orders o ON s.order_id = CAST(o.o_orderkey AS VARCHAR)""")
def q_incremental_load_items(spark, sf_dir):
    return _incremental(spark, sf_dir)["items"]


def _gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    def build(folder, database):
        bronze_to_silver(L.bronze(spark, sf_dir), folder, database, L.GOLD1_INPUTS, FIRST_LOAD)
        return silver_to_gold(spark, folder, database, SECOND_LOAD)
    return _once(spark, sf_dir, "gold", build)


@_register("saved_order_summary",
           f"SELECT *, DATE '{SECOND_LOAD}' AS load_date FROM ({O.order_summary_sql()})")
def q_saved_order_summary(spark, sf_dir):
    return _gold(spark, sf_dir)["order_summary"]


@_register("saved_kpi_table",
           f"SELECT *, DATE '{SECOND_LOAD}' AS load_date FROM ({O.kpi_table_sql()})")
def q_saved_kpi_table(spark, sf_dir):
    return _gold(spark, sf_dir)["kpi_table"]


# --- batches that do not fit, touch little, or take rows away -----------------------------

@_register("upsert_parts", """
WITH b AS (
  SELECT 1 AS batch, o_orderkey AS order_key, o_orderstatus AS status, o_totalprice AS price FROM orders WHERE o_orderkey % 3 <> 0
  UNION ALL SELECT 2, o_orderkey, o_orderstatus, o_totalprice + 1 FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 10 = 1
  UNION ALL SELECT 3, o_orderkey, 'Z', o_totalprice FROM orders WHERE o_orderkey % 100 = 7)
SELECT order_key, status, price, DATE '2024-01-01' + CAST(batch AS INTEGER) AS load_date FROM b
QUALIFY row_number() OVER (PARTITION BY order_key ORDER BY batch DESC) = 1""")
def q_upsert_parts(spark, sf_dir):
    """Three uneven batches into a table of 32 parts; each writes the parts its keys fall in."""
    folder, database = _lake(spark, "upsert_parts")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("orderKey"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    key = F.col("orderKey")
    batches = [orders.where(key % 3 != 0),
               orders.where((key % 3 == 0) | (key % 10 == 1)).withColumn("price", F.col("price") + 1),
               orders.where(key % 100 == 7).withColumn("status", F.lit("Z"))]
    for n, rows in enumerate(batches, 1):
        out = save_with_merge(rows, f"{folder}/orders", database, "orders", "orderKey",
                              dt.date(2024, 1, 1) + dt.timedelta(days=n), parts=32)
    return out


@_register("save_reconciled", f"""
SELECT CAST(p_partkey AS BIGINT) AS part_id,
  CASE WHEN p_partkey % 4 <> 0 THEN p_name END AS name,
  CASE WHEN p_partkey % 4 = 0 THEN p_size * 10000000000 ELSE p_size END AS size,
  CASE WHEN p_partkey % 4 = 0 THEN DATE '{SECOND_LOAD}' ELSE DATE '{FIRST_LOAD}' END AS load_date,
  CASE WHEN p_partkey % 4 = 0 THEN p_brand END AS brand
FROM part""")
def q_save_reconciled(spark, sf_dir):
    """A second batch that lacks a column, has a new one and two of wider types."""
    folder, database = _lake(spark, "reconciled")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    key, size = F.col("p_partkey"), F.col("p_size")
    first = part.select(key.cast("int").alias("partId"), F.col("p_name").alias("name"), size.cast("int").alias("size"))
    second = part.where(key % 4 == 0).select(key.cast("bigint").alias("partId"), F.col("p_brand").alias("brand"),
                                             (size.cast("bigint") * 10_000_000_000).alias("size"))
    save_with_merge(first, f"{folder}/parts", database, "parts", "partId", FIRST_LOAD)
    return save_with_merge(second, f"{folder}/parts", database, "parts", "partId", SECOND_LOAD)


@_register("save_changes", """
WITH old AS (SELECT l_orderkey AS k, l_linenumber AS line, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem),
new AS (
  SELECT k, line, CASE WHEN line = 2 THEN quantity + 1 ELSE quantity END AS quantity FROM old
  WHERE k % 5 = 0 AND k % 25 <> 0 AND line <= 3),
c AS (
  SELECT k, line, quantity, count(*) FILTER (s = 0) AS was, count(*) FILTER (s = 1) AS now
  FROM (SELECT *, 0 AS s FROM old WHERE k % 5 = 0 UNION ALL SELECT *, 1 FROM new) GROUP BY k, line, quantity),
g AS (SELECT *, bool_or(now > was) OVER (PARTITION BY k) AND bool_or(now < was) OVER (PARTITION BY k) AS paired FROM c)
SELECT k AS order_key, line, quantity,
  CASE WHEN paired THEN 'updated' WHEN now > was THEN 'inserted' ELSE 'removed' END AS change_kind,
  CAST(sign(now - was) AS INTEGER) AS change_sign
FROM g, range(abs(now - was))
UNION ALL SELECT k, line, quantity, 'unchanged', 0 FROM g, range(least(was, now))""")
def q_save_changes(spark, sf_dir):
    """What a load of every fifth order changed: lines beyond the third go, one changes, some orders
    lose all lines."""
    folder, database = _lake(spark, "changes")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_orderkey").alias("orderKey"), F.col("l_linenumber").alias("line"),
        F.col("l_quantity").cast("bigint").alias("quantity"))
    key = F.col("orderKey")
    come = lines.where((key % 5 == 0) & (key % 25 != 0) & (F.col("line") <= 3)) \
        .withColumn("quantity", F.when(F.col("line") == 2, F.col("quantity") + 1).otherwise(F.col("quantity")))
    save = lambda rows, date, groups=None: save_with_merge(
        rows, f"{folder}/lines", database, "lines", None, date, replace_by=["order_key"], groups=groups, changes=True)
    save(lines, FIRST_LOAD)
    save(come, SECOND_LOAD, lines.where(key % 5 == 0).select("orderKey").distinct())
    return read_changes(spark, f"{folder}/lines", 1).drop("load_date", "version")


@_register("incremental_emptied_orders", O.with_silver("items") + f"""
SELECT s.*, DATE '{FIRST_LOAD}' AS load_date FROM s_items s WHERE CAST(s.order_id AS BIGINT) % 20 <> 0""")
def q_incremental_emptied_orders(spark, sf_dir):
    """Every twentieth order comes again without items: its item rows go."""
    folder, database = _lake(spark, "emptied")
    bronze_to_silver(L.bronze(spark, sf_dir), folder, database, ("items",), FIRST_LOAD)
    key = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderkey % 20 = 0").select(F.col("o_orderkey").cast("string").alias("k"))
    emptied = key.select(F.concat(F.lit('{"orderId":"'), "k", F.lit('","items":[]}')).alias("orderDetails"))
    return bronze_to_silver(emptied, folder, database, ("items",), SECOND_LOAD)["items"]


@_register("rejected_documents", """
WITH d AS (
  SELECT o_orderkey AS k, '{"orderId":"' || o_orderkey || '","status":"' || o_orderstatus || '"}' AS whole FROM orders),
t AS (
  SELECT CASE k % 20 WHEN 0 THEN left(whole, len(whole) - 3) WHEN 1 THEN replace(whole, 'orderId', 'id') WHEN 2 THEN NULL
              WHEN 3 THEN replace(whole, '"status"', '"value":"none","status"') END AS document,
         CASE k % 20 WHEN 0 THEN 'malformed' WHEN 1 THEN 'no order id' WHEN 2 THEN 'no document'
              WHEN 3 THEN 'field of another type' END AS reason, k % 20 = 3 AS is_kept
  FROM d WHERE k % 20 < 4)
SELECT coalesce(sha256(document), '') AS document_digest, document, reason, is_kept, count(*) AS copies
FROM t GROUP BY ALL""")
def q_rejected_documents(spark, sf_dir):
    """Cut off, without an order id, without text, with a field of another type."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    whole = F.concat(F.lit('{"orderId":"'), F.col("o_orderkey").cast("string"), F.lit('","status":"'),
                     F.col("o_orderstatus"), F.lit('"}'))
    part = F.col("o_orderkey") % 20
    text = F.when(part == 0, F.expr("left(whole, length(whole) - 3)")) \
        .when(part == 1, F.replace("whole", F.lit("orderId"), F.lit("id"))).when(part == 2, F.lit(None)) \
        .when(part == 3, F.replace("whole", F.lit('"status"'), F.lit('"value":"none","status"'))).otherwise(F.col("whole"))
    bronze = orders.withColumn("whole", whole).select(text.alias("orderDetails"))
    return rejects.rejected(rejects.parse_checked(bronze, fields=["orderId", "status", "value"]))


@_register("dedupe_map_rows", O.with_silver("rates_and_benefits") + f"""
SELECT DISTINCT * FROM {O.cte_name("rates_and_benefits")}""")
def q_dedupe_map_rows(spark, sf_dir):
    """Full-row dedupe of a table with a map column; entries stand in another order in every second copy."""
    rates = L.silver(spark, sf_dir, "rates_and_benefits")
    maps = [f.name for f in rates.schema.fields if f.dataType.typeName() == "map"]
    turned = rates.withColumns({m: F.map_from_entries(F.reverse(F.map_entries(m))) for m in maps})
    kept = drop_duplicate_rows(turned.union(rates))
    return kept.withColumns({m: F.to_json(m) for m in maps})


@_register("load_date_today", "SELECT c_custkey, TRUE AS is_today FROM customer")
def q_load_date_today(spark, sf_dir):
    """The load date without a given day (X5) is the current date."""
    rows = with_load_date(spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey"))
    return rows.select("c_custkey", (F.col("load_date") == F.current_date()).alias("is_today"))


@_register("json_lines_inferred", """
SELECT c_custkey AS custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS name,
  CASE WHEN c_custkey % 2 = 1 THEN CAST(c_nationkey AS BIGINT) END AS nation,
  CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS segment
FROM customer""")
def q_json_lines_inferred(spark, sf_dir):
    """JSON lines whose records differ from file to file; the schema is inferred over all files."""
    path = _folder(spark, "json_drift")
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet")
    even = rows.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"))
    odd = rows.where("c_custkey % 2 = 1").select(
        F.col("c_custkey").alias("custkey"), F.struct(F.col("c_nationkey").cast("bigint").alias("nation"),
                                                       F.col("c_mktsegment").alias("segment")).alias("place"))
    even.write.json(f"{path}/a")
    odd.write.json(f"{path}/b")
    read = read_documents(spark, f"{path}/*", infer_schema=True)
    return read.select("custkey", "name", "place.nation", "place.segment")


@_register("stream_new_files", O.with_silver("orders") + f"""
SELECT s.*, {_LOADED} FROM s_orders s JOIN orders o ON s.order_id = CAST(o.o_orderkey AS VARCHAR)""")
def q_stream_new_files(spark, sf_dir):
    """Two drops of files into one folder, each loaded by a run of the stream; the orders of 1998 come
    twice; a third run finds nothing."""
    folder, database = _lake(spark, "stream")
    bronze, created = L.bronze(spark, sf_dir), F.get_json_object("orderDetails", "$.creationDate")
    for rows, date in ((bronze.where(created < "1999"), FIRST_LOAD), (bronze.where(created >= "1998"), SECOND_LOAD),
                       (None, dt.date(2024, 2, 2))):
        if rows is not None:
            write_bronze(rows, f"{folder}/drops", mode="append")
        load_new_files(spark, f"{folder}/drops", folder, database, f"{folder}/marks", ("orders",), date)
    return spark.table(f"{database}.orders").drop("key_part")


def _maintained(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Two loads, after each of which the gold state follows: the orders created before 1999, of which
    those of 1998 have another status and quantity than later; then the orders since 1998."""
    def build(folder, database):
        bronze, created = L.bronze(spark, sf_dir), F.get_json_object("orderDetails", "$.creationDate")
        wrong = F.regexp_replace(F.regexp_replace("orderDetails", '"quantity":', '"quantity":1'), '"status":"invoiced"', '"status":"open"')
        first = bronze.where(created < "1999").withColumn(
            "orderDetails", F.when(created >= "1998", wrong).otherwise(F.col("orderDetails")))
        for rows in (first, bronze.where(created >= "1998")):
            bronze_to_silver(rows, folder, database, maintained.INPUTS, FIRST_LOAD, changes=True, parts=4)
            maintained.update_gold(spark, folder, database, FIRST_LOAD)
        return maintained.read_gold(spark, folder, SECOND_LOAD)
    return _once(spark, sf_dir, "maintained", build)


@_register("maintained_order_summary", O.order_summary_sql())
def q_maintained_order_summary(spark, sf_dir):
    return _maintained(spark, sf_dir)["order_summary"]


@_register("maintained_kpi_table", O.kpi_table_sql())
def q_maintained_kpi_table(spark, sf_dir):
    return _maintained(spark, sf_dir)["kpi_table"]
