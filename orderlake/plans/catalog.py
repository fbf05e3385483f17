"""Registered queries: one per operator or metric, each with its independent SQL answer.

Every query reads the flat input tables of an ``sf_dir`` (or layers Spark derives from
them) in full.  ``QUERIES[name] = (spark_query, sql)``; ``sql`` is ``None`` where no SQL
form is given.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.functions.naming import snake_case_columns
from orderlake.operators import flatten as FL
from orderlake.operators.joins import full_outer_chain
from orderlake.operators.metrics import add_global_metrics, add_group_metric, attach_metrics
from orderlake.plans import kpi as K
from orderlake.plans import layers as L
from orderlake.plans import oracle as O
from orderlake.plans import saved
from orderlake.plans import summary as S
from orderlake.sources.upsert import merge_by_key, with_load_date

LOAD_DATE = dt.date.fromisoformat(O.FIXED_LOAD_DATE)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Query, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _silver(spark, sf_dir, *names):
    return L.silver_set(spark, sf_dir, *names)


# ---------------------------------------------------------------------------
# Generic operators (sources, projections, generators, joins, aggregates, sinks)
# ---------------------------------------------------------------------------

@register("scan_table", "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders")
def q_scan_table(spark, sf_dir):
    return _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")


@register("filter_equality", "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders "
                             "WHERE o_orderstatus = 'F'")
def q_filter_equality(spark, sf_dir):
    return (_table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
            .select("o_orderkey", "o_totalprice", "o_orderdate"))


@register("parse_json_column", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER)"
                               " AS k FROM events")
def q_parse_json_column(spark, sf_dir):
    from orderlake.sources.ingest import parse_json_column
    return (parse_json_column(_table(spark, sf_dir, "events"), "props", "k INT")
            .select("event_id", F.col("props.k").alias("k")))


@register("snake_case_columns",
          "SELECT c_custkey AS customer_key, c_name AS customer_name, "
          "c_nationkey AS nation_key, c_acctbal AS acct_bal, "
          "c_mktsegment AS market_segment FROM customer")
def q_snake_case_columns(spark, sf_dir):
    df = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customerKey"), F.col("c_name").alias("CustomerName"),
        F.col("c_nationkey").alias("nationKey"), F.col("c_acctbal").alias("acctBAL"),
        F.col("c_mktsegment").alias("MarketSegment"))
    return snake_case_columns(df)


@register("explode_position",
          "SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, "
          "unnest(embedding) AS value FROM embeddings")
def q_explode_position(spark, sf_dir):
    return _table(spark, sf_dir, "embeddings").select(
        "vec_id", F.posexplode("embedding").alias("pos", "value"))


@register("explode_inner", """
SELECT vec_id, label, unnest(embedding) AS value FROM embeddings WHERE label > 1""")
def q_explode_inner(spark, sf_dir):
    """Labels 0 and null have a null array, label 1 an empty one: their rows go."""
    label = F.col("label")
    values = (F.when(label == 1, F.array().cast("array<float>"))
              .when(label > 1, F.col("embedding")))
    df = _table(spark, sf_dir, "embeddings").select("vec_id", "label", values.alias("value"))
    return FL.explode_inner(df, "value")


@register("explode_outer", """
SELECT vec_id, label, unnest(embedding) AS value FROM embeddings
WHERE coalesce(label <> 0 AND len(embedding) > 0, FALSE)
UNION ALL
SELECT vec_id, label, CAST(NULL AS FLOAT) AS value FROM embeddings
WHERE NOT coalesce(label <> 0 AND len(embedding) > 0, FALSE)""")
def q_explode_outer(spark, sf_dir):
    df = _table(spark, sf_dir, "embeddings")
    df = df.withColumn("value", F.when(F.col("label") != 0, F.col("embedding")))
    return FL.explode_outer(df, "value").select("vec_id", "label", "value")


def _doc_items(spark, sf_dir, *reads):
    """Items of the documents, parsed for the fields ``reads`` of an item."""
    return L.parsed(spark, sf_dir, "items", only=["orderId", *(f"items.{path}" for path in reads)]).select(
        F.col("orderId").alias("order_id"), F.explode("items").alias("it"))


@register("explode_map", O.with_silver(extra="""
cm_rows AS (
  SELECT li.*, cm.j AS cm_j FROM li
  LEFT JOIN (VALUES (1), (2)) cm(j)
    ON cm.j <= CASE WHEN ln IN (1, 2) THEN 0
                    WHEN ln = 6 OR (ln = 5 AND pk % 4 = 0) THEN 2 ELSE 1 END)""") + """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_orderkey || '-' || ln || '-' || pk AS unique_id,
  CASE cm_j WHEN 1 THEN 'color' WHEN 2 THEN 'engraving' END AS content_key,
  CASE cm_j
    WHEN 1 THEN CASE WHEN ln = 6 OR (ln = 5 AND pk % 4 = 0) THEN 'blue' ELSE 'red' END
    WHEN 2 THEN CASE WHEN sk % 5 = 0 THEN NULL ELSE 'E' || sk END END AS content_value
FROM cm_rows""")
def q_explode_map(spark, sf_dir):
    items = _doc_items(spark, sf_dir, "uniqueId", "itemAttachment.content").select(
        "order_id", F.col("it.uniqueId").alias("unique_id"),
        F.col("it.itemAttachment.content").alias("content"))
    return FL.explode_map(items, "content", "content_key", "content_value")


@register("explode_chain", O.with_silver() + """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_orderkey || '-' || ln || '-' || pk AS unique_id,
  CASE pt.i WHEN 1 THEN 'tag-' || l_returnflag WHEN 2 THEN 'tag-' || l_linestatus END AS price_tag,
  CASE cat.c WHEN 1 THEN 'Cat' || (pk % 10) WHEN 2 THEN 'Sub' || (pk % 10) END AS category_name
FROM li
LEFT JOIN (VALUES (1), (2)) pt(i)
  ON pt.i <= CASE WHEN ln IN (1, 2) THEN 0 WHEN ln = 5 THEN 2 ELSE 1 END
LEFT JOIN (VALUES (1), (2)) cat(c)
  ON cat.c <= CASE WHEN ln = 7 AND pk % 2 = 0 THEN 2 ELSE 1 END""")
def q_explode_chain(spark, sf_dir):
    items = _doc_items(spark, sf_dir, "uniqueId", "priceTags", "additionalInfo.categories.name").select(
        "order_id", F.col("it.uniqueId").alias("unique_id"),
        F.col("it.priceTags").alias("price_tag"),
        F.col("it.additionalInfo.categories").alias("category"))
    out = FL.explode_chain(items, ["price_tag", "category"])
    return out.select("order_id", "unique_id", "price_tag",
                      F.col("category.name").alias("category_name"))


@register("expand_struct", O.with_silver() + """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 'residential' AS address_type,
  c_name AS receiver_name, 'A' || o_orderkey AS address_id,
  CAST(NULL AS VARCHAR) AS version_id, CAST(NULL AS VARCHAR) AS entity_id,
  CAST(o_orderkey % 90000 + 10000 AS VARCHAR) AS postal_code,
  'City' || (o_orderkey % 20) AS city, 'ST' || (o_orderkey % 5) AS state,
  'BRA' AS country, 'Street ' || (o_orderkey % 100) AS street,
  CAST(o_orderkey % 1000 AS VARCHAR) AS number, CAST(NULL AS VARCHAR) AS neighborhood,
  CAST(NULL AS VARCHAR) AS complement, CAST(NULL AS VARCHAR) AS reference,
  CAST(NULL AS FLOAT[]) AS geo_coordinates
FROM ord""")
def q_expand_struct(spark, sf_dir):
    docs = L.parsed(spark, sf_dir, "shipping_data", only=["orderId", "shippingData.address"]).select(
        "orderId", F.col("shippingData.address").alias("address"))
    return snake_case_columns(FL.expand(docs, "address"))


@register("drop_all_null", O.with_silver() + """
SELECT 'MD' || o_orderkey AS id, 'src' || (o_orderkey % 3) AS utm_source,
  CAST(NULL AS VARCHAR) AS utm_partner, 'cpc' AS utm_medium,
  'camp' || (o_orderkey % 4) AS utm_campaign,
  CASE WHEN o_orderkey % 6 = 0 THEN 'CUP10' END AS coupon
FROM ord WHERE o_orderkey % 2 = 0""")
def q_drop_all_null(spark, sf_dir):
    docs = L.parsed(spark, sf_dir, "marketing")
    df = docs.select(*[F.col(f"marketingData.{c}").alias(c) for c in
                       ("id", "utmSource", "utmPartner", "utmMedium", "utmCampaign",
                        "coupon")])
    return snake_case_columns(FL.drop_all_null(df))


@register("drop_duplicates", O.with_silver("payment") + "\nSELECT DISTINCT * FROM s_payment")
def q_drop_duplicates(spark, sf_dir):
    return _silver(spark, sf_dir, "payment")["payment"].dropDuplicates()


@register("distinct_values",
          "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def q_distinct_values(spark, sf_dir):
    return _table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@register("inner_join", O.with_silver("items", "cancellation") + """
SELECT c.order_id, c.reason, i.unique_id, i.product_id
FROM s_cancellation c JOIN s_items i ON c.order_id = i.order_id""")
def q_inner_join(spark, sf_dir):
    s = L.silver_set(spark, sf_dir, "items", "cancellation", for_gold=True)
    return (s["cancellation"].select("order_id", "reason")
            .join(s["items"].select("order_id", "unique_id", "product_id"), "order_id"))


@register("left_join", """
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def q_left_join(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return (o.join(c, o["o_custkey"] == c["c_custkey"], "left")
            .select("o_orderkey", "o_custkey", "c_name", "c_mktsegment"))


@register("full_outer_join", O.with_silver("totals", "sellers", "marketplace_items") + """
SELECT order_id, total_id, total_value, seller_id, marketplace_items
FROM (SELECT order_id, id AS total_id, value AS total_value FROM s_totals) a
FULL OUTER JOIN (SELECT order_id, id AS seller_id FROM s_sellers) b USING (order_id)
FULL OUTER JOIN (SELECT order_id, marketplace_items FROM s_marketplace_items) c
  USING (order_id)""")
def q_full_outer_join(spark, sf_dir):
    s = _silver(spark, sf_dir, "totals", "sellers", "marketplace_items")
    return full_outer_chain([
        s["totals"].select("order_id", F.col("id").alias("total_id"),
                           F.col("value").alias("total_value")),
        s["sellers"].select("order_id", F.col("id").alias("seller_id")),
        s["marketplace_items"].select("order_id", "marketplace_items"),
    ], "order_id")


@register("group_join_back", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, g.part_quantity
FROM lineitem l LEFT JOIN (
  SELECT l_partkey, sum(l_quantity) AS part_quantity FROM lineitem
  WHERE l_partkey IS NOT NULL GROUP BY l_partkey) g
ON l.l_partkey = g.l_partkey""")
def q_group_join_back(spark, sf_dir):
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return add_group_metric(li, "l_partkey", part_quantity=F.sum("l_quantity")) \
        .select("l_orderkey", "l_linenumber", "l_partkey", "part_quantity")


@register("group_join_back_null", """
SELECT l.l_orderkey, l.l_linenumber, l.part_key, g.part_quantity
FROM (SELECT *, CASE WHEN l_returnflag <> 'N' THEN l_partkey END AS part_key FROM lineitem) l
LEFT JOIN (SELECT l_partkey, sum(l_quantity) AS part_quantity FROM lineitem
           WHERE l_returnflag <> 'N' GROUP BY l_partkey) g
ON l.part_key = g.l_partkey""")
def q_group_join_back_null(spark, sf_dir):
    """Lines that were not returned yet have a null key, and so a null metric."""
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.when(F.col("l_returnflag") != "N", F.col("l_partkey")).alias("part_key"))
    return add_group_metric(li, "part_key", part_quantity=F.sum("l_quantity")) \
        .select("l_orderkey", "l_linenumber", "part_key", "part_quantity")


@register("left_join_unmatched", """
SELECT s.s_name, s.party_id, g.n_orders
FROM (SELECT s_name, CASE WHEN s_acctbal >= 0 THEN s_suppkey * 40 END AS party_id
      FROM supplier) s
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) g
ON s.party_id = g.o_custkey""")
def q_left_join_unmatched(spark, sf_dir):
    """Keys with a match, keys without one, and null keys."""
    parties = _table(spark, sf_dir, "supplier").select(
        "s_name", F.when(F.col("s_acctbal") >= 0, F.col("s_suppkey") * 40).alias("party_id"))
    counts = (_table(spark, sf_dir, "orders")
              .groupBy(F.col("o_custkey").alias("party_id"))
              .agg(F.count(F.lit(1)).alias("n_orders")))
    return attach_metrics(parties, counts, "party_id").select("s_name", "party_id", "n_orders")


@register("full_outer_null_keys", """
SELECT party_id, c_name, s_name, p_name
FROM (SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END AS party_id, c_name FROM customer) a
FULL OUTER JOIN (SELECT CASE WHEN s_acctbal >= 0 THEN s_suppkey * 40 END AS party_id, s_name
                 FROM supplier) b USING (party_id)
FULL OUTER JOIN (SELECT CASE WHEN p_size > 5 THEN p_partkey + 100 END AS party_id, p_name
                 FROM part) c USING (party_id)""")
def q_full_outer_null_keys(spark, sf_dir):
    """Every input has null keys, and keys that no other input has."""
    def keyed(table, key, name):
        return _table(spark, sf_dir, table).select(key.alias("party_id"), name)
    return full_outer_chain([
        keyed("customer", F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")), "c_name"),
        keyed("supplier", F.when(F.col("s_acctbal") >= 0, F.col("s_suppkey") * 40), "s_name"),
        keyed("part", F.when(F.col("p_size") > 5, F.col("p_partkey") + 100), "p_name"),
    ], "party_id")


@register("global_metrics", """
SELECT o_orderkey, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS order_cents,
  CAST(sum(CAST(ROUND(o_totalprice * 100) AS BIGINT)) OVER () AS BIGINT) AS total_cents,
  avg(CAST(ROUND(o_totalprice * 100) AS BIGINT)) OVER () AS avg_cents,
  count(*) OVER () AS n_orders
FROM orders""")
def q_global_metrics(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").select(
        "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("order_cents"))
    return add_global_metrics(o, total_cents=F.sum("order_cents"),
                              avg_cents=F.avg("order_cents"), n_orders=F.count(F.lit(1)))


@register("distinct_count_null", O.with_silver("client_profile") + """
SELECT count(*) AS distinct_customers FROM (SELECT DISTINCT email FROM s_client_profile)""")
def q_distinct_count_null(spark, sf_dir):
    return K.distinct_customers(_silver(spark, sf_dir, "client_profile")["client_profile"])


@register("merge_by_key", O.with_silver("orders", extra="""
src AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, 'repriced' AS status,
    CAST(sum(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS value
  FROM lineitem GROUP BY l_orderkey)""") + """
SELECT t.order_id, t.status, CAST(t.value AS BIGINT) AS value
FROM s_orders t ANTI JOIN src ON t.order_id = src.order_id
UNION ALL SELECT order_id, status, value FROM src""")
def q_merge_by_key(spark, sf_dir):
    target = (_silver(spark, sf_dir, "orders")["orders"]
              .select("order_id", "status", F.col("value").cast("bigint").alias("value")))
    source = (_table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
              .agg(F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("value"))
              .select(F.col("l_orderkey").cast("string").alias("order_id"),
                      F.lit("repriced").alias("status"), "value"))
    return merge_by_key(target, source, ["order_id"])


@register("load_date", O.with_silver("orders") +
          f"\nSELECT order_id, DATE '{O.FIXED_LOAD_DATE}' AS load_date FROM s_orders")
def q_load_date(spark, sf_dir):
    orders = _silver(spark, sf_dir, "orders")["orders"].select("order_id")
    return with_load_date(orders, LOAD_DATE)


# ---------------------------------------------------------------------------
# Silver tables B0-B14 (stored form; the one map column as JSON text)
# ---------------------------------------------------------------------------

def _silver_query(name: str) -> Query:
    def run(spark, sf_dir):
        df = L.silver(spark, sf_dir, name)
        if name == "rates_and_benefits":
            df = df.withColumn("matched_parameters", F.to_json("matched_parameters"))
        return df
    return run


for _name in ("orders", "totals", "items", "marketplace_items", "client_profile",
              "rates_and_benefits", "marketing", "shipping_data", "store_preferences",
              "payment", "package_attachment", "sellers", "item_metadata",
              "client_preferences", "cancellation"):
    register(f"silver_{_name}", O.silver_sql(_name))(_silver_query(_name))


# ---------------------------------------------------------------------------
# Gold 1: order summary
# ---------------------------------------------------------------------------

def _g1(spark, sf_dir, *names):
    return L.gold1_inputs(spark, sf_dir, *names)


@register("gold1_order_id_groups", O.gold1_plain(
    "SELECT count(*) AS order_id_groups FROM (SELECT DISTINCT order_id FROM {orders})"))
def q_g1_order_id_groups(spark, sf_dir):
    return S.order_id_groups(_g1(spark, sf_dir, "orders")["orders"])


def _orders_m(spark, sf_dir):
    return S.order_metrics(_g1(spark, sf_dir, "orders")["orders"])


@register("gold1_fulfillment_time", O.gold1_sql(
    "orders", ["order_id", "fulfillment_time"]))
def q_g1_fulfillment_time(spark, sf_dir):
    return _orders_m(spark, sf_dir).select("order_id", "fulfillment_time")


@register("gold1_order_status_count", O.gold1_sql(
    "orders", ["order_id", "status", "order_status_count"]))
def q_g1_order_status_count(spark, sf_dir):
    return _orders_m(spark, sf_dir).select("order_id", "status", "order_status_count")


@register("gold1_total_orders_per_channel", O.gold1_sql(
    "orders", ["order_id", "sales_channel", "total_orders_per_channel"]))
def q_g1_orders_per_channel(spark, sf_dir):
    return _orders_m(spark, sf_dir).select("order_id", "sales_channel",
                                           "total_orders_per_channel")


@register("gold1_total_sales_value_per_channel", O.gold1_sql(
    "orders", ["order_id", "sales_channel", "total_sales_value_per_channel"]))
def q_g1_sales_per_channel(spark, sf_dir):
    return _orders_m(spark, sf_dir).select("order_id", "sales_channel",
                                           "total_sales_value_per_channel")


@register("gold1_payment_methods", O.gold1_plain(
    "SELECT DISTINCT payment_system_name FROM {payment}"))
def q_g1_payment_methods(spark, sf_dir):
    return S.payment_methods(_g1(spark, sf_dir, "payment")["payment"])


@register("gold1_payment_method_usage_count", O.gold1_sql(
    "payment", ["order_id", "payment_system_name", "payment_method_usage_count"]))
def q_g1_payment_usage(spark, sf_dir):
    return S.payment_metrics(_g1(spark, sf_dir, "payment")["payment"]).select(
        "order_id", "payment_system_name", "payment_method_usage_count")


@register("gold1_payment_method_total_value", O.gold1_sql(
    "payment", ["order_id", "payment_system_name", "payment_method_total_value"]))
def q_g1_payment_total(spark, sf_dir):
    return S.payment_metrics(_g1(spark, sf_dir, "payment")["payment"]).select(
        "order_id", "payment_system_name", "payment_method_total_value")


@register("gold1_shipping_cost", O.gold1_sql(
    "shipping_data", ["order_id", "price", "avg_shipping_cost", "total_shipping_cost"]))
def q_g1_shipping_cost(spark, sf_dir):
    return S.shipping_metrics(_g1(spark, sf_dir, "shipping_data")["shipping_data"]).select(
        "order_id", "price", "avg_shipping_cost", "total_shipping_cost")


@register("gold1_total_quantity_sold", O.gold1_sql(
    "items", ["order_id", "unique_id", "total_quantity_sold"]))
def q_g1_quantity(spark, sf_dir):
    return S.item_metrics(_g1(spark, sf_dir, "items")["items"]).select(
        "order_id", "unique_id", "total_quantity_sold")


@register("gold1_total_sales_value", O.gold1_sql(
    "items", ["order_id", "unique_id", "total_sales_value"]))
def q_g1_sales_value(spark, sf_dir):
    return S.item_metrics(_g1(spark, sf_dir, "items")["items"]).select(
        "order_id", "unique_id", "total_sales_value")


@register("gold1_cancel_reason_count", O.gold1_sql(
    "cancellation", ["order_id", "cancel_reason", "cancel_reason_count", "is_return"]))
def q_g1_cancel(spark, sf_dir):
    return S.cancellation_metrics(_g1(spark, sf_dir, "cancellation")["cancellation"]).select(
        "order_id", "cancel_reason", "cancel_reason_count", "is_return")


@register("gold1_return_count", O.return_count_sql())
def q_g1_return_count(spark, sf_dir):
    s = _g1(spark, sf_dir, "items", "cancellation")
    items_m = S.item_metrics(s["items"])
    return S.return_counts(items_m, s["cancellation"], s["items"]).select(
        "order_id", "product_id", "return_count")


@register("gold1_total_orders_per_customer", O.gold1_sql(
    "client_profile", ["order_id", "total_orders_per_customer", "is_repeat_customer"]))
def q_g1_customers(spark, sf_dir):
    s = _g1(spark, sf_dir, "orders", "client_profile")
    return S.customer_order_counts(s["orders"], s["client_profile"]).select(
        "order_id", "total_orders_per_customer", "is_repeat_customer")


@register("order_summary", O.order_summary_sql())
def q_order_summary(spark, sf_dir):
    return S.order_summary(_g1(spark, sf_dir), prepared=True)


# ---------------------------------------------------------------------------
# Gold 2: KPI table
# ---------------------------------------------------------------------------

def _g2(spark, sf_dir, *names):
    return L.silver_set(spark, sf_dir, *(names or L.GOLD2_INPUTS), for_gold=True)


@register("gold2_total_quantity_sold", O.gold2_sql(
    "items", ["order_id", "unique_id", "product_id", "total_quantity_sold"]))
def q_g2_quantity(spark, sf_dir):
    return K.product_metrics(_g2(spark, sf_dir, "items")["items"]).select(
        "order_id", "unique_id", "product_id", "total_quantity_sold")


@register("gold2_total_sales_value", O.gold2_sql(
    "items", ["order_id", "unique_id", "product_id", "total_sales_value"]))
def q_g2_sales(spark, sf_dir):
    return K.product_metrics(_g2(spark, sf_dir, "items")["items"]).select(
        "order_id", "unique_id", "product_id", "total_sales_value")


@register("gold2_average_price", O.gold2_sql(
    "items", ["order_id", "unique_id", "product_id", "average_price"]))
def q_g2_avg_price(spark, sf_dir):
    return K.product_metrics(_g2(spark, sf_dir, "items")["items"]).select(
        "order_id", "unique_id", "product_id", "average_price")


@register("gold2_order_metrics", O.order_kpi_sql(
    ["total_orders", "completed_orders", "canceled_orders", "total_order_value",
     "average_order_value", "fulfillment_rate", "cancellation_rate"]))
def q_g2_order_metrics(spark, sf_dir):
    return K.order_kpis(_g2(spark, sf_dir, "orders")["orders"]).withColumnRenamed(
        "cancelled_orders", "canceled_orders")


@register("gold2_distinct_customers", O.gold2_plain(
    "SELECT count(*) AS distinct_customers FROM (SELECT DISTINCT email FROM {client_profile})"))
def q_g2_distinct_customers(spark, sf_dir):
    return K.distinct_customers(_g2(spark, sf_dir, "client_profile")["client_profile"])


def _customers(spark, sf_dir):
    s = _g2(spark, sf_dir)
    return K.customer_metrics(s["orders"], s["items"], s["client_profile"])


@register("gold2_customer_lifetime_value", O.gold2_sql(
    "client_profile", ["order_id", "email", "customer_lifetime_value"]))
def q_g2_clv(spark, sf_dir):
    return _customers(spark, sf_dir).select("order_id", "email", "customer_lifetime_value")


@register("gold2_total_orders_per_customer", O.gold2_sql(
    "client_profile", ["order_id", "email", "total_orders_per_customer"]))
def q_g2_orders_per_customer(spark, sf_dir):
    return _customers(spark, sf_dir).select("order_id", "email", "total_orders_per_customer")


@register("gold2_average_items_per_order", O.gold2_sql(
    "client_profile", ["order_id", "email", "average_items_per_order"]))
def q_g2_items_per_order(spark, sf_dir):
    return _customers(spark, sf_dir).select("order_id", "email", "average_items_per_order")


@register("kpi_table", O.kpi_table_sql())
def q_kpi_table(spark, sf_dir):
    return K.kpi_table(_g2(spark, sf_dir), LOAD_DATE)


# ---------------------------------------------------------------------------
# One query per remaining metric, so each inventory line has its own check
# ---------------------------------------------------------------------------

def _projection(source: Callable[[SparkSession, str], DataFrame], cols: list[str]) -> Query:
    def run(spark, sf_dir):
        return source(spark, sf_dir).select(*cols)
    return run


def _shipping_m(spark, sf_dir):
    return S.shipping_metrics(_g1(spark, sf_dir, "shipping_data")["shipping_data"])


def _cancellation_m(spark, sf_dir):
    return S.cancellation_metrics(_g1(spark, sf_dir, "cancellation")["cancellation"])


def _customers_m(spark, sf_dir):
    s = _g1(spark, sf_dir, "orders", "client_profile")
    return S.customer_order_counts(s["orders"], s["client_profile"])


for _name, _src, _cols, _rows_of in [
    ("gold1_avg_shipping_cost", _shipping_m, ["order_id", "avg_shipping_cost"], "shipping_data"),
    ("gold1_total_shipping_cost", _shipping_m, ["order_id", "total_shipping_cost"], "shipping_data"),
    ("gold1_cancel_reason", _cancellation_m, ["order_id", "cancel_reason"], "cancellation"),
    ("gold1_is_return", _cancellation_m, ["order_id", "cancellation_date", "is_return"], "cancellation"),
    ("gold1_is_repeat_customer", _customers_m, ["order_id", "is_repeat_customer"], "client_profile"),
]:
    register(_name, O.gold1_sql(_rows_of, _cols))(
        _projection(_src, _cols))


def _order_kpis(spark, sf_dir):
    return K.order_kpis(_g2(spark, sf_dir, "orders")["orders"]).withColumnRenamed(
        "cancelled_orders", "canceled_orders")


for _col in ["total_orders", "completed_orders", "canceled_orders", "total_order_value",
             "average_order_value", "fulfillment_rate", "cancellation_rate"]:
    register(f"gold2_{_col}", O.order_kpi_sql([_col]))(_projection(_order_kpis, [_col]))

QUERIES.update(saved.QUERIES)
