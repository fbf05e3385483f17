"""Gold table 2: KPI table (metrics K1-K15).

Input: the stored silver tables ``orders``, ``items``, ``client_profile``; none of them is
deduplicated here.  Same-named metrics differ from the order summary on purpose
(quantity by product id, sales value as a sum of selling prices, orders per e-mail).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.scalars import try_ratio_pct
from orderlake.operators.metrics import (add_global_metrics, add_key_metrics,
                                         attach_metrics, distinct_count_with_null,
                                         global_metrics)

# Output columns of the KPI table, in order.
KPI_COLUMNS = [
    "product_id", "total_orders", "completed_orders", "canceled_orders",
    "total_order_value", "average_order_value", "fulfillment_rate", "cancellation_rate",
    "customer_lifetime_value", "total_orders_per_customer", "average_items_per_order",
    "total_quantity_sold", "total_sales_value", "average_price", "at_load_date"]


def product_metrics(items: DataFrame) -> DataFrame:
    """K1-K3: per product id, quantity and selling-price sums (null product is a group of
    its own) and the average list price (null product gets null), from one aggregate."""
    return add_key_metrics(
        items, "product_id",
        window={"total_quantity_sold": F.sum("items_quantity"),
                "total_sales_value": F.sum("selling_price")},
        joined={"average_price": F.avg("list_price")})


def _order_aggregates() -> dict[str, Column]:
    completed = F.count_if(F.col("is_completed") == F.lit(True))
    canceled = F.count_if(F.col("status") == F.lit("canceled"))
    rows = F.count(F.lit(1))
    return {
        "total_orders": distinct_count_with_null("order_id"),
        "completed_orders": completed,
        "cancelled_orders": canceled,
        "total_order_value": F.sum("value"),
        "average_order_value": F.avg("value"),
        "fulfillment_rate": try_ratio_pct(completed, rows),
        "cancellation_rate": try_ratio_pct(canceled, rows),
    }


def order_kpis(orders: DataFrame) -> DataFrame:
    """K4-K10 as one row (one pass over the orders)."""
    return global_metrics(orders, **_order_aggregates())


def orders_with_kpis(orders: DataFrame) -> DataFrame:
    """K4-K10 repeated on every order row."""
    return add_global_metrics(orders, **_order_aggregates())


def distinct_customers(client_profile: DataFrame) -> DataFrame:
    """Distinct e-mail addresses, null counted."""
    return client_profile.agg(distinct_count_with_null("email").alias("distinct_customers"))


def customer_metrics(orders: DataFrame, items: DataFrame,
                     client_profile: DataFrame) -> DataFrame:
    """K12-K14 per e-mail, joined back to every profile row (null e-mail gets null).

    K12 sums order value and K13 counts orders over profile x orders; K14 divides summed
    item quantity by the count of rows over profile x orders x items.  Items are summed
    and counted per order first, so their rows are never multiplied or sent to an e-mail;
    an e-mail without items gets null for K14.
    """
    per_order = items.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(
        F.sum("items_quantity").alias("quantity"), F.count(F.lit(1)).alias("item_rows"))
    po = client_profile.select("order_id", "email").where(F.col("email").isNotNull()).join(
        orders.select("order_id", "value"), "order_id").join(per_order, "order_id", "left")
    metrics = po.groupBy("email").agg(
        F.sum("value").alias("customer_lifetime_value"),
        F.count("order_id").alias("total_orders_per_customer"),
        F.try_divide(F.sum("quantity").cast("double"),
                     F.sum("item_rows").cast("double")).alias("average_items_per_order"))
    return attach_metrics(client_profile, metrics, "email")


def kpi_table(silver: dict[str, DataFrame], load_date: dt.date | None = None) -> DataFrame:
    """Orders full-outer items full-outer profiles, inner-joined to the enriched
    profiles on order_id; 15 columns.

    The trailing inner join keeps only order ids of enriched profile rows, and every
    such id is a key of the profiles input of the outer chain.  So the chain reduces to
    left joins from the enriched rows: for an order id k the rows are
    enriched(k) x max(1, orders(k)) x max(1, items(k)) x max(1, profiles(k)), exactly
    the chain's, with no key spine and no null-key rows (an inner join drops those).
    """
    orders, items, profiles = silver["orders"], silver["items"], silver["client_profile"]
    orders_k = orders_with_kpis(orders)
    items_k = product_metrics(items)
    enriched = customer_metrics(orders, items, profiles)
    joined = (enriched.select("order_id", "customer_lifetime_value",
                              "total_orders_per_customer", "average_items_per_order")
              .where(F.col("order_id").isNotNull())
              .join(orders_k.select("order_id", "total_orders", "completed_orders",
                                    "cancelled_orders", "total_order_value",
                                    "average_order_value", "fulfillment_rate",
                                    "cancellation_rate"), "order_id", "left")
              .join(profiles.select("order_id"), "order_id", "left")
              .join(items_k.select("order_id", "product_id", "total_quantity_sold",
                                   "total_sales_value", "average_price"), "order_id", "left"))
    at = F.current_date() if load_date is None else F.lit(load_date)
    return joined.select(
        "product_id", "total_orders", "completed_orders",
        F.col("cancelled_orders").alias("canceled_orders"),
        "total_order_value", "average_order_value", "fulfillment_rate",
        "cancellation_rate", "customer_lifetime_value", "total_orders_per_customer",
        "average_items_per_order", "total_quantity_sold", "total_sales_value",
        "average_price", at.alias("at_load_date"))
