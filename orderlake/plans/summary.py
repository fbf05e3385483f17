"""Gold table 1: per-order summary (metrics M0-M18).

Input: the stored silver tables (snake_case names) ``orders``, ``payment``,
``shipping_data``, ``items``, ``cancellation``, ``client_profile``.  The source
deduplicates every input except ``orders``; ``prepare_inputs`` does that once and stores
the result, and the metric steps below take its output.  Each step returns a DataFrame so
that every metric can be queried on its own; ``order_summary`` joins them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.scalars import days_between, flag
from orderlake.operators.adaptive import add_metric
from orderlake.operators.joins import full_outer_chain
from orderlake.operators.metrics import (add_global_metrics, add_key_metrics, add_partition_metric,
                                         attach_metrics, distinct_count_with_null, materialize)

# Output columns of the summary, in order.
SUMMARY_COLUMNS = [
    "order_id", "fulfillment_time", "payment_system_name", "payment_method_usage_count",
    "payment_method_total_value", "avg_shipping_cost", "total_shipping_cost", "product_id",
    "total_quantity_sold", "total_sales_value", "cancel_reason", "cancel_reason_count",
    "is_return", "return_count", "email", "total_orders_per_customer",
    "is_repeat_customer", "status", "order_status_count", "sales_channel",
    "total_orders_per_channel", "total_sales_value_per_channel"]


#: Inputs that are deduplicated, over all their columns, and the columns that the summary reads of them.
PREPARED = {
    "payment": ("order_id", "payment_system_name", "value"),
    "shipping_data": ("order_id", "price"),
    "items": ("order_id", "unique_id", "product_id", "items_quantity", "selling_price"),
    "cancellation": ("order_id", "reason", "cancellation_date"),
    "client_profile": ("order_id", "user_profile_id", "email")}
DEDUPLICATED = tuple(PREPARED)


def prepare_inputs(silver: dict[str, DataFrame], store: bool = True,
                   already_unique: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Full-row dedupe of every input but orders (A9), each computed once.

    Stored (``materialize``) by default: several metrics and the final join read the
    same deduplicated table, and reading it back is cheaper than repeating the shuffle; stored are the columns that
    the summary reads (``PREPARED``).
    Of the inputs those in ``silver`` are prepared.  ``already_unique`` names inputs known to hold no duplicate rows (for instance an
    ``items`` table straight from ``build_items``, which ends with the same full-row
    dedupe); they are used as they are.
    """
    out = {}
    for name in silver:
        if name in already_unique or name not in DEDUPLICATED:
            out[name] = silver[name]
            continue
        if not store:
            out[name] = silver[name].dropDuplicates()
            continue
        # equal rows share an order, so one shuffle by order serves the dedupe and the buckets
        buckets = int(silver[name].sparkSession.conf.get("spark.sql.shuffle.partitions"))
        unique = silver[name].repartition(buckets, "order_id").dropDuplicates().select(*PREPARED[name])
        out[name] = materialize(unique, f"gold1-{name}", bucket_by=["order_id"], prepartitioned=True)
    return out


def order_id_groups(orders: DataFrame) -> DataFrame:
    """M0: number of order-id groups (null is a group) - the key check on orders."""
    return orders.agg(distinct_count_with_null("order_id").alias("order_id_groups"))


def order_metrics(orders: DataFrame) -> DataFrame:
    """M1-M4 on the (not deduplicated) orders table."""
    out = orders.withColumn("fulfillment_time",
                            days_between("authorized_date", "creation_date"))
    out = add_partition_metric(out, "status", order_status_count=F.count("order_id"))
    return add_partition_metric(out, "sales_channel",
                                total_orders_per_channel=F.count("order_id"),
                                total_sales_value_per_channel=F.sum("value"))


def payment_methods(payment: DataFrame) -> DataFrame:
    """M5: the distinct payment methods, null kept as a value."""
    return payment.select("payment_system_name").distinct()


def payment_metrics(payment: DataFrame) -> DataFrame:
    """M6-M7 on deduplicated payments: usage count (null method counted) and total value
    (null method gets null), from one aggregate."""
    return add_key_metrics(
        payment, "payment_system_name",
        window={"payment_method_usage_count": F.count("order_id")},
        joined={"payment_method_total_value": F.sum("value")})


def shipping_metrics(shipping: DataFrame) -> DataFrame:
    """M8-M9: global average and total shipping price on every deduplicated row."""
    return add_global_metrics(shipping,
                              avg_shipping_cost=F.avg("price"),
                              total_shipping_cost=F.sum("price"))


def item_metrics(items: DataFrame) -> DataFrame:
    """M10-M11 on deduplicated items: quantity sold per unique id, row sales value."""
    # ids are nearly unique: beyond a broadcast the rows move to their id once
    out = add_metric(items, "unique_id", joined={"total_quantity_sold": F.sum("items_quantity")})
    return out.withColumn("total_sales_value",
                          F.col("items_quantity").cast("bigint")
                          * F.col("selling_price").cast("bigint"))


def cancellation_metrics(cancellation: DataFrame) -> DataFrame:
    """M12-M14 on deduplicated cancellations."""
    out = cancellation.withColumn("cancel_reason", F.col("reason"))
    out = add_partition_metric(
        out, "reason",
        cancel_reason_count=F.count(F.when(F.col("reason").isNotNull(), F.col("order_id"))))
    return out.withColumn("is_return", flag(F.col("cancellation_date").isNotNull()))


def return_counts(items_m: DataFrame, cancellation: DataFrame, items: DataFrame,
                  only_returned: bool = False) -> DataFrame:
    """Rows of cancellation x items per product id, joined back to the item rows.

    ``items_m`` gets the column; the counts come from the deduplicated ``items`` and
    ``cancellation`` tables (same rows, fewer columns).  As in the source, every
    cancellation row counts, returned or not; pass ``only_returned=True`` to count
    returned orders only.
    """
    canc = cancellation.select("order_id", "cancellation_date")
    if only_returned:
        canc = canc.where(F.col("cancellation_date").isNotNull())
    per_product = (canc.select("order_id").join(items.select("order_id", "product_id"),
                                                "order_id")
                   .groupBy("product_id").agg(F.count(F.lit(1)).alias("return_count")))
    return attach_metrics(items_m, per_product, "product_id")


def customer_order_counts(orders_m: DataFrame, profiles: DataFrame) -> DataFrame:
    """Orders per user profile (orders x deduplicated profiles), joined back to
    the profiles; repeat customer when more than one."""
    counted = (orders_m.select("order_id")
               .join(profiles.select("order_id", "user_profile_id"), "order_id")
               .where(F.col("user_profile_id").isNotNull())
               .groupBy("user_profile_id")
               .agg(F.count("order_id").alias("total_orders_per_customer")))
    out = attach_metrics(profiles, counted, "user_profile_id")
    return out.withColumn("is_repeat_customer",
                          flag(F.col("total_orders_per_customer") > 1))


def order_summary(silver: dict[str, DataFrame], only_returned: bool = False,
                  prepared: bool = False) -> DataFrame:
    """Seven inputs full-outer-joined on order_id, 22 columns.

    ``silver`` holds the stored silver tables, or ``prepare_inputs`` output when
    ``prepared``.  The join's key spine is read from the inputs' own key columns: the
    metric steps keep every input row, so they do not change the set of keys.
    """
    g = silver if prepared else prepare_inputs(silver)
    orders_m = order_metrics(g["orders"])
    payment_m = payment_metrics(g["payment"])
    shipping_m = shipping_metrics(g["shipping_data"])
    items_m = item_metrics(g["items"])
    cancellation_m = cancellation_metrics(g["cancellation"])
    items_r = return_counts(items_m, g["cancellation"], g["items"], only_returned)
    customers = customer_order_counts(g["orders"], g["client_profile"])
    # Inputs with one row per order first, the ones that multiply rows (payments,
    # shipping lines, item rows) last: every join streams the rows built so far, so the
    # full product is formed only by the final join instead of being re-streamed.
    parts = [
        orders_m.select("order_id", "fulfillment_time", "status", "order_status_count",
                        "sales_channel", "total_orders_per_channel",
                        "total_sales_value_per_channel"),
        cancellation_m.select("order_id", "cancel_reason", "cancel_reason_count",
                              "is_return"),
        g["client_profile"].select("order_id", "email"),
        customers.select("order_id", "total_orders_per_customer", "is_repeat_customer"),
        payment_m.select("order_id", "payment_system_name", "payment_method_usage_count",
                         "payment_method_total_value"),
        shipping_m.select("order_id", "avg_shipping_cost", "total_shipping_cost"),
        items_r.select("order_id", "product_id", "total_quantity_sold", "total_sales_value",
                       "return_count"),
    ]
    key_sources = [g[n] for n in ("orders", "cancellation", "client_profile", "payment",
                                  "shipping_data", "items")]
    return full_outer_chain(parts, "order_id", key_sources).select(*SUMMARY_COLUMNS)
