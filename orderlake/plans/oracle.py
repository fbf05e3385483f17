"""Independent SQL answers (DuckDB dialect) for the registered queries.

The Spark queries go flat tables -> JSON documents -> parse -> explode -> metrics.  The
SQL here never builds a document: each silver table is computed straight from the flat
tables, every array of the document becomes a join with a small ``VALUES`` row generator
(an outer explode of n elements = a left join on ``i <= n``), and the gold metrics use
SQL window functions and scalar subqueries the way the source pipeline states them.
Both sides follow the same document rules (``orderlake.sources.documents``).
"""

from __future__ import annotations

# Fixed date used by queries that stamp a load date, so results do not depend on the clock.
FIXED_LOAD_DATE = "2024-01-01"

_BASE = """
ord AS (
  SELECT o.*, c.*, CAST(ROUND(o.o_totalprice * 100) AS INTEGER) AS cents
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
),
li AS (
  SELECT l.*,
    l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk,
    CAST(l_quantity AS INTEGER) AS qty,
    CAST(CAST(ROUND(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT) AS INTEGER) AS unit,
    CAST(((CAST(ROUND(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT))
          * (100 - CAST(ROUND(l_discount * 100) AS INTEGER))) // 100 AS INTEGER) AS selling,
    CAST((CAST(ROUND(l_extendedprice * 100) AS BIGINT) * CAST(ROUND(l_tax * 100) AS INTEGER)) // 100 AS INTEGER) AS ship
  FROM lineitem l
)"""

_ORDERS = """
s_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
    '00-' || o_orderkey AS seller_order_id,
    CASE WHEN o_orderkey % 4 = 0 THEN 'Fulfillment' ELSE 'Marketplace' END AS origin,
    o_orderpriority AS sales_channel,
    CASE o_orderstatus WHEN 'F' THEN 'invoiced' WHEN 'O' THEN 'canceled'
      WHEN 'P' THEN 'payment-pending' ELSE o_orderstatus END AS status,
    (o_orderkey % 13 = 0) AS workflow_is_in_error,
    CASE o_orderstatus WHEN 'F' THEN 'Invoiced' WHEN 'O' THEN 'Canceled'
      WHEN 'P' THEN 'Payment pending' END AS status_description,
    cents AS value,
    o_orderdate AS creation_date,
    o_orderdate + INTERVAL 1 DAY AS last_change,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL
      ELSE o_orderdate + to_days(CAST(o_orderkey % 5 AS INTEGER)) END AS authorized_date,
    CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS is_completed,
    'f' || o_orderkey || '@orders.example' AS follow_up_email,
    'G' || (o_orderkey // 10) AS order_group
  FROM ord
)"""

_ITEMS = """
it AS (
  SELECT li.*, pt.i AS pt_i, cm.j AS cm_j, cat.c AS cat_c, dom.d AS dom_d
  FROM li
  LEFT JOIN (VALUES (1), (2)) pt(i)
    ON pt.i <= CASE WHEN ln IN (1, 2) THEN 0 WHEN ln = 5 THEN 2 ELSE 1 END
  LEFT JOIN (VALUES (1), (2)) cm(j)
    ON cm.j <= CASE WHEN ln IN (1, 2) THEN 0
                    WHEN ln = 6 OR (ln = 5 AND pk % 4 = 0) THEN 2 ELSE 1 END
  LEFT JOIN (VALUES (1), (2)) cat(c)
    ON cat.c <= CASE WHEN ln = 7 AND pk % 2 = 0 THEN 2 ELSE 1 END
  LEFT JOIN (VALUES (1), (2)) dom(d)
    ON dom.d <= CASE WHEN ln = 7 AND pk % 2 = 1 THEN 2 ELSE 0 END
),
s_items AS (
  SELECT DISTINCT
    CAST(l_orderkey AS VARCHAR) AS order_id,
    l_orderkey || '-' || ln || '-' || pk AS unique_id,
    CASE WHEN pk % 97 = 0 THEN NULL ELSE CAST(pk AS VARCHAR) END AS product_id,
    '789' || pk AS ean,
    CAST(NULL AS VARCHAR) AS lock_id,
    '1' AS seller,
    'REF' || pk AS ref_id,
    unit AS list_price,
    CAST(NULL AS VARCHAR) AS manual_price,
    CASE pt_i WHEN 1 THEN 'tag-' || l_returnflag WHEN 2 THEN 'tag-' || l_linestatus END AS price_tags,
    '/img/' || pk || '.jpg' AS image_url,
    '/p/' || pk AS detail_url,
    CASE WHEN sk % 2 = 1 THEN 'warranty:' || (sk % 3) END AS params,
    CAST(pk AS VARCHAR) AS seller_sku,
    CAST(NULL AS VARCHAR) AS price_valid_until,
    0 AS commission,
    CAST(ROUND(l_tax * 100) AS INTEGER) AS tax,
    CAST(NULL AS VARCHAR) AS pre_sale_date,
    'un' AS measurement_unit,
    CAST(1.0 AS FLOAT) AS unit_multiplier,
    selling AS selling_price,
    FALSE AS is_gift,
    CAST(NULL AS VARCHAR) AS shipping_price,
    0 AS reward_value,
    0 AS freight_commission,
    CAST(NULL AS VARCHAR) AS tax_code,
    CAST(NULL AS VARCHAR) AS parent_item_index,
    CAST(NULL AS VARCHAR) AS parent_assembly_binding,
    CAST(NULL AS VARCHAR) AS call_center_operator,
    CAST(NULL AS VARCHAR) AS serial_numbers,
    CASE WHEN ln = 3 THEN 'assembly-' || pk END AS assemblies,
    CAST(NULL AS INTEGER) AS cost_price,
    'Part ' || pk AS items_name,
    CAST(pk AS VARCHAR) AS items_id,
    unit AS items_price,
    qty AS items_quantity,
    CASE WHEN ln IN (1, 2) THEN NULL ELSE 'Personalization' END AS item_attachment_name,
    CASE WHEN ln % 2 = 1 THEN 'Warranty' END AS type,
    CASE WHEN ln % 2 = 1 THEN 'Warranty plan' END AS offerings_name,
    CASE WHEN ln % 2 = 1 THEN 'OF' || (pk % 10) END AS offerings_id,
    CASE WHEN ln % 2 = 1 THEN unit // 10 END AS offerings_price,
    CASE WHEN ln = 7 AND pk % 2 = 1 THEN FALSE WHEN ln = 4 THEN TRUE END AS required,
    CASE WHEN ln = 7 AND pk % 2 = 1 THEN 'takeback' WHEN ln = 4 THEN 'gift-note' END
      AS attachment_offerings_name,
    'Brand' || (pk % 20) AS brand_name,
    CAST(pk % 20 + 2000 AS VARCHAR) AS brand_id,
    '/' || (pk % 10) || '/' AS categories_ids,
    CAST(NULL AS VARCHAR) AS product_cluster_id,
    '1' AS commercial_condition_id,
    CAST(NULL AS VARCHAR) AS offering_info,
    CAST(NULL AS VARCHAR) AS offering_type,
    CAST(NULL AS VARCHAR) AS offering_type_id,
    selling AS calculated_selling_price,
    CAST(selling * qty AS INTEGER) AS total,
    CAST(NULL AS VARCHAR) AS reason,
    CASE cm_j WHEN 1 THEN 'color' WHEN 2 THEN 'engraving' END AS content_key,
    CASE cm_j
      WHEN 1 THEN CASE WHEN ln = 6 OR (ln = 5 AND pk % 4 = 0) THEN 'blue' ELSE 'red' END
      WHEN 2 THEN CASE WHEN sk % 5 = 0 THEN NULL ELSE 'E' || sk END END AS content_value,
    CASE WHEN ln = 7 AND pk % 2 = 1 THEN 'takeback' WHEN ln = 4 THEN 'note' END AS schema_key,
    CASE cat_c WHEN 1 THEN 'Cat' || (pk % 10) WHEN 2 THEN 'Sub' || (pk % 10) END AS categories_name,
    CAST(CASE cat_c WHEN 1 THEN pk % 10 WHEN 2 THEN pk % 10 + 100 END AS INTEGER) AS categories_id,
    CAST(0.5 AS FLOAT) AS cubicweight,
    CAST(ln AS FLOAT) AS height,
    CAST(10.0 AS FLOAT) AS length,
    CAST(l_quantity AS FLOAT) AS weight,
    CAST(2.25 AS FLOAT) AS width,
    selling AS value,
    qty AS selling_prices_quantity,
    CASE WHEN ln = 7 AND pk % 2 = 1 THEN 15 WHEN ln = 4 THEN 100 END AS maximum_number_of_characters,
    CASE dom_d WHEN 1 THEN 'yes' WHEN 2 THEN 'no' END AS domain
  FROM it
)"""

_SHIPPING = """
sh AS (
  SELECT ord.*, li.*, s.x AS sla_x, k.y AS kit_y
  FROM ord
  LEFT JOIN li ON li.l_orderkey = ord.o_orderkey
  LEFT JOIN (VALUES (1), (2)) s(x)
    ON li.l_orderkey IS NOT NULL AND s.x <= CASE WHEN li.ln % 2 = 0 THEN 2 ELSE 1 END
  LEFT JOIN (VALUES (1), (2)) k(y) ON li.ln = 7
),
s_shipping AS (
  SELECT
    CAST(o_orderkey AS VARCHAR) AS order_id,
    CAST(NULL AS VARCHAR) AS tracking_hints,
    ln - 1 AS item_index,
    CASE WHEN ln IS NULL THEN NULL WHEN ln % 2 = 0 THEN 'Express' ELSE 'Normal' END AS selected_sla,
    CASE WHEN ln IS NOT NULL THEN '10d' END AS lock_ttl,
    ship AS price, ship AS list_price, ship AS selling_price,
    CAST(NULL AS VARCHAR) AS delivery_window,
    'Carrier' || (sk % 3) AS delivery_company,
    ln || 'bd' AS shipping_estimate,
    strftime(l_shipdate, '%Y-%m-%d') AS shipping_estimate_date,
    CASE WHEN ln IS NOT NULL THEN 'BRA' END AS ships_to,
    CASE WHEN ln IS NOT NULL THEN 'delivery' END AS delivery_channel,
    CAST(NULL AS VARCHAR) AS polygon_name,
    CAST(NULL AS VARCHAR) AS pickup_point_id,
    ln || 'd' AS transit_time,
    CASE WHEN ln IS NOT NULL THEN 'delivery' END AS logistics_delivery_channel,
    'residential' AS address_type,
    c_name AS receiver_name,
    CAST(o_orderkey % 90000 + 10000 AS VARCHAR) AS postal_code,
    'City' || (o_orderkey % 20) AS city,
    'ST' || (o_orderkey % 5) AS state,
    'BRA' AS country,
    'Street ' || (o_orderkey % 100) AS street,
    CAST(o_orderkey % 1000 AS VARCHAR) AS number,
    CAST(NULL AS VARCHAR) AS neighborhood,
    CAST(NULL AS VARCHAR) AS complement,
    CAST(NULL AS VARCHAR) AS reference,
    CAST(NULL AS FLOAT[]) AS geo_coordinates,
    'C' || (sk % 3) AS courier_id,
    'Carrier' || (sk % 3) AS courier_name,
    CASE WHEN ln IS NOT NULL THEN 'D1' END AS dock_id,
    qty AS quantity,
    'W' || (sk % 4) AS warehouse_id,
    CAST(NULL AS VARCHAR) AS account_carrier_name,
    CASE kit_y WHEN 1 THEN 'kit-a' WHEN 2 THEN 'kit-b' END AS kit_item_details,
    qty * 10 AS stock_balance
  FROM sh
)"""

_PAYMENT = """
pay AS (
  SELECT ord.*, g.x AS gift_x, p.i AS pi, e.j AS ej
  FROM ord
  JOIN (VALUES (1), (2)) g(x)
    ON g.x <= CASE WHEN o_orderkey % 17 <> 0 AND o_orderkey % 4 = 0 THEN 2 ELSE 1 END
  LEFT JOIN (VALUES (0), (1)) p(i)
    ON o_orderkey % 17 <> 0 AND p.i <= CASE WHEN o_orderkey % 6 = 0 THEN 1 ELSE 0 END
  LEFT JOIN (VALUES (1), (2)) e(j)
    ON p.i = 0 AND e.j <= CASE WHEN o_orderkey % 10 = 0 THEN 2 ELSE 1 END
),
s_payment AS (
  SELECT
    CAST(o_orderkey AS VARCHAR) AS order_id,
    CASE WHEN o_orderkey % 17 <> 0 THEN TRUE END AS is_active,
    CASE WHEN o_orderkey % 17 <> 0 THEN 'T' || o_orderkey END AS transaction_id,
    CASE WHEN o_orderkey % 17 <> 0 THEN 'STORE' END AS merchant_name,
    'P' || o_orderkey || '-' || pi AS id,
    CAST(pi + 1 AS VARCHAR) AS payment_system,
    CASE pi
      WHEN 0 THEN CASE WHEN o_orderkey % 7 = 0 THEN NULL
        ELSE ['Visa', 'Mastercard', 'Pix', 'Boleto', 'Diners'][CAST(substr(o_orderpriority, 1, 1) AS INTEGER)] END
      WHEN 1 THEN 'Gift Card' END AS payment_system_name,
    CAST(CASE pi WHEN 0 THEN CASE WHEN o_orderkey % 6 = 0 THEN cents - cents // 3 ELSE cents END
      WHEN 1 THEN cents // 3 END AS INTEGER) AS value,
    CAST(CASE WHEN pi IS NOT NULL THEN o_orderkey % 6 + 1 END AS INTEGER) AS installments,
    CAST(CASE pi WHEN 0 THEN CASE WHEN o_orderkey % 6 = 0 THEN cents - cents // 3 ELSE cents END
      WHEN 1 THEN cents // 3 END AS INTEGER) AS reference_value,
    CAST(NULL AS VARCHAR) AS card_holder, CAST(NULL AS VARCHAR) AS card_number,
    CAST(NULL AS VARCHAR) AS first_digits, CAST(NULL AS VARCHAR) AS last_digits,
    CAST(NULL AS VARCHAR) AS cvv2, CAST(NULL AS VARCHAR) AS expire_month,
    CAST(NULL AS VARCHAR) AS expire_year, CAST(NULL AS VARCHAR) AS url,
    CAST(NULL AS VARCHAR) AS gift_card_id, CAST(NULL AS VARCHAR) AS gift_card_name,
    CAST(NULL AS VARCHAR) AS gift_card_caption, CAST(NULL AS VARCHAR) AS redemption_code,
    CASE pi WHEN 0 THEN 'creditCard' WHEN 1 THEN 'giftCard' END AS "group",
    CAST(NULL AS VARCHAR) AS tid, CAST(NULL AS VARCHAR) AS due_date,
    CAST(NULL AS VARCHAR) AS gift_card_provider, CAST(NULL AS VARCHAR) AS gift_card_as_discount,
    CAST(NULL AS VARCHAR) AS koin_url, CAST(NULL AS VARCHAR) AS account_id,
    CAST(NULL AS VARCHAR) AS parent_account_id,
    CAST(NULL AS VARCHAR) AS bank_issued_invoice_identification_number,
    CAST(NULL AS VARCHAR) AS bank_issued_invoice_identification_number_formatted,
    CAST(NULL AS VARCHAR) AS bank_issued_invoice_bar_code_number,
    CAST(NULL AS VARCHAR) AS bank_issued_invoice_bar_code_type,
    CAST(NULL AS VARCHAR) AS billing_address, CAST(NULL AS VARCHAR) AS payment_origin,
    CASE ej WHEN 1 THEN 'Tid' WHEN 2 THEN 'ReturnCode' END AS connector_key,
    CASE ej WHEN 1 THEN 'tid' || o_orderkey
      WHEN 2 THEN CASE WHEN o_orderkey % 20 = 0 THEN '0' END END AS connector_value
  FROM pay
)"""

_CANCELLATION = """
s_cancellation AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
    CASE WHEN o_orderstatus = 'O' THEN o_orderkey % 2 = 0 END AS requested_by_user,
    CAST(NULL AS VARCHAR) AS requested_by_system,
    CAST(NULL AS VARCHAR) AS requested_by_seller_notification,
    CAST(NULL AS VARCHAR) AS requested_by_payment_notification,
    CASE WHEN o_orderstatus = 'O' AND o_orderkey % 3 <> 0 THEN
      ['Customer request', 'Out of stock', 'Payment declined', 'Fraud suspicion'][o_orderkey % 4 + 1]
    END AS reason,
    CASE WHEN o_orderstatus = 'O' AND o_orderkey % 5 <> 0 THEN
      strftime(o_orderdate + INTERVAL 2 DAY, '%Y-%m-%dT%H:%M:%S') END AS cancellation_date
  FROM ord
)"""

_CLIENT_PROFILE = """
s_client_profile AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
    'CP' || c_custkey AS id,
    CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE lower(c_name) || '@example.com' END AS email,
    CASE WHEN c_custkey IS NOT NULL THEN 'Customer' END AS first_name,
    CAST(c_custkey AS VARCHAR) AS last_name,
    CASE WHEN c_custkey IS NOT NULL THEN 'cpf' END AS document_type,
    CAST(c_custkey * 7 AS VARCHAR) AS document,
    '+55' || c_nationkey AS phone,
    CAST(NULL AS VARCHAR) AS corporate_name, CAST(NULL AS VARCHAR) AS trade_name,
    CAST(NULL AS VARCHAR) AS corporate_document, CAST(NULL AS VARCHAR) AS state_inscription,
    CAST(NULL AS VARCHAR) AS corporate_phone,
    c_mktsegment = 'BUILDING' AS is_corporate,
    CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS user_profile_id,
    CAST(NULL AS VARCHAR) AS user_profile_version,
    c_mktsegment AS customer_class
  FROM ord
)"""

_OTHER_SILVER = {
    "totals": """
s_totals AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
    CASE t.i WHEN 1 THEN 'Items' ELSE 'Discounts' END AS id,
    CASE t.i WHEN 1 THEN 'Items Total' ELSE 'Discounts Total' END AS name,
    CAST(CASE t.i WHEN 1 THEN cents ELSE -(o_orderkey % 1000) END AS INTEGER) AS value
  FROM ord JOIN (VALUES (1), (2)) t(i) ON t.i <= o_orderkey % 3
)""",
    "marketplace_items": """
s_marketplace_items AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
    CASE WHEN o_orderkey % 5 = 0 THEN 'MKT-' || o_orderkey END AS marketplace_items
  FROM ord
)""",
    "rates_and_benefits": """
s_rates_and_benefits AS (
  SELECT 'promotion ' || r.i AS description, r.i = 0 AS featured, 'R' || r.i AS id,
    'Rate ' || r.i AS name,
    CASE WHEN r.i = 0 THEN '{"channel":"' || o_orderpriority || '"}' END AS matched_parameters,
    CAST(NULL AS VARCHAR) AS additional_info
  FROM ord JOIN (VALUES (0), (1)) r(i)
    ON o_orderkey % 7 <> 0 AND r.i < o_orderkey % 3
)""",
    "marketing": """
s_marketing AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
    CASE WHEN o_orderkey % 2 = 0 THEN 'MD' || o_orderkey END AS id,
    CASE WHEN o_orderkey % 2 = 0 THEN 'src' || (o_orderkey % 3) END AS utm_source,
    CAST(NULL AS VARCHAR) AS utm_partner,
    CASE WHEN o_orderkey % 2 = 0 THEN 'cpc' END AS utm_medium,
    CASE WHEN o_orderkey % 2 = 0 THEN 'camp' || (o_orderkey % 4) END AS utm_campaign,
    CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 6 = 0 THEN 'CUP10' END AS coupon,
    CAST(NULL AS VARCHAR) AS utmi_campaign, CAST(NULL AS VARCHAR) AS utmipage,
    CAST(NULL AS VARCHAR) AS utmi_part,
    CASE t.i WHEN 1 THEN 'tag0' WHEN 2 THEN 'tag1' END AS marketing_tag
  FROM ord LEFT JOIN (VALUES (1), (2)) t(i)
    ON o_orderkey % 2 = 0 AND t.i <= o_orderkey % 3
)""",
    "store_preferences": """
s_store_preferences AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
    CASE WHEN o_orderkey % 9 <> 0 THEN 'BRA' END AS country_code,
    CASE WHEN o_orderkey % 9 <> 0 THEN 'BRL' END AS currency_code,
    CASE WHEN o_orderkey % 9 <> 0 THEN 1046 END AS currency_locale,
    CASE WHEN o_orderkey % 9 <> 0 THEN 'R$' END AS currency_symbol,
    CASE WHEN o_orderkey % 9 <> 0 THEN 'E. South America Standard Time' END AS time_zone,
    CASE WHEN o_orderkey % 9 <> 0 THEN 2 END AS currency_decimal_digits,
    CASE WHEN o_orderkey % 9 <> 0 THEN ',' END AS currency_decimal_separator,
    CASE WHEN o_orderkey % 9 <> 0 THEN '.' END AS currency_group_separator,
    CASE WHEN o_orderkey % 9 <> 0 THEN 3 END AS currency_group_size,
    CASE WHEN o_orderkey % 9 <> 0 THEN TRUE END AS starts_with_currency_symbol
  FROM ord
)""",
    "package_attachment": """
s_package_attachment AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(NULL AS VARCHAR) AS packages FROM ord
)""",
    "sellers": """
s_sellers AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
    CASE s.i WHEN 1 THEN '1' ELSE 'S' || (o_orderkey % 3) END AS id,
    CASE s.i WHEN 1 THEN 'Main Store' ELSE 'Partner ' || (o_orderkey % 3) END AS name,
    CAST(NULL AS VARCHAR) AS logo, CAST(NULL AS VARCHAR) AS fulfillment_endpoint
  FROM ord JOIN (VALUES (1), (2)) s(i)
    ON s.i <= CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END
)""",
    "item_metadata": """
s_item_metadata AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
    CAST(pk AS VARCHAR) AS id,
    CASE WHEN pk IS NOT NULL THEN '1' END AS seller,
    'Part ' || pk AS name,
    'SKU ' || pk AS sku_name,
    CASE WHEN pk % 97 = 0 THEN NULL ELSE CAST(pk AS VARCHAR) END AS product_id,
    'REF' || pk AS ref_id,
    '789' || pk AS ean,
    '/img/' || pk || '.jpg' AS image_url,
    '/p/' || pk AS detail_url,
    CASE WHEN ln % 4 = 1 THEN 'warranty' END AS assemble_id,
    CASE WHEN ln % 4 = 1 THEN 'Extended warranty' END AS assembly_name,
    CASE WHEN ln % 4 = 1 THEN FALSE END AS required,
    CAST(NULL AS VARCHAR) AS composition,
    CASE tb.i WHEN 1 THEN 'yes' WHEN 2 THEN 'no' END AS takeback_domain,
    CASE ge.i WHEN 1 THEN '12m' WHEN 2 THEN '24m' WHEN 3 THEN '36m' END AS garantia_estendida_domain
  FROM ord
  LEFT JOIN li ON li.l_orderkey = ord.o_orderkey
  LEFT JOIN (VALUES (1), (2)) tb(i) ON li.ln % 4 = 1
  LEFT JOIN (VALUES (1), (2), (3)) ge(i) ON li.ln % 4 = 1
)""",
    "client_preferences": """
s_client_preferences AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
    CASE WHEN o_orderkey % 2 = 0 THEN 'pt-BR' ELSE 'en-US' END AS locale,
    o_orderkey % 3 = 0 AS optin_news_letter
  FROM ord
)""",
}

_SILVER = {"orders": _ORDERS, "items": _ITEMS, "shipping_data": _SHIPPING,
           "payment": _PAYMENT, "cancellation": _CANCELLATION,
           "client_profile": _CLIENT_PROFILE, **_OTHER_SILVER}

_CTE_NAME = {"orders": "s_orders", "items": "s_items", "shipping_data": "s_shipping",
             "payment": "s_payment", "cancellation": "s_cancellation",
             "client_profile": "s_client_profile"}


def cte_name(table: str) -> str:
    return _CTE_NAME.get(table, f"s_{table}")


def with_silver(*tables: str, extra: str = "") -> str:
    """``WITH`` clause defining the base rows and the given silver tables."""
    parts = [_BASE] + [_SILVER[t] for t in tables]
    if extra:
        parts.append(extra)
    return "WITH " + ",".join(parts)


def silver_sql(table: str) -> str:
    return with_silver(table) + f"\nSELECT * FROM {cte_name(table)}"


# ---------------------------------------------------------------------------
# Gold metrics, each from its own definition
# ---------------------------------------------------------------------------

# metric: (rows the aggregate reads, key, aggregate, whether null keys are a group too)
_GOLD1_PER_KEY = {
    "order_status_count": ("{orders}", "status", "count(order_id)", True),
    "total_orders_per_channel": ("{orders}", "sales_channel", "count(order_id)", True),
    "total_sales_value_per_channel":
        ("{orders}", "sales_channel", "CAST(sum(value) AS BIGINT)", True),
    "payment_method_usage_count":
        ("{payment}", "payment_system_name", "count(order_id)", True),
    "payment_method_total_value":
        ("{payment}", "payment_system_name", "CAST(sum(value) AS BIGINT)", False),
    "total_quantity_sold":
        ("{items}", "unique_id", "CAST(sum(items_quantity) AS BIGINT)", False),
    "cancel_reason_count":
        ("{cancellation}", "reason", "count(order_id) FILTER (WHERE reason IS NOT NULL)", True),
    "return_count": ("(SELECT product_id FROM {items} JOIN (SELECT order_id FROM {cancellation})"
                     " USING (order_id))",
                     "product_id", "count(*)", False),
    "total_orders_per_customer":
        ("(SELECT order_id, user_profile_id FROM {client_profile}"
         " JOIN (SELECT order_id FROM {orders}) USING (order_id))",
         "user_profile_id", "count(order_id)", False),
}

_PROFILE_ORDERS = ("(SELECT order_id, email, value FROM (SELECT order_id, email FROM {client_profile})"
                   " JOIN (SELECT order_id, value FROM {orders}) USING (order_id))")

_GOLD2_PER_KEY = {
    "total_quantity_sold":
        ("{items}", "product_id", "CAST(sum(items_quantity) AS BIGINT)", True),
    "total_sales_value":
        ("{items}", "product_id", "CAST(sum(selling_price) AS BIGINT)", True),
    "average_price": ("{items}", "product_id", "avg(list_price)", False),
    "customer_lifetime_value":
        (_PROFILE_ORDERS, "email", "CAST(sum(value) AS BIGINT)", False),
    "total_orders_per_customer": (_PROFILE_ORDERS, "email", "count(order_id)", False),
    "average_items_per_order":
        (_PROFILE_ORDERS + " JOIN (SELECT order_id, items_quantity FROM {items}) USING (order_id)",
         "email", "sum(items_quantity) / CAST(count(order_id) AS DOUBLE)", False),
}

# columns computed from one row, or from a whole table
_GOLD1_ROW = {
    "fulfillment_time": "CAST(datediff('day', creation_date, authorized_date) AS INTEGER)",
    "avg_shipping_cost": "(SELECT avg(price) FROM {shipping_data})",
    "total_shipping_cost": "(SELECT CAST(sum(price) AS BIGINT) FROM {shipping_data})",
    "total_sales_value": "CAST(items_quantity AS BIGINT) * selling_price",
    "cancel_reason": "reason",
    "is_return": "CAST(cancellation_date IS NOT NULL AS INTEGER)",
    "is_repeat_customer": "CAST(coalesce(m_total_orders_per_customer.v, 0) > 1 AS INTEGER)",
}

_ORDER_KPI = {
    "total_orders": "count(DISTINCT order_id) + CAST(count(*) > count(order_id) AS INTEGER)",
    "completed_orders": "count(*) FILTER (WHERE is_completed)",
    "canceled_orders": "count(*) FILTER (WHERE status = 'canceled')",
    "total_order_value": "CAST(sum(value) AS BIGINT)",
    "average_order_value": "avg(value)",
    "fulfillment_rate": "CAST(count(*) FILTER (WHERE is_completed) AS DOUBLE) / count(*) * 100",
    "cancellation_rate":
        "CAST(count(*) FILTER (WHERE status = 'canceled') AS DOUBLE) / count(*) * 100",
}


def _rows(deduplicated: bool) -> dict[str, str]:
    """Relation of each silver table; gold 1 deduplicates all of them but orders."""
    return {t: f"u_{t}" if deduplicated and t != "orders" else cte_name(t) for t in _CTE_NAME}


def _metric_rows(table: str, columns: list[str], per_key: dict, row: dict, rows: dict) -> str:
    """SELECT of columns of a silver table, looking up each metric by its key."""
    out, joins, joined = [], [], set()
    needed = columns + ["total_orders_per_customer"] * ("is_repeat_customer" in columns)
    for name in needed:
        if name in per_key and name not in joined:
            source, key, aggregate, null_group = per_key[name]
            joined.add(name)
            same = "IS NOT DISTINCT FROM" if null_group else "="
            joins.append(f"LEFT JOIN (SELECT {key} AS k, {aggregate} AS v FROM "
                         f"{source.format(**rows)} GROUP BY {key}) m_{name} "
                         f"ON d.{key} {same} m_{name}.k")
    for name in columns:
        if name in per_key:
            out.append(f"m_{name}.v AS {name}")
        elif name in row:
            out.append(f"{row[name].format(**rows)} AS {name}")
        else:
            out.append(f"d.{name}")
    return f"SELECT {', '.join(out)} FROM {rows[table]} d " + " ".join(joins)


def _with_rows(sql: str, deduplicated: bool) -> str:
    """``sql`` with the silver tables that it, or a table it reads, names."""
    used = [t for t, name in _rows(deduplicated).items() if name in sql]
    unique = ",".join(f"\nu_{t} AS (SELECT DISTINCT * FROM {cte_name(t)})" for t in used
                      if deduplicated and t != "orders")
    return with_silver(*used, extra=unique) + "\n" + sql


def gold1_sql(table: str, columns: list[str]) -> str:
    """Columns and metrics of one deduplicated silver table of the order summary."""
    return _with_rows(_metric_rows(table, columns, _GOLD1_PER_KEY, _GOLD1_ROW, _rows(True)), True)


def gold1_plain(sql: str) -> str:
    """SQL over the summary's inputs, named ``{orders}``, ``{payment}``, ...."""
    return _with_rows(sql.format(**_rows(True)), True)


def gold2_sql(table: str, columns: list[str]) -> str:
    """Columns and metrics of one silver table of the KPI table."""
    return _with_rows(_metric_rows(table, columns, _GOLD2_PER_KEY, {}, _rows(False)), False)


def gold2_plain(sql: str) -> str:
    """SQL over the KPI table's inputs, named ``{orders}``, ``{items}``, ...."""
    return _with_rows(sql.format(**_rows(False)), False)


def order_kpi_sql(names: list[str]) -> str:
    """Order KPIs as one row."""
    return gold2_plain("SELECT " + ", ".join(f"{_ORDER_KPI[n]} AS {n}" for n in names)
                       + " FROM {orders}")


def return_count_sql() -> str:
    """M15 from the lines alone: an item row is a line and a choice of its generators, so the other columns
    of the wide row are not needed to tell rows apart."""
    return with_silver("items", "cancellation") + """
SELECT order_id, product_id,
  CASE WHEN product_id IS NOT NULL THEN nullif(count(c.k) OVER (PARTITION BY product_id), 0) END AS return_count
FROM (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS order_id, ln, pk, sk, qty, unit, selling, l_tax, l_returnflag, l_linestatus,
        CASE WHEN pk % 97 = 0 THEN NULL ELSE CAST(pk AS VARCHAR) END AS product_id, pt_i, cm_j, cat_c, dom_d FROM it)
LEFT JOIN (SELECT DISTINCT order_id AS k FROM s_cancellation) c ON c.k = order_id"""


# summary columns by the table they come from; profiles give two inputs
_SUMMARY_PARTS = [
    ("orders", ["fulfillment_time", "status", "order_status_count", "sales_channel",
                "total_orders_per_channel", "total_sales_value_per_channel"]),
    ("client_profile", ["email"]),
    ("client_profile", ["total_orders_per_customer", "is_repeat_customer"]),
    ("cancellation", ["cancel_reason", "cancel_reason_count", "is_return"]),
    ("items", ["product_id", "total_quantity_sold", "total_sales_value", "return_count"]),
    ("shipping_data", ["avg_shipping_cost", "total_shipping_cost"]),
    ("payment", ["payment_system_name", "payment_method_usage_count",
                 "payment_method_total_value"]),
]


def order_summary_sql() -> str:
    """All order ids with every input's rows of that id; rows without an id stay alone."""
    rows = _rows(True)
    parts = [_metric_rows(t, ["order_id", *columns], _GOLD1_PER_KEY, _GOLD1_ROW, rows)
             for t, columns in _SUMMARY_PARTS]
    named = ",\n".join(f"part{i} AS ({sql})" for i, sql in enumerate(parts))
    ids = " UNION ".join(f"SELECT order_id FROM part{i} WHERE order_id IS NOT NULL"
                         for i in range(len(parts)))
    matched = " ".join(f"LEFT JOIN part{i} USING (order_id)" for i in range(len(parts)))
    alone = " ".join(f"UNION ALL BY NAME SELECT * FROM part{i} WHERE order_id IS NULL"
                     for i in range(len(parts)))
    sql = f"SELECT * FROM ids {matched} {alone}"
    body = f"{named},\nids AS ({ids})"
    used = [t for t in rows]
    unique = ",".join(f"\n{rows[t]} AS (SELECT DISTINCT * FROM {cte_name(t)})" for t in used
                      if t != "orders")
    return with_silver(*used, extra=unique + ",\n" + body) + "\n" + sql


def kpi_table_sql() -> str:
    """Profile rows with an order id, times the order, item and profile rows of that id."""
    rows = _rows(False)
    people = _metric_rows("client_profile", [
        "order_id", "customer_lifetime_value", "total_orders_per_customer",
        "average_items_per_order"], _GOLD2_PER_KEY, {}, rows)
    goods = _metric_rows("items", [
        "order_id", "product_id", "total_quantity_sold", "total_sales_value",
        "average_price"], _GOLD2_PER_KEY, {}, rows)
    totals = ", ".join(f"(SELECT {sql} FROM {rows['orders']}) AS {n}"
                       for n, sql in _ORDER_KPI.items())
    return _with_rows(f"""SELECT * EXCLUDE (order_id), DATE '{FIXED_LOAD_DATE}' AS at_load_date
FROM ({people})
JOIN (SELECT order_id FROM {rows['client_profile']}) USING (order_id)
LEFT JOIN ({goods}) USING (order_id)
LEFT JOIN (SELECT order_id, {totals} FROM {rows['orders']}) USING (order_id)""", False)
