"""Snake-case renaming (P1) on order columns."""

import pytest

from orderlake.functions.naming import snake_case_columns, to_snake_case


def test_order_columns_keep_their_order_and_values(spark):
    df = spark.sql("SELECT 'o1' AS orderId, 250 AS listPrice, true AS isGift, 'x' AS origin")
    out = snake_case_columns(df)
    assert out.columns == ["order_id", "list_price", "is_gift", "origin"]
    assert tuple(out.first()) == ("o1", 250, True, "x")


def test_no_rows_and_no_change(spark):
    none = spark.sql("SELECT 1 AS sellingPrice WHERE false")
    assert snake_case_columns(none).columns == ["selling_price"] and none.isEmpty()
    assert snake_case_columns(spark.sql("SELECT 1 AS unit_price")).columns == ["unit_price"]


@pytest.mark.parametrize("name,expected", [
    ("orderId", "order_id"), ("lockTTL", "lock_ttl"), ("first_Name", "first__name"),
    ("CurrencyDecimalDigits", "currency_decimal_digits"),
    ("sellingPrices_quantity", "selling_prices_quantity"),
    ("bankIssuedInvoiceIdentificationNumberFormatted",
     "bank_issued_invoice_identification_number_formatted"),
    ("cvv2", "cvv2"), ("utmipage", "utmipage"), ("Assemble_id", "assemble_id"),
])
def test_rule(name, expected):
    assert to_snake_case(name) == expected


def test_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], ["aB", "a_b"])
    with pytest.raises(ValueError):
        snake_case_columns(df)
