"""Item rows are compared where they may be equal, and only there; gold stores what it reads of them."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orderlake.operators.metrics import materialize
from orderlake.plans import layers as L
from orderlake.plans import silver as S
from orderlake.plans.medallion import bronze_to_silver
from orderlake.sources.ingest import parse_documents


def _item(unique, **more):
    return {"uniqueId": unique, "productId": "p", "quantity": 1, "priceTags": ["a", "b"]} | more


#: Order id -> (item rows that differ, whether some may be equal).
DOCUMENTS = {
    "plain": ([_item("1"), _item("2")], False),
    "twice": ([_item("1"), _item("1")], True),
    "overlap": ([_item("1"), _item("1", priceTags=["b", "c"])], True),
    "no unique id": ([_item(None), _item(None)], True),
    "one without": ([_item(None), _item("1")], False),
    "tag twice": ([_item("1", priceTags=["a", "a"])], True),
    "null tags": ([_item("1", priceTags=[None, None])], True),
    "offers": ([_item("1", offerings=[{"id": "x"}, {"id": "y"}])], False),
    "null offer": ([_item("1", offerings=[None, {}])], True),
    "attachment offers": ([_item("1", attachmentOfferings=[
        {"name": "n", "required": True, "schema": {"k": {"Domain": ["a"]}}},
        {"name": "n", "required": True, "schema": {"k": {"Domain": ["a"]}}}])], True),
    "domain": ([_item("1", attachmentOfferings=[{"name": "n", "schema": {"k": {"Domain": ["a", "a"]}}}])], True),
    "zero": ([_item("1", additionalInfo={"dimension": {"height": -0.0}})], False),
    "none": ([], False),
}


def _bronze(spark, more=()):
    texts = [json.dumps({"orderId": k, "items": items}) for k, (items, _) in DOCUMENTS.items()]
    return spark.createDataFrame([(t,) for t in [*texts, *more]], "orderDetails STRING")


def _rows(df):
    return Counter(str(r) for r in df.collect())


def test_documents_with_equal_rows_are_marked(spark):
    docs = parse_documents(_bronze(spark)).select("orderId", S.items_may_repeat().alias("m"))
    assert {r.orderId: r.m for r in docs.collect()} == {k: m for k, (_, m) in DOCUMENTS.items()}


def test_items_of_marked_documents_are_the_same(spark):
    again = [json.dumps({"orderId": "plain", "items": [_item("2"), _item("3")]}),
             *[json.dumps({"items": [_item("1")]})] * 2]
    docs = parse_documents(_bronze(spark, again), fields=["orderId", "items"])
    expected = _rows(S.build_items(docs))
    stored = materialize(docs.withColumn(S.MAY_REPEAT, S.items_may_repeat()), "documents")
    assert _rows(S.build_items(S.repeats_marked(stored))) == expected
    assert max(expected.values()) == 1 and not any("-0.0" in r for r in expected)


def test_rows_that_cannot_be_equal_are_not_compared(spark):
    docs = materialize(parse_documents(_bronze(spark).limit(1), fields=["orderId", "items"])
                       .withColumn(S.MAY_REPEAT, S.items_may_repeat()), "documents")
    plan = S.build_items(S.repeats_marked(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan


def test_saved_items_have_no_equal_rows(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS repeats LOCATION '{tmp_path}/repeats.db'")
    bronze = _bronze(spark)
    saved = bronze_to_silver(bronze, str(tmp_path), "repeats", ("items",))["items"].drop("load_date")
    assert _rows(saved) == _rows(S.silver_from_bronze(bronze, "items").select(*saved.columns))


@pytest.fixture
def folder(spark, tmp_path):
    ts = "timestamp'2024-01-01'"
    orders = [(1, 5, "F", 10.0, "1-A"), (2, 5, "O", 20.0, "2-B"), (2, 5, "O", 20.0, "2-B"), (None, 5, "F", 1.0, "1-A")]
    lines = [(1, 7, 3, 1), (1, 8, 3, 2), (2, 7, 3, 5), (2, 7, 3, 5), (2, 9, 3, 4)]
    spark.createDataFrame(orders, "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, "
                          "o_orderpriority STRING").selectExpr("*", f"{ts} o_orderdate") \
        .write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame(lines, "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT").selectExpr(
        "*", "2.0D l_quantity", "9.0D l_extendedprice", "0.1D l_discount", "0.1D l_tax", "'R' l_returnflag",
        "'F' l_linestatus", f"{ts} l_shipdate").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(5, "c", 1, "BUILDING")], "c_custkey LONG, c_name STRING, c_nationkey INT, "
                          "c_mktsegment STRING").write.parquet(str(tmp_path / "customer.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("tables", [("items",), ("items", "cancellation")])
def test_gold_stores_the_columns_it_reads(spark, folder, tables):
    narrow = L.silver_set(spark, folder, *tables, for_gold=True)["items"]
    assert "items" not in L._layer(spark, folder)
    assert sorted(narrow.columns) == sorted(L.GOLD_COLUMNS["items"])
    whole = S.silver_from_bronze(L.bronze(spark, folder), "items")
    assert _rows(narrow) == _rows(whole.select(*narrow.columns))
    assert _rows(L.silver(spark, folder, "items")) == _rows(whole)
    assert whole.where(F.col("order_id") == "2").count() == 3  # two tags of line 5, line 4; each from two documents


def test_prepared_inputs_are_shuffled_once_and_stored_with_what_is_read(spark):
    from orderlake.plans import summary
    rows = spark.createDataFrame([("1", 5, "x"), ("1", 5, "x"), ("1", 5, "y"), (None, 5, "x"), (None, 5, "x")],
                                 "order_id STRING, price INT, carrier STRING")
    made = summary.prepare_inputs({"shipping_data": rows})["shipping_data"]
    assert made.columns == ["order_id", "price"]
    assert sorted(made.collect(), key=str) == sorted([(None, 5), ("1", 5), ("1", 5)], key=str)


def test_a_first_load_compares_nothing(spark, tmp_path, monkeypatch):
    from orderlake.sources import upsert
    monkeypatch.setattr(upsert, "compare", None)
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "k INT, v STRING")
    upsert.save_with_merge(rows, f"{tmp_path}/t", "first_loads", "t", None, replace_by=["k"], changes=True)
    changes = upsert.read_changes(spark, f"{tmp_path}/t").select("k", "v", "change_kind", "change_sign").collect()
    assert sorted((r.k or 0, r.v) for r in changes) == [(0, "b"), (1, "a"), (1, "a")]
    assert {(r.change_kind, r.change_sign) for r in changes} == {("inserted", 1)}
