"""Steps that all document queries share: no text is sorted, nothing is parsed or stored that a query does not read."""

import contextlib
import gzip
import io
import json

from pyspark.sql import functions as F

import __spark_entry__ as E
from orderlake.operators.metrics import materialize
from orderlake.plans import layers as L
from orderlake.plans.silver import silver_from_bronze
from orderlake.sources import documents as D
from orderlake.sources.ingest import read_documents, write_bronze


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _simple_plan(df) -> str:
    setting = "spark.sql.debug.maxToStringFields"
    before = df.sparkSession.conf.get(setting)
    df.sparkSession.conf.set(setting, "1000")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.select("*").explain()
        return buf.getvalue()
    finally:
        df.sparkSession.conf.set(setting, before)


def _tables(spark, folder):
    """Two orders, one with lines out of order and a flag that needs escapes, one without lines; a stray line."""
    spark.sql("""SELECT * FROM VALUES (1L, 1L, 'F', 10.5D, TIMESTAMP '2024-01-01 00:00:00', '1-URGENT'),
        (2L, NULL, 'O', 3.0D, TIMESTAMP '2024-01-02 00:00:00', '5-LOW')
        t(o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)""").write.parquet(f"{folder}/orders.parquet")
    spark.sql("""SELECT * FROM VALUES
        (1L, 7L, 4L, 5L, 3.0D, 30.0D, 0.1D, 0.05D, '"R\\\\', 'O', TIMESTAMP '2024-02-01 00:00:00'),
        (1L, 5L, 4L, 2L, 1.0D, 20.0D, 0.0D, 0.0D, 'N', 'F', TIMESTAMP '2024-02-01 00:00:00'),
        (1L, NULL, NULL, 3L, 2.0D, NULL, 0.0D, NULL, NULL, 'F', CAST(NULL AS TIMESTAMP)),
        (NULL, 5L, 4L, 1L, 1.0D, 20.0D, 0.0D, 0.0D, 'N', 'F', TIMESTAMP '2024-02-01 00:00:00')
        t(l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
          l_returnflag, l_linestatus, l_shipdate)""").write.parquet(f"{folder}/lineitem.parquet")
    spark.sql("SELECT 1L AS c_custkey, 'C1' AS c_name, 3 AS c_nationkey, 'BUILDING' AS c_mktsegment").write.parquet(f"{folder}/customer.parquet")
    return str(folder)


def test_documents_hold_all_lines_and_nulls(spark, tmp_path):
    found = {}
    for row in D.bronze_from_dir(spark, _tables(spark, tmp_path)).collect():
        doc = json.loads(row.orderDetails)
        found[doc["orderId"]] = doc
    assert set(found) == {"1", "2"}
    assert "items" not in found["2"] and "itemMetadata" not in found["2"]
    items = found["1"]["items"]
    assert [i["uniqueId"] for i in items] == ["1-2-5", "1-3", "1-5-7"]
    assert items[2]["priceTags"] == ['tag-"R\\', "tag-O"]
    assert items[1]["priceTags"] == [None] and items[1]["assemblies"] == [None]
    assert "price" not in items[1] and items[1]["priceDefinition"] == {"sellingPrices": [{"quantity": 2}]}
    assert found["1"]["shippingData"]["logisticsInfo"][1]["itemIndex"] == 2
    assert len(found["1"]["itemMetadata"]["Items"]) == 3


def test_line_texts_are_neither_sorted_nor_aggregated(spark, tmp_path):
    plan = _plan(D.bronze_from_dir(spark, _tables(spark, tmp_path)))
    assert "ObjectHashAggregate" not in plan
    assert not any(") Sort" in step and "uniqueId" in step for step in plan.split("\n\n"))


def test_order_text_is_written_by_one_concat(spark, tmp_path):
    odd = 'a"b\\c\n\t\x01é🙂/'
    tables = D.load_tables(spark, _tables(spark, tmp_path))
    tables["orders"] = tables["orders"].withColumn("o_orderpriority", F.concat(F.lit("2-"), F.lit(odd)))
    tables["customer"] = tables["customer"].withColumn("c_name", F.lit(odd)).withColumn("c_mktsegment", F.lit(odd))
    bronze = D.build_bronze(tables)
    plan = _simple_plan(bronze)
    assert "StructField(orderId" not in plan  # no struct of all fields goes through to_json
    assert "collect_list" not in plan and "listagg" in plan  # nor are an order's texts gathered as arrays
    one, two = sorted((json.loads(r.orderDetails) for r in bronze.collect()), key=lambda doc: doc["orderId"])
    assert one["salesChannel"] == "2-" + odd and one["shippingData"]["address"]["receiverName"] == odd
    assert one["clientProfileData"]["customerClass"] == odd
    assert one["clientProfileData"]["email"] == odd.lower() + "@example.com"
    assert one["ratesAndBenefitsData"]["rateAndBenefitsIdentifiers"][0]["matchedParameters"] == {"channel": "2-" + odd}
    assert one["status"] == "invoiced" and one["value"] == 1050 and one["isCompleted"] is True
    assert one["creationDate"].startswith("2024-01-01T00:00:00.000") and one["lastChange"].startswith("2024-01-02T")
    assert one["paymentData"]["transactions"][0]["payments"][0]["connectorResponses"] == {"Tid": "tid1"}
    assert len(one["items"]) == 3 and "cancellationData" not in one
    assert "clientProfileData" not in two and "receiverName" not in two["shippingData"]["address"]
    assert "logisticsInfo" not in two["shippingData"] and two["marketingData"]["marketingTags"] == ["tag0", "tag1"]
    assert two["cancellationData"]["RequestedByUser"] is True and "itemMetadata" not in two


def test_one_table_is_built_without_storing_documents(spark, tmp_path):
    folder = _tables(spark, tmp_path)
    assert E.queries()["silver_items"](spark, folder).count() == 4  # one line has two price tags
    assert E.queries()["explode_map"](spark, folder).count() == 3
    assert not any(label.startswith("__documents__") for label in L._layer(spark, folder))


def test_documents_are_built_and_parsed_once(spark, tmp_path):
    folder = _tables(spark, tmp_path)
    items = silver_from_bronze(D.bronze_from_dir(spark, folder), "items")
    assert items.count() == 4
    steps = [line for line in _simple_plan(items).splitlines() if "from_json" in line]
    assert len(steps) == 1 and "Project" in steps[0]  # no filter parses the document again
    assert "to_json" not in steps[0].lower() and "concat(" not in steps[0]  # nor does the parse build it
    assert "StructsToJson" in _simple_plan(items)


def test_metric_prepares_the_inputs_it_reads(spark, tmp_path):
    folder = _tables(spark, tmp_path)
    assert E.queries()["gold1_fulfillment_time"](spark, folder).count() == 2
    assert [n for n in L._layer(spark, folder) if n.startswith("__gold1__")] == ["__gold1__orders"]
    assert "items" not in L._layer(spark, folder)


def test_bucketed_write_leaves_the_session_as_it_was(spark):
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting, None)
    stored = materialize(spark.range(50).withColumnRenamed("id", "order_id"), "unsorted", bucket_by=["order_id"])
    assert stored.count() == 50 and spark.conf.get(setting, None) == before


def test_json_lines_are_compressed(spark, tmp_path):
    bronze = spark.range(20).selectExpr("concat('{\"orderId\":\"', id, '\"}') AS orderDetails")
    write_bronze(bronze, str(tmp_path / "lines"))
    files = list((tmp_path / "lines").glob("part-*"))
    assert files and all(f.name.endswith(".json.gz") for f in files)
    assert sum(len(gzip.open(f).readlines()) for f in files) == 20
    assert read_documents(spark, str(tmp_path / "lines")).count() == 20


def test_texts_of_customers_and_orders_are_made_once(spark, tmp_path):
    plan = _simple_plan(D.bronze_from_dir(spark, _tables(spark, tmp_path)))
    document = next(line for line in plan.splitlines() if '"sellerOrderId"' in line)
    assert "RLIKE(c_" not in document and "RLIKE(o_orderpriority" not in document  # these are quoted below
    assert 'coalesce(concat(,"items":' not in document  # an order's lines are copied into the document alone
    assert "substring(invoke(StructsToJson" not in plan  # a text cut by its own length would be made twice


def test_orders_without_key_or_price_leave_members_out(spark, tmp_path):
    tables = D.load_tables(spark, _tables(spark, tmp_path))
    tables["orders"] = tables["orders"].withColumn("o_orderkey", F.expr("nullif(o_orderkey, 2)")) \
        .withColumn("o_totalprice", F.expr("nullif(o_totalprice, 10.5)"))
    docs = [json.loads(r.orderDetails) for r in D.build_bronze(tables).collect()]
    priceless = next(d for d in docs if d.get("orderId") == "1")
    keyless = next(d for d in docs if "orderId" not in d)
    assert "value" not in priceless and priceless["paymentData"]["transactions"][0]["payments"][0]["id"] == "P1-0"
    assert len(priceless["items"]) == 3 and len(priceless["shippingData"]["logisticsInfo"]) == 3
    assert keyless["value"] == 300 and keyless["clientPreferencesData"] == {"locale": "en-US"}
    assert "items" not in keyless and keyless["shippingData"]["address"]["country"] == "BRA"


def test_item_queries_parse_the_fields_they_read(spark, tmp_path):
    folder = _tables(spark, tmp_path)
    plan = _simple_plan(E.queries()["explode_map"](spark, folder))
    parse = next(line for line in plan.splitlines() if "from_json" in line)
    assert "itemAttachment" in parse and "sellingPrices" not in parse and "offerings" not in parse
    found = {(r.unique_id, r.price_tag, r.category_name) for r in E.queries()["explode_chain"](spark, folder).collect()}
    assert ("1-5-7", "tag-O", "Cat7") in found and len(found) == 4
