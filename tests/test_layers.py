"""Stored layers: bucket placement of the document table and co-partitioned plans."""

from pyspark.sql import functions as F

from orderlake.plans import layers as L

SF = "/root/testdata/sf0.001"


def _misplaced(spark, df, key):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = df.select(F.input_file_name().alias("f"),
                      F.expr(f"pmod(hash({key}), {n})").alias("expected"))
    got = files.select(F.regexp_extract("f", r"_(\d{5})\.c\d{3}", 1).cast("int").alias("b"),
                       "expected")
    return got.where(F.col("b").isNull() | (F.col("b") != F.col("expected"))).count()


def test_document_rows_sit_in_their_bucket(spark):
    docs = L.documents(spark, SF)
    assert docs.count() > 0
    assert _misplaced(spark, docs, "orderId") == 0


def test_silver_rows_sit_in_their_bucket(spark):
    for name in ("orders", "items", "payment"):
        assert _misplaced(spark, L.silver(spark, SF, name), "order_id") == 0


def test_stored_items_have_no_duplicate_rows(spark):
    # the summary uses the stored items table without a second dedupe
    items = L.silver(spark, SF, "items")
    assert items.count() == items.dropDuplicates().count()
