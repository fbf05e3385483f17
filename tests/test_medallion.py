"""End-to-end jobs: save silver tables (twice: create, then merge) and the gold tables."""

import datetime as dt

import __spark_entry__ as E
from orderlake.plans.medallion import bronze_to_silver, silver_to_gold
from orderlake.sources.documents import bronze_from_dir

SF = "/root/testdata/sf0.001"
DAY = dt.date(2024, 1, 1)


def test_bronze_to_silver_to_gold(spark, tmp_path):
    bronze = bronze_from_dir(spark, SF)
    lake = str(tmp_path / "lake")
    first = bronze_to_silver(bronze, lake, "ol_lake", load_date=DAY)
    assert first["orders"].count() == 1500
    assert "load_date" in first["items"].columns
    # a second load of the same documents: keyed tables are upserted, others replaced
    second = bronze_to_silver(bronze, lake, "ol_lake", tables=("orders", "items"),
                              load_date=DAY)
    assert second["orders"].count() == 1500
    assert second["items"].count() == first["items"].count()
    gold = silver_to_gold(spark, lake, "ol_lake", load_date=DAY)
    assert len(gold["order_summary"].columns) == 23          # 22 + load_date
    assert gold["order_summary"].count() == E.entry(spark).count()
    assert gold["kpi_table"].count() > 0


def test_two_batches_leave_the_rows_of_both(spark, tmp_path):
    from pyspark.sql import functions as F
    bronze = bronze_from_dir(spark, SF)
    number = F.xxhash64("orderDetails") % 2
    lake = str(tmp_path / "lake2")
    names = ("orders", "items", "payment", "shipping_data", "totals")
    whole = bronze_to_silver(bronze, str(tmp_path / "whole"), "ol_whole", tables=names, load_date=DAY)
    bronze_to_silver(bronze.where(number == 0), lake, "ol_parts", tables=names, load_date=DAY)
    parts = bronze_to_silver(bronze.where(number != 0), lake, "ol_parts", tables=names, load_date=DAY)
    for name in names:
        assert parts[name].count() == whole[name].count() > 0, name
