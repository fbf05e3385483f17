"""Load date, keyed merge and save-with-merge (S4-S9), on order rows."""

import datetime as dt

import pytest

from orderlake.sources.upsert import merge_by_key, save_with_merge, stored_versions, with_load_date

DAY = dt.date(2024, 1, 1)


def _orders(spark, *rows):
    return spark.createDataFrame(list(rows), "orderId STRING, orderValue INT")


def test_save_inserts_updates_and_keeps(spark, tmp_path):
    path = str(tmp_path / "orders")
    save_with_merge(_orders(spark, ("o1", 100), ("o2", 250), (None, 5)), path, "ol_db", "orders_t", ["orderId"], DAY)
    assert spark.catalog.tableExists("ol_db.orders_t")
    out = save_with_merge(_orders(spark, ("o2", 275), ("o9", 40), (None, 6)), path, "ol_db", "orders_t", "orderId", DAY)
    assert out.columns == ["order_id", "order_value", "load_date"]
    got = sorted((str(r.order_id), r.order_value) for r in out.collect())
    assert got == [("None", 5), ("None", 6), ("o1", 100), ("o2", 275), ("o9", 40)]


def test_target_is_found_by_path_and_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "by_path")
    for i in range(4):
        save_with_merge(_orders(spark, (f"o{i}", i)), path, "ol_db", "by_path", ["orderId"], DAY)
        spark.sql("DROP TABLE ol_db.by_path")  # what another session's catalog knows: nothing
    out = save_with_merge(_orders(spark, ("o0", 9)), path, "ol_db", "by_path", ["orderId"], DAY)
    assert sorted((r.order_id, r.order_value) for r in out.collect()) == [("o0", 9), ("o1", 1), ("o2", 2), ("o3", 3)]
    assert [n for n, _ in stored_versions(spark, path)] == [3, 4]


def test_groups_of_the_batch_are_replaced(spark, tmp_path):
    path = str(tmp_path / "lines")
    first = _orders(spark, ("o1", 1), ("o1", 2), ("o2", 3))
    save_with_merge(first, path, "ol_db", "lines_t", None, DAY, replace_by=["order_id"])
    out = save_with_merge(_orders(spark, ("o1", 7), ("o3", 8), ("o3", 8)), path, "ol_db", "lines_t", None, DAY,
                          replace_by=["order_id"])
    assert sorted((r.order_id, r.order_value) for r in out.collect()) == [("o1", 7), ("o2", 3), ("o3", 8), ("o3", 8)]


def test_merge_cases(spark):
    target = spark.createDataFrame(
        [("a", 1), ("b", 2), (None, 3)], "k STRING, v INT")
    source = spark.createDataFrame(
        [("a", 10), ("c", 30), (None, 40)], "k STRING, v INT")
    got = sorted((str(r.k), r.v) for r in merge_by_key(target, source, ["k"]).collect())
    # updated a, kept b, inserted c; null keys never match, so both null rows stay
    assert got == [("None", 3), ("None", 40), ("a", 10), ("b", 2), ("c", 30)]
    got_ns = merge_by_key(target, source, ["k"], null_safe=True).collect()
    assert sorted((str(r.k), r.v) for r in got_ns) == [("None", 40), ("a", 10), ("b", 2),
                                                       ("c", 30)]


def test_merge_duplicate_source_key_raises(spark):
    target = spark.createDataFrame([("a", 1)], "k STRING, v INT")
    source = spark.createDataFrame([("a", 2), ("a", 3)], "k STRING, v INT")
    with pytest.raises(ValueError):
        merge_by_key(target, source, ["k"])
    # duplicates that match no target row are inserted as they are
    other = spark.createDataFrame([("z", 2), ("z", 3)], "k STRING, v INT")
    assert merge_by_key(target, other, ["k"]).count() == 3


def test_merge_multi_key(spark):
    target = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "a INT, b INT, v STRING")
    source = spark.createDataFrame([(1, 2, "z")], "a INT, b INT, v STRING")
    got = sorted(tuple(r) for r in merge_by_key(target, source, ["a", "b"]).collect())
    assert got == [(1, 1, "x"), (1, 2, "z")]


def test_load_date(spark):
    df = spark.createDataFrame([(1,)], "x INT")
    assert with_load_date(df, DAY).first().load_date == DAY
    assert with_load_date(df).first().load_date is not None


def test_save_without_keys_replaces(spark, tmp_path):
    cols = ["OrderId", "Metric"]
    path = str(tmp_path / "t3")
    save_with_merge(spark.createDataFrame([("1", 1), ("1", 2)], cols), path, "ol_db",
                    "gold_like", None, DAY)
    out = save_with_merge(spark.createDataFrame([("2", 5)], cols), path, "ol_db",
                          "gold_like", None, DAY)
    assert [(r.order_id, r.metric) for r in out.collect()] == [("2", 5)]
