"""Metric shapes (W, J5, P9, A8) and the full outer chain (J4), null keys included."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlake.operators.joins import full_outer_chain, full_outer_chain_plain
from orderlake.operators.metrics import (add_global_metrics, add_group_metric,
                                         add_key_metrics, add_partition_metric,
                                         distinct_count_with_null)

ROWS = [("a", 1), ("a", 2), ("b", 5), (None, 7), (None, 8)]


def _df(spark):
    return spark.createDataFrame(ROWS, "k STRING, v INT")


def _rows(df, *cols):
    return sorted(tuple("~" if x is None else x for x in r) for r in df.select(*cols).collect())


def test_partition_metric_equals_window(spark):
    df = _df(spark)
    ours = add_partition_metric(df, "k", n=F.count("v"), s=F.sum("v"))
    w = Window.partitionBy("k")
    ref = df.withColumn("n", F.count("v").over(w)).withColumn("s", F.sum("v").over(w))
    assert _rows(ours, "k", "v", "n", "s") == _rows(ref, "k", "v", "n", "s")
    assert ("~", 7, 2, 15) in _rows(ours, "k", "v", "n", "s")


def test_group_metric_null_key_gets_null(spark):
    out = add_group_metric(_df(spark), "k", s=F.sum("v"))
    got = _rows(out, "k", "v", "s")
    assert got == [("a", 1, 3), ("a", 2, 3), ("b", 5, 5), ("~", 7, "~"), ("~", 8, "~")]


def test_key_metrics_mixed(spark):
    out = add_key_metrics(_df(spark), "k", window={"n": F.count("v")},
                          joined={"s": F.sum("v")}, write=False)
    assert ("~", 7, 2, "~") in _rows(out, "k", "v", "n", "s")
    assert ("b", 5, 1, 5) in _rows(out, "k", "v", "n", "s")


def test_global_metrics_and_distinct_with_null(spark):
    out = add_global_metrics(_df(spark), total=F.sum("v"),
                             keys=distinct_count_with_null("k"))
    assert {(r.total, r.keys) for r in out.collect()} == {(23, 3)}
    empty = spark.createDataFrame([], "k STRING, v INT")
    r = empty.agg(distinct_count_with_null("k").alias("n")).first()
    assert r.n == 0


def test_full_outer_chain_matches_plain_chain(spark):
    a = spark.createDataFrame([("1", "a1"), ("1", "a2"), ("2", "a3"), (None, "a4")],
                              "id STRING, x STRING")
    b = spark.createDataFrame([("1", "b1"), ("3", "b2"), (None, "b3")], "id STRING, y STRING")
    c = spark.createDataFrame([("2", "c1"), ("3", "c2"), ("3", "c3")], "id STRING, z STRING")
    ours = full_outer_chain([a, b, c], "id")
    plain = full_outer_chain_plain([a, b, c], "id")
    assert _rows(ours, "id", "x", "y", "z") == _rows(plain, "id", "x", "y", "z")
    assert ours.count() == 7


def test_full_outer_chain_rejects_name_clash(spark):
    import pytest
    a = spark.createDataFrame([("1", 1)], "id STRING, v INT")
    with pytest.raises(ValueError):
        full_outer_chain([a, a], "id")


def test_full_outer_chain_with_key_sources(spark):
    a = spark.createDataFrame([("1", "a1"), ("2", "a2")], "id STRING, x STRING")
    b = spark.createDataFrame([("2", "b1"), ("3", "b2"), (None, "b3")], "id STRING, y STRING")
    ours = full_outer_chain([a, b], "id", key_sources=[a.select("id"), b.select("id")])
    plain = full_outer_chain_plain([a, b], "id")
    assert _rows(ours, "id", "x", "y") == _rows(plain, "id", "x", "y")


def test_global_metrics_on_empty_input_are_typed_nulls(spark):
    empty = spark.createDataFrame([], "k STRING, v INT")
    out = add_global_metrics(empty, avg_v=F.avg("v"), total=F.sum("v"))
    assert dict(out.dtypes)["avg_v"] == "double"
    assert dict(out.dtypes)["total"] == "bigint"
    assert out.count() == 0
