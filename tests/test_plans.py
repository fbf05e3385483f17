"""Plan shape of the gold tables: the properties the design relies on at scale."""

import contextlib
import io

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_gold_plans_have_no_window_and_no_cross_join(spark):
    for name in ("order_summary", "kpi_table", "gold1_order_status_count",
                 "gold2_total_quantity_sold"):
        plan = _plan(E.queries()[name](spark, SF))
        assert "Window" not in plan, name
        assert "CartesianProduct" not in plan, name
        assert "NestedLoopJoin" not in plan, name


def test_summary_reads_bucketed_inputs(spark):
    plan = _plan(E.queries()["order_summary"](spark, SF))
    assert "Bucketed: true" in plan


def test_quantity_per_unique_id_moves_rows_once(spark):
    """M10 with broadcast off: item rows go to their id in one exchange."""
    import re
    E.queries()["gold1_total_quantity_sold"](spark, SF)  # stored inputs, made under the usual settings
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(E.queries()["gold1_total_quantity_sold"](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 1
