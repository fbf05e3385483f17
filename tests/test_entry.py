"""Driver contract and a few registered queries against their SQL answers at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_contract_keys():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 50


def test_entry_runs(spark):
    df = E.entry(spark)
    assert len(df.columns) == 22
    assert df.count() > 0


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("orders", "lineitem", "customer", "supplier", "part", "events", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", ["silver_items", "silver_payment", "order_summary",
                                  "kpi_table", "merge_by_key", "explode_map",
                                  "explode_inner", "full_outer_null_keys",
                                  "left_join_unmatched", "group_join_back_null",
                                  "json_lines_scan", "save_first_load", "save_merge",
                                  "incremental_load_orders", "incremental_load_items",
                                  "saved_order_summary", "saved_kpi_table"])
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    order = sorted(cols)
    ours = sorted(repr(tuple(r[c] for c in order)) for r in df.collect())
    theirs = sorted(repr(tuple(row[cols.index(c)] for c in order)) for row in res.fetchall())
    assert ours == theirs
