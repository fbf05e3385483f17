"""Headline timings: the bronze -> silver -> gold run at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line.  Stages, each timed to completion (results written to Spark's
no-op sink or stored, never collected to the driver):

* ``bronze_silver``: order documents built from the flat tables, parsed once, and all
  15 silver tables stored (the source's bronze-to-silver step for every table);
* ``order_summary``: gold table 1 from the stored silver tables;
* ``kpi_table``: gold table 2 from the stored silver tables;
* ``silver_items`` / ``payment_metrics`` / ``merge_orders``: single operators on the
  stored layers (the 13-generator flatten, a partition+group metric, a keyed upsert).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from orderlake.session import SCALE_CONF

    scratch = tempfile.mkdtemp(prefix="orderlake-bench-")
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName("orderlake-bench")
               .config("spark.sql.shuffle.partitions", str(int(cpus) * 2))
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEM", "16g"))
               .config("spark.local.dir", scratch)
               .config("spark.sql.warehouse.dir", f"{scratch}/warehouse"))
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    from orderlake.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)   # the configured spark.checkpoint.dir, or a scratch one

    from orderlake.plans import kpi as K
    from orderlake.plans import layers as L
    from orderlake.plans import summary as S
    from orderlake.plans.catalog import LOAD_DATE
    from orderlake.plans.silver import BUILDERS
    from orderlake.sources.upsert import merge_by_key

    def run(df) -> None:
        df.write.mode("overwrite").format("noop").save()

    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    timed("bronze_silver", lambda: [L.silver(spark, sf_dir, n) for n in BUILDERS])
    silver = L.silver_set(spark, sf_dir, *L.GOLD1_INPUTS)
    prepared: dict = {}
    timed("order_summary", lambda: (prepared.update(L.gold1_inputs(spark, sf_dir)),
                                    run(S.order_summary(prepared, prepared=True))))
    timed("kpi_table", lambda: run(K.kpi_table(silver, LOAD_DATE)))
    from orderlake.plans.silver import silver_table
    timed("silver_items", lambda: run(silver_table(L.documents(spark, sf_dir), "items")))
    timed("payment_metrics", lambda: run(S.payment_metrics(prepared["payment"])))
    target = silver["orders"].select("order_id", "status", F.col("value").cast("bigint"))
    source = (spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey")
              .agg(F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("value"))
              .select(F.col("l_orderkey").cast("string").alias("order_id"),
                      F.lit("repriced").alias("status"), "value"))
    timed("merge_orders", lambda: run(merge_by_key(target, source, ["order_id"])))
    spark.stop()
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "medallion_run_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir,
                      "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
