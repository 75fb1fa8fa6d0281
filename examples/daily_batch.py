"""One daily batch with lakehand, end to end, over the driver's tables.

usage: python examples/daily_batch.py <sf_dir> <work_dir>

control tables -> task list -> incremental extract (watermark) -> raw folder ->
trusted table (keyed upsert) -> curated type 2 dimension (two batches, bucketed)
-> fact lookup of current surrogate keys -> monitoring views.  Every step is a
DataFrame job; ``work_dir`` must be a shared folder on a cluster.
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def run(spark: SparkSession, sf_dir: str, work: str) -> dict:
    from lakehand.context import JobContext, run_entity
    from lakehand.operators.incremental import incremental_load
    from lakehand.operators.joins import lookup
    from lakehand.plans import fixtures as X
    from lakehand.plans.control import batch_init, register_sources
    from lakehand.plans.monitor import batch_status_log, object_lineage
    from lakehand.plans.zones import raw_load, trusted_load
    from lakehand.sinks.keyed import KeyedTable
    from lakehand.sinks.tables import land_parquet

    t = X.Tables(spark, sf_dir)
    out = {}

    # control tables: register new sources, then the batch's task list
    manifest = X.extract_manifest(t)
    out["new_sources"] = register_sources(manifest, X.ingestion_sheet(t), created_at=X.TS2).count()
    status = X.extract_status(t)
    out["tasks"] = batch_init(status, manifest, "20240201", created_at=X.TS2).count()

    # extract: rows after the stored high-water mark, landed as Parquet
    rows, low, high = incremental_load(t.orders, "o_orderdate", prev_low="1998-01-01 00:00:00")
    land_parquet(rows, f"{work}/raw/erp/dbo_orders")
    out["extracted"], out["high_watermark"] = rows.count(), str(high)

    # raw registration and trusted upsert on the business key
    task = {"DestinationSchema": "dbo", "DestinationTableName": "orders", "RawPath": "/raw/erp/dbo_orders/x.parquet",
            "BusinessKeyColumn": "o_orderkey", "ExtendedProperties": None}
    raw = raw_load(spark, task, f"{work}/raw/erp/dbo_orders")
    trusted = KeyedTable(spark, f"{work}/trusted/erp/dbo_orders", "o_orderkey", buckets=8)
    trusted_load(spark, task, raw, trusted)
    out["trusted_rows"] = trusted.read().count()

    # curated type 2 dimension, two batches, stored in buckets of the business key
    dim = KeyedTable(spark, f"{work}/curated/Dimension/D_Customer", "Customer_BK", buckets=8)
    for start, version in ((X.TS1, X.customer_v1), (X.TS2, X.customer_v2)):
        ctx = JobContext(spark, "Dimension", "Customer", start=start)
        X.customer_entity(version(t)).createOrReplaceTempView("trusted_dbo_customer")
        run_output = run_entity(ctx, lambda c: c.table("trusted_dbo_customer"), dim)
    out["dimension_rows"] = dim.read().count()
    out["run_output"] = json.loads(run_output)

    # facts pick up the current surrogate keys
    facts = trusted.read().select("o_orderkey", F.col("o_custkey").cast("string").alias("Customer_BK"),
                                  "o_totalprice")
    out["facts_with_sk"] = lookup(facts, dim.read(), "Customer_BK", dim_columns=["Customer_SK"]).count()

    # monitoring
    bsl = batch_status_log(status, manifest, X.log_table(t), X.TS2)
    out["batches"] = bsl.select("BatchID").distinct().count()
    out["lineage_rows"] = object_lineage(X.log_table(t), X.report_refresh(t), X.transform_manifest(t),
                                         manifest).count()
    return out


if __name__ == "__main__":
    from lakehand.session import get_spark
    sf, work = sys.argv[1], sys.argv[2]
    print(json.dumps(run(get_spark("daily-batch", master="local[8]", shuffle_partitions=16), sf, work),
                     indent=2, default=str))
