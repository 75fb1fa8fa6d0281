"""Streaming delivery of the type 2 load and the job context."""

import json

from pyspark.sql import functions as F

from lakehand.context import JobContext, run_entity
from lakehand.sinks.keyed import KeyedTable
from lakehand.streaming.incremental import read_landing_stream, scd2_stream


def test_available_now_scd2(spark, tmp):
    schema = "K_BK string, v string, ts timestamp_ntz"
    b1 = spark.createDataFrame([("1", "a", "2024-01-01 00:00:00"), ("2", "b", "2024-01-01 00:00:00")],
                               "K_BK string, v string, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    b1.write.mode("append").parquet(f"{tmp}/land")
    table = KeyedTable(spark, f"{tmp}/dim", "K_BK", buckets=4)
    from pyspark.sql.types import _parse_datatype_string
    q = scd2_stream(read_landing_stream(spark, f"{tmp}/land", _parse_datatype_string(schema)), table, "K_BK", "K_SK",
                    f"{tmp}/ckpt", dedupe_by="ts", start_col="ts")
    q.awaitTermination(120)
    assert table.read().count() == 2 and "ts" not in table.read().columns
    b2 = spark.createDataFrame([("1", "A", "2024-01-02 00:00:00"), ("1", "Z", "2024-01-02 00:00:01")],
                               "K_BK string, v string, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    b2.write.mode("append").parquet(f"{tmp}/land")
    q = scd2_stream(read_landing_stream(spark, f"{tmp}/land", _parse_datatype_string(schema)), table, "K_BK", "K_SK",
                    f"{tmp}/ckpt", dedupe_by="ts", start_col="ts")
    q.awaitTermination(120)
    rows = {(r.K_BK, r.v, r._Current) for r in table.read().collect()}
    assert rows == {("1", "a", 0), ("1", "Z", 1), ("2", "b", 1)}


def test_job_context_lineage(spark, tmp):
    spark.createDataFrame([(1, "x")], "uid int, name string").createOrReplaceTempView("dbo_thing")
    ctx = JobContext(spark, "Dimension", "Thing", start="2024-01-01 00:00:00")

    def transform(c):
        return c.table("dbo_thing").select(F.col("uid").cast("string").alias(c.bk), "name")

    o = json.loads(run_entity(ctx, transform, KeyedTable(spark, f"{tmp}/thing", buckets=2)))
    assert o["CuratedTransform"]["Tables"] == ["dbo_thing"]
    assert o["Counts"]["InsertCount"] == 1 and o["Counts"]["UpdateCount"] == 0
    assert o["CuratedTransform"]["Destination"] == "curated.D_Thing" and o["Counts"]["CuratedCount"] == 1


def test_a_replayed_micro_batch_is_skipped(spark, tmp):
    """The checkpoint of a finished batch is taken away, so Spark delivers the batch again."""
    import shutil
    rows = [("1", "a", "2024-01-01 00:00:00"), (None, "n", "2024-01-01 00:00:00")]
    frame = spark.createDataFrame(rows, "K_BK string, v string, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    frame.write.parquet(f"{tmp}/land")
    table = KeyedTable(spark, f"{tmp}/dim", "K_BK", buckets=2)
    saves = []
    save = table.save_scd2
    table.save_scd2 = lambda *a, **k: saves.append(k["batch_id"]) or save(*a, **k)
    for _ in range(2):
        stream = read_landing_stream(spark, f"{tmp}/land", frame.schema)
        assert scd2_stream(stream, table, "K_BK", "K_SK", f"{tmp}/ckpt", dedupe_by="ts", start_col="ts").awaitTermination(120)
        shutil.move(f"{tmp}/ckpt/commits", f"{tmp}/commits-{len(saves)}-{_}")
    assert saves == ["ckpt:0"] and table.delivered("ckpt:0") and not table.delivered("ckpt:1")
    assert table.read().count() == 2
    # a batch that died before its id was kept is saved again, without effect
    shutil.move(f"{tmp}/dim-batches", f"{tmp}/gone")
    assert scd2_stream(read_landing_stream(spark, f"{tmp}/land", frame.schema), table, "K_BK", "K_SK", f"{tmp}/ckpt",
                       dedupe_by="ts", start_col="ts").awaitTermination(120)
    assert saves == ["ckpt:0", "ckpt:0"] and table.read().count() == 2
