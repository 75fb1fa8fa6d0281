"""Physical-plan properties that matter at scale (read from explain output)."""

from lakehand.plans.catalog import QUERIES
from tests.conftest import SF_SMALL


def _explain(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_watermark_range_is_pushed_to_the_scan(spark):
    p = _explain(QUERIES["wm_range"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in p
    assert "LessThanOrEqual(o_orderdate" in p


def test_scd2_merge_is_one_full_outer_join(spark):
    p = _explain(QUERIES["scd2_merge_second"](spark, SF_SMALL))
    assert p.count("Join type: FullOuter") == 1      # the previous batch is read back, not recomputed
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_lookup_broadcasts_a_bounded_dimension(spark):
    p = _explain(QUERIES["fact_lookup_sk"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p


def test_projection_is_pruned(spark):
    p = _explain(QUERIES["wm_bounds"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in p


def test_no_python_udfs_in_any_plan(spark):
    for k in ["batch_status_log", "object_lineage", "meta_generated_sql", "register_source", "scd2_fact_batch_key"]:
        p = _explain(QUERIES[k](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, k


def test_history_key_check_is_map_side_for_a_small_batch(spark, tmp):
    """Closed history is filtered by a broadcast of the batch keys, never shuffled."""
    from lakehand.operators import scd as S
    from pyspark.sql import functions as F
    base = spark.range(1000).select(F.col("id").cast("string").alias("K_BK"), (F.col("id") % 3).alias("v"))
    t = S.scd2_first_load(base, "K_BK", "K_SK", "2024-01-01 00:00:00")
    t = S.scd2_apply(t, base.withColumn("v", F.col("v") + 1), "K_BK", "K_SK", "2024-01-02 00:00:00")
    t.write.parquet(f"{tmp}/t")
    stored = spark.read.parquet(f"{tmp}/t")
    batch = base.limit(10).withColumn("v", F.lit(99))
    p = _explain(S.scd2_apply(stored, batch, "K_BK", "K_SK", "2024-01-03 00:00:00"))
    assert "BroadcastHashJoin LeftSemi" in p
    head = p.split("\n\n(1)")[0]
    semi = head[head.index("BroadcastHashJoin LeftSemi"):]
    first_branch = semi.split("+- BroadcastExchange")[0]
    assert "Exchange" not in first_branch           # the history side is not shuffled before the filter
