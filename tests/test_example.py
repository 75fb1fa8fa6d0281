"""The end-to-end daily batch example runs on the smallest scale factor."""

from examples.daily_batch import run
from tests.conftest import SF_SMALL


def test_daily_batch(spark, tmp):
    out = run(spark, SF_SMALL, tmp)
    assert out["new_sources"] > 0 and out["tasks"] > 0
    assert out["extracted"] == out["trusted_rows"] > 0
    assert out["dimension_rows"] == out["run_output"]["Counts"]["CuratedCount"]
    assert out["run_output"]["CuratedTransform"]["Tables"] == ["trusted_dbo_customer"]
    assert out["facts_with_sk"] > 0 and out["batches"] > 0 and out["lineage_rows"] > 0


def test_example_counts_agree_with_registered_queries(spark, tmp):
    """The sink's observed counts equal what the registered queries compute."""
    from lakehand.plans.catalog import QUERIES
    out = run(spark, SF_SMALL, tmp)
    changed = QUERIES["scd2_changed_rows"](spark, SF_SMALL).count()
    new_keys = QUERIES["anti_new_keys"](spark, SF_SMALL).count()
    counts = out["run_output"]["Counts"]
    assert counts["UpdateCount"] == changed
    assert counts["InsertCount"] == changed + new_keys
    assert out["dimension_rows"] == QUERIES["scd2_merge"](spark, SF_SMALL).count()
    assert out["tasks"] == QUERIES["wm_batch_init"](spark, SF_SMALL).count()
