"""Session helpers: the shared checkpoint folder comes from the session."""

from lakehand.session import checkpoint_dir, cut_lineage, get_spark


def test_active_session_is_reused(spark):
    assert get_spark() is spark


def test_checkpoint_folder_from_session_and_lineage_cut(spark):
    d = checkpoint_dir(spark)
    assert d and not d.startswith("file:/tmp/spark-")       # named by the session, not a Spark scratch dir
    df = spark.range(10).selectExpr("id * 2 AS x")
    cut = cut_lineage(df)
    assert cut.count() == 10 and sorted(r.x for r in cut.collect())[-1] == 18
