"""Each parity switch of SURVEY 4.4 reproduces the reference behaviour."""

from pyspark.sql import functions as F

from lakehand.functions.scalar import scaled_units, tsql_concat
from lakehand.operators import scd as S
from lakehand.operators.incremental import incremental_load, wm_filter
from lakehand.operators.joins import lookup


def test_first_load_lower_bound(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "w int")
    rows, low, high = incremental_load(df, "w")
    assert rows.count() == 3 and (low, high) == (1, 3)
    rows, _, _ = incremental_load(df, "w", include_min=False)          # N13: > min skips the minimum
    assert rows.count() == 2
    assert wm_filter(df, "w", 1, 2).count() == 1
    full, _, _ = incremental_load(df, None)                            # F7: no column -> full load
    assert full.count() == 3


def test_closing_batch_key_source(spark):
    t = S.scd2_first_load(spark.createDataFrame([("1", "a")], "K_BK string, v string"), "K_BK", "K_SK",
                          "2024-01-01 00:00:00", with_batch_key=True)
    src = spark.createDataFrame([("1", "b")], "K_BK string, v string")
    own = S.scd2_apply(t, src, "K_BK", "K_SK", "2024-01-05 00:00:00").where("_Current = 0").first()._Batch_SK
    new = S.scd2_apply(t, src, "K_BK", "K_SK", "2024-01-05 00:00:00", close_batch_from="new") \
        .where("_Current = 0").first()._Batch_SK
    assert str(own).startswith("240101000000") and str(new).startswith("240105000000")      # N15


def test_lookup_versions(spark):
    dim = spark.createDataFrame([("1", "old", 0), ("1", "new", 1)], "K string, v string, _Current int")
    fact = spark.createDataFrame([("1", 10)], "K string, amount int")
    assert lookup(fact, dim, "K").count() == 1
    assert lookup(fact, dim, "K", versions="all").count() == 2                                # N6
    assert lookup(fact, dim, "K", salt_buckets=4).count() == 1
    hot = spark.range(500).select(F.when(F.col("id") % 10 < 7, "1").otherwise(F.col("id").cast("string")).alias("K"),
                                  F.col("id").alias("amount"))
    d = spark.range(500).select(F.col("id").cast("string").alias("K"), F.lit(1).alias("_Current"), F.col("id").alias("x"))
    plain = sorted(map(tuple, lookup(hot, d, "K").collect()))
    salted = sorted(map(tuple, lookup(hot, d, "K", salt_buckets=8).collect()))
    assert plain == salted and len(plain) == 500


def test_units_and_concat(spark):
    r = spark.range(1).select(scaled_units(F.lit(1048576)).alias("a"), scaled_units(F.lit(1026), 1026).alias("b"),
                              tsql_concat(F.lit("Q"), F.lit(None)).alias("c")).first()
    assert (r.a, r.b, r.c) == ("1.00", "1.00", "Q")                                           # N9, N8


def test_format_parity():
    from lakehand.sources.files import detect_format
    assert detect_format("/raw/json_feed/x.parquet", parity=True) == "json"                   # N1
    assert detect_format("/raw/json_feed/x.parquet") == "parquet"


def test_composite_key_text_collides_but_merge_uses_columns(spark):
    from lakehand.operators.keys import business_key
    df = spark.createDataFrame([("1", "23", "a"), ("12", "3", "b")], "k1 string, k2 string, v string")
    assert df.select(business_key("k1,k2").alias("bk")).distinct().count() == 1               # N4 text collides
    t = df.withColumn("_Current", F.lit(1))
    src = spark.createDataFrame([("12", "3", "B")], "k1 string, k2 string, v string")
    out = S.scd1_upsert(t.drop("_Current"), src, ["k1", "k2"])
    assert sorted((r.k1, r.k2, r.v) for r in out.collect()) == [("1", "23", "a"), ("12", "3", "B")]


def test_merge_inserts_get_end_of_day(spark):
    t = S.scd2_first_load(spark.createDataFrame([("1", "a")], "K_BK string, v string"), "K_BK", "K_SK",
                          "2024-01-01 00:00:00", end="2024-01-07 00:00:00")
    t = S.scd2_apply(t, spark.createDataFrame([("1", "b")], "K_BK string, v string"), "K_BK", "K_SK",
                     "2024-01-08 00:00:00", end="2024-01-14 00:00:00")
    ends = {r.v: str(r._Ended) for r in t.collect()}
    assert ends == {"a": "2024-01-07 23:59:59", "b": "2024-01-14 23:59:59"}                    # N14


def test_failed_literal_counts_as_failure(spark):
    from lakehand.plans.monitor import task_status
    st = spark.createDataFrame(
        [(1, "b", "s", 7, "Failed", "Success")], "ID long, BatchID string, SystemCode string, SourceID long, "
        "RawStatus string, TrustedStatus string").select(
        "*", F.lit(None).cast("long").alias("SourceRowCount"), F.lit(None).cast("long").alias("SinkRowCount"),
        *[F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias(c) for c in
          ("RawStartDTS", "RawEndDTS", "TrustedStartDTS", "TrustedEndDTS", "CreatedDTS", "EndedDTS")])
    m = spark.createDataFrame([(7, "dbo", "T7")], "SourceID long, SourceSchema string, SourceTableName string")
    assert task_status(st, m, "2024-01-02 00:00:00").first().Fail == 1                            # N17


def test_upsert_requires_key(spark):
    import pytest
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError):
        S.scd1_upsert(t, t, [])                                                                 # N26
