"""One-pass replay equals saving one snapshot after the other."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from lakehand.operators import history
from lakehand.operators import scd as S
from pyspark.sql import functions as F

SCHEMA = "k string, v string, w int"
DATES = ["2024-01-07 00:00:00", "2024-02-07 00:00:00", "2024-03-07 00:00:00", "2024-03-20 00:00:00"]
row = st.tuples(st.sampled_from([None, "a", "b", "c"]), st.sampled_from([None, "x", "y"]), st.integers(0, 1))
snapshot = st.lists(row, max_size=4, unique_by=lambda r: r[0])


def stepwise(periods, target=None, batch=False, reopen=False):
    t = target
    for as_at, src in periods:
        start = as_at.replace("-07 ", "-01 ").replace("-20 ", "-14 ")
        t = (S.scd2_first_load(src, "k", "k_SK", start, as_at, with_batch_key=batch) if t is None
             else S.scd2_apply(t, src, "k", "k_SK", start, as_at, reopen=reopen))
    return t


def rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


@given(st.lists(snapshot, min_size=1, max_size=4), st.booleans())
@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_replay_equals_steps(spark, snapshots, batch):
    periods = [(d, spark.createDataFrame(s, SCHEMA)) for d, s in zip(DATES, snapshots)]
    got = history.replay_periods(periods, "k", "k_SK", days=6, with_batch_key=batch)
    assert rows(got) == rows(stepwise(periods, batch=batch))


@pytest.mark.parametrize("reopen", [False, True])
def test_replay_onto_a_target(spark, reopen):
    rng = random.Random(8)
    draw = lambda: [(f"k{i}", rng.choice("xy"), 0) for i in range(12) if rng.random() < .7] + [(None, "n", 1)]
    first = S.scd2_first_load(spark.createDataFrame(draw(), SCHEMA), "k", "k_SK", "2023-01-01 00:00:00")
    target = S.scd2_apply(first, spark.createDataFrame(draw(), SCHEMA), "k", "k_SK", "2023-06-01 00:00:00")
    # a key whose only versions are closed, one of them in a snapshot
    shut = target.where("k = 'k1' or k = 'k2'").withColumn("_Current", F.lit(0)).unionByName(target.where("k <> 'k1' and k <> 'k2' or k is null"))
    shut = spark.createDataFrame(shut.collect(), target.schema)
    periods = [(d, spark.createDataFrame([("k1", "z", 3), *[r for r in draw() if r[0] != "k1"]], SCHEMA)) for d in DATES]
    got = history.replay_periods(periods, "k", "k_SK", days=6, target=shut, reopen=reopen)
    assert rows(got) == rows(stepwise(periods, shut, reopen=reopen))


def test_replay_is_one_shuffle(spark):
    periods = [(d, spark.range(50).select(F.col("id").cast("string").alias("k"), F.lit(d).alias("v"))) for d in DATES]
    plan = history.replay_periods(periods, "k", "k_SK")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_replay_without_null_safety_keeps_its_steps(spark):
    src = [[("a", None, 1)], [("a", "x", 1)], [("a", "y", 1)]]
    periods = [(d, spark.createDataFrame(s, SCHEMA)) for d, s in zip(DATES, src)]
    got = history.replay_periods(periods, "k", "k_SK", null_safe=False)
    assert [(r["v"], r["_Current"]) for r in got.collect()] == [(None, 1)]


def test_composite_key_texts_differ(spark):
    from lakehand.operators.keys import composite_key
    pairs = [("a|", "b"), ("a", "|b"), ("a\\", "|b"), ("a\\|", "b"), ("1", "23"), ("12", "3"), ("", ""), ("|", ""), ("", "|"), (None, "x")]
    got = spark.createDataFrame(pairs, "x string, y string").select(composite_key(["x", "y"])).collect()
    texts = [r[0] for r in got]
    assert texts[-1] is None and len(set(texts)) == len(pairs)
