"""Skew-safe window replacements agree with plain Spark windows, including a hot group."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakehand.operators.windows import dense_rank_global, latest_per_key, partition_agg, rank_in_buckets, rank_within


def _hot(spark):
    # one group holds two thirds of the rows; timestamps repeat and include NULLs
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("g"),
        F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.col("id") % 700).alias("v"), "id")
    return df


def test_rank_within_matches_window(spark):
    df = _hot(spark)
    w = Window.partitionBy("g").orderBy(F.col("v").asc_nulls_first())
    exp = {(r.id, r.r) for r in df.withColumn("r", F.dense_rank().over(w)).collect()}
    got = {(r.id, r.r) for r in rank_within(df, "g", F.col("v").asc_nulls_first(), "r", num_partitions=7).collect()}
    assert got == exp
    w2 = Window.partitionBy("g").orderBy("v", "id")
    exp2 = {(r.id, r.r) for r in df.withColumn("r", F.row_number().over(w2)).collect()}
    got2 = {(r.id, r.r) for r in rank_within(df, "g", ["v", "id"], "r", method="row_number", num_partitions=5).collect()}
    assert got2 == exp2


def test_dense_rank_global_desc(spark):
    df = _hot(spark)
    exp = {(r.id, r.r) for r in df.withColumn("r", F.dense_rank().over(Window.orderBy(F.col("v").desc()))).collect()}
    got = {(r.id, r.r) for r in dense_rank_global(df, "v", "r", desc=True).collect()}
    assert got == exp


def test_latest_per_key_keeps_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 3, "c"), (2, None, "d"), (2, None, "e")],
                               "k int, t int, x string")
    assert sorted(r.x for r in latest_per_key(df, "k", "t").collect()) == ["a", "b", "d", "e"]
    assert sorted(r.x for r in latest_per_key(df, "k", "t", desc=False).collect()) == ["c", "d", "e"]


def test_partition_agg_matches_window(spark):
    df = _hot(spark)
    got = {(r.id, r.n, r.s) for r in partition_agg(df, "g", {"n": F.count("id"), "s": F.sum("v")}).collect()}
    w = Window.partitionBy("g")
    exp = {(r.id, r.n, r.s) for r in df.select("id", F.count("id").over(w).alias("n"),
                                               F.sum("v").over(w).alias("s")).collect()}
    assert got == exp


def test_rank_in_buckets_matches_window(spark):
    vals = _hot(spark).select("g", "v").distinct()
    for desc in (False, True):
        order = F.col("v").desc_nulls_last() if desc else F.col("v").asc_nulls_first()
        exp = {(r.g, r.v, r.r) for r in vals.withColumn("r", F.dense_rank().over(Window.partitionBy("g").orderBy(order))).collect()}
        got = rank_in_buckets(vals, "g", "v", F.floor(F.col("v") / 50), "r", desc=desc)
        assert {(r.g, r.v, r.r) for r in got.collect()} == exp
    alone = vals.select("v").distinct()
    exp = {(r.v, r.r) for r in alone.withColumn("r", F.dense_rank().over(Window.orderBy(F.col("v").asc_nulls_first()))).collect()}
    assert {(r.v, r.r) for r in rank_in_buckets(alone, [], "v", F.floor(F.col("v") / 9), "r").collect()} == exp


def _tasks(spark):
    from tests.conftest import SF_SMALL
    from lakehand.plans import fixtures as X
    from lakehand.plans import monitor as M
    t = X.Tables(spark, SF_SMALL)
    return M.task_status(X.extract_status(t), X.extract_manifest(t), X.TS2)


def test_stage_ranks_match_windows_and_hold_no_whole_group(spark):
    from lakehand.plans import monitor as M
    tasks = _tasks(spark)
    w = Window.partitionBy("BatchID", "SystemCode")
    exp = tasks.withColumns({n: F.dense_rank().over(w.orderBy(F.col(c).asc_nulls_first())) for n, c in M.STAGE_RANKS.items()})
    cols = ["ID", *M.STAGE_RANKS]
    got = M.stage_ranks(tasks)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, exp.select(cols).collect()))


def test_state_of_deltas_equals_the_whole(spark):
    """Three deltas of new rows, then a batch that changed after it was counted."""
    from functools import reduce
    from lakehand.plans import monitor as M
    tasks = _tasks(spark)
    whole = M.source_state(tasks)
    rows = lambda df: sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)
    deltas = [M.source_state(tasks.where(F.col("ID") % 4 == k)) for k in range(4)]
    assert rows(reduce(M.merge_states, deltas)) == rows(whole)
    assert rows(M.levels(reduce(M.merge_states, deltas), "2024-02-01 00:00:00")) == rows(M.levels(whole, "2024-02-01 00:00:00"))
    batch = tasks.first()["BatchID"]
    later = tasks.where(F.col("BatchID") == batch).withColumn("EndedDTS", F.lit(None).cast("timestamp_ntz"))
    kept = M.without_batches(whole, later)
    assert rows(M.merge_states(kept, M.source_state(later))) == rows(M.source_state(tasks.where(F.col("BatchID") != batch).unionByName(later)))


def test_log_facts_need_no_sorted_aggregate(spark):
    import contextlib
    import io
    from tests.conftest import SF_SMALL
    from lakehand.plans import fixtures as X
    from lakehand.plans import monitor as M
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        M.task_log_facts(X.log_table(X.Tables(spark, SF_SMALL))).explain("formatted")
    assert "SortAggregate" not in buf.getvalue() and "HashAggregate" in buf.getvalue()


def test_hot_keys_are_measured_and_salted_alone(spark):
    from lakehand.operators.joins import hot_keys, hot_salted_join
    fact = spark.range(8000).select(F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                                    F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.lit("a")).alias("o"), "id")
    dim = spark.range(9000).select(F.col("id").alias("k"), F.lit("a").alias("o"), (F.col("id") * 2).alias("v"))
    assert [r.k for r in hot_keys(fact, ["k"]).collect()] == [7]
    for how in ("inner", "left"):
        for on in (["k"], ["k", "o"]):
            got = hot_salted_join(fact, dim.select(*on, "v"), on, how)
            exp = fact.join(dim.select(*on, "v"), on, how)
            assert got.columns == exp.columns
            assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, exp.collect()), key=repr)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 6))),
                min_size=1, max_size=40)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS, st.integers(1, 6), st.booleans())
def test_rank_within_random(spark, rows, parts, dense):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], "id int, g string, v int")
    method = "dense_rank" if dense else "row_number"
    order = [F.col("v").asc_nulls_first()] + ([] if dense else [F.col("id")])
    fn = F.dense_rank() if dense else F.row_number()
    exp = {(r.id, r.r) for r in df.withColumn("r", fn.over(Window.partitionBy("g").orderBy(*order))).collect()}
    got = {(r.id, r.r) for r in rank_within(df, "g", order, "r", method=method, num_partitions=parts).collect()}
    assert got == exp
