"""SCD2 scenario from the reference's manual test notebook, plus invariants."""

from pyspark.sql import functions as F

from lakehand.operators import scd as S
from lakehand.operators.keys import check_unique_keys, duplicate_keys, surrogate_key_hash

BK, SK = "Test_BK", "Test_SK"
STEPS = [[(1, "V1"), (2, "V1")], [(1, "V1")], [(1, "V2")], [(2, "V2")], [(2, "V3")], [(3, "V1")]]
EXPECTED = [
    {(1, "V1", 1), (2, "V1", 1)},
    {(1, "V1", 1), (2, "V1", 1)},
    {(1, "V1", 0), (1, "V2", 1), (2, "V1", 1)},
    {(1, "V1", 0), (1, "V2", 1), (2, "V1", 0), (2, "V2", 1)},
    {(1, "V1", 0), (1, "V2", 1), (2, "V1", 0), (2, "V2", 0), (2, "V3", 1)},
    {(1, "V1", 0), (1, "V2", 1), (2, "V1", 0), (2, "V2", 0), (2, "V3", 1), (3, "V1", 1)},
]


def _src(spark, rows):
    return spark.createDataFrame([(str(k), v) for k, v in rows], f"{BK} string, TestingName string")


def _starts(n):
    return [f"2024-01-0{i + 1} 00:00:00" for i in range(n)]


def _run(spark, batch_key=False):
    t, out = None, []
    for rows, start in zip(STEPS, _starts(len(STEPS))):
        src = _src(spark, rows)
        t = (S.scd2_first_load(src, BK, SK, start, with_batch_key=batch_key) if t is None
             else S.scd2_apply(t, src, BK, SK, start))
        t = t.cache()
        out.append(t)
    return out


def test_reference_scenario(spark):
    for got, exp in zip(_run(spark), EXPECTED):
        assert {(int(r[BK]), r.TestingName, r._Current) for r in got.collect()} == exp


def test_closed_rows_end_one_second_before_batch(spark):
    final = _run(spark)[-1]
    closed = {(r[BK], r.TestingName): r._Ended for r in final.where("_Current = 0").collect()}
    assert str(closed[("1", "V1")]) == "2024-01-02 23:59:59"
    assert str(closed[("2", "V2")]) == "2024-01-04 23:59:59"


def test_invariants(spark):
    final = _run(spark)[-1]
    # at most one current row per key
    assert final.where("_Current = 1").groupBy(BK).count().where("count > 1").count() == 0
    # versions of a key do not overlap
    rows = sorted((r[BK], r._Created, r._Ended) for r in final.collect())
    for (k1, c1, e1), (k2, c2, e2) in zip(rows, rows[1:]):
        if k1 == k2:
            assert e1 is not None and e1 < c2
    # replaying the same batch is a no-op
    again = S.scd2_apply(final, _src(spark, STEPS[-1]), BK, SK, "2024-01-09 00:00:00")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, final.collect()))


def test_batch_key_open_and_closed(spark):
    t = S.scd2_first_load(_src(spark, STEPS[0]), BK, SK, "2024-01-01 00:00:00", with_batch_key=True)
    t = S.scd2_apply(t, _src(spark, [(1, "V2")]), BK, SK, "2024-01-02 00:00:00")
    got = {(r[BK], r.TestingName): str(r._Batch_SK) for r in t.collect()}
    assert got[("1", "V1")] == "2401010000002401012359590"
    assert got[("1", "V2")] == "2401020000000000000000001"
    assert got[("2", "V1")] == "2401010000000000000000001"


def test_null_changes_and_strict_mode(spark):
    t = S.scd2_first_load(spark.createDataFrame([("1", None), ("2", "a")], f"{BK} string, v string"), BK, SK,
                          "2024-01-01 00:00:00")
    src = spark.createDataFrame([("1", "x"), ("2", None)], f"{BK} string, v string")
    safe = S.scd2_apply(t, src, BK, SK, "2024-01-02 00:00:00")
    strict = S.scd2_apply(t, src, BK, SK, "2024-01-02 00:00:00", null_safe=False)
    assert safe.count() == 4 and strict.count() == 2


def test_null_key_rows_are_inserted_not_joined(spark):
    t = S.scd2_first_load(spark.createDataFrame([("1", "a")], f"{BK} string, v string"), BK, SK, "2024-01-01 00:00:00")
    src = spark.createDataFrame([(None, "n"), ("1", "a")], f"{BK} string, v string")
    out = S.scd2_apply(t, src, BK, SK, "2024-01-02 00:00:00")
    assert out.count() == 2 and out.where(F.col(BK).isNull()).count() == 1


def test_closed_only_key_not_reopened(spark):
    rows = [("1", "SK1", "a", "2024-01-01", "2024-01-01 12:00:00", 0)]
    t = spark.createDataFrame(rows, f"{BK} string, {SK} string, v string, _c string, _e string, _Current int") \
        .select(SK, BK, "v", F.col("_c").cast("timestamp_ntz").alias("_Created"),
                F.col("_e").cast("timestamp_ntz").alias("_Ended"), "_Current")
    src = spark.createDataFrame([("1", "b")], f"{BK} string, v string")
    assert S.scd2_apply(t, src, BK, SK, "2024-01-02 00:00:00").count() == 1
    assert S.scd2_apply(t, src, BK, SK, "2024-01-02 00:00:00", reopen=True).count() == 2


def test_duplicate_guard(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c")], f"{BK} string, v string")
    assert duplicate_keys(df, BK).count() == 1
    try:
        check_unique_keys(df, BK)
        raise AssertionError("expected a duplicate-key error")
    except ValueError:
        pass


def test_xxhash_key_uses_second_value(spark):
    df = spark.createDataFrame([("7",)], f"{BK} string")
    a = df.select(surrogate_key_hash(F.col(BK), "2024-01-01 00:00:00").alias("k")).first().k
    b = df.select(F.xxhash64(F.concat(F.lit("240101000000-"), F.col(BK))).alias("k")).first().k
    c = df.select(F.xxhash64(F.concat(F.lit("240101000000-"), F.col(BK)), F.lit(512)).alias("k")).first().k
    assert a == c and a != b


def test_scd1_upsert_and_update(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(map(tuple, S.scd1_upsert(t, s, "k").collect())) == [(1, "a"), (2, "B"), (3, "C")]
    seeded = S.seed_if_absent(t, s, "k")
    assert sorted((r.k, r._Action) for r in seeded.collect()) == [(1, None), (2, None), (3, "INSERT")]


def test_schema_drift_and_evolve(spark):
    t = S.scd2_first_load(spark.createDataFrame([("1", "a")], f"{BK} string, v string"), BK, SK, "2024-01-01 00:00:00")
    src = spark.createDataFrame([("1", "a", 5), ("2", "b", 6)], f"{BK} string, v string, w int")
    assert S.schema_drift(t, src, BK, SK) == {"added": ["w"], "missing": [], "type_changed": []}
    plain = S.scd2_apply(t, src, BK, SK, "2024-01-02 00:00:00")               # new column ignored
    assert "w" not in plain.columns and plain.count() == 2
    evolved = S.scd2_apply(t, src, BK, SK, "2024-01-02 00:00:00", evolve=True)
    assert evolved.columns[:4] == [SK, BK, "v", "w"]
    got = {(r[BK], r.w, r._Current) for r in evolved.collect()}
    assert got == {("1", 5, 1), ("1", None, 0), ("2", 6, 1)}


def test_scd2_delta_frames(spark):
    t = _run(spark)[2]                          # 1:V1 closed, 1:V2 and 2:V1 current
    cur, closed = S.scd2_delta(t, _src(spark, [(1, "V3"), (2, "V1")]), BK, SK, "2024-01-09 00:00:00")
    assert {(r[BK], r.TestingName) for r in cur.collect()} == {("1", "V3"), ("2", "V1")}
    assert {(r[BK], r.TestingName) for r in closed.collect()} == {("1", "V2")}
