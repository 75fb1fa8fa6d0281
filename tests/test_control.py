"""Source registration, batch start and manifest refresh on small tables."""

from lakehand.operators.shape import limit_or_all, period_filter
from lakehand.plans import control as C
from lakehand.plans import fixtures as X
from lakehand.plans.metadata import refresh_manifest
from lakehand.plans.zones import raw_load, trusted_load
from lakehand.sinks.keyed import KeyedTable
from pyspark.sql import functions as F
from tests.conftest import SF_SMALL

MANIFEST = "SourceID long, SystemCode string, SourceSchema string, SourceTableName string"
SHEET = ("SystemCode string, TableSchema string, TableName string, SourceQuery string, WatermarkColumn string, SourceHandler string, "
         "RawFileExtension string, KeyVaultSecret string, ExtendedProperties string")


def sheet(spark, names):
    return spark.createDataFrame([(s, "dbo", t, *[None] * 6) for s, t in names], SHEET)


def test_ids_are_unique_over_old_and_new(spark):
    old = [(20001 + i, "A", "dbo", f"T{i}") for i in range(990)] + [(21001 + i, "B", "dbo", f"T{i}") for i in range(5)]
    old += [(25998, "A", "dbo", "late"), (30999, "C", "dbo", "full")]
    new = [("A", f"N{i}") for i in range(3000)] + [("B", f"N{i}") for i in range(40)] + [("C", f"N{i}") for i in range(1200)]
    new += [("D", "only"), ("A", "T1"), ("B", "N7"), ("D", "only")]            # known, and named twice
    got = C.register_sources(spark.createDataFrame(old, MANIFEST), sheet(spark, new), created_at=X.TS2).collect()
    ids = [r.SourceID for r in got]
    assert len(got) == 3000 + 40 + 1200 + 1 and len(set(ids)) == len(ids) and not set(ids) & {r[0] for r in old}
    system = {}
    for r in got:       # no prefix holds two systems, and no id leaves its prefix's range
        assert system.setdefault(r.SourceID // 1000, r.SystemCode) == r.SystemCode and 1 <= r.SourceID % 1000 <= 999
    of = lambda s: sorted(r.SourceID for r in got if r.SystemCode == s)
    assert of("A")[:10] == [*range(20991, 21000), 25999] and of("B")[0] == 21006
    assert of("A")[10] == 31001 and of("C")[0] == 35001 - 1000 and of("D") == [36001]      # fresh prefixes, by system
    assert {"LoadType", "BusinessKeyColumn"} <= set(got[0].asDict())


def test_first_source_of_an_empty_manifest(spark):
    got = C.register_sources(spark.createDataFrame([], MANIFEST), sheet(spark, [("Z", "a"), ("Z", "b"), ("Y", "c")])).collect()
    assert sorted((r.SystemCode, r.SourceID) for r in got) == [("Y", 20001), ("Z", 21001), ("Z", 21002)]


def test_a_task_of_the_batch_drives_its_upsert(spark, tmp):
    """M1's row carries the business key to the trusted load, twice."""
    t = X.Tables(spark, SF_SMALL)
    status, manifest = X.extract_status(t), X.extract_manifest(t)
    rows = C.new_status_rows(status, manifest, "20240201", created_at=X.TS2)
    assert rows.columns == ["ID", "BatchID", "SystemCode", "SourceID", "LowWatermark", *C.STATUS_OPEN, "CreatedDTS"]
    assert set(rows.columns) == set(status.columns)
    tasks = C.task_list(rows, manifest)
    assert tasks.columns == ["BatchID", "ID", "LowWatermark", *C.TASK_COLUMNS] and tasks.count() == rows.count()
    task = tasks.where("BusinessKeyColumn is not null").orderBy("SourceID").first().asDict()
    key = task["BusinessKeyColumn"]
    table = KeyedTable(spark, f"{tmp}/trusted", key, buckets=4)
    for values in ([(1, "a"), (2, "b")], [(2, "c"), (3, "d")]):
        spark.createDataFrame(values, f"{key} int, v string").write.mode("overwrite").parquet(f"{tmp}/raw")
        trusted_load(spark, task, raw_load(spark, task, f"{tmp}/raw", fmt="parquet"), table)
    assert sorted(map(tuple, table.read().select(key, "v").collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_generated_selects_stay_in_their_system(spark):
    manifest = spark.createDataFrame([("A", "dbo", "T", "old"), ("B", "dbo", "T", "old"), ("C", "dbo", "T", "old")],
                                     "SystemCode string, SourceSchema string, SourceTableName string, SourceQuery string")
    generated = spark.createDataFrame([("A", "dbo", "T", "select a"), ("B", "dbo", "T", "select b"), ("B", "dbo", "T", "select b2")],
                                      "SystemCode string, TableSchema string, TableName string, SelectSQL string")
    got = {r.SystemCode: r.SourceQuery for r in refresh_manifest(manifest, generated).collect()}
    assert got == {"A": "select a", "B": "select b", "C": "old"}


def test_limits_and_years(spark):
    df = spark.range(10)
    assert limit_or_all(df, 0).count() == 10 and [r.id for r in limit_or_all(df, 3, "id").collect()] == [0, 1, 2]
    keys = spark.createDataFrame([("19961231",), ("19970101",), ("19971231",), ("19980101",), (None,)], "k string")
    both = keys.select("k", F.col("k").cast("int").alias("n"), F.to_date("k", "yyyyMMdd").alias("d"))
    for column in ("k", "n", "d"):
        assert [r.k for r in period_filter(both, column, 1997).collect()] == ["19970101", "19971231"]


def test_the_whole_sheet_comes_in_order(spark, tmp):
    """More rows than any preview, keys repeated and null; a limit of 0 keeps the order too."""
    from lakehand.plans.catalog import QUERIES
    keys = [*range(1200, 0, -1), 7, 7, None]
    spark.createDataFrame([(k,) for k in keys], "p_partkey long").write.parquet(f"{tmp}/part.parquet")
    rows = QUERIES["limit_or_all"](spark, tmp).collect()
    assert sorted(r.SheetRow or 0 for r in rows) == sorted(k or 0 for k in keys)
    order = [((r.SystemCode or ""), (r.TableSchema or ""), (r.TableName or ""), r.SheetRow or 0) for r in rows]
    assert order == sorted(order)
    assert [r.id for r in limit_or_all(spark.range(5, 0, -1), 0, "id").collect()] == [1, 2, 3, 4, 5]


def test_lineage_is_no_cross_product(spark):
    """Each report's tables are of the sources its event type loads."""
    from lakehand.plans.catalog import QUERIES
    rows = QUERIES["object_lineage"](spark, SF_SMALL).collect()
    t = X.Tables(spark, SF_SMALL)
    system = {r.SourceID: r.SystemCode for r in X.extract_manifest(t).collect()}
    assert rows and all(system[r.SourceID] == r.ReportName.removeprefix("R_") for r in rows)
    assert len(rows) < len({r.SourceID for r in rows}) * len({r.ReportName for r in rows}) / 2
