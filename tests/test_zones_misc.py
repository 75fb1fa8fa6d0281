"""Zone jobs and the remaining readers/writers/control helpers."""

import os

from pyspark.sql import functions as F

from lakehand.plans.control import apply_status_update
from lakehand.plans.zones import incremental_ingest, raw_load, trusted_load
from lakehand.sinks.keyed import KeyedTable
from lakehand.sources.files import read_json_pages, read_sheet
from lakehand.sources.metadata import capture_schema, explode_metadata, metadata_json


def test_zone_flow_overwrite_then_keyed(spark, tmp):
    os.makedirs(f"{tmp}/raw/crm/dbo_acct")
    with open(f"{tmp}/raw/crm/dbo_acct/a.csv", "w") as f:
        f.write("acct id,acct name\n1,x\n2,y\n")
    task = {"DestinationSchema": "dbo", "DestinationTableName": "acct", "RawPath": "/raw/crm/dbo_acct/$guid$.csv",
            "ExtendedProperties": '{"TrustedQuery": "SELECT acct_id, upper(acct_name) AS acct_name FROM {tableFqn}"}'}
    raw = raw_load(spark, task, f"{tmp}/raw/crm/dbo_acct/a.csv")
    t = KeyedTable(spark, f"{tmp}/trusted/acct", "acct_id")
    trusted_load(spark, task, raw, t)
    assert sorted(r.acct_name for r in t.read().collect()) == ["X", "Y"]
    with open(f"{tmp}/raw/crm/dbo_acct/a.csv", "w") as f:
        f.write("acct id,acct name\n2,z\n3,w\n")
    raw = raw_load(spark, task, f"{tmp}/raw/crm/dbo_acct/a.csv")
    trusted_load(spark, {**task, "BusinessKeyColumn": "acct_id"}, raw, t)
    assert sorted((r.acct_id, r.acct_name) for r in t.read().collect()) == [(1, "X"), (2, "Z"), (3, "W")]


def test_incremental_ingest(spark):
    spark.range(10).select(F.col("id").alias("w")).createOrReplaceTempView("src_w")
    rows, low, high = incremental_ingest(spark, {"SourceQuery": "SELECT * FROM src_w", "WatermarkColumn": "w",
                                                 "LowWatermark": 6})
    assert rows.count() == 3 and high == 9


def test_pages_sheet_capture(spark, tmp):
    os.makedirs(f"{tmp}/pages")
    for i in range(2):
        with open(f"{tmp}/pages/p{i}.json", "w") as f:
            f.write('{"Response": [{"id": %d}, {"id": %d}], "next": null}' % (2 * i, 2 * i + 1))
    items = read_json_pages(spark, f"{tmp}/pages")
    assert sorted(r.id for r in items.collect()) == [0, 1, 2, 3] and "_page" in items.columns
    with open(f"{tmp}/sheet.csv", "w") as f:
        f.write("SystemCode,TableName\n" + "".join(f"S,T{i}\n" for i in range(1200)))
    assert read_sheet(spark, f"{tmp}/sheet.csv", 0).count() == 1200
    assert read_sheet(spark, f"{tmp}/sheet.csv", 5, order_by="TableName").count() == 5
    df = spark.createDataFrame([], "id int, name string, amt decimal(10,2)")
    cols = capture_schema(spark, df, "dbo", "T").withColumn("SystemCode", F.lit("S")) \
        .withColumn("ExtendedProperties", F.lit(None).cast("string"))
    back = explode_metadata(metadata_json(cols))
    assert [r.COLUMN_NAME for r in back.orderBy("ORDINAL_POSITION").collect()] == ["id", "name", "amt"]
    assert back.where("COLUMN_NAME = 'amt'").first().NUMERIC_SCALE == 2


def test_overwrite_and_upsert(spark, tmp):
    t = KeyedTable(spark, f"{tmp}/t", "k")
    t.upsert(spark.createDataFrame([(1, "a")], "k int, v string"), "k")
    t.upsert(spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"), "k")
    assert sorted(map(tuple, t.read().collect())) == [(1, "b"), (2, "c")]
    t.overwrite(spark.createDataFrame([(9, "z")], "k int, v string"))
    assert sorted(map(tuple, t.read().collect())) == [(9, "z")]


def test_status_update_and_staged_publish(spark, tmp):
    s = spark.createDataFrame([(1, "Success"), (2, None)], "ID int, RawStatus string")
    out = apply_status_update(s, 2, "RawStatus", "Fail")
    assert sorted(map(tuple, out.collect())) == [(1, "Success"), (2, "Fail")]
    from lakehand.sinks.jdbc import publish_staged
    url = f"jdbc:derby:memory:pub{abs(hash(tmp)) % 10**6};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    publish_staged(spark.range(5).select(F.col("id").cast("int").alias("ID")), f"{tmp}/stage", url, "P1",
                   properties=props)
    from lakehand.sources.jdbc import read_jdbc
    assert read_jdbc(spark, url, table="P1", properties=props).count() == 5


def test_history_snapshot_folder(spark, tmp):
    from lakehand.operators.history import load_snapshot_folder
    os.makedirs(f"{tmp}/hist/20240107")
    with open(f"{tmp}/hist/20240107/dbo_x.csv", "w") as f:
        f.write("a,b\n1,\n")
    with open(f"{tmp}/hist/20240107/dbo_unknown.csv", "w") as f:
        f.write("a\n1\n")
    open(f"{tmp}/hist/20240107/dbo_empty.csv", "w").close()
    ref = {"dbo_x": spark.createDataFrame([], "a int, b string"), "dbo_empty": spark.createDataFrame([], "a int")}
    got = load_snapshot_folder(spark, f"{tmp}/hist", "20240107", ref)
    assert list(got) == ["dbo_x"]
    assert got["dbo_x"].first().asDict() == {"a": 1, "b": "", "as_at": "20240107"}


def test_snapshot_periods_and_typed_pages(spark, tmp):
    from lakehand.operators.history import snapshot_periods
    df = spark.createDataFrame([(1, 2020), (2, 2021)], "id int, y int")
    one = snapshot_periods(df, F.col("y"))
    two = snapshot_periods(df, F.array(F.col("y"), F.col("y") + 1))
    assert one.count() == 2 and sorted(r.as_at for r in two.collect()) == [2020, 2021, 2021, 2022]
    os.makedirs(f"{tmp}/tp")
    with open(f"{tmp}/tp/p.json", "w") as f:
        f.write('{"data": [{"id": 1, "name": "a"}]}')
    rows = read_json_pages(spark, f"{tmp}/tp", prop="data", element_schema="id bigint, name string")
    assert [(r.id, r.name) for r in rows.collect()] == [(1, "a")]


def test_list_separator_is_plain_text(spark):
    from lakehand.functions.scalar import list_to_rows
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([("a.b|c",)], "s string").select(list_to_rows(F.col("s"), "|").alias("x")).collect()
    assert [r.x for r in rows] == ["a.b", "c"]
