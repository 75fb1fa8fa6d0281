"""Sources and sinks: formats, borrowed schema, missing files, binaries, snapshot table, JDBC."""

import os

import pytest
from pyspark.sql import functions as F

from lakehand.sinks.keyed import KeyedTable
from lakehand.sinks.tables import insert_into, land_parquet, read_merged, write_table
from lakehand.sources.files import (binary_inventory, detect_format, read_csv_borrowed_schema, read_optional,
                                    read_source, register_raw)


def test_detect_format():
    assert detect_format("/raw/a/b.csv") == "csv"
    assert detect_format("/raw/csv_table/x.parquet") == "parquet"
    assert detect_format("/raw/csv_table/x.parquet", parity=True) == "csv"
    with pytest.raises(ValueError):
        detect_format("/raw/a/b.xlsx")


def test_csv_json_xml_parquet(spark, tmp):
    with open(f"{tmp}/a.csv", "w") as f:
        f.write('id,name\n1,"multi\nline"\n2,"q \\"x\\""\n')
    df = read_source(spark, f"{tmp}/a.csv")
    assert df.count() == 2 and dict(df.dtypes)["id"] == "int"
    os.makedirs(f"{tmp}/j")
    with open(f"{tmp}/j/p.json", "w") as f:
        f.write('{"Response": [{"id": 1}, {"id": 2}]}')
    assert read_source(spark, f"{tmp}/j/p.json").count() == 1
    with open(f"{tmp}/x.xml", "w") as f:
        f.write("<rows><row><id>1</id></row><row><id>2</id></row></rows>")
    assert read_source(spark, f"{tmp}/x.xml", row_tag="row").count() == 2
    land_parquet(df, f"{tmp}/p")
    assert read_source(spark, f"{tmp}/p", fmt="parquet").count() == 2


def test_register_raw_folder(spark, tmp):
    os.makedirs(f"{tmp}/raw/sys/dbo_t")
    for i in range(2):
        with open(f"{tmp}/raw/sys/dbo_t/f{i}.csv", "w") as f:
            f.write(f"id\n{i}\n")
    task = {"DestinationSchema": "dbo", "DestinationTableName": "t", "RawPath": "/raw/sys/dbo_t/x.csv"}
    df, rows = register_raw(spark, task, f"{tmp}/raw/sys/dbo_t/f0.csv")
    assert rows == df.count() == 2 and spark.table("raw_dbo_t").count() == 2
    assert spark.catalog.getTable("raw_dbo_t").tableType == "EXTERNAL"
    with open(f"{tmp}/raw/sys/dbo_t/f1.csv", "w") as f:
        f.write('id,note\n1,"two\nlines"\n')
    os.remove(f"{tmp}/raw/sys/dbo_t/f0.csv")
    df, rows = register_raw(spark, task, f"{tmp}/raw/sys/dbo_t/f0.csv", database="raw_zone")
    assert rows == 1 and spark.table("raw_zone.dbo_t").first()["note"] == "two\nlines"


def test_borrowed_schema_fill_and_optional(spark, tmp):
    with open(f"{tmp}/h.csv", "w") as f:
        f.write("a,b\nx,\n,2\n")
    ref = spark.createDataFrame([], "a string, b int")
    df = read_csv_borrowed_schema(spark, f"{tmp}/h.csv", ref)
    assert sorted(map(tuple, df.collect()), key=str) == sorted([("x", None), ("", 2)], key=str)
    empty, status = read_optional(spark, f"{tmp}/missing.csv", ref.schema, fmt="csv")
    assert status == "Skipped" and empty.count() == 0


def test_binary_inventory_and_pages(spark, tmp):
    os.makedirs(f"{tmp}/bin/sub")
    for p in ("a.bin", "sub/b.bin"):
        with open(f"{tmp}/bin/{p}", "wb") as f:
            f.write(b"\x00\x01")
    inv = binary_inventory(spark, f"{tmp}/bin")
    assert inv.count() == 2 and "content" not in inv.columns


def files(root):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_keyed_table_scd2_roundtrip(spark, tmp):
    t = KeyedTable(spark, f"{tmp}/dim", "K_BK", buckets=4, name="d_test")
    s1 = spark.createDataFrame([("1", "a"), ("2", "b")], "K_BK string, v string")
    s2 = spark.createDataFrame([("1", "A"), ("3", "c")], "K_BK string, v string")
    assert t.save_scd2(s1, sk="K_SK", start="2024-01-01 00:00:00")
    assert t.last_metrics == {"InsertCount": 2, "UpdateCount": 0, "WrittenCount": 2}
    assert t.save_scd2(s2, sk="K_SK", start="2024-01-02 00:00:00")
    assert t.last_metrics["InsertCount"] == 2 and t.last_metrics["UpdateCount"] == 1
    rows = {(r.K_BK, r.v, r._Current) for r in t.read().collect()}
    assert rows == {("1", "a", 0), ("1", "A", 1), ("2", "b", 1), ("3", "c", 1)}
    assert {r.v for r in t.read(as_of="2024-01-01 12:00:00").collect()} == {"a", "b"}
    assert spark.table("d_test").count() == 4
    dup = spark.createDataFrame([("9", "a"), ("9", "b")], "K_BK string, v string")
    with pytest.raises(ValueError):
        t.save_scd2(dup, sk="K_SK", start="2024-01-03 00:00:00")
    assert t.read().count() == 4


def test_a_batch_rewrites_only_its_buckets(spark, tmp):
    t = KeyedTable(spark, f"{tmp}/dim", "K_BK", buckets=32)
    rows = lambda ids, v: spark.createDataFrame([(i, v) for i in ids], "K_BK int, v string")
    t.save_scd2(rows(range(500), "a"), sk="K_SK", start="2024-01-01 00:00:00")
    before = files(f"{tmp}/dim")
    t.save_scd2(rows([3, 4, 900, 3000, 7], "b"), sk="K_SK", start="2024-01-02 00:00:00")    # one per cent
    after = files(f"{tmp}/dim")
    touched = {f.split("_of32=")[1].split("/")[0] for f in set(after) - set(before)}
    assert len(touched) <= 5
    stayed = {f for f in before if f.split("_of32=")[1].split("/")[0] not in touched}
    assert len(stayed) >= 27 and all(after[f] == before[f] for f in stayed)
    assert t.read().where("_Current = 1").count() == 502 and t.read().where("_Current = 0").count() == 3
    closed = {f for f in after if "_part=closed" in f}
    t.save_scd2(rows([3, 4], "c"), sk="K_SK", start="2024-01-03 00:00:00")
    assert all(files(f"{tmp}/dim").get(f) == after[f] for f in closed)      # history is never rewritten


def test_a_save_that_is_repeated_changes_nothing(spark, tmp):
    t = KeyedTable(spark, f"{tmp}/dim", ["a", "b"], buckets=4)
    src = lambda rows: spark.createDataFrame(rows, "a int, b string, v string")
    first = [(1, "x", "p"), (1, "y", "p"), (None, "z", "p"), (11, "", "p")]
    second = [(1, "x", "q"), (2, "x", "p"), (None, "z", "p"), (None, None, None)]
    t.save_scd2(src(first), sk="SK", start="2024-01-01 00:00:00", with_batch_key=True)
    t.save_scd2(src(second), sk="SK", start="2024-01-02 00:00:00")
    once = sorted(map(tuple, t.read().collect()), key=repr)
    t.save_scd2(src(second), sk="SK", start="2024-01-02 00:00:00")
    assert sorted(map(tuple, t.read().collect()), key=repr) == once
    # options of the first load hold; the key's columns are no attributes; rows without a key stay
    assert "_Batch_SK" in t.read().columns and len({r.SK for r in t.read().where("a is not null").collect()}) == 5
    assert t.read().where("a is null").count() == 3
    assert t.save_scd2(src(second), sk="SK", start="2024-01-03 00:00:00", batch_id="s:7")
    assert not t.save_scd2(src([(5, "n", "n")]), sk="SK", start="2024-01-04 00:00:00", batch_id="s:7")
    assert t.read().where("a = 5").isEmpty()


def test_keyed_table_evolves_and_upserts(spark, tmp):
    t = KeyedTable(spark, f"{tmp}/dim", "k", buckets=2)
    t.save_scd2(spark.createDataFrame([(i, "a") for i in range(9)], "k int, v string"), sk="SK", start="2024-01-01 00:00:00")
    t.save_scd2(spark.createDataFrame([(1, "a", 5)], "k int, v string, w int"), sk="SK", start="2024-01-02 00:00:00", evolve=True)
    assert {(r.k, r.w) for r in t.read().where("_Current = 1 and k < 3").collect()} == {(0, None), (1, 5), (2, None)}
    u = KeyedTable(spark, f"{tmp}/up", "k", buckets=8)
    u.upsert(spark.createDataFrame([(i, "a") for i in range(40)], "k long, v string"))
    before = files(f"{tmp}/up")
    u.upsert(spark.createDataFrame([(3, "b"), (77, "n")], "k int, v string"))
    assert u.read().count() == 41 and u.read().where("k = 3").first()["v"] == "b"
    assert len(set(files(f"{tmp}/up")) & set(before)) >= 6


def test_registered_table_shows_merged_columns(spark, tmp):
    write_table(spark.createDataFrame([(1, "x", "p1")], "id int, a string, p string"), f"{tmp}/reg", name="reg_t", partition_by=["p"])
    write_table(spark.createDataFrame([(2, 5, "p2")], "id int, b int, p string"), f"{tmp}/reg", name="reg_t", mode="append", partition_by=["p"])
    got = {(r["id"], r["a"], r["b"], r["p"]) for r in spark.table("reg_t").collect()}
    assert got == {(1, "x", None, "p1"), (2, None, 5, "p2")}
    with pytest.raises(ValueError):
        write_table(spark.createDataFrame([("no", "p3")], "id string, p string"), f"{tmp}/reg", name="reg_t", mode="append")
    write_table(spark.createDataFrame([(9,)], "z int"), f"{tmp}/reg", name="reg_t")
    assert spark.table("reg_t").columns == ["z"] and spark.table("reg_t").count() == 1


def test_files_are_read_in_splits_unless_records_span_lines(spark, tmp):
    os.makedirs(f"{tmp}/c")
    line = 'k%d,"a, \\"quoted\\" ""text"" of some length so that the file grows",%d\n'
    with open(f"{tmp}/c/big.csv", "w") as f:
        f.write("id,text,n\n")
        f.writelines(line % (i, i) for i in range(60_000))
    with open(f"{tmp}/c/big.json", "w") as f:
        f.writelines('{"id": %d, "text": "%s"}\n' % (i, "x" * 40) for i in range(60_000))
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        for name in ("big.csv", "big.json"):
            df = read_source(spark, f"{tmp}/c/{name}")
            assert df.count() == 60_000 and df.rdd.getNumPartitions() > 2
        with open(f"{tmp}/c/big.csv", "a") as f:
            f.write('last,"one\nand two",1\n')
        df = read_source(spark, f"{tmp}/c/big.csv")
        assert df.count() == 60_001 and df.where("id = 'last'").first()["text"] == "one\nand two" and df.rdd.getNumPartitions() == 1
        for text in ('[{"id": 1},\n {"id": 2}]', '{"id": 1,\n "t": 2}\n{"id": 3}'):
            with open(f"{tmp}/c/odd.json", "w") as f:
                f.write(text)
            assert read_source(spark, f"{tmp}/c/odd.json").where("id = 1").count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)


def test_append_merge_and_insert_into(spark, tmp):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 5)], "id int, b int")
    write_table(a, f"{tmp}/m", mode="overwrite")
    write_table(b, f"{tmp}/m", mode="append")
    assert set(read_merged(spark, f"{tmp}/m").columns) == {"id", "a", "b"}
    spark.sql("DROP TABLE IF EXISTS ins_t")
    spark.sql(f"CREATE TABLE ins_t (id INT, a STRING) USING parquet LOCATION '{tmp}/ins_t'")
    insert_into(spark.createDataFrame([("y", 3)], "a string, id int"), "ins_t")
    assert spark.table("ins_t").first().id == 3
    from lakehand.sinks.tables import save_as_table
    save_as_table(spark.table("ins_t"), "ctas_t")
    save_as_table(spark.table("ins_t").union(spark.table("ins_t")), "ctas_t")
    assert spark.table("ctas_t").count() == 2


def test_jdbc_roundtrip(spark, tmp):
    from lakehand.sinks.jdbc import write_jdbc
    from lakehand.sources.jdbc import read_jdbc
    url = f"jdbc:derby:memory:lh{abs(hash(tmp)) % 10**6};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.range(100).select(F.col("id").cast("int").alias("ID"), (F.col("id") * 2).cast("int").alias("V"))
    try:
        write_jdbc(df, url, "T1", mode="overwrite", properties=props)
    except Exception as ex:  # noqa: BLE001
        pytest.skip(f"Derby driver unavailable: {ex}")
    back = read_jdbc(spark, url, table="T1", partition_column="ID", lower=0, upper=100, num_partitions=4,
                     properties=props)
    assert back.count() == 100 and back.rdd.getNumPartitions() == 4
    q = read_jdbc(spark, url, query="SELECT ID FROM T1 WHERE V > 100", properties=props)
    assert q.count() == 49


def derby(tmp):
    return f"jdbc:derby:memory:q{abs(hash(tmp)) % 10**6};create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_query_read_in_ranges_has_every_row_once(spark, tmp):
    from lakehand.sinks.jdbc import write_jdbc
    from lakehand.sources.jdbc import query_to_parquet, read_jdbc
    url, props = derby(tmp)
    day = F.timestamp_add("HOUR", F.col("id").cast("int") * 7, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    df = spark.range(500).select(F.when(F.col("id") % 50 != 7, F.col("id")).alias("K"), F.col("id").cast("int").alias("V"),
                                 day.alias("T"), (F.col("id") / 3).alias("D"), F.to_date(day).alias("E"))
    write_jdbc(df, url, "Q1", mode="overwrite", properties=props)
    for column in ("K", "V", "T", "D", "E"):
        got = read_jdbc(spark, url, query="SELECT K, V, T, D, E FROM Q1 WHERE V >= 20", partition_column=column, num_partitions=8,
                        properties=props)
        assert got.rdd.getNumPartitions() == 8
        assert sorted(r.V for r in got.collect()) == list(range(20, 500))
    none = read_jdbc(spark, url, query="SELECT K FROM Q1 WHERE V < 0", partition_column="K", num_partitions=8, properties=props)
    assert none.count() == 0
    one = read_jdbc(spark, url, query="SELECT K FROM Q1 WHERE V = 5", partition_column="K", num_partitions=8, properties=props)
    assert one.count() == 1
    query_to_parquet(spark, url, "SELECT V, T FROM Q1", f"{tmp}/landed", "V", 4, props)
    assert spark.read.parquet(f"{tmp}/landed").count() == 500


@pytest.mark.parametrize("low, high, parts", [(0, 7, 8), (0, 1000, 7), (5, 5, 4), (-3, 3, 2)])
def test_ranges_are_disjoint_and_whole(spark, low, high, parts):
    from lakehand.sources.jdbc import range_predicates
    rows = spark.createDataFrame([(i,) for i in [None, *range(low - 2, high + 3)]], "c int")
    met = sum(F.when(F.expr(p), 1).otherwise(0) for p in range_predicates("c", low, high, parts))
    assert rows.where(met != 1).isEmpty()
