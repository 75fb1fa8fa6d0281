"""Inputs derived from the driver's tables by fixed rules (FIXTURES.md section 3).

Each rule is written once here with DataFrame expressions and once as SQL in
:mod:`lakehand.plans.oracle`; both must give identical rows.  All of them grow
with the driver's tables (customer, part, events, lineitem).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehand.functions.scalar import ts_lit

TS1, TS2, TS3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"
SYSTEMS = ["click", "error", "purchase", "signup", "view"]


class Tables:
    """Lazy parquet views of one scale-factor folder (column pruning and filters push down)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def _k():
    return F.col("c_custkey")


def customer_v1(t: Tables) -> DataFrame:
    k = _k()
    seg = F.when(k % 11 == 0, F.lit(None)).when(k % 13 == 0, F.lit("")).otherwise(F.col("c_mktsegment"))
    return t.customer.where(k % 20 != 19).select("c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                                 seg.alias("c_mktsegment"))


def _v2_columns(moved: bool):
    k = _k()
    seg = F.when(k % 22 == 0, F.lit("NEW")).when((k % 11 == 0) | (k % 23 == 0), F.lit(None)) \
           .when(k % 13 == 0, F.lit("")).otherwise(F.col("c_mktsegment"))
    if moved:
        seg = F.when(k % 10 == 5, F.lit("MOVED")).otherwise(seg)
    bal = F.when(k % 10 == 0, F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal"))
    return ["c_custkey", "c_name", "c_nationkey", bal.alias("c_acctbal"), seg.alias("c_mktsegment")]


def customer_v2(t: Tables) -> DataFrame:
    return t.customer.where(_k() % 17 != 0).select(*_v2_columns(False))


def customer_v3(t: Tables) -> DataFrame:
    return t.customer.where(_k() % 17 != 0).select(*_v2_columns(True))


def customer_entity(v: DataFrame) -> DataFrame:
    """Entity source rows: business key text + attributes."""
    return v.select(F.col("c_custkey").cast("string").alias("Customer_BK"),
                    "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def source_id(p):
    """SourceID of a part key: five systems take turns; a system's ids fill one prefix of 999 after another."""
    i = F.floor(p / 5)
    return ((20 + p % 5 + 5 * F.floor(i / 999)) * 1000 + i % 999 + 1).cast("bigint")


def source_key(sid):
    """The part key of a SourceID."""
    prefix = F.floor(sid / 1000) - 20
    return ((F.floor(prefix / 5) * 999 + sid % 1000 - 1) * 5 + prefix % 5).cast("bigint")


def sourced_events(t: Tables) -> DataFrame:
    """Events with ``p``, the part key of the source their task loads (spread over all part keys, of the
    event type's system), and ``p_next``, the next source of that system."""
    keys = t.part.agg(F.count(F.lit(1))).scalar()
    kind = F.array_position(F.array(*map(F.lit, SYSTEMS)), F.col("event_type")) - 1
    events = t.events.withColumn("n_keys", keys)
    at = F.col("user_id") * 13 % F.col("n_keys")
    return events.withColumn("p", (at - at % 5 + kind) % F.col("n_keys")).withColumn("p_next", (F.col("p") + 5) % F.col("n_keys"))


def _plus_seconds(ts, n):
    return F.timestamp_add("SECOND", n, ts)


def extract_status(t: Tables) -> DataFrame:
    """ExtractLoadStatus rows, one per event."""
    e = F.col("event_id")
    raw_end = F.when(e % 29 == 0, ts_lit(None)).otherwise(_plus_seconds(F.col("ts"), e % 90))
    trusted_start = _plus_seconds(raw_end, F.lit(5))
    trusted_end = F.when(e % 31 == 0, ts_lit(None)).otherwise(_plus_seconds(trusted_start, e % 60))
    p = F.col("p")
    return sourced_events(t).select(
        e.alias("ID"),
        F.date_format("ts", "yyyyMMdd").alias("BatchID"),
        F.col("event_type").alias("SystemCode"),
        source_id(p).alias("SourceID"),
        F.lit(None).cast("string").alias("LowWatermark"),
        F.when(e % 7 == 0, F.lit(None)).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("HighWatermark"),
        (e % 1000).alias("SourceRowCount"),
        (e % 1000 - F.when(e % 3 == 0, 1).otherwise(0)).alias("SinkRowCount"),
        F.concat(F.lit("/raw/"), F.col("event_type"), F.lit("/dbo_T"), p.cast("string"),
                 F.lit("/"), e.cast("string"), F.lit(".parquet")).alias("RawPath"),
        F.when(e % 23 == 0, F.lit("Fail")).otherwise(F.lit("Success")).alias("RawStatus"),
        F.col("ts").alias("RawStartDTS"),
        raw_end.alias("RawEndDTS"),
        F.when(e % 37 == 0, F.lit("Fail")).otherwise(F.lit("Success")).alias("TrustedStatus"),
        trusted_start.alias("TrustedStartDTS"),
        trusted_end.alias("TrustedEndDTS"),
        F.col("ts").alias("CreatedDTS"),
        _plus_seconds(F.col("ts"), F.lit(3600)).alias("EndedDTS"),
    )


def _system_code(n):
    return (F.when(n % 5 == 0, "click").when(n % 5 == 1, "error").when(n % 5 == 2, "purchase")
            .when(n % 5 == 3, "signup").otherwise("view"))


def extract_manifest(t: Tables) -> DataFrame:
    """ExtractLoadManifest rows, one per part key."""
    p = F.col("p_partkey")
    name = F.concat(F.lit("T"), p.cast("string"))
    sysc = _system_code(p)
    none = F.lit(None).cast("string")
    file = p % 13 == 0
    return t.part.select(
        source_id(p).alias("SourceID"),
        sysc.alias("SystemCode"),
        F.lit("dbo").alias("SourceSchema"),
        name.alias("SourceTableName"),
        F.when(p % 4 == 0, none).otherwise(F.concat(F.lit("SELECT * FROM [dbo].["), name, F.lit("]")))
         .alias("SourceQuery"),
        F.when(file, F.concat(F.lit("/in/"), sysc)).alias("SourceFolderPath"),
        F.when(file, F.concat(name, F.lit(".csv"))).alias("SourceFileName"),
        F.concat(F.lit("kv-"), sysc).alias("SourceKeyVaultSecret"),
        none.alias("SourceMetaData"),
        F.when(file, "csv-load").otherwise("sql-load").alias("SourceHandler"),
        F.when(p % 3 == 0, "Full").otherwise("Delta").alias("LoadType"),
        F.when(p % 8 < 5, F.concat(name, F.lit("_ID"))).alias("BusinessKeyColumn"),
        F.when(p % 3 == 0, F.lit(None)).otherwise(F.lit("ModifiedDTS")).alias("WatermarkColumn"),
        F.lit("raw-load").alias("RawHandler"),
        F.concat(F.lit("/raw/"), sysc, F.lit("/dbo_"), name, F.lit("/$guid$.parquet")).alias("RawPath"),
        F.lit("trusted-load").alias("TrustedHandler"),
        F.concat(F.lit("/trusted/"), sysc, F.lit("/dbo_"), name, F.lit("/")).alias("TrustedPath"),
        F.lit("dbo").alias("DestinationSchema"),
        name.alias("DestinationTableName"),
        F.when(p % 17 == 0, F.lit("kv-lake")).alias("DestinationKeyVaultSecret"),
        none.alias("ExtendedProperties"),
        (p % 7 != 6).alias("Enabled"),
        ts_lit(TS1).alias("CreatedDTS"),
    )


def log_table(t: Tables) -> DataFrame:
    """Log rows, three per event: copy output, stage status, curated run output."""
    e, ty = F.col("event_id"), F.col("event_type")
    es = e.cast("string")
    crlf = F.when(e % 5 == 0, F.lit("\r\n")).otherwise(F.lit(""))
    copy_msg = F.concat(
        F.lit('{"PipelineRunId":"run-'), es, F.lit('",'), crlf, F.lit('"Status":"Succeeded","Output":{"dataRead":'),
        (e * 7919).cast("string"), F.lit(',"dataWritten":'), (e * 3571).cast("string"),
        F.lit(',"rowsRead":'), (e % 1000).cast("string"), F.lit(',"rowsCopied":'), (e % 1000).cast("string"),
        F.lit(',"copyDuration":'), (e % 90).cast("string"), F.lit(',"throughput":'), (e % 500).cast("string"),
        F.lit("."), F.lpad((e % 100).cast("string"), 2, "0"),
        F.when(e % 46 == 0, F.concat(F.lit(',"errors":[{"Message":"copy failed '), es, F.lit('"}]')))
         .otherwise(F.lit("")),
        F.lit("}}"))
    status_msg = (
        F.when(e % 23 == 0, F.concat(F.lit('{"PipelineRunId":"run-'), es,
                                     F.lit('","Status":"Failed","Error":{"message":"boom '), es, F.lit('"}}')))
         .when(e % 19 == 0, F.concat(F.lit('{"PipelineRunId":"run-'), es,
                                     F.lit('","Status":"Failed","Error":"plain '), es, F.lit('"}')))
         .otherwise(F.concat(F.lit('{"PipelineRunId":"run-'), es, F.lit('","Status":"Succeeded","dataRead":'),
                             (e * 11).cast("string"), F.lit(',"rowsRead":'), (e % 700).cast("string"), F.lit("}"))))
    run_msg = F.concat(
        F.lit('{"PipelineRunId":"run-'), es, F.lit('","Status":"Succeeded","Output":{"runOutput":{"Counts":{"SpotCount":'),
        (e % 1000).cast("string"), F.lit(',"InsertCount":-1,"UpdateCount":-1,"CuratedCount":'), (e % 5000).cast("string"),
        F.lit('},"CuratedTransform":{"EntityType":"Dimension","Name":"'), ty, F.lit('","Destination":"curated.D_'), ty,
        F.lit('","Tables":["trusted.dbo_T'), F.col("p").cast("string"), F.lit('","trusted.dbo_T'),
        F.col("p_next").cast("string"), F.lit('"]}}}}'))
    null_id = F.lit(None).cast("bigint")
    ev = sourced_events(t)

    def part(i, ext, tr, activity, msg):
        return ev.select((e * 3 + i).alias("ID"), ext.alias("ExtractLoadStatusID"), tr.alias("TransformStatusID"),
                         F.lit(activity).alias("ActivityType"), msg.alias("Message"),
                         _plus_seconds(F.col("ts"), F.lit(i + 1)).alias("CreatedDTS"))

    # UNION ALL (not explode): a filter on the id columns prunes whole branches
    return (part(0, e, null_id, "copy-data", copy_msg)
            .unionByName(part(1, e, null_id, "raw-status", status_msg))
            .unionByName(part(2, null_id, e, "curated-transform", run_msg)))


def transform_manifest(t: Tables) -> DataFrame:
    """One transform per event type; ids by dense rank of the (few) distinct types."""
    from lakehand.operators.windows import dense_rank_global
    types = dense_rank_global(t.events.select("event_type").distinct(), "event_type", "TransformID")
    tid = F.col("TransformID")
    return types.select(
        tid.alias("TransformID"),
        F.lit("Dimension").alias("EntityType"),
        F.concat(F.lit("d_"), F.col("event_type")).alias("EntityName"),
        F.lit("notebook").alias("ProcessorType"),
        F.lit("kv-curated").alias("TargetKeyVaultSecret"),
        F.concat(F.lit("Transform/Dimension/"), F.col("event_type")).alias("Command"),
        F.lit(None).cast("string").alias("Dependancies"),
        (tid % 3 + 1).alias("ParallelGroup"),
        (F.col("event_type") != "error").alias("Enabled"),
        ts_lit(TS1).alias("CreatedDTS"),
    )


def report_refresh(t: Tables) -> DataFrame:
    """Two refreshes per report (one per event type); the later one names the live table."""
    types = t.events.select("event_type").distinct()
    return types.select(F.explode(F.array(
        F.struct(F.concat(F.lit("R_"), F.col("event_type")).alias("ReportName"),
                 F.concat(F.lit("curated.old_"), F.col("event_type")).alias("SourceTable"),
                 F.lit("Success").alias("Status"), ts_lit(TS1).alias("CreatedDTS")),
        F.struct(F.concat(F.lit("R_"), F.col("event_type")).alias("ReportName"),
                 F.concat(F.lit("curated.d_"), F.col("event_type")).alias("SourceTable"),
                 F.lit("Success").alias("Status"), ts_lit(TS2).alias("CreatedDTS")),
    )).alias("r")).select("r.*")


def column_metadata(t: Tables) -> DataFrame:
    """Source column metadata rows: each part row is one column of table T<p_partkey div 20>."""
    p, size = F.col("p_partkey"), F.col("p_size")
    tab = F.floor(p / 20).cast("bigint")
    dtype = (F.when(size % 6 == 0, "nvarchar").when(size % 6 == 1, "int").when(size % 6 == 2, "decimal")
             .when(size % 6 == 3, "datetime2").when(size % 6 == 4, "varbinary").otherwise("bigint"))
    return t.part.select(
        F.when(tab % 8 == 0, "D365FO").when(tab % 8 == 1, "EDW1").when(tab % 8 == 2, "EDW2").when(tab % 8 == 3, "CRM")
         .otherwise(_system_code(tab)).alias("SystemCode"),
        F.lit("dbo").alias("TABLE_SCHEMA"),
        F.concat(F.lit("T"), tab.cast("string")).alias("TABLE_NAME"),
        F.when(p % 9 == 0, F.concat(F.col("p_name"), F.lit(",("), p.cast("string"), F.lit(")")))
         .otherwise(F.concat(F.col("p_name"), F.lit(" "), p.cast("string"))).alias("COLUMN_NAME"),
        (p % 20 + 1).alias("ORDINAL_POSITION"),
        F.when(p % 3 == 0, "NO").otherwise("YES").alias("IS_NULLABLE"),
        dtype.alias("DATA_TYPE"),
        F.when((size % 6 == 0) | (size % 6 == 4), F.when(size > 40, -1).otherwise(size * 10))
         .alias("CHARACTER_MAXIMUM_LENGTH"),
        F.when(size % 6 == 2, 18).alias("NUMERIC_PRECISION"),
        F.when(size % 6 == 2, size % 5).alias("NUMERIC_SCALE"),
        F.when(tab % 3 == 0, F.concat(F.lit('{"SynapseTableSchema":"syn","SynapseTableName":"S'), tab.cast("string"),
                                      F.lit('"}'))).alias("ExtendedProperties"),
    )


def ingestion_sheet(t: Tables) -> DataFrame:
    """Sources to register, one row per part key: keys divisible by 7 name known sources, and a key of
    1 modulo 12 repeats the source of the row before it."""
    p = F.col("p_partkey")
    known = p % 7 == 0
    k = p - F.when((p % 12 == 1) & ~known, 1).otherwise(0)
    sysc = (F.when(known, _system_code(p))
            .when(k % 10 == 0, F.concat(F.lit("NEWSYS"), (k % 3).cast("string")))
            .otherwise(_system_code(k)))
    return t.part.select(
        p.alias("SheetRow"),
        sysc.alias("SystemCode"),
        F.when(known, F.lit("dbo")).when(k % 11 == 0, F.lit("sales data")).otherwise(F.lit("dbo")).alias("TableSchema"),
        F.when(known, F.concat(F.lit("T"), p.cast("string"))).otherwise(F.concat(F.lit("N"), k.cast("string")))
         .alias("TableName"),
        F.lit(None).cast("string").alias("SourceQuery"),
        F.when(p % 2 == 0, F.lit("ModifiedDTS")).alias("WatermarkColumn"),
        F.when(p % 13 == 0, F.lit("csv-load")).alias("SourceHandler"),
        F.when(p % 13 == 0, F.lit("csv")).when(p % 17 == 0, F.lit("")).alias("RawFileExtension"),
        F.when(p % 19 == 0, F.concat(F.lit("kv-"), p.cast("string"))).alias("KeyVaultSecret"),
        F.lit(None).cast("string").alias("ExtendedProperties"),
    )


def event_config(t: Tables) -> DataFrame:
    """Key/value config rows from events: group = event type, key = Key<user_id % 4>."""
    return t.events.select(
        F.col("event_type").alias("KeyGroup"),
        F.concat(F.lit("Key"), (F.col("user_id") % 4).cast("string")).alias("Key"),
        F.lpad(F.get_json_object("props", "$.k"), 3, "0").alias("Value"))


def status_events(t: Tables) -> DataFrame:
    """Status-update events (ID, Property, Value, Seq) derived from the status rows."""
    s = extract_status(t)
    return s.select("ID", F.explode(F.array(
        F.struct(F.lit("RawStatus").alias("Property"), F.lit("In Progress").alias("Value"), F.lit(1).alias("Seq")),
        F.struct(F.lit("RawStatus").alias("Property"), F.col("RawStatus").alias("Value"), F.lit(2).alias("Seq")),
        F.struct(F.lit("TrustedStatus").alias("Property"), F.lit("In Progress").alias("Value"), F.lit(3).alias("Seq")),
        F.struct(F.lit("TrustedStatus").alias("Property"), F.col("TrustedStatus").alias("Value"), F.lit(4).alias("Seq")),
        F.struct(F.lit("SinkRowCount").alias("Property"), F.col("SinkRowCount").cast("string").alias("Value"),
                 F.lit(5).alias("Seq")),
    )).alias("e")).select("ID", "e.*")
