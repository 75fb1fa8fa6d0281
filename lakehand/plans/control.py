"""Control-table jobs: batch and transform init, source registration, status and
log writes, system selection, task grouping (M1-M9, A7, A8, J9, J10, J12).

Control tables are append-only DataFrames here; an "update" is a new version
computed from the old one plus the change rows.  Scalar lookups (max id, config
values, group lists) are scalar subqueries, not driver round trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakehand.constants import (FIRST_SOURCE_ID, INGESTION_DEFAULTS, RAW_HANDLER, DEFAULT_RAW_EXTENSION,
                                DEFAULT_SOURCE_HANDLER, TRUSTED_HANDLER)
from lakehand.functions.scalar import fill_template, ts_lit
from lakehand.operators.incremental import base_query, is_incremental, last_watermark_per_source, range_query
from lakehand.operators.windows import rank_within

#: A task row: what M1 hands to the loads besides batch, id and low mark.
TASK_COLUMNS = ["SourceID", "SystemCode", "SourceSchema", "SourceTableName", "SourceQuery", "SourceFolderPath", "SourceFileName",
                "SourceKeyVaultSecret", "SourceHandler", "LoadType", "BusinessKeyColumn", "WatermarkColumn", "RawHandler", "RawPath",
                "TrustedHandler", "TrustedPath", "DestinationSchema", "DestinationTableName", "DestinationKeyVaultSecret",
                "ExtendedProperties"]
#: Columns of the extract and transform status tables that a new row leaves open.
STATUS_OPEN = {"HighWatermark": "string", "SourceRowCount": "bigint", "SinkRowCount": "bigint", "RawPath": "string", "RawStatus": "string",
               "RawStartDTS": "timestamp_ntz", "RawEndDTS": "timestamp_ntz", "TrustedStatus": "string",
               "TrustedStartDTS": "timestamp_ntz", "TrustedEndDTS": "timestamp_ntz", "EndedDTS": "timestamp_ntz"}
TRANSFORM_OPEN = {"SpotCount": "bigint", "InsertCount": "bigint", "UpdateCount": "bigint", "CuratedCount": "bigint", "Status": "string",
                  "StartDTS": "timestamp_ntz", "EndDTS": "timestamp_ntz"}
TRANSFORM_COLUMNS = ["TransformID", "EntityType", "EntityName", "ProcessorType", "TargetKeyVaultSecret", "Command", "Dependancies",
                     "ParallelGroup", "Enabled", "CreatedDTS"]
#: Ids of a system share a prefix; a prefix has this many, ``prefix * 1000 + 1`` first.
PREFIX_IDS = 999


def _max_or(df: DataFrame, col: str, default: int = 0) -> Column:
    return F.coalesce(df.agg(F.max(col)).scalar(), F.lit(default))


def number_rows(df: DataFrame, order, start: Column | int = 0, out: str = "ID") -> DataFrame:
    """IDENTITY-like ids: ``start`` + row number in ``order`` (no one-partition window)."""
    r = rank_within(df.withColumn("__all", F.lit(1)), "__all", order, "__rn", method="row_number").drop("__all")
    s = start if isinstance(start, Column) else F.lit(start)
    return r.withColumn(out, (s + F.col("__rn")).cast("bigint")).drop("__rn")


def _open(columns: dict) -> list[Column]:
    return [F.lit(None).cast(kind).alias(name) for name, kind in columns.items()]


def _stamp(created_at) -> Column:
    return ts_lit(created_at) if created_at else F.current_timestamp()


def new_status_rows(status: DataFrame, manifest: DataFrame, batch_id: str, systems=None, created_at=None) -> DataFrame:
    """M1, first half: the status rows a batch appends, one per enabled source; the low mark is the
    source's last high mark.  All columns of the status table, those a run fills still NULL."""
    last = last_watermark_per_source(status).withColumnRenamed("HighWatermark", "LowWatermark")
    m = manifest.where(F.col("Enabled"))
    if systems:
        m = m.where(F.col("SystemCode").isin(list(systems)))
    new = number_rows(m.select("SystemCode", "SourceID").join(last, "SourceID", "left"), ["SystemCode", "SourceID"], _max_or(status, "ID"))
    return new.select("ID", F.lit(batch_id).alias("BatchID"), "SystemCode", "SourceID", "LowWatermark", *_open(STATUS_OPEN),
                      _stamp(created_at).alias("CreatedDTS"))


def task_list(new_rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """M1, second half: the appended status rows with everything the loads need of their manifest row."""
    rows = new_rows.select("BatchID", "ID", "LowWatermark", "SourceID")
    return rows.join(manifest.where(F.col("Enabled")), "SourceID").select("BatchID", "ID", "LowWatermark", *TASK_COLUMNS)


def batch_init(status: DataFrame, manifest: DataFrame, batch_id: str, systems=None,
               created_at=None) -> DataFrame:
    """M1: the task list of a new batch (see :func:`new_status_rows` for the rows to append)."""
    return task_list(new_status_rows(status, manifest, batch_id, systems, created_at), manifest)


def source_queries(manifest: DataFrame, status: DataFrame, high) -> DataFrame:
    """F7 + F6 + S9: per source the base query and the full or ranged query text."""
    last = last_watermark_per_source(status).withColumnRenamed("HighWatermark", "LowWatermark")
    m = manifest.join(last, "SourceID", "left")
    base = base_query()
    hi = F.lit(str(high))
    return m.select("SourceID", is_incremental(F.col("WatermarkColumn")).alias("IsDelta"), base.alias("BaseQuery"),
                    "LowWatermark", hi.alias("HighWatermark"),
                    range_query(base, F.col("WatermarkColumn"), F.col("LowWatermark"), hi).alias("Query"))


def group_list_text(transform_manifest: DataFrame) -> Column:
    """Distinct parallel groups in order, comma separated (scalar subquery, J9)."""
    return transform_manifest.agg(
        F.array_join(F.sort_array(F.collect_set("ParallelGroup")).cast("array<string>"), ",")).scalar()


def new_transform_rows(transform_status: DataFrame, transform_manifest: DataFrame, batch_id: str, created_at=None) -> DataFrame:
    """M2, first half: the status rows a batch appends, one per enabled transform."""
    new = number_rows(transform_manifest.where(F.col("Enabled")).select("TransformID"), ["TransformID"], _max_or(transform_status, "ID"))
    return new.select("ID", F.lit(batch_id).alias("BatchID"), "TransformID", *_open(TRANSFORM_OPEN), _stamp(created_at).alias("CreatedDTS"))


def transform_init(transform_status: DataFrame, transform_manifest: DataFrame, batch_id: str,
                   created_at=None) -> DataFrame:
    """M2: the new status rows with their whole manifest row and the list of parallel groups."""
    new = new_transform_rows(transform_status, transform_manifest, batch_id, created_at).select("BatchID", "ID", "TransformID")
    m = transform_manifest.where(F.col("Enabled")).select(*TRANSFORM_COLUMNS)
    return new.join(m, "TransformID").select("BatchID", "ID", *TRANSFORM_COLUMNS, group_list_text(transform_manifest).alias("List"))


def group_plan(transform_manifest: DataFrame) -> DataFrame:
    """M7: transforms per parallel group, in id order (the plan the orchestrator walks)."""
    m = transform_manifest.where(F.col("Enabled"))
    return m.groupBy("ParallelGroup").agg(
        F.array_join(F.sort_array(F.collect_list("TransformID")).cast("array<string>"), ",").alias("Transforms"),
        F.count(F.lit(1)).alias("Tasks"))


def config_pivot(config: DataFrame, keys, group_col: str = "KeyGroup") -> DataFrame:
    """key/value config -> one row per key group, one column per key (MAX)."""
    return config.groupBy(group_col).pivot("Key", list(keys)).agg(F.max("Value"))


def free_ids(manifest: DataFrame) -> DataFrame:
    """Free ids per system as ranges (SystemCode, lo, n, before): what each of its prefixes has left
    behind its last id; ``before`` counts the free ids of the system's earlier prefixes.

    A prefix belongs to the system of its last id, so no two systems are dealt the same id.
    """
    prefix = F.floor(F.col("SourceID") / 1000)
    last = manifest.groupBy(prefix.alias("prefix")).agg(F.max(F.struct("SourceID", "SystemCode")).alias("last"))
    left = last.select(F.col("last.SystemCode").alias("SystemCode"), "prefix", (F.col("last.SourceID") + 1).alias("lo"),
                       (F.col("prefix") * 1000 + PREFIX_IDS - F.col("last.SourceID")).alias("n")).where("n > 0")
    so_far = F.sum("n").over(Window.partitionBy("SystemCode").orderBy("prefix"))
    return left.select("SystemCode", "lo", "n", (so_far - F.col("n")).alias("before"))


def deal_ids(new: DataFrame, manifest: DataFrame, order) -> DataFrame:
    """``new`` rows (SystemCode, ...) with a SourceID that no row of ``manifest`` and no other has.

    Rows are numbered within their system; the first take the free ids of its prefixes in
    order, the others spill into prefixes nobody has, dealt to the systems in order of
    their code.  Ranges, capacities and prefixes are rows per system, not per source.
    """
    ranked = rank_within(new, "SystemCode", order, "__rn", method="row_number")
    free = free_ids(manifest)
    need = (new.groupBy("SystemCode").agg(F.count(F.lit(1)).alias("rows"))
            .join(free.groupBy("SystemCode").agg(F.sum("n").alias("room")), "SystemCode", "left")
            .select("SystemCode", F.coalesce("room", F.lit(0)).alias("room"),
                    F.ceil(F.greatest(F.col("rows") - F.coalesce("room", F.lit(0)), F.lit(0)) / PREFIX_IDS).alias("prefixes")))
    top = F.coalesce(manifest.agg(F.max(F.floor(F.col("SourceID") / 1000))).scalar(), F.lit(FIRST_SOURCE_ID // 1000 - 1))
    first = top + 1 + F.sum("prefixes").over(Window.orderBy("SystemCode")) - F.col("prefixes")
    need = need.withColumn("fresh", first).select(F.col("SystemCode").alias("__sc"), "room", "fresh")
    rows = ranked.join(need, ranked["SystemCode"] == F.col("__sc")).drop("__sc")
    within = rows.where("__rn <= room").join(free.withColumnRenamed("SystemCode", "__sc"),
                                             (F.col("SystemCode") == F.col("__sc")) & (F.col("__rn") > F.col("before"))
                                             & (F.col("__rn") <= F.col("before") + F.col("n")))
    over = F.col("__rn") - F.col("room") - 1
    spilled = rows.where("__rn > room")
    out = lambda df, sid: df.select(*new.columns, sid.cast("bigint").alias("SourceID"))
    return out(within, F.col("lo") + F.col("__rn") - 1 - F.col("before")).unionByName(
        out(spilled, (F.col("fresh") + F.floor(over / PREFIX_IDS)) * 1000 + over % PREFIX_IDS + 1))


def register_sources(manifest: DataFrame, sheet: DataFrame, config: DataFrame | None = None,
                     created_at=None) -> DataFrame:
    """M3 for a batch of new sources.

    * a source that the sheet names twice is registered once (its least row);
    * sources already registered are left out (EXISTS guard, J10);
    * ids: see :func:`deal_ids` (20001 first when the manifest is empty);
    * paths and defaults come from the pivoted ``IngestionDefault`` config (A8).
    ``sheet`` columns: SystemCode, TableSchema, TableName, SourceQuery, WatermarkColumn,
    SourceHandler, RawFileExtension, KeyVaultSecret, ExtendedProperties.
    """
    if config is None:
        spark = manifest.sparkSession
        config = spark.createDataFrame([("IngestionDefault", k, v) for k, v in INGESTION_DEFAULTS.items()],
                                       "KeyGroup string, Key string, Value string")
    cfg = config_pivot(config.where(F.col("KeyGroup") == "IngestionDefault"), list(INGESTION_DEFAULTS))

    def c(k):
        return cfg.select(k).scalar()

    names = ["SystemCode", "TableSchema", "TableName"]
    rest = [x for x in sheet.columns if x not in names]
    once = sheet.groupBy(*names).agg(F.min(F.struct(*rest)).alias("__row")).select(*names, "__row.*")
    existing = manifest.select("SystemCode", F.col("SourceSchema").alias("TableSchema"),
                               F.col("SourceTableName").alias("TableName"))
    new = deal_ids(once.join(existing, names, "left_anti"), manifest, ["TableSchema", "TableName"])
    source_id = F.col("SourceID")
    ext = F.coalesce(F.col("RawFileExtension"), F.lit(DEFAULT_RAW_EXTENSION))
    guid = F.when(F.col("RawFileExtension") == "", F.lit("")).otherwise(F.lit("$guid$."))
    raw = fill_template(c("RawPath"), {"$SYSTEM$": F.col("SystemCode"), "$SCHEMA$": F.col("TableSchema"),
                                       "$TABLE$": F.col("TableName"), "$EXT$": ext})
    raw = F.replace(raw, F.lit("$guid$."), guid)
    trusted = fill_template(c("TrustedPath"), {"$SYSTEM$": F.col("SystemCode"), "$SCHEMA$": F.col("TableSchema"),
                                               "$TABLE$": F.col("TableName")})

    def clean(x):
        return F.replace(F.replace(F.col(x), F.lit("\\"), F.lit("")), F.lit(" "), F.lit(""))

    return new.select(
        source_id.alias("SourceID"), "SystemCode", F.col("TableSchema").alias("SourceSchema"),
        F.col("TableName").alias("SourceTableName"), "SourceQuery",
        F.coalesce(F.col("KeyVaultSecret"), c("SourceKeyVaultSecret")).alias("SourceKeyVaultSecret"),
        F.coalesce(F.col("SourceHandler"), F.lit(DEFAULT_SOURCE_HANDLER)).alias("SourceHandler"),
        F.lit(None).cast("string").alias("LoadType"), F.lit(None).cast("string").alias("BusinessKeyColumn"), "WatermarkColumn", raw.alias("RawPath"), F.lit(RAW_HANDLER).alias("RawHandler"),
        F.lit(TRUSTED_HANDLER).alias("TrustedHandler"), trusted.alias("TrustedPath"),
        clean("TableSchema").alias("DestinationSchema"), clean("TableName").alias("DestinationTableName"),
        "ExtendedProperties", (c("Enabled") == "1").alias("Enabled"),
        (ts_lit(created_at) if created_at else F.current_timestamp()).alias("CreatedDTS"))


def fold_status_events(events: DataFrame, properties, id_col: str = "ID") -> DataFrame:
    """M4 at scale: status changes are appended as (ID, Property, Value, Seq) events and
    folded to the last value per (ID, Property), one column per property."""
    return (events.groupBy(id_col).pivot("Property", list(properties))
            .agg(F.max_by("Value", "Seq")))


def apply_status_update(status: DataFrame, row_id, prop: str, value) -> DataFrame:
    """M4 single update: set one property of one row (the reference's dynamic UPDATE)."""
    dt = status.schema[prop].dataType
    return status.withColumn(prop, F.when(F.col("ID") == F.lit(row_id), F.lit(value).cast(dt)).otherwise(F.col(prop)))


def route_logs(messages: DataFrame, id_col: str = "ID", is_transform: str = "IsTransform") -> DataFrame:
    """M5: log rows keep the id in the extract or the transform id column."""
    t = F.coalesce(F.col(is_transform), F.lit(False))
    return messages.select(
        F.when(~t, F.col(id_col)).alias("ExtractLoadStatusID"),
        F.when(t, F.col(id_col)).alias("TransformStatusID"),
        "ActivityType", "Message", "CreatedDTS")


def system_selection(manifest: DataFrame, systems_text: str | None) -> DataFrame:
    """Comma list of systems, blank = all enabled; distinct (Order, SystemCode) in order."""
    m = manifest.where(F.col("Enabled"))
    if systems_text and systems_text.strip():
        sel = (m.sparkSession.range(1).select(F.explode(F.split(F.lit(systems_text), ",")).alias("s"))
               .select(F.trim("s").alias("SystemCode")).where(F.col("SystemCode") != ""))
        m = m.join(sel, "SystemCode", "left_semi")
    return (m.select(F.floor(F.col("SourceID") / 1000).cast("string").alias("Order"), "SystemCode")
            .distinct().orderBy("Order", "SystemCode"))


def end_system_stamp(status: DataFrame, batch_id: str, system: str, ended_at) -> DataFrame:
    """M8: stamp the end of a system's run on its open rows of one batch."""
    hit = (F.col("BatchID") == batch_id) & (F.col("SystemCode") == system)
    return status.withColumn("EndedDTS", F.when(hit, ts_lit(ended_at)).otherwise(F.col("EndedDTS")))
