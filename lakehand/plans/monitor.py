"""Run monitoring from control tables and JSON logs.

``as_of`` replaces the reference's "now" so results are reproducible; durations
are whole seconds (bigint) instead of TIME values that wrap at 24 h (N11).

One plan at every size.  Task counts become a *state*: one row per (batch, system,
source) with sums, counts, least and greatest times (:func:`source_state`).  States merge
by adding up, so new status rows are rolled up alone and merged into the stored state
(:func:`merge_states`).  System and batch figures are sums over a batch's state rows, a
row per source however many tasks, and one join brings all levels back to the tasks.
Stage ranks number the distinct times hour by hour (:func:`rank_in_buckets`), so a batch or
system that holds a third of all tasks is in no task as a whole.  Log facts are numbers
first (greatest and least ids per task, a hash aggregate), then two lookups by log id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakehand.constants import COPY_ACTIVITY, STATUS_FAIL_ALIASES, STATUS_IN_PROGRESS, STATUS_SUCCESS
from lakehand.functions.scalar import (duration_seconds, fixed2, json_value, quarter_label, scaled_units,
                                       strip_crlf, ts_lit)
from lakehand.operators.joins import lookup
from lakehand.operators.windows import latest_per_key, rank_in_buckets

MB = 1048576
RUN_OUTPUT_SCHEMA = ("struct<Output: struct<runOutput: struct<CuratedTransform: "
                     "struct<Destination: string, Tables: array<string>>>>>")
_COUNTERS = "dataRead string, dataWritten string, rowsRead string, rowsCopied string, copyDuration string, " \
            "throughput string"
# Fields the views read from a log message.  String-typed fields keep the JSON text
# of whatever value is there (objects included), like a path lookup would.
LOG_MESSAGE_SCHEMA = (f"PipelineRunId string, Status string, Error string, {_COUNTERS}, "
                      f"Output struct<{_COUNTERS.replace(' string', ': string')}, "
                      "errors: array<struct<Message: string>>>")


def _scalar(c: Column) -> Column:
    """JSON_VALUE on an already extracted field: objects and arrays give NULL.
    ``c`` is a cheap field access of a parsed struct, so repeating it is free."""
    return F.when(~(c.startswith("{") | c.startswith("[")), c)


def parse_message(msg: Column) -> Column:
    """One JSON parse per log row (instead of one per path)."""
    return F.from_json(msg, LOG_MESSAGE_SCHEMA)


def _error(p: Column, with_plain: bool = True) -> Column:
    """First of errors[0].Message, Error.message (and Error itself when a scalar)."""
    parts = [_scalar(F.get(p["Output"]["errors"], 0)["Message"]),
             json_value(p["Error"], "$.message")]
    if with_plain:
        parts.append(_scalar(p["Error"]))
    return F.coalesce(*parts)


def log_parsed(log: DataFrame, size_path: str = "$", divisor: int = MB) -> DataFrame:
    """V1: parsed log rows (run id, status, sizes in MB, rows, duration, throughput, error).

    ``size_path`` is where the copy counters live: top level in this view (N19).
    ``divisor=1026`` reproduces the reference's ``1024 ^ 2`` (N9).
    """
    m = strip_crlf("Message")
    top = size_path.rstrip(".") in ("$", "")

    def counter(k):
        return _scalar(F.col("__p")[k] if top else F.col("__p")["Output"][k])

    base = log.select("ID", "ExtractLoadStatusID", "ActivityType", m.alias("Message"), "CreatedDTS")
    base = base.withColumn("__p", parse_message(F.col("Message")))
    return base.select(
        "ID", "ExtractLoadStatusID", "ActivityType", "Message", "CreatedDTS",
        _scalar(F.col("__p")["PipelineRunId"]).alias("JsonPipelineRunId"),
        _scalar(F.col("__p")["Status"]).alias("Status"),
        scaled_units(counter("dataRead").try_cast("decimal(16,2)"), divisor).alias("DataRead"),
        scaled_units(counter("dataWritten").try_cast("decimal(16,2)"), divisor).alias("DataWritten"),
        counter("rowsRead").try_cast("int").cast("string").alias("RowsRead"),
        counter("rowsCopied").try_cast("int").cast("string").alias("RowsCopied"),
        counter("copyDuration").try_cast("int").cast("string").alias("CopyDuration"),
        fixed2(counter("throughput")).alias("Throughput"),
        _error(F.col("__p"), with_plain=False).alias("Error"),
    )


def task_log_facts(log: DataFrame, divisor: int = MB) -> DataFrame:
    """W2 + W3 + W4 on the log: per extract task its last log (run id, status, error), its log count and
    the sizes from its first copy log.

    The ids are a hash aggregate over numbers; a task with a third of all logs is one partial
    row per input partition.  The two logs are then found by their id, which no two share.
    """
    lg = log.where(F.col("ExtractLoadStatusID").isNotNull())
    is_copy = F.col("ActivityType").isin(COPY_ACTIVITY)
    ids = lg.groupBy("ExtractLoadStatusID").agg(F.count(F.lit(1)).alias("Logs"), F.max("ID").alias("LastLogID"),
                                                F.min(F.when(is_copy, F.col("ID"))).alias("FirstCopyLogID"))
    msg = lg.select("ID", "ActivityType", parse_message(strip_crlf("Message")).alias("__p"))
    p = F.col("__p")
    last = msg.select(F.col("ID").alias("LastLogID"), _scalar(p["PipelineRunId"]).alias("JsonPipelineRunId"),
                      _scalar(p["Status"]).alias("Status"), _error(p).alias("Error"))
    size = lambda k: scaled_units(_scalar(p["Output"][k]).try_cast("decimal(16,2)"), divisor)
    copy = msg.where(is_copy).select(F.col("ID").alias("FirstCopyLogID"), size("dataRead").alias("DataRead"),
                                     size("dataWritten").alias("DataWritten"))
    return ids.join(last, "LastLogID", "left").join(copy, "FirstCopyLogID", "left").select(
        "ExtractLoadStatusID", "Logs", "LastLogID", "FirstCopyLogID", "JsonPipelineRunId", "Status", "Error", "DataRead", "DataWritten")


def task_status(status: DataFrame, manifest: DataFrame, as_of) -> DataFrame:
    """_RawTask + _TaskLogic: stage status, durations and the task flags (F16)."""
    now = ts_lit(as_of)
    m = manifest.select("SourceID", "SourceSchema", "SourceTableName")
    s = lookup(status, m, "SourceID")
    raw_ip = F.col("RawStartDTS").isNotNull() & F.col("RawEndDTS").isNull()
    tr_ip = F.col("TrustedStartDTS").isNotNull() & F.col("TrustedEndDTS").isNull()
    fail = list(STATUS_FAIL_ALIASES)          # 'Fail' and 'Failed' both count (N17)
    t = s.select(
        "ID", "BatchID", "SystemCode", "SourceID", "SourceSchema", "SourceTableName", "SourceRowCount",
        "SinkRowCount",
        F.when(raw_ip, F.lit(STATUS_IN_PROGRESS)).otherwise(F.col("RawStatus")).alias("RawStatus"),
        "RawStartDTS", "RawEndDTS", duration_seconds("RawStartDTS", "RawEndDTS", now).alias("RawDuration"),
        F.when(tr_ip, F.lit(STATUS_IN_PROGRESS)).otherwise(F.col("TrustedStatus")).alias("TrustedStatus"),
        "TrustedStartDTS", "TrustedEndDTS",
        duration_seconds("TrustedStartDTS", "TrustedEndDTS", now).alias("TrustedDuration"),
        "CreatedDTS", "EndedDTS",
        raw_ip.cast("int").alias("RawStage"), tr_ip.cast("int").alias("TrustedStage"))
    stage_end = F.when(F.col("TrustedStatus").isNotNull(), F.col("TrustedEndDTS")).otherwise(F.col("RawEndDTS"))
    current = (F.when(F.col("RawStatus") == STATUS_IN_PROGRESS, F.lit("Raw"))
               .when(F.col("TrustedStatus") == STATUS_IN_PROGRESS, F.lit("Trusted")))
    t = t.withColumn("TotalDuration", duration_seconds(F.col("RawStartDTS"), stage_end, now)) \
         .withColumn("CurrentStage", current)
    return t.withColumns({
        "Pending": (F.col("CurrentStage").isNull() & (F.col("TrustedStatus").isNull() | F.col("RawStatus").isNull()))
        .cast("int"),
        "InProgress": F.col("CurrentStage").isNotNull().cast("int"),
        "Success": F.coalesce((F.col("TrustedStatus") == STATUS_SUCCESS) & (F.col("RawStatus") == STATUS_SUCCESS),
                              F.lit(False)).cast("int"),
        "Fail": F.coalesce(F.col("TrustedStatus").isin(*fail) | F.col("RawStatus").isin(*fail), F.lit(False))
        .cast("int"),
    })


STAGE_RANKS = {"RawStartRank": "RawStartDTS", "RawEndRank": "RawEndDTS",
               "TrustedStartRank": "TrustedStartDTS", "TrustedEndRank": "TrustedEndDTS"}


def stage_ranks(tasks: DataFrame) -> DataFrame:
    """DENSE_RANK of each stage start/end within (BatchID, SystemCode), NULLs first.

    The four times of a task are four rows of (batch, system, which, time); their distinct
    values are ranked once, and the ranks come back to the task by its ID.
    """
    g = ["BatchID", "SystemCode"]
    stacked = tasks.select("ID", *g, F.explode(F.array(*[
        F.struct(F.lit(k).alias("which"), F.col(c).alias("time")) for k, c in enumerate(STAGE_RANKS.values())])).alias("x")).select(
        "ID", *g, "x.which", "x.time")
    r = rank_in_buckets(stacked.drop("ID").distinct(), [*g, "which"], "time", F.date_trunc("HOUR", "time"), "rank")
    names = {c: f"__{c}" for c in (*g, "which", "time")}
    r = r.select(*[F.col(c).alias(n) for c, n in names.items()], "rank")
    on = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    ranks = stacked.join(r, on).groupBy("ID").agg(*[F.max(F.when(F.col("which") == k, F.col("rank"))).alias(n)
                                                    for k, n in enumerate(STAGE_RANKS)])
    return tasks.join(ranks, "ID")


STATE_KEYS = ["BatchID", "SystemCode", "SourceID"]
_FLAGS = ["Pending", "InProgress", "Success", "Fail"]
_SUMS = [*[f"{c}Tasks" for c in _FLAGS], "FinishedTasks", "TotalTasks", "Rows"]


def source_state(tasks: DataFrame) -> DataFrame:
    """V2: the mergeable state of tasks, a row per (batch, system, source): sums of the flags, finished and
    counted tasks, rows, first start and last end."""
    return tasks.groupBy(*STATE_KEYS).agg(
        *[F.sum(c).alias(f"{c}Tasks") for c in _FLAGS], F.sum(F.col("Success") + F.col("Fail")).alias("FinishedTasks"),
        F.count("ID").alias("TotalTasks"), F.count(F.lit(1)).alias("Rows"), F.min("CreatedDTS").alias("StartDTS"),
        F.max("EndedDTS").alias("EndDTS"))


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of the tasks of all ``states`` together; a new batch of status rows is rolled up alone
    and merged in, no earlier row is read again."""
    return reduce(DataFrame.unionByName, states).groupBy(*STATE_KEYS).agg(
        *[F.sum(c).alias(c) for c in _SUMS], F.min("StartDTS").alias("StartDTS"), F.max("EndDTS").alias("EndDTS"))


def without_batches(state: DataFrame, batches: DataFrame) -> DataFrame:
    """A state without some batches: tasks that changed after they were counted are rolled up again with
    all tasks of their batch (least and greatest times cannot be taken back)."""
    return state.join(batches.select("BatchID").distinct(), "BatchID", "left_anti")


def levels(state: DataFrame, as_of) -> DataFrame:
    """V2/V3: system and batch figures from a state, on a row per (batch, system, source).

    A batch's rows here are its sources, so its window is as large as the manifest at most.
    """
    now = ts_lit(as_of)
    out = state
    for level, keys in (("System", ["BatchID", "SystemCode"]), ("Batch", ["BatchID"])):
        w = Window.partitionBy(*keys)
        names = {c: f"{level}{c}" for c in _SUMS if c != "Rows"}
        out = out.withColumns({n: F.sum(c).over(w) for c, n in names.items()}
                              | {f"{level}StartDTS": F.min("StartDTS").over(w), f"{level}EndDTS": F.max("EndDTS").over(w)})
    # a system's completed count is its success count once for every task of the source
    out = out.withColumn("SystemCompletedTasks", F.coalesce("SystemSuccessTasks", "SystemFailTasks") * F.col("Rows"))
    out = out.withColumnRenamed("BatchFinishedTasks", "BatchCompletedTasks")
    for level in ("System", "Batch"):
        done = (F.col(f"{level}CompletedTasks") == F.col(f"{level}TotalTasks")) & F.col(f"{level}EndDTS").isNotNull()
        out = out.withColumns({
            f"{level}Duration": duration_seconds(f"{level}StartDTS", f"{level}EndDTS", now),
            f"{level}Status": F.when(done, F.lit("Completed")).otherwise(F.lit(STATUS_IN_PROGRESS))})
    ends = state.groupBy("BatchID").agg(F.max("EndDTS").alias("__e")).select("__e").distinct()
    ranked = rank_in_buckets(ends, [], "__e", F.date_trunc("MONTH", "__e"), "BatchRank", desc=True)
    out = out.join(ranked, F.col("BatchEndDTS").eqNullSafe(F.col("__e"))).drop("__e")
    # DENSE_RANK over (batch, system) ordered by SystemEndDTS is constant in that partition
    return out.withColumn("BatchSystemRank", F.lit(1)).drop(*_SUMS, "StartDTS", "EndDTS")


SYSTEM_COLUMNS = [f"System{c}" for c in ("PendingTasks", "InProgressTasks", "SuccessTasks", "FailTasks", "TotalTasks", "StartDTS", "EndDTS",
                                         "FinishedTasks", "CompletedTasks", "Duration", "Status")]
BATCH_COLUMNS = [f"Batch{c}" for c in ("PendingTasks", "InProgressTasks", "SuccessTasks", "FailTasks", "CompletedTasks", "TotalTasks",
                                       "StartDTS", "EndDTS", "Duration", "Status", "SystemRank", "Rank")]


def with_levels(tasks: DataFrame, figures: DataFrame, columns: list[str]) -> DataFrame:
    """Tasks with the figures of their system and batch: one join."""
    names = [f"__{k}" for k in STATE_KEYS]
    right = figures.select(*[F.col(k).alias(n) for k, n in zip(STATE_KEYS, names)], *columns)
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(STATE_KEYS, names)])
    out = tasks.join(right, on).drop(*names)
    # DENSE_RANK over the batch ordered by TrustedEndRank: every system's ranks are dense from 1, so the
    # batch's distinct values are 1..max and the rank is the value
    if "TrustedEndRank" in tasks.columns and "BatchRank" in columns:
        out = out.withColumn("BatchTaskRank", F.col("TrustedEndRank"))
    return out


def system_rollup(tasks: DataFrame, as_of) -> DataFrame:
    """W4-W6 at system level (BatchID, SystemCode), with the reference's completed count."""
    return with_levels(tasks, levels(source_state(tasks), as_of), SYSTEM_COLUMNS)


def batch_rollup(tasks: DataFrame, as_of) -> DataFrame:
    """W4-W6 at batch level, batch status, and the batch-level ranks."""
    return with_levels(tasks, levels(source_state(tasks), as_of), BATCH_COLUMNS)


def latest_batches(tasks_with_batch: DataFrame) -> DataFrame:
    """One row per batch with its global rank and the latest flag."""
    return (tasks_with_batch.select("BatchID", "BatchEndDTS", "BatchRank").distinct()
            .withColumn("LatestBatch", (F.col("BatchRank") == 1).cast("int")))


def batch_status_log(status: DataFrame, manifest: DataFrame, log: DataFrame, as_of,
                     divisor: int = MB, state: DataFrame | None = None) -> DataFrame:
    """V2: task stage/status/durations -> system roll-up -> batch roll-up -> ranks,
    with the last log, the first copy log's sizes and the latest-batch flag.

    With a stored ``state`` of all tasks (:func:`merge_states`) the roll-ups come from it, and
    ``status`` may be the rows of the batches to show alone.
    """
    t = task_status(status, manifest, as_of)
    figures = levels(source_state(t) if state is None else state, as_of)
    t = with_levels(stage_ranks(t), figures, SYSTEM_COLUMNS + BATCH_COLUMNS)
    facts = task_log_facts(log, divisor).select(
        F.col("ExtractLoadStatusID").alias("__lid"), "Logs", "DataRead", "DataWritten", "Error")
    out = t.join(facts, t["ID"] == facts["__lid"], "left").drop("__lid")
    return out.withColumn("LatestBatch", (F.col("BatchRank") == 1).cast("int"))


def report_lineage(refresh: DataFrame) -> DataFrame:
    """Latest refresh per report (RANK = 1, ties kept): (ReportName, SourceTable)."""
    return latest_per_key(refresh, "ReportName", "CreatedDTS", desc=True).select("ReportName", "SourceTable")


def object_lineage(log: DataFrame, refresh: DataFrame, transform_manifest: DataFrame,
                   extract_manifest: DataFrame) -> DataFrame:
    """V4: report -> curated table -> trusted source, from curated run-output JSON.

    Name matches are case-insensitive like the reference's collation (N7).  Log
    rows are reduced to distinct (destination, source table) pairs before any join.
    """
    # one JSON parse per log row for both fields
    parsed = (log.where(F.col("TransformStatusID").isNotNull())
              .select(F.from_json(strip_crlf("Message"), RUN_OUTPUT_SCHEMA).alias("__r")))
    run = F.col("__r")["Output"]["runOutput"]["CuratedTransform"]
    dest = run["Destination"]
    pairs = (parsed
             .select(F.when(~(dest.startswith("{") | dest.startswith("[")), dest).alias("__dest"),
                     F.explode(run["Tables"]).alias("SourceTable"))
             .distinct())
    reports = report_lineage(refresh)
    c = (pairs.join(reports.select("ReportName", F.col("SourceTable").alias("CuratedDestination")),
                    F.lower(pairs["__dest"]) == F.lower(F.col("CuratedDestination")))
         .select("ReportName", "CuratedDestination", "SourceTable").distinct())
    tm = transform_manifest.select("TransformID",
                                   F.concat(F.lit("curated."), F.lower("EntityName")).alias("CuratedTable"))
    tl = extract_manifest.select("SystemCode", "SourceID", F.concat(
        F.lit("trusted."), F.col("DestinationSchema"), F.lit("_"), F.col("DestinationTableName")).alias("TrustedTable"))
    j = c.join(tm, F.lower(tm["CuratedTable"]) == F.lower(c["CuratedDestination"]))
    j = j.join(tl, F.lower(tl["TrustedTable"]) == F.lower(j["SourceTable"]))
    return j.select("ReportName", "TransformID", "CuratedTable", "SourceID", "TrustedTable")


def health_dashboard(batch_log: DataFrame, lineage: DataFrame, transform_manifest: DataFrame,
                     extract_manifest: DataFrame, as_of) -> DataFrame:
    """V3: batch log x lineage (one row per report), success rate, quarter, age.

    ``SuccessRate`` keeps the reference's (success - 1) / total (N18);
    ``SuccessRatio`` is the plain ratio.
    """
    l = lineage.select(F.col("SourceID").alias("__sid"), "TransformID", "CuratedTable", "ReportName")
    j = batch_log.join(l, batch_log["SourceID"] == l["__sid"]).drop("__sid")
    j = j.join(transform_manifest.select("TransformID"), "TransformID", "left_semi")
    j = j.join(extract_manifest.select(F.col("SourceID").alias("__e")), F.col("SourceID") == F.col("__e"),
               "left_semi")
    rate = (F.col("BatchSuccessTasks") - 1).cast("decimal(18,3)") / F.col("BatchTotalTasks").cast("decimal(18,3)")
    ratio = F.col("BatchSuccessTasks").cast("decimal(18,3)") / F.col("BatchTotalTasks").cast("decimal(18,3)")
    return j.withColumns({
        "LastRun": F.col("BatchEndDTS"),
        "NextRefresh": duration_seconds(F.col("BatchEndDTS"), ts_lit(as_of)),
        "SuccessRate": rate.cast("decimal(20,10)"),
        "SuccessRatio": ratio.cast("decimal(20,10)"),
        "Period": quarter_label("RawStartDTS"),
        "Latest": F.col("LatestBatch"),
    })
