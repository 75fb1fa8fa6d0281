"""History: dated snapshots as a partition column (H1) and period replay (H2)."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakehand.constants import SCD_BATCH, SCD_CREATED, SCD_CURRENT, SCD_ENDED
from lakehand.functions.scalar import ts_lit
from lakehand.operators.keys import _as_list, batch_key
from lakehand.operators.scd import scd2_apply, system_columns, wrap_system_columns
from lakehand.session import cut_lineage


def snapshot_periods(df: DataFrame, period, as_at_col: str = "as_at") -> DataFrame:
    """H1 as data: tag each row with its snapshot(s) as a partition column instead of
    a database per date.  ``period`` is a Column (one snapshot) or an array Column
    (a row belonging to several snapshots)."""
    from pyspark.sql import types as T
    is_array = isinstance(df.select(period).schema[0].dataType, T.ArrayType)
    return df.withColumn(as_at_col, F.explode(period) if is_array else period)


def load_snapshot_folder(spark: SparkSession, root: str, as_at: str, reference_tables: dict,
                         fill: str = "") -> dict:
    """H1: read every CSV of ``root/<as_at>/`` with the schema of the raw table of the
    same name; unknown or empty files are skipped.  Returns {table: DataFrame}."""
    from lakehand.sources.files import binary_inventory, read_csv_borrowed_schema
    files = binary_inventory(spark, f"{root}/{as_at}", glob="*.csv", recursive=False).select("path", "length")
    out = {}
    for row in files.where(F.col("length") > 0).collect():     # a folder listing, not data
        name = row["path"].rsplit("/", 1)[1][:-4]
        ref = reference_tables.get(name)
        if ref is None:
            continue
        df = read_csv_borrowed_schema(spark, row["path"], ref, fill)
        out[name] = df.withColumn("as_at", F.lit(as_at))
    return out


def replay_snapshots(snapshots: DataFrame, as_at: str, bk, sk: str, days: int = 6, target: DataFrame | None = None,
                     with_batch_key: bool = False, reopen: bool = False) -> DataFrame:
    """H2: the versions that saving one snapshot after the other would leave, in one pass.

    ``snapshots`` holds all snapshots, ``as_at`` their time; each is saved with
    start = as_at - ``days`` and end = as_at.  Per key the rows are put in time order
    once: a row equal to the version before it ends in that version's run, any other
    begins a new version, and the next one's start closes it (gaps and islands).  One
    shuffle and one sort on the key, whatever the number of snapshots; a key has one row
    per snapshot, so none is hot.  Keys are unique within a snapshot.

    A key missing from a snapshot is left alone, as by the merge.  Rows whose key is
    NULL match nothing: each stays a version of its own, outside the sort.  With a
    ``target``, its closed rows pass, its current rows come first, and a key it holds only
    closed gets no new version unless ``reopen``.  No snapshots give the target, or no rows.
    """
    keys = _as_list(bk)
    spark_ts = F.col(as_at).cast("timestamp_ntz")
    attrs = [c for c in snapshots.columns if c not in (as_at, *keys)]
    rows = snapshots.withColumn("__end", spark_ts).withColumn("__at", F.col("__end") - F.expr(f"INTERVAL {days} DAYS"))
    new = wrap_system_columns(rows.select(*keys, *attrs, "__at", "__end"), keys, sk, F.col("__at"), F.col("__end"),
                              with_batch_key=with_batch_key)
    cols = [c for c in new.columns if c not in ("__at", "__end")]
    new = new.withColumn("__seen", F.lit(0))
    known = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
    passed = new.where(~known).select(cols)
    line = new.where(known)
    if target is not None:
        cols = target.columns
        passed = passed.select(cols).unionByName(target.where((F.col(SCD_CURRENT) != 1) | ~known))
        nothing = lambda names: [F.lit(None).cast(line.schema[c].dataType).alias(c) for c in names]
        current = target.where((F.col(SCD_CURRENT) == 1) & known).select(*cols, *nothing(["__at", "__end"]), F.lit(1).alias("__seen"))
        closed = (target.where((F.col(SCD_CURRENT) != 1) & known).select(*keys).distinct()
                  .select(*keys, *nothing([c for c in (*cols, "__at", "__end") if c not in keys]), F.lit(2).alias("__seen")))
        line = line.select(*cols, "__at", "__end", "__seen").unionByName(current).unionByName(closed)
    by_key = Window.partitionBy(*keys)
    in_time = by_key.orderBy(F.col("__seen").desc(), F.col("__at").asc_nulls_first())
    value = F.struct(*[F.col(c) for c in cols if c not in system_columns(sk, keys)])
    if target is not None:
        # closed keys are told apart before their marker rows leave the line
        gone = (F.max(F.when(F.col("__seen") == 2, 1)).over(by_key).isNotNull()
                & F.max(F.when(F.col("__seen") == 1, 1)).over(by_key).isNull())
        line = line.withColumn("__gone", F.lit(False) if reopen else gone).where("__seen < 2 and not __gone")
    line = line.withColumn("__before", F.lag(value).over(in_time)).withColumn("__first", F.row_number().over(in_time) == 1)
    line = line.where(F.col("__first") | ~value.eqNullSafe(F.col("__before")))
    close = F.lead("__at").over(in_time) - F.expr("INTERVAL 1 SECOND")
    line = line.withColumn("__close", close)
    open_ = F.col("__close").isNull()
    fields = {SCD_ENDED: F.when(open_, F.col(SCD_ENDED)).otherwise(F.col("__close")),
              SCD_CURRENT: F.when(open_, F.col(SCD_CURRENT)).otherwise(F.lit(0))}
    if SCD_BATCH in cols:
        fields[SCD_BATCH] = F.when(open_, F.col(SCD_BATCH)).otherwise(batch_key(F.col(SCD_CREATED), F.col("__close"), F.lit(0)))
    out = line.select([fields.get(c, F.col(c)).cast(line.schema[c].dataType).alias(c) for c in cols])
    return out.unionByName(passed)


def replay_periods(periods, bk, sk, days: int = 6, target: DataFrame | None = None, null_safe: bool = True, **kw) -> DataFrame:
    """H2 over a list of (as_at, source): see :func:`replay_snapshots`.

    ``null_safe=False`` (a change from or to NULL is none) is no equality that a run of
    rows could share, so that case saves one period after the other, each result in the
    shared folder before the next one reads it.
    """
    periods = [(v if isinstance(v, dt.datetime) else dt.datetime.fromisoformat(str(v)), src) for v, src in periods]
    if null_safe and periods:
        first = periods[0][1]
        as_at = "__as_at"
        tagged = [src.select(*first.columns, ts_lit(str(end)).alias(as_at)) for end, src in periods]
        return replay_snapshots(reduce(DataFrame.unionByName, tagged), as_at, bk, sk, days, target, **kw)
    t = target
    for i, (end, src) in enumerate(periods):
        start = str(end - dt.timedelta(days=days))
        if t is None:
            t = wrap_system_columns(src, bk, sk, start, str(end), with_batch_key=kw.get("with_batch_key", False))
        else:
            t = scd2_apply(cut_lineage(t) if i else t, src, bk, sk, start, str(end), null_safe=null_safe, **kw)
    return t
