"""Whole-partition window semantics that survive hot partitions.

The reference uses RANK/DENSE_RANK/COUNT/SUM/MIN/MAX OVER (PARTITION BY ...).
A plain Spark window puts a whole partition-key group into one task; when one
batch or system holds a third of the rows that task holds a third of the data.
These helpers give the same results with pre-aggregation and balanced shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def latest_per_key(df: DataFrame, keys, order_col: str, desc: bool = True) -> DataFrame:
    """Rows with RANK() = 1 per key (ties kept): latest (``desc``) or first.

    The best value per key is a partial (map-side) MIN/MAX; the rows are then picked
    by a semi join on (key, value), which spreads a hot key's rows over partitions.
    Rows whose order value is NULL rank last for DESC and never win unless the whole
    key has only NULLs, in which case all its rows tie (as RANK does).
    """
    keys = _cols(keys)
    agg = F.max(order_col) if desc else F.min(order_col)
    best = df.groupBy(*[F.col(k).alias(f"__lk_{k}") for k in keys]).agg(agg.alias("__best"))
    on = df[order_col].eqNullSafe(best["__best"])
    for k in keys:
        on = on & df[k].eqNullSafe(best[f"__lk_{k}"])
    return df.join(best, on, "left_semi")


def partition_agg(df: DataFrame, keys, aggs: dict[str, Column]) -> DataFrame:
    """Attach whole-partition aggregates (COUNT/SUM/MIN/MAX OVER (PARTITION BY keys)).

    Computed as a grouped aggregate (partial aggregation before the shuffle) and
    joined back on the keys; AQE splits a hot key's rows on the big side.
    """
    keys = _cols(keys)
    g = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    for k in keys:
        g = g.withColumnRenamed(k, f"__g_{k}")
    on = None
    for k in keys:
        c = df[k].eqNullSafe(g[f"__g_{k}"])
        on = c if on is None else on & c
    return df.join(g, on, "left").drop(*[f"__g_{k}" for k in keys])


def rank_in_buckets(values: DataFrame, keys, value: str, bucket: Column, out: str, desc: bool = False) -> DataFrame:
    """DENSE_RANK of distinct ``values`` (columns ``keys`` and ``value``) per key, without a task that
    holds a whole key: rows are numbered inside their bucket, and the buckets before it, a
    small table of counts, are added.  ``bucket`` must rise with the value (NULL for NULL):
    the hour of a time, the high digits of a number.  NULL is first, or last with ``desc``.
    """
    keys = _cols(keys)
    direction = (lambda c: F.col(c).desc_nulls_last()) if desc else (lambda c: F.col(c).asc_nulls_first())
    inside = Window.partitionBy(*keys, "__b").orderBy(direction(value))
    rows = values.withColumn("__b", bucket).withColumn("__rn", F.row_number().over(inside))
    names = [f"__k{i}" for i in range(len(keys))]
    held = values.withColumn("__b", bucket).groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)], "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*(names or [F.lit(1)])).orderBy(direction("__b")).rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n").withColumnRenamed("__b", "__hb")
    on = F.col("__b").eqNullSafe(F.col("__hb"))
    for k, n in zip(keys, names):
        on = on & F.col(k).eqNullSafe(F.col(n))
    return rows.join(held, on).select(*keys, value, (F.col("__rn") + F.col("__before")).cast("int").alias(out))


def rank_within(df: DataFrame, group, order, out: str, method: str = "dense_rank",
                num_partitions: int | None = None) -> DataFrame:
    """RANK-family number per group that does not put a hot group into one task, for orders that
    :func:`rank_in_buckets` has no bucket for.

    1. range-partition on (group, order): a hot group spans several partitions and
       equal (group, order) keys always share one;
    2. number rows locally per (group, partition);
    3. per (group, partition) counts -> prefix sums over the partitions of a group
       (a tiny table) -> add as offsets.
    ``method`` is ``dense_rank`` or ``row_number``.  The range-split frame is
    checkpointed to the shared checkpoint folder: range bounds come from sampling,
    so both uses of the frame must read one materialisation.
    """
    from lakehand.session import cut_lineage
    group = _cols(group)
    orders = order if isinstance(order, (list, tuple)) else [order]
    o = [F.col(x) if isinstance(x, str) else x for x in orders]
    local = F.dense_rank() if method == "dense_rank" else F.row_number()
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = df.repartitionByRange(n, *[F.col(g) for g in group], *o).withColumn("__pid", F.spark_partition_id())
    w = Window.partitionBy(*group, "__pid").orderBy(*o)
    r = cut_lineage(r.withColumn("__local", local.over(w)))
    cnt = r.groupBy(*group, "__pid").agg(F.max("__local").alias("__n"))
    prev = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    off = cnt.withColumn("__off", F.coalesce(F.sum("__n").over(prev), F.lit(0))).drop("__n")
    for g in group:
        off = off.withColumnRenamed(g, f"__g_{g}")
    off = off.withColumnRenamed("__pid", "__opid")
    cond = r["__pid"] == off["__opid"]
    for g in group:
        cond = cond & r[g].eqNullSafe(off[f"__g_{g}"])
    res = r.join(off, cond, "inner")
    return res.withColumn(out, (F.col("__local") + F.col("__off")).cast("int")).drop(
        "__pid", "__opid", "__local", "__off", *[f"__g_{g}" for g in group])


def dense_rank_global(df: DataFrame, order_col: str, out: str, desc: bool = False) -> DataFrame:
    """DENSE_RANK() over the whole table (W8) without a one-partition window:
    the distinct values are ranked by :func:`rank_within` and joined back."""
    vals = df.select(order_col).distinct().withColumn("__all", F.lit(1))
    o = F.col(order_col).desc_nulls_last() if desc else F.col(order_col).asc_nulls_first()
    ranked = rank_within(vals, "__all", o, out).drop("__all").withColumnRenamed(order_col, "__v")
    return df.join(ranked, df[order_col].eqNullSafe(ranked["__v"]), "left").drop("__v")
