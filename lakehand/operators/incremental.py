"""High-water-mark incremental loads.

A "watermark" here is a batch high-water mark stored per source, not a
streaming event-time watermark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehand.operators.windows import latest_per_key


def is_incremental(watermark_column) -> Column | bool:
    """a source is incremental iff it names a watermark column."""
    if isinstance(watermark_column, Column):
        return watermark_column.isNotNull() & (F.trim(watermark_column) != "")
    return bool(watermark_column and str(watermark_column).strip())


def wm_bounds(df: DataFrame, column: str, prev_low=None) -> DataFrame:
    """A3: one row (LowWatermark, HighWatermark): coalesce(previous low, MIN), MAX.

    Both are partial aggregates, so this is a single cheap pass over ``column`` only.
    """
    prev = F.lit(prev_low).cast(df.schema[column].dataType) if prev_low is not None else None
    lo = F.min(column) if prev is None else F.coalesce(prev, F.min(column))
    return df.agg(lo.alias("LowWatermark"), F.max(column).alias("HighWatermark"))


def wm_filter(df: DataFrame, column: str, low=None, high=None, include_min: bool = True) -> DataFrame:
    """``low < column <= high`` with typed literals (pushed into the Parquet/JDBC scan).

    With no previous mark (first load) there is no lower bound, so rows at the
    minimum are kept (N13); ``include_min=False`` reproduces the reference's
    ``> min`` that skips them.
    """
    c = F.col(column)
    dt = df.schema[column].dataType
    cond = F.lit(True)
    if low is not None:
        cond = cond & (c > F.lit(low).cast(dt))
    elif not include_min:
        raise ValueError("include_min=False needs the minimum passed as low")
    if high is not None:
        cond = cond & (c <= F.lit(high).cast(dt))
    return df.where(cond)


def incremental_load(df: DataFrame, column: str | None, prev_low=None, include_min: bool = True):
    """Bounds then range filter.  Returns (rows, low, high); full load when no column.

    Only the two bound values reach the driver; they become literals so the range
    predicate is pushed to the scan.
    """
    if not is_incremental(column):
        return df, None, None
    b = wm_bounds(df, column, prev_low).first()
    low = prev_low if prev_low is not None else (None if include_min else b["LowWatermark"])
    return wm_filter(df, column, low, b["HighWatermark"]), b["LowWatermark"], b["HighWatermark"]


def base_query(schema_col="SourceSchema", table_col="SourceTableName", query_col="SourceQuery") -> Column:
    """The manifest's query if present, else SELECT * FROM [schema].[table]."""
    q = F.col(query_col)
    return F.when(q.isNotNull() & (F.trim(q) != ""), q).otherwise(
        F.concat(F.lit("SELECT * FROM ["), F.col(schema_col), F.lit("].["), F.col(table_col), F.lit("]")))


def range_query(base: Column, wm_col: Column, low: Column, high: Column) -> Column:
    """F6 clause over the base query: wrapped, quoted bounds; full query when not incremental."""
    clause = F.concat(F.lit("SELECT * FROM ("), base, F.lit(") T WHERE ["), wm_col, F.lit("] > '"), low,
                      F.lit("' AND ["), wm_col, F.lit("] <= '"), high, F.lit("'"))
    first = F.concat(F.lit("SELECT * FROM ("), base, F.lit(") T WHERE ["), wm_col, F.lit("] <= '"), high, F.lit("'"))
    return F.when(~is_incremental(wm_col), base).when(low.isNull(), first).otherwise(clause)


def query_or_table(spark: SparkSession, query: str | None = None, table: str | DataFrame | None = None) -> DataFrame:
    """S9 on Spark: run the source query if given, else read the table."""
    if query:
        return spark.sql(query)
    return table if isinstance(table, DataFrame) else spark.table(table)


def last_watermark_per_source(status: DataFrame, key: str = "SourceID", wm: str = "HighWatermark",
                              order: str = "CreatedDTS") -> DataFrame:
    """The latest non-NULL high-water mark per source (RANK = 1, ties kept)."""
    s = status.where(F.col(wm).isNotNull()).select(key, wm, order)
    return latest_per_key(s, key, order, desc=True).select(key, wm)
