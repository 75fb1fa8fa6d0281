"""Shaping: projections, renames, sentinels, templates, ordering."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakehand.functions.scalar import null_sentinels  # noqa: F401  (re-export, F10)


def project_exprs(df: DataFrame, exprs) -> DataFrame:
    """a declarative list of SQL expressions applied once."""
    return df.selectExpr(*exprs)


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    """prefix every column name."""
    return df.select([F.col(f"`{c}`").alias(prefix + c) for c in df.columns])


_SANITIZERS = {
    "trusted": lambda c: c.replace(" ", "_"),
    "select": lambda c: re.sub(r"[ ,()]", "_", c),
    "destination": lambda c: c.replace("\\", "").replace(" ", ""),
}


def sanitize_name(name: str, style: str = "trusted") -> str:
    return _SANITIZERS[style](name)


def sanitize_columns(df: DataFrame, style: str = "trusted", on_collision: str = "error") -> DataFrame:
    """clean column names; two columns mapping to one name is an error (or suffixed)."""
    new, seen = [], {}
    for c in df.columns:
        n = sanitize_name(c, style)
        if n in seen:
            if on_collision == "error":
                raise ValueError(f"columns {seen[n]!r} and {c!r} both become {n!r}")
            k = 2
            while f"{n}_{k}" in seen:
                k += 1
            n = f"{n}_{k}"
        seen[n] = c
        new.append(n)
    return df.toDF(*new)


def trusted_query(spark: SparkSession, template: str | None, df: DataFrame) -> DataFrame:
    """run a SQL template with a ``{tableFqn}`` slot over the (sanitised) frame."""
    if not template:
        return df
    return spark.sql(template, tableFqn=df)


def drop_key_columns(df: DataFrame, keys=None, n: int = 2) -> DataFrame:
    """drop the surrogate/business key columns (by name; leading ``n`` as fallback)."""
    if keys:
        return df.drop(*keys)
    return df.select(*[F.col(f"`{c}`") for c in df.columns[n:]])


def key_first(df: DataFrame, key: str) -> DataFrame:
    """put the key column first."""
    return df.select(key, *[c for c in df.columns if c != key])


def tag(df: DataFrame, **literals) -> DataFrame:
    """constant tag columns (organisation, country)."""
    return df.withColumns({k: F.lit(v) for k, v in literals.items()})


def period_filter(df: DataFrame, date_key: str, year) -> DataFrame:
    """keep the rows of one year, by a range on the column itself, which a scan can push down and
    prune by.  The column is a date or time, or a yyyyMMdd key as a number or text."""
    c, y = F.col(date_key), int(year)
    kind = df.schema[date_key].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        low, high = (F.lit(f"{v:04d}-01-01").cast(kind) for v in (y, y + 1))
    elif isinstance(kind, T.StringType):
        low, high = F.lit(f"{y:04d}"), F.lit(f"{y + 1:04d}")
    else:
        low, high = (F.lit(v * 10000).cast(kind) for v in (y, y + 1))
    return df.where((c >= low) & (c < high))


def limit_or_all(df: DataFrame, n: int, order_by=None) -> DataFrame:
    """L2: first ``n`` rows in order; 0 means no limit (all rows in order)."""
    if order_by:
        df = df.orderBy(*([order_by] if isinstance(order_by, str) else order_by))
    return df.limit(int(n)) if n else df


def empty_clone(df: DataFrame) -> DataFrame:
    """Same columns, zero rows."""
    return df.limit(0)
