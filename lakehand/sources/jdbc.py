"""JDBC sources (S7, S9, S15): tables and queries read in disjoint ranges."""

from __future__ import annotations

import datetime as dt
import decimal
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession


def _literal(value) -> str:
    """A bound as SQL text; dates and times in the escapes every JDBC driver knows."""
    if isinstance(value, dt.datetime):
        return f"{{ts '{value:%Y-%m-%d %H:%M:%S.%f}'}}"
    if isinstance(value, dt.date):
        return f"{{d '{value:%Y-%m-%d}'}}"
    return str(value)


def _cuts(low, high, parts: int) -> list:
    """``parts - 1`` values, or fewer, that cut the range from ``low`` to ``high`` evenly."""
    if isinstance(low, dt.datetime):
        step = (high - low) / parts
    elif isinstance(low, dt.date):
        step = (high - low) / parts       # a date takes whole days of it
    elif isinstance(low, (int, decimal.Decimal, float)):
        step = Fraction(high - low) / parts
        cuts = [Fraction(low) + step * k for k in range(1, parts)]
        made = {int: lambda c: -(-c.numerator // c.denominator), float: float,
                decimal.Decimal: lambda c: decimal.Decimal(c.numerator) / c.denominator}[type(low)]
        return sorted({made(c) for c in cuts} - {low})
    else:
        raise ValueError(f"a column of {type(low).__name__} values has no ranges; pass predicates")
    return sorted({low + step * k for k in range(1, parts)} - {low})


def range_predicates(column: str, low, high, parts: int) -> list[str]:
    """Conditions that every row meets one of: ``parts`` ranges without a gap between them, open to
    both sides; rows without a value are in the first."""
    cuts = [_literal(c) for c in _cuts(low, high, max(1, parts))] if low is not None else []
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"({column} < {cuts[0]} OR {column} IS NULL)", *inner, f"{column} >= {cuts[-1]}"]


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              partition_column: str | None = None, lower=None, upper=None, num_partitions: int | None = None,
              properties: dict | None = None, fetch_size: int = 10000, predicates: list[str] | None = None) -> DataFrame:
    """Read a table or a query, in parallel where a column is named.

    With ``partition_column`` and ``num_partitions`` the rows are read in that many ranges of
    the column (a number, date or time), each by its own task and each row once, rows
    without a value included.  Without ``lower`` and ``upper`` the ranges' bounds come from
    one aggregate the database computes.  ``predicates`` gives the conditions instead.
    Filters and column pruning are pushed into the generated SQL by Spark.
    """
    options = {"fetchsize": str(fetch_size), **(properties or {})}
    source = f"({query}) q" if query else table
    if predicates is None and not (partition_column and num_partitions):
        return spark.read.format("jdbc").options(url=url, dbtable=source, **options).load()
    if predicates is None:
        if lower is None or upper is None:
            bounds = f"SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {source}"
            lower, upper = spark.read.format("jdbc").options(url=url, query=bounds, **options).load().first()
        predicates = range_predicates(partition_column, lower, upper, num_partitions)
    return spark.read.jdbc(url, source, predicates=predicates, properties=options)


def query_to_parquet(spark: SparkSession, url: str, query: str, path: str, partition_column: str | None = None,
                     num_partitions: int | None = None, properties: dict | None = None) -> None:
    """Land a source query as Parquet, one range of rows per task and file."""
    df = read_jdbc(spark, url, query=query, partition_column=partition_column, num_partitions=num_partitions,
                   properties=properties)
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
