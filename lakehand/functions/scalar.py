"""Column-level helpers (all built-in Spark expressions; no Python UDFs)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakehand.constants import EMPTY_SENTINEL, NULL_SENTINEL

__all__ = [
    "ts_lit", "col_or", "sentinel", "null_sentinels", "json_value", "strip_crlf",
    "duration_seconds", "quarter_label", "scaled_units", "fixed2", "date_key_parse",
    "fill_template", "tz_stamp", "tsql_concat", "list_to_rows", "props_to_rows",
    "week_start", "any_of",
]


def ts_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal (the driver's tables use timestamp_ntz)."""
    if value is None:
        return F.lit(None).cast(T.TimestampNTZType())
    return F.lit(str(value)).cast(T.TimestampNTZType())


def col_or(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentinel(c) -> Column:
    """'' -> (~empty~), NULL -> (~null~), else the value (reference CASE)."""
    c = col_or(c)
    return F.when(c == "", F.lit(EMPTY_SENTINEL)).when(c.isNull(), F.lit(NULL_SENTINEL)).otherwise(c)


def null_sentinels(df: DataFrame, columns=None) -> DataFrame:
    """Apply :func:`sentinel` to the given (default: all string) columns."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    cols = set(columns)
    return df.select([sentinel(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def json_value(c, path: str) -> Column:
    """Scalar JSON path like SQL Server JSON_VALUE: objects/arrays give NULL."""
    v = F.get_json_object(col_or(c), path)
    # the path is parsed once: the guard filters a one-element array
    return F.get(F.filter(F.array(v), lambda x: ~(x.startswith("{") | x.startswith("["))), 0)


def strip_crlf(c) -> Column:
    return F.translate(col_or(c), "\r\n", "")


def duration_seconds(start, end, as_of=None) -> Column:
    """Whole seconds from start to end (or to ``as_of`` while end is NULL).

    Seconds as bigint instead of a TIME value, so durations over 24 h do not wrap (N11).
    """
    e = col_or(end)
    if as_of is not None:
        e = F.coalesce(e, as_of if isinstance(as_of, Column) else ts_lit(as_of))
    return F.timestamp_diff("SECOND", col_or(start), e)


def quarter_label(ts) -> Column:
    """'Q' + quarter; NULL timestamp gives 'Q' (T-SQL CONCAT treats NULL as empty, N8)."""
    return F.concat_ws("", F.lit("Q"), F.quarter(col_or(ts)).cast("string"))


def scaled_units(c, divisor: int = 1048576) -> Column:
    """Integer byte count / divisor, rounded half-up to 2 decimals, as text.

    Integer arithmetic keeps the result exact; ``divisor=1026`` reproduces the
    reference's ``1024 ^ 2`` (XOR) bug (N9).
    """
    b = col_or(c).cast("decimal(38,2)")
    hundredths = F.floor((b * 100 + F.lit(divisor // 2)) / F.lit(divisor))
    return (hundredths.cast("decimal(30,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(18,2)").cast("string")


def fixed2(c) -> Column:
    """Number text -> DECIMAL(16,2) text with two decimals ('0.00' format)."""
    return col_or(c).try_cast("decimal(16,2)").cast("string")


def date_key_parse(c) -> Column:
    """yyyyMMdd integer/text key -> DATE."""
    return F.to_date(col_or(c).cast("string"), "yyyyMMdd")


def fill_template(template, mapping: dict) -> Column:
    """Replace ``$SLOT$`` tokens in a template column/literal, in dict order."""
    out = template if isinstance(template, Column) else F.lit(template)
    for k, v in mapping.items():
        out = F.replace(out, F.lit(k), v if isinstance(v, Column) else F.lit(v))
    return out


def tz_stamp(ts, tz: str, source_tz: str = "UTC") -> Column:
    """Wall clock of ``source_tz`` -> wall clock of ``tz`` (the reference stamps in its
    local zone).  Works on TIMESTAMP_NTZ, so the session time zone does not matter."""
    return F.convert_timezone(F.lit(source_tz), F.lit(tz), col_or(ts).cast("timestamp_ntz"))


def tsql_concat(*cols) -> Column:
    """T-SQL CONCAT: NULL arguments count as empty strings."""
    return F.concat_ws("", *[col_or(c).cast("string") for c in cols])


def list_to_rows(c, sep: str = ",") -> Column:
    """'a, b,,c' -> rows a, b, c (trimmed, blanks dropped by the caller)."""
    return F.explode(F.split(col_or(c), re.escape(sep)))


def props_to_rows(c, value_type: str = "bigint") -> Column:
    """Flat JSON object -> (key, value) rows via from_json map + explode."""
    return F.explode(F.from_json(col_or(c), f"map<string,{value_type}>"))


def week_start(end_date, days: int = 6) -> Column:
    return F.date_sub(col_or(end_date), days)


def any_of(conds) -> Column:
    conds = list(conds)
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)
