"""Business, surrogate and batch keys (D1-D5) and the duplicate-key guard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehand.constants import HASH_SECOND_VALUE, KEY_TIME_FORMAT, OPEN_END_CODE
from lakehand.functions.scalar import col_or, ts_lit


def _as_list(cols) -> list[str]:
    if isinstance(cols, str):
        return [c.strip() for c in cols.split(",") if c.strip()]
    return list(cols)


def business_key(columns, prefix: str | None = None) -> Column:
    """Composite business-key text: the columns concatenated with no separator.

    Like the reference, ``('1','23')`` and ``('12','3')`` give the same text and any
    NULL part makes the key NULL (N4); merges therefore join on the column list
    (see :mod:`lakehand.operators.scd`) and keep this text only as the ``_BK`` value.
    """
    parts = [F.col(c).cast("string") for c in _as_list(columns)]
    key = parts[0] if len(parts) == 1 else F.concat(*parts)
    return F.concat(F.lit(prefix), key) if prefix else key


#: Between the parts of a composite key's text; inside a part it and the escape are escaped.
KEY_SEPARATOR, KEY_ESCAPE = "|", "\\"


def composite_key(columns) -> Column:
    """Text of a key of several columns that no other key shares; NULL where a part is NULL."""
    sep, esc = F.lit(KEY_SEPARATOR), F.lit(KEY_ESCAPE)
    parts = [F.replace(F.replace(F.col(c).cast("string"), esc, F.lit(2 * KEY_ESCAPE)), sep, F.lit(KEY_ESCAPE + KEY_SEPARATOR))
             for c in _as_list(columns)]
    return F.concat(*[x for p in parts for x in (sep, p)][1:])


def key_time_text(ts) -> Column:
    return F.date_format(ts if isinstance(ts, Column) else ts_lit(ts), KEY_TIME_FORMAT)


def surrogate_key(bk, batch_ts) -> Column:
    """Load time ``yyMMddHHmmss`` + '-' + business key."""
    return F.concat(key_time_text(batch_ts), F.lit("-"), col_or(bk).cast("string"))


def surrogate_key_hash(bk, batch_ts, method: str = "xxhash64") -> Column:
    """Hashed surrogate key (D3).

    ``xxhash64`` hashes the key text together with the constant 512 as a second
    value, as the reference does (N5); ``sha2`` gives a 256-bit hex variant that
    other engines can reproduce.
    """
    text = surrogate_key(bk, batch_ts)
    if method == "xxhash64":
        return F.xxhash64(text, F.lit(HASH_SECOND_VALUE))
    if method == "sha2":
        return F.sha2(text, 256)
    raise ValueError(f"unknown surrogate key hash {method!r}")


def inject_sk(df: DataFrame, sk: str, bk: str, batch_ts, method: str | None = None) -> DataFrame:
    """Add the surrogate key and put it first."""
    sk_col = surrogate_key(bk, batch_ts) if method is None else surrogate_key_hash(bk, batch_ts, method)
    return df.select(sk_col.alias(sk), *[F.col(c) for c in df.columns if c != sk])


def end_of_day(end) -> Column:
    e = end if isinstance(end, Column) else ts_lit(end)
    return e + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 1 SECOND")


def scd_columns(df: DataFrame, start, end=None) -> DataFrame:
    """_Created = start, _Ended = NULL or end-of-day of ``end``, _Current = 1."""
    created = start if isinstance(start, Column) else ts_lit(start)
    ended = ts_lit(None) if end is None else end_of_day(end)
    return df.withColumns({"_Created": created, "_Ended": ended, "_Current": F.lit(1).cast("int")})


def batch_key(created="_Created", ended="_Ended", current="_Current") -> Column:
    """start ‖ (end or 12 zeros) ‖ current as DECIMAL(25,0)."""
    return F.concat(
        key_time_text(col_or(created)),
        F.coalesce(key_time_text(col_or(ended)), F.lit(OPEN_END_CODE)),
        col_or(current).cast("string"),
    ).cast("decimal(25,0)")


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Business keys that occur more than once, with their count ``n`` (A2).

    A map-side partial count per key precedes the shuffle, so a hot key costs one
    partial row per input partition, never a one-task group.
    """
    keys = _as_list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_unique_keys(df: DataFrame, keys, on_duplicate: str = "error", null_keys: str = "allow") -> None:
    """Fail fast (or warn) on duplicated keys before a merge.

    Runs one small aggregation job; only the first offending keys reach the driver.
    """
    keys = _as_list(keys)
    if null_keys == "error":
        cond = None
        for k in keys:
            c = F.col(k).isNull()
            cond = c if cond is None else cond | c
        if df.where(cond).limit(1).count():
            raise ValueError(f"NULL business key in {keys}")
    if on_duplicate == "ignore":
        return
    sample = duplicate_keys(df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)), keys).limit(5).collect()
    if sample:
        msg = f"duplicate business keys on {keys}: {[tuple(r) for r in sample]}"
        if on_duplicate == "error":
            raise ValueError(msg)
        print("WARNING:", msg)
