"""Slowly changing dimensions and merges without a merge-capable table format.

* :func:`scd2_apply` - type 2 merge (D9, D10, D11): closed versions pass through
  untouched; the current versions are full-outer joined once with the source on
  the business key; each key then yields zero, one or two rows.
* :func:`scd1_upsert` (D6), :func:`scd1_update` (D12), :func:`seed_if_absent` (D13).

Scale notes: the only large shuffle is the key join of *current* rows with the
source (a :class:`~lakehand.sinks.keyed.KeyedTable` hands in the touched buckets
alone).  Business
keys are unique on both sides of it (one current version per key; duplicated
source keys are rejected by :func:`check_unique_keys` before a save), so no key
can be hot.  Rows whose key is NULL never match anything, so they are routed
around the join instead of all hashing into one partition.  Stored history is
only consulted for the batch's keys.  Which side of these joins is broadcast is left to
the planner, which knows the sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehand.constants import SCD_BATCH, SCD_CREATED, SCD_CURRENT, SCD_ENDED
from lakehand.functions.scalar import any_of, ts_lit
from lakehand.operators.keys import (_as_list, batch_key, composite_key, inject_sk, key_time_text,
                                     scd_columns)

ACTION = "_Action"


def _ts(v) -> Column:
    return v if isinstance(v, Column) else ts_lit(v)


def system_columns(sk: str | None, bk) -> set[str]:
    return {c for c in [sk, *_as_list(bk), *[SCD_CREATED, SCD_ENDED, SCD_CURRENT, SCD_BATCH]] if c}


def wrap_system_columns(source: DataFrame, bk, sk: str, start, end=None,
                        hash_method: str | None = None, with_batch_key: bool = False) -> DataFrame:
    """SK first, then the source columns, then the SCD columns (and batch key).

    The key may be one column or a list; a list's surrogate key is made of the columns'
    business key text (:func:`~lakehand.operators.keys.business_key`), with the separator
    ``KEY_SEPARATOR`` so that no two keys share a text.
    """
    keys = _as_list(bk)
    text = keys[0] if len(keys) == 1 else composite_key(keys)
    df = scd_columns(inject_sk(source, sk, text, _ts(start), hash_method), _ts(start), end)
    if with_batch_key:
        df = df.withColumn(SCD_BATCH, batch_key())
    return df


scd2_first_load = wrap_system_columns


def changed_predicate(columns, left: str = "s", right: str = "t", null_safe: bool = True) -> Column:
    """OR over the compared columns (F8).

    ``null_safe=True`` counts NULL->value and value->NULL as changes; ``False``
    reproduces the reference's plain ``<>`` which ignores them (N2).
    """
    if null_safe:
        return any_of(~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns)
    return F.coalesce(any_of(F.col(f"{left}.{c}") != F.col(f"{right}.{c}") for c in columns), F.lit(False))


def current_rows(df: DataFrame) -> DataFrame:
    """Current-version filter."""
    return df.where(F.col(SCD_CURRENT) == 1)


def _key_not_null(keys) -> Column:
    c = None
    for k in keys:
        x = F.col(k).isNotNull()
        c = x if c is None else c & x
    return c


def schema_drift(target: DataFrame, source: DataFrame, bk, sk: str | None = None) -> dict:
    """Schema-drift report between a target and a new source (N27), from schemas only:
    source columns the target lacks, target attributes the source lacks, type changes."""
    sys_cols = system_columns(sk, _as_list(bk))
    t = {f.name: f.dataType for f in target.schema.fields if f.name not in sys_cols}
    s = {f.name: f.dataType for f in source.schema.fields if f.name not in sys_cols}
    return {"added": [c for c in s if c not in t], "missing": [c for c in t if c not in s],
            "type_changed": [c for c in t if c in s and t[c] != s[c]]}


def evolve_target(target: DataFrame, source: DataFrame, bk, sk: str | None = None) -> DataFrame:
    """Add the source's new attribute columns to the target (NULL on stored rows),
    placed before the SCD columns."""
    added = schema_drift(target, source, bk, sk)["added"]
    if not added:
        return target
    first_scd = next((i for i, c in enumerate(target.columns) if c in (SCD_CREATED, SCD_ENDED, SCD_CURRENT,
                                                                    SCD_BATCH)), len(target.columns))
    new = [F.lit(None).cast(source.schema[c].dataType).alias(c) for c in added]
    cols = [F.col(f"`{c}`") for c in target.columns]
    return target.select(*cols[:first_scd], *new, *cols[first_scd:])


def scd2_apply(target: DataFrame, source: DataFrame, bk, sk: str, start, end=None, *,
               null_safe: bool = True, with_batch_key: bool | None = None, reopen: bool = False,
               hash_method: str | None = None, close_batch_from: str = "closed",
               compare=None, with_action: bool = False, evolve: bool = False) -> DataFrame:
    """Type 2 merge of ``source`` (plain rows with the business key) into ``target``.

    Per business key:
      * target only, or unchanged      -> the target row is kept;
      * changed                        -> the current row is closed (``_Ended`` =
        start - 1 s, ``_Current`` = 0) and a new current version is added;
      * source only                    -> new version, unless the key exists only as
        closed rows (not reopened, as in the reference; ``reopen=True`` changes that).
    Keys missing from the source are left alone (no delete detection, N28).  The
    compared columns come from the target schema (N27); ``evolve=True`` first adds
    the source's new columns to the target (see :func:`schema_drift`).
    """
    keys = _as_list(bk)
    if evolve:
        target = evolve_target(target, source, keys, sk)
    has_batch = (SCD_BATCH in target.columns) if with_batch_key is None else with_batch_key
    sys_cols = system_columns(sk, keys)
    attrs = list(compare) if compare else [c for c in target.columns if c not in sys_cols]
    missing = [c for c in attrs + keys if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    cols = target.columns
    start_c = _ts(start)
    close_end = start_c - F.expr("INTERVAL 1 SECOND")

    new = wrap_system_columns(source.select(*keys, *[c for c in attrs if c not in keys]), keys, sk, start_c, end,
                              hash_method, has_batch)
    new = new.select([F.col(c).cast(target.schema[c].dataType).alias(c) for c in cols])

    is_cur = F.col(SCD_CURRENT) == 1
    nn = _key_not_null(keys)
    current = target.where(is_cur & nn)
    passthrough = target.where(~is_cur | ~nn)          # closed history + NULL-key rows
    src_nn, src_null = new.where(nn), new.where(~nn)

    kcols = [f"__k{i}" for i in range(len(keys))]
    s = src_nn.select(*[F.col(k).alias(a) for k, a in zip(keys, kcols)], F.struct(*cols).alias("s"))
    if not reopen:
        # keys with stored history: only those the batch mentions matter (a small batch's keys are
        # broadcast by their size, and the history filtered where it is read)
        hist = target.where(~is_cur & nn).select(*[F.col(k).alias(a) for k, a in zip(keys, kcols)])
        hist = hist.join(s.select(*kcols), kcols, "left_semi")
        closed_keys = hist.distinct().withColumn("__hist", F.lit(True))
        s = s.join(closed_keys, kcols, "left")
    else:
        s = s.withColumn("__hist", F.lit(False))
    t = current.select(*[F.col(k).alias(a) for k, a in zip(keys, kcols)], F.struct(*cols).alias("t"))
    j = t.join(s, kcols, "full_outer")

    changed = changed_predicate(attrs, "s", "t", null_safe)
    if close_batch_from == "closed":
        closed_created = F.col(f"t.{SCD_CREATED}")
    else:                                   # parity: the new row's _Created (N15)
        closed_created = F.col(f"s.{SCD_CREATED}")

    def closed_field(c):
        if c == SCD_ENDED:
            return close_end.cast(target.schema[c].dataType).alias(c)
        if c == SCD_CURRENT:
            return F.lit(0).cast(target.schema[c].dataType).alias(c)
        if c == SCD_BATCH and has_batch:
            return batch_key(closed_created, close_end, F.lit(0)).alias(c)
        return F.col(f"t.{c}").alias(c)

    def tagged(fields, action):
        return F.struct(*fields, F.lit(action).alias(ACTION))

    keep = tagged([F.col(f"t.{c}").alias(c) for c in cols], "keep")
    close = tagged([closed_field(c) for c in cols], "close")
    insert = tagged([F.col(f"s.{c}").alias(c) for c in cols], "insert")
    skip = tagged([F.col(f"s.{c}").alias(c) for c in cols], "skip")
    t_in, s_in = F.col("t").isNotNull(), F.col("s").isNotNull()
    rows = (F.when(t_in & s_in & changed, F.array(close, insert))
             .when(t_in, F.array(keep))
             .when(F.coalesce(F.col("__hist"), F.lit(False)), F.array(skip))
             .otherwise(F.array(insert)))
    merged = j.select(F.explode(rows).alias("r")).select("r.*").where(F.col(ACTION) != "skip")

    out = (passthrough.withColumn(ACTION, F.lit("history"))
           .unionByName(merged)
           .unionByName(src_null.withColumn(ACTION, F.lit("insert"))))
    return out if with_action else out.drop(ACTION)


def scd2_delta(target: DataFrame, source: DataFrame, bk, sk: str, start, end=None, **kw):
    """The type 2 merge as the two frames a sink writes: (new current versions,
    rows closed by this batch).  Stored history is not part of either."""
    merged = scd2_apply(target, source, bk, sk, start, end, with_action=True, **kw)
    changed = merged.where(F.col(ACTION) != "history")
    current = changed.where(F.col(SCD_CURRENT) == 1).drop(ACTION)
    closed = changed.where(F.col(SCD_CURRENT) != 1).drop(ACTION)
    return current, closed


def scd2_changed_rows(source: DataFrame, target: DataFrame, bk, null_safe: bool = True, compare=None,
                      sk: str | None = None) -> DataFrame:
    """Source rows whose current target version differs (F8 + J2)."""
    keys = _as_list(bk)
    attrs = list(compare) if compare else [c for c in target.columns if c not in system_columns(sk, keys)]
    return (source.alias("s").join(current_rows(target).alias("t"), keys)
            .where(changed_predicate(attrs, "s", "t", null_safe))
            .select(*[F.col(k) for k in keys], *[F.col(f"s.{c}") for c in source.columns if c not in keys]))


def scd2_staged_rows(source: DataFrame, target: DataFrame, bk, null_safe: bool = True, sk: str | None = None,
                     merge_key: str = "MergeKey") -> DataFrame:
    """Single-pass merge staging (D10): changed rows with a NULL merge key (forces an
    insert) plus every source row keyed by its business key (closes the match)."""
    keys = _as_list(bk)
    key = F.col(keys[0]).cast("string") if len(keys) == 1 else composite_key(keys)
    changed = scd2_changed_rows(source, target, keys, null_safe, sk=sk).select(source.columns)
    return (changed.select(F.lit(None).cast("string").alias(merge_key), *source.columns)
            .unionByName(source.select(key.alias(merge_key), *source.columns)))


def scd1_upsert(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Update-all / insert-all merge on the key columns (D6).  The key is required."""
    keys = _as_list(keys)
    if not keys:
        raise ValueError("scd1_upsert needs the business key columns")
    src = source.select(target.columns)
    nn = _key_not_null(keys)
    kept = target.where(nn).join(src.where(nn).select(*keys), keys, "left_anti").select(target.columns)
    return kept.unionByName(target.where(~nn)).unionByName(src)


def scd1_update(target: DataFrame, source: DataFrame, bk, sk: str | None = None) -> DataFrame:
    """Overwrite non-key columns on a key match in *every* version; no inserts."""
    keys = _as_list(bk)
    sys_cols = system_columns(sk, keys)
    attrs = [c for c in target.columns if c not in sys_cols and c in source.columns]
    s = source.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in attrs]).withColumn("__m", F.lit(True))
    j = target.join(s, keys, "left")
    return j.select([
        F.when(F.col("__m"), F.col(f"__s_{c}")).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
        if c in attrs else F.col(c) for c in target.columns])


def seed_if_absent(target: DataFrame, seed: DataFrame, keys, action_col: str = ACTION) -> DataFrame:
    """MERGE with only WHEN NOT MATCHED: insert seed rows whose key is absent.

    Returns the new table with ``action_col`` = 'INSERT' on inserted rows, NULL elsewhere.
    """
    keys = _as_list(keys)
    new = seed.select(target.columns).join(target.select(*keys), keys, "left_anti").select(target.columns)
    return (target.withColumn(action_col, F.lit(None).cast("string"))
            .unionByName(new.withColumn(action_col, F.lit("INSERT"))))


def restamp(df: DataFrame, created, ended) -> DataFrame:
    """Rewrite the SCD dates of a whole table (D16); idempotent."""
    return df.withColumns({SCD_CREATED: _ts(created), SCD_ENDED: _ts(ended)})


def run_metrics(source: DataFrame, merged_with_action: DataFrame) -> DataFrame:
    """Run counts in one aggregation (A11): source rows, inserted, closed and table rows.

    The reference reports -1 for inserted/updated; here they are real counts.
    """
    a = merged_with_action.select(F.col(ACTION))
    s = source.select(F.lit("source").alias(ACTION))
    return a.unionByName(s).agg(
        F.count_if(F.col(ACTION) == "source").alias("SpotCount"),
        F.count_if(F.col(ACTION) == "insert").alias("InsertCount"),
        F.count_if(F.col(ACTION) == "close").alias("UpdateCount"),
        F.count_if(F.col(ACTION) != "source").alias("CuratedCount"),
    )


def load_counts(df: DataFrame) -> DataFrame:
    """Rows per load timestamp."""
    return df.groupBy(SCD_CREATED).agg(F.count(F.lit(1)).alias("Counts"))


__all__ = ["schema_drift", "evolve_target", "wrap_system_columns", "scd2_first_load", "changed_predicate", "current_rows", "scd2_apply",
           "scd2_delta", "scd2_changed_rows", "scd2_staged_rows", "scd1_upsert", "scd1_update", "seed_if_absent",
           "restamp", "run_metrics", "load_counts", "key_time_text", "ACTION"]
