"""Unions across organisations and history snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def union_all(frames) -> DataFrame:
    """UNION ALL by name of any number of frames (a balanced tree, not a deep chain)."""
    frames = list(frames)
    while len(frames) > 1:
        frames = [frames[i].unionByName(frames[i + 1]) if i + 1 < len(frames) else frames[i]
                  for i in range(0, len(frames), 2)]
    return frames[0]


def union_orgs(parts, key_col: str, bk_name: str, tag_col: str = "CountryCode") -> DataFrame:
    """One entity from several organisations: prefixed business key + tag column.

    ``parts`` = [(org_id, key_prefix, frame), ...].
    """
    out = []
    for org, prefix, df in parts:
        cols = [c for c in df.columns if c != key_col]
        out.append(df.select(F.concat(F.lit(str(prefix)), F.col(key_col).cast("string")).alias(bk_name),
                             *cols, F.lit(org).alias(tag_col)))
    return union_all(out)


def unionise(spark: SparkSession, template: str, orgs, tag_col: str = "Organisation") -> DataFrame:
    """Run one SQL template per organisation, tag each result and union them.

    ``orgs`` is an *ordered* list of (org_id, {slot: frame}) (N20); the template
    names its tables as ``{slot}`` (Spark parameterised SQL).
    """
    return union_all(spark.sql(template, **tables).withColumn(tag_col, F.lit(org)) for org, tables in orgs)


def history_union(current: DataFrame, history: DataFrame, drop=None, distinct: bool = True) -> DataFrame:
    """Current ∪ history snapshots (UNION = distinct).

    ``drop`` removes key columns first (fact form, F11).  The distinct is one
    hash aggregation with map-side dedupe.
    """
    cols = [c for c in current.columns if c not in (drop or [])]
    u = current.select(cols).unionByName(history.select(cols))
    return u.distinct() if distinct else u


def override_snapshot(history: DataFrame, snapshot_col: str, snapshot, **literals) -> DataFrame:
    """Give one snapshot fixed column values (e.g. dates) before the union."""
    hit = F.col(snapshot_col) == F.lit(snapshot)
    return history.withColumns({c: F.when(hit, v if hasattr(v, "alias") else F.lit(v)).otherwise(F.col(c))
                                for c, v in literals.items()})
