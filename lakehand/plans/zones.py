"""Zone jobs: landed file -> raw registration -> trusted table.

``raw_load`` is S1; ``trusted_load`` is F3 -> F4 -> D8 (no business key:
overwrite; a business key: create-or-merge); ``incremental_ingest`` is the
source side of a task: base query/table -> watermark bounds -> range filter.
Each step is a DataFrame function; only the final save writes.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from lakehand.operators.incremental import incremental_load
from lakehand.operators.shape import sanitize_columns, trusted_query
from lakehand.sinks.keyed import KeyedTable
from lakehand.sources.files import register_raw


def raw_load(spark: SparkSession, task: dict, raw_path: str, fmt: str | None = None) -> DataFrame:
    """(re)register the landed folder of ``raw_path`` as the external table ``raw_<schema>_<table>``."""
    return register_raw(spark, task, raw_path, fmt=fmt)[0]


def trusted_load(spark: SparkSession, task: dict, raw: DataFrame, table: KeyedTable) -> None:
    """F3 + F4 + D8: clean column names, apply the optional trusted query (which
    sees the cleaned frame, N21), then overwrite (no key) or upsert on the key."""
    df = sanitize_columns(raw, style="trusted")
    ext = json.loads(task.get("ExtendedProperties") or "{}")
    df = trusted_query(spark, ext.get("TrustedQuery"), df)
    bk = task.get("BusinessKeyColumn")
    if not bk:
        table.overwrite(df)
    else:
        table.upsert(df, bk)


def incremental_ingest(spark: SparkSession, task: dict, source: DataFrame | None = None,
                       include_min: bool = True):
    """Source side of a load task: the manifest query (or ``source``), then the
    watermark range after the task's low mark.  Returns (rows, low, high)."""
    df = source if source is not None else spark.sql(task["SourceQuery"])
    return incremental_load(df, task.get("WatermarkColumn"), task.get("LowWatermark"), include_min)
