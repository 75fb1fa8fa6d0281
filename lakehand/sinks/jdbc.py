"""JDBC sinks (K7, K8, K9)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict | None = None,
               truncate: bool = True, batch_size: int = 10000, num_partitions: int | None = None) -> None:
    """Append or overwrite a table (K7).  ``overwrite`` truncates an existing table
    instead of dropping it (K9: truncate if it exists, auto-create otherwise)."""
    w = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table) \
        .option("batchsize", str(batch_size)).option("truncate", str(truncate).lower())
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def publish_staged(df: DataFrame, stage_path: str, url: str, table: str, mode: str = "overwrite",
                   properties: dict | None = None) -> None:
    """K8 re-aimed: stage the rows as Parquet in the lake (the reference's warehouse
    bulk-load input), then load the target over JDBC from the staged copy."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(stage_path)
    write_jdbc(df.sparkSession.read.parquet(stage_path), url, table, mode, properties)
