"""Table writers: files with a registered table over them, appends with schema merge, inserts by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def union_schema_merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """K2: append with schema merge (columns missing on either side become NULL)."""
    return old.unionByName(new, allowMissingColumns=True)


def add_columns(spark: SparkSession, name: str, schema: T.StructType) -> list[str]:
    """K2: add the columns of ``schema`` that the registered table ``name`` lacks; returns their names.

    Rows written before show NULL there.  Names are compared as the catalog does, without
    regard to case; a column of the same name and another type is an error.
    """
    have = {f.name.lower(): f.dataType for f in spark.table(name).schema.fields}
    for f in schema.fields:
        known = have.get(f.name.lower())
        if known is not None and known != f.dataType:
            raise ValueError(f"{name}.{f.name} is {known.simpleString()}, the new rows have {f.dataType.simpleString()}")
    new = [f for f in schema.fields if f.name.lower() not in have]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
    return [f.name for f in new]


def write_table(df: DataFrame, path: str, name: str | None = None, mode: str = "overwrite",
                partition_by=None, fmt: str = "parquet") -> None:
    """K1/K2/K5: write files, then register an external table over them.

    An append's new columns are added to the registered table, an overwrite's schema
    replaces it; partitions that the write made are registered too.
    """
    spark = df.sparkSession
    known = bool(name) and spark.catalog.tableExists(name)
    if known and mode == "append":
        add_columns(spark, name, df.schema)
    w = df.write.mode(mode).format(fmt).option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    if not name:
        return
    if known and mode == "overwrite":
        spark.sql(f"DROP TABLE {name}")      # external: the files stay
        known = False
    if not known:
        files = spark.read.option("mergeSchema", "true").format(fmt).load(path)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)
        parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt}{parts} LOCATION '{path}'")
    if partition_by:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)


def save_as_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """K5: CTAS-style overwrite of a catalog table."""
    df.write.mode(mode).format(fmt).saveAsTable(name)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Read an append-with-schema-merge folder (K2)."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def insert_into(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """K4: positional insert, after selecting the target's columns *by name*."""
    cols = df.sparkSession.table(table).columns
    df.select(*cols).write.insertInto(table, overwrite=overwrite)


def land_parquet(df: DataFrame, path: str, partition_by=None) -> None:
    """Landing conversion to snappy Parquet."""
    write_table(df, path, mode="overwrite", partition_by=partition_by)
