"""Source schema capture (S17): column metadata rows and their JSON form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

META_FIELDS = ["TABLE_SCHEMA", "TABLE_NAME", "COLUMN_NAME", "ORDINAL_POSITION", "IS_NULLABLE", "DATA_TYPE",
               "CHARACTER_MAXIMUM_LENGTH", "NUMERIC_PRECISION", "NUMERIC_SCALE"]
META_SCHEMA = ("array<struct<TABLE_SCHEMA:string,TABLE_NAME:string,COLUMN_NAME:string,ORDINAL_POSITION:bigint,"
               "IS_NULLABLE:string,DATA_TYPE:string,CHARACTER_MAXIMUM_LENGTH:int,NUMERIC_PRECISION:int,"
               "NUMERIC_SCALE:int>>")


def _sql_type(dt: T.DataType):
    """Spark type -> (DATA_TYPE, max length, precision, scale) in the source's vocabulary."""
    if isinstance(dt, T.StringType):
        return "nvarchar", -1, None, None
    if isinstance(dt, T.BinaryType):
        return "varbinary", -1, None, None
    if isinstance(dt, T.DecimalType):
        return "decimal", None, dt.precision, dt.scale
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "datetime2", None, None, None
    simple = {T.IntegerType: "int", T.LongType: "bigint", T.ShortType: "smallint", T.ByteType: "tinyint",
              T.DoubleType: "float", T.FloatType: "real", T.BooleanType: "bit", T.DateType: "date"}
    for k, v in simple.items():
        if isinstance(dt, k):
            return v, None, None, None
    return "nvarchar", -1, None, None


def capture_schema(spark: SparkSession, df: DataFrame, schema: str, table: str) -> DataFrame:
    """Column metadata rows of a DataFrame's schema (one row per column; schema-sized)."""
    rows = []
    for i, f in enumerate(df.schema.fields, start=1):
        t, ln, p, s = _sql_type(f.dataType)
        rows.append((schema, table, f.name, i, "YES" if f.nullable else "NO", t, ln, p, s))
    return spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in zip(
        META_FIELDS, ["string", "string", "string", "bigint", "string", "string", "int", "int", "int"])))


def metadata_json(columns: DataFrame, group=("SystemCode", "TABLE_SCHEMA", "TABLE_NAME"),
                  extra=("ExtendedProperties",)) -> DataFrame:
    """Per table: its column rows as one JSON array in ordinal order (the manifest's
    SourceMetaData).  A group is one table's columns, bounded by its schema width."""
    cols = [F.col(c) for c in META_FIELDS]
    g = list(group)
    keyed = F.struct(F.col("ORDINAL_POSITION").alias("p"), F.col("COLUMN_NAME").alias("n"), F.struct(*cols).alias("r"))
    agg = [F.to_json(F.transform(F.array_sort(F.collect_list(keyed)), lambda x: x["r"]),
                     {"ignoreNullFields": "false"}).alias("SourceMetaData")]
    agg += [F.max(c).alias(c) for c in extra]
    return (columns.groupBy(*g).agg(*agg)
            .withColumnRenamed("TABLE_SCHEMA", "SourceSchema").withColumnRenamed("TABLE_NAME", "SourceTableName"))


def explode_metadata(manifest: DataFrame, json_col: str = "SourceMetaData") -> DataFrame:
    """Manifest rows -> one row per described column (CROSS APPLY OPENJSON; rows
    whose JSON has no elements vanish, J6)."""
    keep = [c for c in manifest.columns if c != json_col]
    return manifest.select(*keep, F.explode(F.from_json(F.col(json_col), META_SCHEMA)).alias("c")).select(*keep, "c.*")
