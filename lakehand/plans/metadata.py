"""Generated SQL from captured source metadata (V5) and its write-back (V6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehand.constants import (CREATE_SCHEMA_SQL, EXTERNAL_DATA_SOURCE, EXTERNAL_FILE_FORMAT,
                                EXTERNAL_SCHEMA_MAP)
from lakehand.sources.metadata import explode_metadata


def _ext_schema(system: Column) -> Column:
    out = None
    for k, v in EXTERNAL_SCHEMA_MAP.items():
        out = (F.when(system == k, F.lit(v)) if out is None else out.when(system == k, F.lit(v)))
    return out.otherwise(system)


def _create_schema(name: Column) -> Column:
    before, after = CREATE_SCHEMA_SQL.split("{schema}")
    return F.concat(F.lit(before), name, F.lit(after))


def _size(dtype: Column, length: Column, prec: Column, scale: Column) -> Column:
    s = lambda c: F.coalesce(c.cast("string"), F.lit(""))  # noqa: E731  (CONCAT treats NULL as '')
    return (F.when(dtype.endswith("char") | dtype.endswith("binary"),
                   F.concat(F.lit("("), F.when(length == -1, F.lit("MAX")).otherwise(s(length)), F.lit(")")))
             .when(dtype.isin("numeric", "decimal"), F.concat(F.lit("("), s(prec), F.lit(","), s(scale), F.lit(")")))
             .when(dtype == "datetime2", F.lit("(7)"))
             .otherwise(F.lit("")))


def _clean(name: Column) -> Column:
    return F.regexp_replace(name, r"[ ,()]", "_")


def _ordered_join(pos: Column, text: Column) -> Column:
    """Texts of a group joined by ',' in ordinal order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(pos.alias("p"), text.alias("t")))),
                                    lambda x: x["t"]), ",")


def generated_sql(manifest: DataFrame) -> DataFrame:
    """V5: per source table the create-schema, create-table, select and external-table texts.

    ``manifest`` rows: SystemCode, SourceSchema, SourceTableName, SourceMetaData (JSON), ExtendedProperties.
    """
    base = explode_metadata(manifest.select("SystemCode", "ExtendedProperties", "SourceMetaData"))
    coldef = F.concat(F.lit("["), F.col("COLUMN_NAME"), F.lit("] ["), F.col("DATA_TYPE"), F.lit("]"),
                      _size(F.col("DATA_TYPE"), F.col("CHARACTER_MAXIMUM_LENGTH"), F.col("NUMERIC_PRECISION"),
                            F.col("NUMERIC_SCALE")),
                      F.lit(" "), F.when(F.col("IS_NULLABLE") == "NO", F.lit("NOT NULL")).otherwise(F.lit("NULL")))
    selcol = F.concat(F.lit("["), F.col("COLUMN_NAME"), F.lit("] ["), _clean(F.col("COLUMN_NAME")), F.lit("]"))
    pos = F.col("ORDINAL_POSITION").cast("int")
    g = (base.groupBy("SystemCode", "ExtendedProperties", F.col("TABLE_SCHEMA").alias("TableSchema"),
                      F.col("TABLE_NAME").alias("TableName"))
         .agg(_ordered_join(pos, coldef).alias("__cols"), _ordered_join(pos, selcol).alias("__sel")))
    sc, tb = F.col("TableSchema"), F.col("TableName")
    g = g.select(
        "SystemCode", "ExtendedProperties", "TableSchema", "TableName",
        _create_schema(sc).alias("CreateSchema"), _create_schema(_ext_schema(F.col("SystemCode"))).alias("CreateExternalSchema"),
        F.concat(F.lit("CREATE TABLE ["), sc, F.lit("].["), tb, F.lit("] ("), F.col("__cols"), F.lit(")"))
        .alias("CreateTableSQL"), "__cols",
        F.concat(F.lit("SELECT "), F.col("__sel"), F.lit(" FROM ["), sc, F.lit("].["), tb, F.lit("] "))
        .alias("SelectSQL"))
    ext = manifest.select(
        F.col("SystemCode").alias("__sys"), F.col("SourceSchema").alias("__ss"), F.col("SourceTableName").alias("__st"),
        F.get_json_object("ExtendedProperties", "$.SynapseTableSchema").alias("SynapseTableSchema"),
        F.get_json_object("ExtendedProperties", "$.SynapseTableName").alias("SynapseTableName"),
        F.col("ExtendedProperties").alias("__ep")).where(F.col("__ep").isNotNull())
    j = g.join(ext, (g["SystemCode"] == ext["__sys"]) & (g["TableSchema"] == ext["__ss"])
               & (g["TableName"] == ext["__st"]), "left")
    has_ext = F.coalesce(F.length("ExtendedProperties"), F.lit(0)) >= 1
    tname = F.when(has_ext, F.coalesce(F.col("SynapseTableName"), F.lit(""))).otherwise(tb)
    sname = F.when(has_ext, F.coalesce(F.col("SynapseTableSchema"), F.lit(""))).otherwise(_ext_schema(F.col("SystemCode")))
    stmt = F.concat(F.lit("CREATE EXTERNAL TABLE ["), sname, F.lit("].[ext_"), tname, F.lit("] ("), F.col("__cols"),
                    F.lit(") WITH (LOCATION ='/external-tables/"), F.col("SystemCode"), F.lit("/"), sc, F.lit("_"), tb,
                    F.lit(f"/' ,DATA_SOURCE = [{EXTERNAL_DATA_SOURCE}], FILE_FORMAT = [{EXTERNAL_FILE_FORMAT}] )"))
    return j.select(*[c for c in g.columns if c != "__cols"], stmt.alias("CreateExternalTableSQL"))


def refresh_manifest(manifest: DataFrame, generated: DataFrame) -> DataFrame:
    """V6: write the generated select back as the source query of the same system, schema and table.

    A table generated more than once (its extended properties differ) gives one select,
    the least text, so no manifest row is multiplied.
    """
    keys = {"SystemCode": "SystemCode", "SourceSchema": "TableSchema", "SourceTableName": "TableName"}
    gen = generated.groupBy(*[F.col(g).alias(f"__{m}") for m, g in keys.items()]).agg(F.min("SelectSQL").alias("__select"))
    on = [F.col(m) == F.col(f"__{m}") for m in keys]
    j = manifest.join(gen, on[0] & on[1] & on[2], "left")
    return j.select(*[F.coalesce("__select", c).alias(c) if c == "SourceQuery" else F.col(c) for c in manifest.columns])
