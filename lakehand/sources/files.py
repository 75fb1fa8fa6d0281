"""File sources: raw registration by format (S1-S5), borrowed-schema CSV (S6),
missing-file guard (S12), landed binaries (S11), landed JSON pages (S13), sheets (S16)."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = ("xml", "csv", "json", "parquet")

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": "\\"}


def detect_format(path: str, fmt: str | None = None, parity: bool = False) -> str:
    """Explicit format, else the real file extension.

    ``parity=True`` reproduces the reference: the first of xml/csv/json found
    anywhere in the path, else parquet.
    """
    if fmt:
        return fmt.lower()
    if parity:
        low = path.lower()
        return next((f for f in ("xml", "csv", "json") if f in low), "parquet")
    ext = os.path.splitext(path.rstrip("/"))[1].lstrip(".").lower()
    if ext in FORMATS:
        return ext
    if ext in ("", "snappy", "parq"):
        return "parquet"
    raise ValueError(f"cannot tell the format of {path!r}; pass fmt= (N25)")


def quotes_span_lines(spark: SparkSession, path: str, quote: str = '"', escape: str = "\\") -> bool:
    """Whether a quoted CSV field of ``path`` may hold a line break.

    One split scan of the lines: a line with an odd number of unescaped quotes opens or
    closes a field that goes on in another line.  Lines need no order for that, so every
    task looks at its own split; the first such line ends the scan.
    """
    text = F.col("value")
    bare = F.replace(F.replace(text, F.lit(2 * escape), F.lit("")), F.lit(escape + quote), F.lit(""))
    odd = (F.length(bare) - F.length(F.replace(bare, F.lit(quote), F.lit("")))) % 2 == 1
    return not spark.read.text(path).where(odd).isEmpty()


def documents_span_lines(spark: SparkSession, path: str) -> bool:
    """S3: whether the JSON of ``path`` is other than one object a line (a document over several
    lines, or an array).  Like :func:`quotes_span_lines`, line by line: a line that is not
    blank and no whole object tells."""
    text = F.trim(F.translate("value", "\r\t\ufeff", "  "))
    whole = text.startswith("{") & text.endswith("}") & F.try_parse_json(text).isNotNull()
    return not spark.read.text(path).where((text != "") & ~whole).isEmpty()


def source_options(spark: SparkSession, path: str, fmt: str, row_tag: str | None = None) -> dict:
    """The reader's options for a format.  A CSV or JSON file is read in splits unless a scan finds
    a record that spans lines; only then ``multiLine`` makes each file one task."""
    if fmt == "csv":
        return {**CSV_OPTIONS, "multiLine": str(quotes_span_lines(spark, path)).lower()}
    if fmt == "json":
        return {"multiLine": str(documents_span_lines(spark, path)).lower()}
    if fmt == "xml":
        if not row_tag:
            raise ValueError("xml needs rowTag (from the manifest's extended properties)")
        return {"rowTag": row_tag}
    return {}


def read_source(spark: SparkSession, path: str, fmt: str | None = None, options: dict | None = None,
                schema: T.StructType | str | None = None, row_tag: str | None = None,
                infer_schema: bool = True) -> DataFrame:
    """Read a landed file or folder with the options the format needs.

    ``options`` win; with ``multiLine`` among them the scan for spanning records is left out.
    """
    fmt = detect_format(path, fmt)
    given = options or {}
    if fmt in ("csv", "json") and "multiLine" in given:
        opts = dict(CSV_OPTIONS) if fmt == "csv" else {}
    else:
        opts = source_options(spark, path, fmt, row_tag)
    if fmt == "csv":
        opts["inferSchema"] = "true" if (infer_schema and schema is None) else "false"
    reader = spark.read.format(fmt).options(**{**opts, **given})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def register_raw(spark: SparkSession, task: dict, raw_path: str, fmt: str | None = None,
                 parity_format: bool = False, database: str | None = None, counted: bool = True) -> tuple[DataFrame, int | None]:
    """Register the *folder* of the landed file as the external table ``raw_<schema>_<table>``
    (``<database>.<schema>_<table>`` where a database is given); returns it and its row count.

    ``task`` is a manifest row as a dict (DestinationSchema, DestinationTableName,
    RawPath, ExtendedProperties).  Registering again replaces the table; the files are not
    touched.
    """
    folder = raw_path.rsplit("/", 1)[0] if os.path.splitext(raw_path)[1] else raw_path
    ext = json.loads(task.get("ExtendedProperties") or "{}")
    fmt = fmt or detect_format(task.get("RawPath") or raw_path, parity=parity_format)
    df = read_source(spark, folder, fmt=fmt, row_tag=ext.get("rowTag"))
    name = f"{task['DestinationSchema']}_{task['DestinationTableName']}"
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    name = f"`{database}`.`{name}`" if database else f"`raw_{name}`"
    options = {**source_options(spark, folder, fmt, ext.get("rowTag")), "path": folder}
    listed = ", ".join("'{}' '{}'".format(k, str(v).replace("\\", "\\\\").replace("'", "\\'")) for k, v in options.items()
                       if k != "inferSchema")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} OPTIONS ({listed})")
    table = spark.table(name)
    return table, table.count() if counted else None


def read_csv_borrowed_schema(spark: SparkSession, path: str, reference: DataFrame | T.StructType,
                             fill: str = "") -> DataFrame:
    """CSV read with the schema of another table; NULL strings become ``fill``."""
    schema = reference.schema if isinstance(reference, DataFrame) else reference
    df = read_source(spark, path, fmt="csv", schema=schema)
    return df.na.fill(fill)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check with the public reader: resolving a missing path raises
    ``PATH_NOT_FOUND`` when the DataFrame is created (only the listing runs)."""
    from pyspark.errors import AnalysisException
    try:
        spark.read.format("text").load(path)
        return True
    except AnalysisException as ex:
        if "PATH_NOT_FOUND" in str(ex) or "Path does not exist" in str(ex):
            return False
        raise


def read_optional(spark: SparkSession, path: str, schema: T.StructType, fmt: str | None = None,
                  **kw) -> tuple[DataFrame, str]:
    """Missing source -> empty frame of the declared schema and status ``Skipped``."""
    from lakehand.constants import STATUS_SKIPPED, STATUS_SUCCESS
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema), STATUS_SKIPPED
    return read_source(spark, path, fmt=fmt, schema=schema, **kw), STATUS_SUCCESS


def binary_inventory(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True,
                     with_content: bool = False) -> DataFrame:
    """Landed binary files (path, modificationTime, length[, content]).

    The byte transport itself (HTTP/SFTP/share copies) is outside Spark.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(path)
    return df if with_content else df.drop("content")


def read_json_pages(spark: SparkSession, path: str, prop: str = "Response",
                    element_schema: str | None = None) -> DataFrame:
    """One landed JSON document per page; rows = elements of ``prop``.

    ``element_schema`` (a DDL struct body such as ``"id bigint, name string"``)
    skips schema inference over all pages."""
    r = spark.read.option("multiLine", "true")
    if element_schema:
        r = r.schema(f"{prop} array<struct<{element_schema}>>")
    df = r.json(path)
    return explode_pages(df.withColumn("_page", F.input_file_name()), prop)


def explode_pages(pages: DataFrame, prop: str = "Response", page_col: str | None = None,
                  element_schema: str | None = None) -> DataFrame:
    """Rows of the array property ``prop`` of each page (pages with none vanish, J6).

    ``page_col`` names a JSON text column; otherwise ``prop`` is an already parsed column.
    """
    if page_col is not None:
        arr = F.from_json(F.col(page_col), f"struct<{prop}: array<{element_schema}>>")[prop]
    else:
        arr = F.col(prop)
    keep = [c for c in pages.columns if c not in (prop, page_col)]
    return pages.select(*keep, F.explode(arr).alias("item")).select(*keep, "item.*")


def read_sheet(spark: SparkSession, path: str, limit: int = 0, order_by: str | None = None) -> DataFrame:
    """Ingestion sheet (CSV) with a row limit; 0 means all rows."""
    from lakehand.operators.shape import limit_or_all
    return limit_or_all(read_source(spark, path, fmt="csv"), limit, order_by)
