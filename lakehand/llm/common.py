"""Shared helpers: reading documents, tables cut into the shared folder, native column idioms."""

from __future__ import annotations

import ctypes
import functools
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import lakehand
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehand.session import shared_dir

#: A word of every contract: a maximal run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Bytes and rows of a batch that Spark hands to a Python task; a task's memory follows them.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 2000


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per Spark context, so Python tasks can import it
    wherever the driver found it (as ``--py-files`` would), and bound the session's Arrow batches."""
    for key, most in (("maxBytesPerBatch", BATCH_BYTES), ("maxRecordsPerBatch", BATCH_ROWS)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(key).rstrip("bB")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))
    sc = spark.sparkContext
    if getattr(sc, "_lakehand_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(lakehand.__file__)))
    if os.path.isdir(root):
        folder = tempfile.mkdtemp(prefix="lakehand-ship-")
        sc.addPyFile(shutil.make_archive(f"{folder}/lakehand_package", "zip", root, "lakehand"))
    sc._lakehand_shipped = True


#: Caches that tasks keep in their Python worker for the next task.
_caches: list[dict] = []


def worker_cache() -> dict:
    """A dict that lives as long as its Python worker, which Spark reuses for tasks of any operator, or
    until ``release``."""
    _caches.append({})
    return _caches[-1]


def trim() -> None:
    """Hand memory that is free, but held by Arrow's or C's allocator, back to the system."""
    pa.default_memory_pool().release_unused()
    if hasattr(ctypes.CDLL(None), "malloc_trim"):     # glibc
        ctypes.CDLL(None).malloc_trim(0)


def release() -> None:
    """Give back what earlier tasks, other operators' too, keep in this worker."""
    for cache in _caches:
        cache.clear()
    trim()


def released(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``rows`` for ``mapInArrow``, run in a worker that holds nothing of earlier tasks.

    For operators that keep nothing themselves: beside them, an executor need not hold an
    earlier operator's tokenizer and words, nor after them what their batches took.
    """
    @functools.wraps(rows)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        yield from rows(batches)
        trim()
    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str = "part") -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the files.

    Cuts the lineage like a reliable checkpoint (lost executors lose nothing), but
    columnar and compressed, so later steps read only the columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lakehand-{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def open_folder(uri: str):
    """(file system, path) of a folder's URI, for tasks that write or read files of a format Spark has no
    source for.  Works in the driver and in tasks; the scheme decides on the store."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


class Scratch:
    """Frames that an operator writes to read them again; ``clear`` deletes them when nothing will."""

    def __init__(self, spark: SparkSession, name: str):
        self.path = f"{shared_dir(spark)}/lakehand-{name}-{uuid.uuid4().hex}"
        self._spark, self._made, self._tables = spark, 0, []

    def written(self, df: DataFrame, name: str = "part") -> DataFrame:
        """As ``written``, in a folder of this scratch."""
        path = f"{self.path}/{self._made}-{name}"
        self._made += 1
        df.write.mode("errorifexists").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, key: str, only: DataFrame, name: str = "rows") -> DataFrame:
        """The rows of ``df`` whose ``key`` is in ``only``, written in hash buckets of the key: the rows
        are shuffled once, later joins on the key read them where they lie."""
        n = int(self._spark.conf.get("spark.sql.shuffle.partitions"))
        table = f"lakehand_{name}_{uuid.uuid4().hex}"
        rows = df.where(F.col(key).isNotNull()).repartition(n, key).join(only.select(key).distinct().repartition(n, key), key, "left_semi")
        self._tables.append(table)
        self._made += 1
        rows.write.bucketBy(n, key).sortBy(key).option("path", f"{self.path}/{name}").saveAsTable(table)
        return self._spark.table(table)

    def clear(self) -> None:
        for table in self._tables:
            self._spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._tables.clear()
        store, path = open_folder(self.path)
        if self._made:
            store.delete_dir(path)
        self._made = 0


#: A key with more than this share of all rows is hot, so there are at most 1 / HOT_SHARE hot keys.
HOT_SHARE = 1 / 1000


def hot_safe_lookup(rows: DataFrame, table: DataFrame, key: str, spread: str, scratch: Scratch | None = None) -> DataFrame:
    """``rows`` left joined with ``table`` on ``key`` without a hot task.

    ``table`` has one row per key, the number of rows that hold it as ``n`` and columns ``rows`` does
    not have.  Keys with more than a thousandth of these rows, so a thousand keys at most, are
    broadcast; their rows are dealt by ``spread`` in the join of the others.
    """
    table = (scratch or Scratch(rows.sparkSession, "lookup")).written(table, "lookup")
    held = table.agg(F.sum("n")).first()[0] or 0
    values = [c for c in table.columns if c not in (key, "n")]
    names = ["hot" + c for c in values]
    hot = table.where(F.col("n") > held * HOT_SHARE).select(F.col(key).alias("hotkey"), *[F.col(c).alias(n) for c, n in zip(values, names)])
    cold = table.where(F.col("n") <= held * HOT_SHARE).select(F.col(key).alias("coldkey"), *values)
    first = rows.join(F.broadcast(hot), F.col(key) == F.col("hotkey"), "left")
    # hot rows are in no partition of their key: the second join key deals them, and matches nothing
    dealt = F.when(F.col("hotkey").isNull() & F.col(key).isNotNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(spread).bitwiseOR(F.lit(1)))
    cold = cold.withColumn("colddealt", F.lit(0).cast("long"))
    both = first.withColumn("dealt", dealt).join(cold, (F.col(key) == F.col("coldkey")) & (F.col("dealt") == F.col("colddealt")), "left")
    return both.select(*rows.columns, *[F.coalesce(n, c).alias(c) for c, n in zip(values, names)])


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` uses it in a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_array(text: Column) -> Column:
    """Words of a text in order; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def free(columns: list[str], name: str) -> str:
    """``name``, with underscores behind it until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Elements of an array that ``running`` takes at a time.
_RUN = 128


def running(values: Column, combine, zero: Column) -> Column:
    """Running ``combine`` of an array, each element with all before it.

    An array grows by copying, so one that grows by an element for each of a million
    values would take half a trillion copies.  Runs of ``_RUN`` elements are made first,
    then what stands before each run, then both are put together.
    """
    kind = F.array(zero)

    def grow(index: Column, value) -> Column:
        start = F.struct(zero.alias("last"), F.slice(kind, 1, 0).alias("out"))
        return F.aggregate(index, start, lambda a, i: F.struct(
            combine(a["last"], value(i)).alias("last"), F.concat(a["out"], F.array(combine(a["last"], value(i)))).alias("out")), lambda a: a["out"])

    def whole(v: Column) -> Column:
        n = F.size(v)
        runs = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / _RUN).cast("int")), lambda k: grow(
            F.sequence(k * _RUN, F.least((k + 1) * _RUN, n) - 1), lambda i: F.get(v, i)))

        def joined(r: Column) -> Column:
            before = grow(F.sequence(F.lit(0), F.size(r) - 1), lambda k: F.when(k == 0, zero).otherwise(F.element_at(F.get(r, k - 1), -1)))
            return let(before, lambda b: F.flatten(F.transform(r, lambda x, k: F.transform(x, lambda y: combine(F.get(b, k), y)))))
        return F.when(n == 0, F.slice(kind, 1, 0)).otherwise(let(runs, joined))

    return let(values, whole)


#: Characters of a block of ``blocks``.
BLOCK = 4096


def blocks(text: Column) -> Column:
    """A text in blocks of ``BLOCK`` characters, so that a place in it is found without counting from its start."""
    return F.when(F.length(text) <= BLOCK, F.array(text)).otherwise(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)))


def cut(pieces: Column, start: Column, length: Column) -> Column:
    """``length`` characters from ``start`` (0-based) of a text in ``blocks``."""
    def part(k: Column) -> Column:
        begin = F.greatest(start - k * BLOCK, F.lit(0))
        return F.substring(F.get(pieces, k), begin + 1, F.least(start + length - k * BLOCK, F.lit(BLOCK)) - begin)

    of = lambda at: F.floor(at / BLOCK).cast("int")
    last = F.least(of(start + length - 1), F.size(pieces) - 1)
    return F.when((length <= 0) | (of(start) > last), F.lit("")).otherwise(
        F.array_join(F.transform(F.sequence(of(start), last), part), ""))


def span_starts(gaps: Column, hits: Column) -> Column:
    """Start of every match in code points: the text before, between and after the matches
    (``split``) and the matches themselves (``regexp_extract_all``) alternate."""
    steps = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.length(g) + F.length(h))
    return F.zip_with(running(steps, lambda x, y: x + y, F.lit(0)), hits, lambda end, h: end - F.length(h))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as array<struct<start,end,hit,part>>.

    ``start`` and ``end`` count code points, ``end`` exclusive; ``part`` is the text of
    ``group``.  The pattern must match the same on ``split`` and ``regexp_extract_all``
    (both run the same find loop) and never match the empty string.
    """
    p = F.lit(pattern)
    empty = F.array().cast("array<struct<start:int,end:int,hit:string,part:string>>")

    def spans(hits):
        rows = F.zip_with(span_starts(F.split(text, pattern, -1), hits), hits,
                          lambda s, h: F.struct(s.alias("start"), (s + F.length(h)).alias("end"),
                                                h.alias("hit"), h.alias("part")))
        if group:
            rows = F.zip_with(rows, F.regexp_extract_all(text, p, F.lit(group)),
                              lambda r, g: F.struct(r["start"].alias("start"), r["end"].alias("end"),
                                                    r["hit"].alias("hit"), g.alias("part")))
        return F.when(F.size(hits) == 0, empty).otherwise(rows)

    return let(F.regexp_extract_all(text, p, F.lit(0)), spans)
