"""Token-id files: whole texts as ids in Simple-8b blocks, in ascending doc_id order.

File format: a folder of Parquet files; each row holds the ids of successive
documents ("run") as Simple-8b words with the word offset of every block.  Parquet
gives the commit protocol (a lost executor's half-written files never count) and
works on every store Spark writes to.  The range partition's number ("shard") and the
run's number in it ("run") order the rows; no row depends on another.

Edge cases: null and empty texts encode to the end id alone; a null doc_id sorts
first; rows that share a doc_id are ordered by text; a table without rows gives none;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakehand.llm import simple8b
from lakehand.llm.common import ship
from lakehand.llm.tokens import default_path, encoder

#: Documents per run, and ids decoded at a time: the blocks that hold some successive documents.
RUN_DOCS, DECODE_IDS = 512, 1 << 18

_RUNS = ("shard int, run int, doc_ids array<long>, doc_tokens array<long>, n_ids long, "
         "block_words binary, words binary")
_DOCS = "shard int, run int, pos int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def ids_crc32(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))


def encode_runs(path: str, end_id: int):
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, run = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            encoded = enc.encode(batch.column("text"))
            for at in range(0, batch.num_rows, RUN_DOCS):
                part = batch.slice(at, RUN_DOCS)
                docs = [np.append(ids, np.uint32(end_id)) for ids in encoded[at:at + RUN_DOCS]]
                ids = np.concatenate(docs)
                words, offsets = simple8b.encode(ids)
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([shard], pa.int32()), "run": pa.array([run], pa.int32()),
                    "doc_ids": pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    "doc_tokens": pa.array([[len(d) for d in docs]], pa.list_(pa.int64())),
                    "n_ids": pa.array([len(ids)], pa.int64()),
                    "block_words": pa.array([offsets.astype("<u4").tobytes()], pa.binary()),
                    "words": pa.array([words.astype("<u8").tobytes()], pa.binary())})
                run += 1
    return runs


def write_tokens(docs: DataFrame, out: str, tokenizer: str | None = None, end_id: int = 2) -> None:
    """Encode ``docs`` (doc_id, text) and write the token files to the folder ``out``."""
    ship(docs.sparkSession)
    ordered = (docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id")
               .sortWithinPartitions("doc_id", "text"))
    ordered.mapInArrow(encode_runs(tokenizer or default_path(), end_id), _RUNS).write.parquet(out)


def decode_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            words, offsets = np.frombuffer(row["words"], "<u8"), np.frombuffer(row["block_words"], "<u4")
            bounds = np.concatenate([[0], np.cumsum(row["doc_tokens"])]).astype(np.int64)
            n, crcs, at = len(bounds) - 1, [], 0
            while at < n:       # documents of DECODE_IDS ids, or one that has more
                to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + DECODE_IDS, "right")) - 1)
                ids = simple8b.decode_range(words, offsets, int(bounds[at]), int(bounds[to])).astype("<u4")
                own = bounds[at:to + 1] - bounds[at]
                crcs += [ids_crc32(ids[a:b]) for a, b in zip(own[:-1], own[1:])]
                at = to
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([row["shard"]] * n, pa.int32()), "run": pa.array([row["run"]] * n, pa.int32()),
                "pos": pa.array(range(n), pa.int32()),
                "doc_id": pa.array(row["doc_ids"], pa.int64()), "local_start": pa.array(bounds[:-1]),
                "n_tokens": pa.array(np.diff(bounds)),
                "ids_crc32": pa.array(crcs, pa.int64())})


def read_tokens(spark, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32.

    Starts are prefix sums in two levels (runs of a shard, then shards), so no task
    sees more than the runs of one shard or one row per shard.
    """
    ship(spark)
    files = spark.read.schema(_RUNS).parquet(folder)
    docs = files.mapInArrow(decode_runs, _DOCS)
    sizes = files.select("shard", "run", "n_ids")
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    shards = shards.select("shard", before(Window.orderBy("shard")).alias("shard_start"))
    runs = sizes.select("shard", "run", before(Window.partitionBy("shard").orderBy("run")).alias("run_start"))
    return (docs.join(runs.join(shards, "shard"), ["shard", "run"])
            .select("doc_id", (F.col("shard_start") + F.col("run_start") + F.col("local_start")).alias("start"),
                    "n_tokens", "ids_crc32"))
