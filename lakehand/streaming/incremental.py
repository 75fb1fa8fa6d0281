"""Optional Structured Streaming delivery of the incremental load.

The reference runs scheduled batches bounded by a stored high-water mark.  The
same load as a stream: a file source read with ``trigger(availableNow=True)``
processes exactly the files not yet seen (the checkpoint replaces the stored
mark), and ``foreachBatch`` applies the type 2 save to each micro-batch.
The checkpoint must live in the shared checkpoint folder.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakehand.operators.keys import _as_list
from lakehand.session import cut_lineage


def read_landing_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def scd2_stream(stream: DataFrame, table, bk, sk: str, checkpoint: str, dedupe_by: str | None = None,
                start_col: str | None = None):
    """Start an availableNow query that saves each micro-batch into ``table``
    (a :class:`lakehand.sinks.keyed.KeyedTable`), each batch once.

    A batch that Spark delivers again after a failure has the same id and is skipped if it
    was finished, repeated without effect if it was not.  Within a micro-batch the last row
    per key wins when ``dedupe_by`` names an ordering column (``max_by`` per key, a partial
    aggregate); that column orders and is no attribute.  Rows with a NULL key match nothing
    and all stay.  The batch start is the micro-batch's largest ``start_col``, else the wall
    clock.  The batch is read once, into the shared folder.  Returns the StreamingQuery.
    """
    keys = _as_list(bk)

    def apply(batch: DataFrame, epoch: int):
        batch_id = f"{checkpoint.rstrip('/').rsplit('/', 1)[-1]}:{epoch}"
        if table.delivered(batch_id):
            return
        src = batch
        if dedupe_by:
            known = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
            rest = [c for c in batch.columns if c not in keys]
            last = (batch.where(known).groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(dedupe_by)).alias("r"))
                    .select(*keys, "r.*"))
            src = last.unionByName(batch.where(f"NOT ({known})"))
        src = cut_lineage(src)
        last = F.max(start_col) if start_col else F.lit(None)
        shape = src.agg(F.count(F.lit(1)).alias("rows"), last.alias("start")).first()
        if not shape["rows"]:
            return
        start = shape["start"] or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        table.save_scd2(src.drop(*[c for c in {dedupe_by, start_col} if c]), bk, sk, str(start)[:19], batch_id=batch_id)

    return (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
