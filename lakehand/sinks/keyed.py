"""Keyed tables: plain Parquet, of which a merge rewrites only the buckets its batch touches.

A table is one folder partitioned by Spark's own writer into

* ``_part``: ``current`` (the current versions) or ``closed-<batch start>`` (the rows
  that batch closed), and
* ``_of<n>``: the hash bucket of the business key, ``n`` buckets in all.  The column's
  name carries ``n``, so a table that is opened again needs no other description.

A save reads the touched buckets (partition pruning), merges, and writes them back with
dynamic partition overwrite: Spark's commit replaces the partitions that were written and
leaves all others alone.  Closed rows go to partitions of their own batch and are never
rewritten.  A save that died is repeated with the same start and gives the same table:
what was replaced before is found unchanged, and the batch's partitions are written anew.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakehand.constants import SCD_CREATED, SCD_CURRENT, SCD_ENDED
from lakehand.operators.keys import _as_list, check_unique_keys, key_time_text
from lakehand.operators.scd import ACTION, _ts, evolve_target, scd1_upsert, scd2_apply, wrap_system_columns
from lakehand.sources.files import path_exists

PART, CURRENT = "_part", "current"
_BUCKET = re.compile(r"_of(\d+)")


class KeyedTable:
    """A type 2, upserted or overwritten table on a business key (one column or several).

    ``buckets`` counts for a new table; choose it so that a bucket is about a gigabyte.
    ``name``: the table is also a view of this name, refreshed by every save.
    """

    def __init__(self, spark: SparkSession, root: str, keys=(), buckets: int = 64, name: str | None = None):
        self.spark, self.root, self.name = spark, root.rstrip("/"), name
        self.keys = _as_list(keys)
        self.buckets = buckets
        #: Rows inserted, closed and written by the last save.
        self.last_metrics: dict = {}

    def exists(self) -> bool:
        return path_exists(self.spark, self.root)

    def _stored(self) -> tuple[DataFrame, str]:
        """All rows with their partition columns, and the bucket column."""
        df = self.spark.read.option("mergeSchema", "true").parquet(self.root)
        column = next(c for c in df.columns if _BUCKET.fullmatch(c))
        return df, column

    def read(self, as_of=None) -> DataFrame:
        """The table, or the versions that held at ``as_of``."""
        df, column = self._stored()
        df = df.drop(PART, column)
        if as_of is None:
            return df
        at = _ts(as_of)
        return df.where((F.col(SCD_CREATED) <= at) & (F.col(SCD_ENDED).isNull() | (F.col(SCD_ENDED) >= at)))

    def _bucket(self, n: int) -> Column:
        """The key's bucket; the key's text is hashed, so that a key of another integer type is the same."""
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(n)).cast("int")

    def _write(self, df: DataFrame, part: Column, column: str, partitions: int, replace: bool = False) -> None:
        n = int(_BUCKET.fullmatch(column).group(1))
        out = df.withColumn(PART, part).withColumn(column, self._bucket(n))
        (out.repartition(max(1, partitions), PART, column).write.mode("overwrite")
         .option("partitionOverwriteMode", "static" if replace else "dynamic")
         .partitionBy(PART, column).parquet(self.root))
        if self.name:
            self.read().createOrReplaceTempView(self.name)

    def _touched(self, source: DataFrame) -> tuple[DataFrame, str, int]:
        """The stored rows of the source's buckets, the bucket column and how many buckets they are."""
        stored, column = self._stored()
        n = int(_BUCKET.fullmatch(column).group(1))
        ids = [r[0] for r in source.select(self._bucket(n)).distinct().collect()]      # n numbers at most
        return stored.where(F.col(column).isin(ids)), column, len(ids)

    def overwrite(self, df: DataFrame) -> None:
        """K1/K3: replace the whole table."""
        self._write(df, F.lit(CURRENT), f"_of{self.buckets}", self.buckets, replace=True)

    def upsert(self, df: DataFrame, keys=None) -> None:
        """Create on the first call, afterwards replace the rows of the source's keys."""
        self.keys = _as_list(keys) if keys else self.keys
        if not self.keys:
            raise ValueError("an upsert needs the business key columns")
        if not self.exists():
            self._write(df, F.lit(CURRENT), f"_of{self.buckets}", self.buckets, replace=True)
            return
        stored, column, count = self._touched(df)
        self._write(scd1_upsert(stored.drop(PART, column), df, self.keys), F.lit(CURRENT), column, count)

    def save_scd2(self, source: DataFrame, bk=None, sk: str | None = None, start=None, end=None, on_duplicate: str = "error",
                  hash_method: str | None = None, with_batch_key: bool = False, evolve: bool = False,
                  batch_id: str | None = None, **kw) -> bool:
        """Type 2 save; options hold from the first load on.  Returns whether it was done.

        With a ``batch_id`` the save is delivered once: ids of finished saves are kept beside the
        table, and a batch whose id is there is skipped.  A batch that died between the two is
        saved again, which changes nothing.
        """
        self.keys = _as_list(bk) if bk else self.keys
        if batch_id is not None and self.delivered(batch_id):
            return False
        check_unique_keys(source, self.keys, on_duplicate)
        start_c = _ts(start)
        if not self.exists():
            merged = wrap_system_columns(source, self.keys, sk, start_c, end, hash_method, with_batch_key)
            merged = merged.withColumn(ACTION, F.lit("insert"))
            column, count = f"_of{self.buckets}", self.buckets
        else:
            stored, column, count = self._touched(source)
            target = stored.drop(PART, column)
            if evolve:
                target = evolve_target(target, source, self.keys, sk)
            no_key = F.coalesce(*[F.when(F.col(k).isNull(), True) for k in self.keys], F.lit(False))
            # rows without a key match nothing: those of a first attempt at this batch come again
            target = target.where(~(no_key & (F.col(SCD_CREATED) == start_c)))
            merged = scd2_apply(target, source, self.keys, sk, start_c, end, hash_method=hash_method, with_action=True, **kw)
            merged = merged.where((F.col(ACTION) != "history") | (F.col(SCD_CURRENT) == 1))
        seen = Observation()
        merged = merged.observe(seen, F.count_if(F.col(ACTION) == "insert").alias("InsertCount"),
                                F.count_if(F.col(ACTION) == "close").alias("UpdateCount"),
                                F.count(F.lit(1)).alias("WrittenCount")).drop(ACTION)
        part = F.when(F.col(SCD_CURRENT) == 1, F.lit(CURRENT)).otherwise(F.concat(F.lit("closed-"), key_time_text(start_c)))
        self._write(merged, part, column, count)
        self.last_metrics = seen.get
        if batch_id is not None:
            self.spark.createDataFrame([(batch_id,)], "batch_id string").coalesce(1).write.mode("append").parquet(self._ledger)
        return True

    @property
    def _ledger(self) -> str:
        return f"{self.root}-batches"

    def delivered(self, batch_id: str) -> bool:
        """Whether a save with this id has finished."""
        if not path_exists(self.spark, self._ledger):
            return False
        return not self.spark.read.parquet(self._ledger).where(F.col("batch_id") == batch_id).isEmpty()
