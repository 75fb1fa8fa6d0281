"""Session creation and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job wants: AQE for runtime re-planning (coalescing, skew
# splitting, broadcast conversion), UTC so timestamps are stable, no UI.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str = "lakehand", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with the defaults above.

    ``master`` is only applied when building a new local session (tests, bench);
    on a cluster the launcher decides.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    The session setting wins.  A fallback is only used where the setting is
    unset (tests); it is then also installed on the SparkContext so that
    ``DataFrame.checkpoint()`` works.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir() if hasattr(spark.sparkContext, "getCheckpointDir") else None
    if not d:
        if fallback is None:
            raise RuntimeError("spark.checkpoint.dir is not set; pass a shared fallback folder")
        d = fallback
        os.makedirs(d, exist_ok=True) if d.startswith("/") else None
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df, spark: SparkSession | None = None):
    """Reliable checkpoint into the shared folder (see ``shared_dir``)."""
    spark = spark or df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor and the driver can write to: ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one process, may go without
    it and gets a temporary folder; a cluster that names none is an error.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="lakehand-")
        sc.setCheckpointDir(d)
    return d
