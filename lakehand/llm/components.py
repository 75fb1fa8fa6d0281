"""Connected components of an edge table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehand.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(id, label): the smallest id reachable from every id of ``edges`` (a, b).

    Each round an id takes the least label among its neighbours (a grouped minimum,
    combined before the shuffle, so a hub with millions of edges is no hot key) and
    then the label of that label; the rounds grow with the logarithm of the diameter.
    Labels are written to the shared folder after each round.  Null ids and self-loops link
    nothing, an id that has no other edge is in no row, repeated edges count once, and a
    table without edges gives no rows.
    """
    written = (scratch or Scratch(edges.sparkSession, "components")).written
    edges = edges.where("a <> b")
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                   "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("b"))
                     .select(F.col("a").alias("id"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("id").alias("b"), F.col("label").alias("near")), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("near").alias("near")))
        step = labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("far"))
        labels = written(step.join(jump, "label", "left").select(
            "id", "old", F.least("label", F.coalesce("far", "label")).alias("label")), "labels")
        if labels.where("label <> old").isEmpty():
            return labels.select("id", "label")
