"""The corpus pipeline: score, deduplicate, redact, mix and pack ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``; so a lost executor costs no more
than part of one stage.  All stages but the last return the columns of ``docs``, extra
ones included.

Edge cases: null and empty texts are scored like any other, are never near duplicates,
hold no personal data, and are mixed without counting a token; a document whose copies
are all left out by the mix does not reach the packing; an empty table gives no pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehand.llm import mixing, near_dedup, packing, pii, quality_classifier
from lakehand.llm.common import documents, free, open_folder
from lakehand.session import shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it is fitted on the labels' training folds."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stats = quality_classifier.document_stats(docs)
    model = quality_classifier.fit(stats, quality_classifier.quality_labels(labels))
    name = free(docs.columns, "_score")
    kept = quality_classifier.scored(docs, model, name).where(F.col(name) >= quality_classifier.THRESHOLD)
    return kept.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return near_dedup.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets."""
    return pii.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its leaf of the weight tree takes it."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences and their places."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mixing", mix),
    ("packing", pack),
]

#: Scores, tokens and sketches cannot be stated in SQL; tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's files go when the next one's are written."""
    folder = f"{shared_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    store, root = open_folder(folder)
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if k:
            store.delete_dir(f"{root}/{k - 1}")
    return docs
