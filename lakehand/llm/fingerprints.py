"""Bottom-k fingerprints: the ``K`` least hashes of a text's distinct word shingles.

Two sketches merge into the sketch of the union by taking the least values of both, so
parts of a text or a corpus can be sketched apart.  The union's sketch estimates the
resemblance (share of its values in both), the containment and the number of distinct
shingles; with fewer than ``K`` shingles all three are exact.  As text a fingerprint is
its values in ascending order, ten hexadecimal digits each.

DataFrame functions only.  Edge cases: a text with fewer words than a shingle has its
word sequence as its only shingle; texts without words have the empty fingerprint; two
empty fingerprints are alike (1), an empty and a filled one are not (0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakehand.llm.common import let, word_array

K = 128
WIDTH = 5
#: Bits of a hash; the estimate of distinct counts holds far below 2**HASH_BITS.
HASH_BITS = 40


def sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """The k least hashes of the shingles, ascending."""
    def of(words: Column) -> Column:
        n = F.size(words)
        one = F.array(F.xxhash64(n, words))
        many = F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(width)]))
        hashes = F.when(n == 0, F.array().cast("array<bigint>")).when(n < width, one).otherwise(many)
        return F.slice(F.array_sort(F.array_distinct(F.transform(hashes, lambda h: F.shiftrightunsigned(h, 64 - HASH_BITS)))), 1, k)
    return let(word_array(text), of)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def merged(parts: DataFrame, key: str, column: str, k: int = K) -> DataFrame:
    """One sketch per key from the sketches of its parts: duplicates go before the shuffle, and a
    key's values are ranked apart from its texts."""
    values = parts.select(key, F.explode_outer(column).alias("v")).distinct()
    rank = Window.partitionBy(key).orderBy("v")
    return (values.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= k).groupBy(key)
            .agg(F.array_sort(F.collect_list("v")).alias(column)))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    union = merge(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / F.greatest(F.size(union), F.lit(1)))


def distinct(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    full = (F.lit(float(k - 1)) * float(1 << HASH_BITS) / (F.element_at(a, -1) + 1))
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(full)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has."""
    both = resemblance(a, b, k) * distinct(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(both / distinct(a, k), F.lit(1.0)))


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda v: F.lower(F.lpad(F.hex(v), HASH_BITS // 4, "0"))), "")


def from_text(s: Column) -> Column:
    """Inverse of ``as_text``."""
    d = HASH_BITS // 4
    return F.when(s == "", F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(1), F.length(s), F.lit(d)), lambda i: F.conv(F.substring(s, i, F.lit(d)), 16, 10).cast("bigint")))


def _bounds(docs: DataFrame, parts: int) -> list[int]:
    """Approximate doc_id quantiles; they only balance the groups."""
    row = docs.select(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 20 * parts).alias("q")).first()
    return sorted(set(row["q"] or []))


def _group(bounds: list[int]) -> Column:
    """Number of bounds at or below doc_id, by a search in two steps; null ids come before all others."""
    step = max(1, round(len(bounds) ** 0.5))
    blocks = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    if not blocks:
        return F.lit(0)
    at = lambda values: F.size(F.filter(values, lambda b: b <= F.col("doc_id")))
    longs = lambda b: F.array(*[F.lit(x).cast("bigint") for x in b])
    first = at(longs([b[0] for b in blocks]))
    inside = F.get(F.array(*[longs(b) for b in blocks]), first - 1)
    return F.when(F.col("doc_id").isNull() | (first == 0), 0).otherwise((first - 1) * step + at(inside))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, fp and the next document's text and fp (``next_text``, ``next_fp``), by descending doc_id.

    Texts are dealt into doc_id ranges, and each range also gets the first document of
    the range below (the last range: of the topmost), so one shuffle of the texts is all.
    Rows with equal doc_id follow each other in the order of their texts.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select("doc_id", "text")
    dealt = ids.withColumn("part", _group(_bounds(docs, parts)))
    # The first document of each range: the largest id, of equal ids the least text.
    heads = dealt.groupBy("part").agg(F.max(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("head"))
    above = Window.orderBy(F.desc("part"))         # one row per range: no more than shuffle partitions
    heads = heads.select("part", "head", F.lag("part").over(above).alias("to"), F.min("part").over(Window.partitionBy(F.lit(1))).alias("low"))
    heads = heads.select("part", "head", F.coalesce("to", "low").alias("to"))
    lent = (dealt.join(F.broadcast(heads), ["part"]).where(F.coalesce("doc_id", F.lit(-(1 << 63))) == F.col("head"))
            .groupBy("to").agg(F.min("text").alias("text")))
    lent = lent.select(F.lit(None).cast("long").alias("doc_id"), "text", F.col("to").alias("part"), F.lit(True).alias("lent"))
    rows = dealt.select("doc_id", "text", "part", F.lit(False).alias("lent")).unionByName(lent).repartition("part")
    order = Window.partitionBy("part").orderBy("lent", F.desc_nulls_last("doc_id"), "text")
    rows = rows.withColumn("fp", sketch(F.col("text")))
    return (rows.withColumn("next_text", F.lead("text").over(order)).withColumn("next_fp", F.lead("fp").over(order))
            .where("not lent"))


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns, with containment and distinct count beside them."""
    rows = with_next(docs)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "fp", "next_fp")
    rows = rows.withColumn("edited_fp", sketch(F.col("edited")))
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
                       resemblance(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                       resemblance(F.col("fp"), F.col("next_fp")).alias("near_next"),
                       containment(F.col("edited_fp"), F.col("fp")).alias("edited_in_text"),
                       distinct(F.col("fp")).alias("n_distinct"))
