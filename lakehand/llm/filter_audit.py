"""Interaction audit of document filters by count-weighted decision diagrams.

1. Every document gets a failure mask, one bit per filter.  Masks are counted per part
   (``counts``), so only ``2 ** filters`` numbers per part go on, however many documents.
2. The counts of a part become a decision diagram: one level per filter, a pass and a
   fail branch per node, equal sub-diagrams shared, the documents below a node as its
   weight.  Empty branches are left out.
3. The filters' orders are walked so that neighbours differ by one swap of adjacent
   filters; the diagram follows by a swap of two adjacent levels, which rebuilds the
   nodes of these two levels alone.
4. In every order the all-pass path from the root yields the steps: what a node weighs
   down its pass branch is kept, down its fail branch removed.  What a filter removes
   first in line is all that fails it, last in line what only it fails.

Duplicates are one of the filters of ``document_masks``: rows are counted by (text
digest, part), combined before the shuffle, so a text with millions of copies is a few
rows when its first document is looked up.

Edge cases: null and empty texts are one text without words; a null doc_id is no
duplicate and makes none; rows that share a doc_id and a text do not make each other
duplicates, but are counted one by one; a null part is the empty string; rows of
``labels`` that share a doc_id count once and as marked if any is; null labels mark
nothing; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakehand.llm.common import let, ship, word_array

#: A node's weights: documents, good ones, toxic ones.
Weights = tuple[int, int, int]

_STEPS = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")


class Diagram:
    """Count-weighted diagram of failure masks; bit ``i`` of a mask is set if filter ``i`` fails.

    A node is a number; ``branch`` holds its (pass, fail) nodes, ``weight`` what is below
    it.  Node 0 is the empty diagram.  ``order`` names the filter of every level.
    """

    def __init__(self, filters: int, counts: dict[int, Weights]):
        self.order = list(range(filters))
        self.branch: list[tuple[int, int]] = [(0, 0)]
        self.weight: list[Weights] = [(0, 0, 0)]
        self._same: dict[tuple, int] = {}
        self.levels: list[set[int]] = [set() for _ in range(filters)]
        self.root = self._build(0, counts)

    def _leaf(self, weight: Weights) -> int:
        return self._shared(("leaf", weight), (0, 0), weight) if any(weight) else 0

    def _node(self, level: int, passed: int, failed: int) -> int:
        if not passed and not failed:
            return 0
        a, b = self.weight[passed], self.weight[failed]
        node = self._shared((self.order[level], passed, failed), (passed, failed), (a[0] + b[0], a[1] + b[1], a[2] + b[2]))
        self.levels[level].add(node)
        return node

    def _shared(self, key: tuple, branch: tuple[int, int], weight: Weights) -> int:
        if key not in self._same:
            self._same[key] = len(self.branch)
            self.branch.append(branch)
            self.weight.append(weight)
        return self._same[key]

    def _build(self, level: int, counts: dict[int, Weights]) -> int:
        if not counts:
            return 0
        if level == len(self.order):
            return self._leaf(next(iter(counts.values())))
        bit = 1 << self.order[level]
        return self._node(level, self._build(level + 1, {m: w for m, w in counts.items() if not m & bit}),
                          self._build(level + 1, {m: w for m, w in counts.items() if m & bit}))

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next one; nodes of other levels stay."""
        upper = self.levels[level]
        first = self.order[level]
        self.order[level], self.order[level + 1] = self.order[level + 1], first
        self.levels[level], self.levels[level + 1] = set(), set()
        for node in sorted(upper):
            passed, failed = self.branch[node]
            self._same.pop((first, passed, failed), None)
            (pp, pf), (fp, ff) = self.branch[passed], self.branch[failed]
            # the nodes above keep pointing to this one, which now asks the other filter first
            self.branch[node] = now = (self._node(level + 1, pp, fp), self._node(level + 1, pf, ff))
            self._same[(self.order[level], *now)] = node
            self.levels[level].add(node)

    def steps(self) -> Iterator[tuple[int, Weights, Weights]]:
        """(filter, kept, removed) down the all-pass path."""
        node = self.root
        for filter_ in self.order:
            passed, failed = self.branch[node]
            yield filter_, self.weight[passed], self.weight[failed]
            node = passed


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels to swap, one after the other, so that all orders of ``n`` come up once: the last
    item runs through the orders of the others, to and fro."""
    if n < 2:
        return
    inner = adjacent_swaps(n - 1)
    down = True
    for _ in range(math.factorial(n - 1)):
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        level = next(inner, None)
        if level is not None:
            yield level + down        # the last item stands in front after a way down
        down = not down


def audit_part(part: str, letters: str, counts: dict[int, Weights]) -> list[tuple]:
    """The steps of all orders of the filters for one part."""
    diagram = Diagram(len(letters), counts)
    walks = [list(diagram.steps())]
    for level in adjacent_swaps(len(letters)):
        diagram.swap(level)
        walks.append(list(diagram.steps()))
    fails, alone, total = {}, {}, dict.fromkeys(range(len(letters)), 0)
    for walk in walks:
        fails[walk[0][0]] = walk[0][2][0]
        alone[walk[-1][0]] = walk[-1][2][0]
        for filter_, _, removed in walk:
            total[filter_] += removed[0]
    return [(part, "".join(letters[s[0]] for s in walk), k, kept[0], removed[0], fails[f] - removed[0], alone[f],
             removed[1], removed[2], total[f])
            for walk in walks for k, (f, kept, removed) in enumerate(walk, 1)]


def audit(counts: DataFrame, letters: str) -> DataFrame:
    """Steps of all orders per part, from ``counts`` (part, mask, docs, good, toxic; one row per part and mask).

    ``letters`` names the filters, bit 0 first.  A part's counts are at most
    ``2 ** len(letters)`` rows, so the list that goes to one task is bounded.
    """
    ship(counts.sparkSession)

    def walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                masks = {m["mask"]: (m["docs"], m["good"], m["toxic"]) for m in row["masks"]}
                columns = zip(*audit_part(row["part"], letters, masks))
                yield pa.RecordBatch.from_arrays([
                    pa.array(c, pa.string() if k < 2 else pa.int32() if k == 2 else pa.int64())
                    for k, c in enumerate(columns)], [c.split()[0] for c in _STEPS.split(", ")])

    return (counts.groupBy("part").agg(F.collect_list(F.struct("mask", "docs", "good", "toxic")).alias("masks"))
            .mapInArrow(walks, _STEPS))


def failing(conditions: list[Column]) -> Column:
    """Mask of the conditions that hold, bit 0 first; a null condition does not hold."""
    bits = [F.when(c, 1 << k).otherwise(0) for k, c in enumerate(conditions)]
    return sum(bits[1:], bits[0]).cast("int")


def text_conditions(text: Column, words: Column) -> list[Column]:
    """Few words, few distinct words, many capitals, markup characters."""
    n = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [n < 200, F.size(F.array_distinct(words)) * 100 < n * 50, capitals * 100 > F.length(text) * 3,
            text.rlike(r"[#$%&*|]")]


def document_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, docs, good, toxic): documents per language and failure mask; the last bit is set
    for copies of a document with a smaller doc_id."""
    marks = (labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
                  F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))
    text = F.coalesce("text", F.lit(""))
    mask = let(word_array(text), lambda words: failing(text_conditions(text, words)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text, 256)).alias("digest"), mask.alias("mask"))
    one = lambda c: F.sum(F.coalesce(c, F.lit(0)))
    # rows of a document, then copies in a part with those of the part's first document beside them
    each = rows.join(marks, "doc_id", "left").groupBy("doc_id", "part", "digest", "mask").agg(
        F.count("*").alias("docs"), one("good").alias("good"), one("toxic").alias("toxic"))
    known = F.col("doc_id").isNotNull()
    own = F.struct("doc_id", "docs", "good", "toxic")
    copies = each.groupBy("digest", "part", "mask").agg(
        F.sum("docs").alias("docs"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"),
        F.min(F.when(known, own)).alias("head"),
        *[F.sum(F.when(~known, F.col(c)).otherwise(0)).alias(f"no_id_{c}") for c in ("docs", "good", "toxic")])
    # by now a text has a row per part, however many copies there are
    copies = copies.withColumn("first", F.min("head.doc_id").over(Window.partitionBy("digest")))
    bit = 1 << 4
    is_first = F.col("head.doc_id") == F.col("first")
    unique = {c: F.when(is_first, F.col(f"head.{c}")).otherwise(0) + F.col(f"no_id_{c}") for c in ("docs", "good", "toxic")}
    split = copies.select("part", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), *[v.alias(c) for c, v in unique.items()]),
        F.struct((F.col("mask") + bit).alias("mask"), *[(F.col(c) - v).alias(c) for c, v in unique.items()]))).alias("m"))
    return (split.select("part", "m.*").where("docs > 0").groupBy("part", "mask")
            .agg(F.sum("docs").alias("docs"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All 120 orders of the five filters A to E for every language of ``docs``."""
    return audit(document_masks(docs, labels), "ABCDE")
