"""Near duplicates by bottom-k sketches of one hash function.

1. Every text gets its set of word shingles (hashes), the set's size, a 128-bit
   signature of the set and the ``k`` least hashes (sketch).  Texts with equal sets are
   one class; only its document with the smallest id goes on.
2. Inverted lists of the sketch values generate overlaps.  A value in one sketch only
   goes nowhere, and each document is listed under the rarest ``PREFIX`` of its values
   alone: two sketches that share more than the rest must meet there (prefix
   filtering), and values of boilerplate passages drop out.
3. A list of ``n`` documents would give ``n * n`` pairs.  Instead each list has one hub,
   the member whose values are the most common, which is the centre of a group of copies,
   and a document is paired with the one hub it shares the most lists with: one pair per
   document.  In later rounds members of lists that still hold several components are
   paired with a hub of another component.
4. The sketch of each pair's union estimates its resemblance; pairs that cannot
   reach the threshold (5 standard deviations) fall out.  The others are verified
   on full shingle sets: a hub's text meets its members in groups of bounded size.
5. Components of the verified links; each document takes its class's component.
6. *Rest.*  Lists that still hold several components are settled on full shingle sets, where
   bounds are exact.  A shingle that no other component holds can be in no missing link;
   documents left with less than the threshold of their set are done, and leaving them out
   makes more shingles useless (``PEELS`` times).  The others are listed under their rarest
   useful shingles, as many as a link may lack (prefix filtering; fewer for the smaller
   document of a pair), and paired where set sizes and the places of the common shingle
   allow the threshold.  Most lists end here without a pair, as copies that are too
   different to be linked differ in shingles of their own.

Edge cases: null, empty and blank texts have the empty set and are linked with
nothing; a text with fewer words than a shingle has its word sequence as its only
shingle; equal rows and equal texts are one class; rows that share a doc_id are one
vertex; a null doc_id is linked with nothing (component null, kept); an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakehand.llm.common import Scratch, free, hot_safe_lookup, released, ship
from lakehand.llm.components import components
from lakehand.llm.words import shingle_sets

K = 32
#: Share of a sketch's values, rarest first, under which a document is listed.
PREFIX = 0.625
#: How far below the threshold an estimate may lie (about 5 standard deviations at K).
MARGIN = 0.35
#: Rounds of pairs with hubs before the rest is settled on full sets.
ROUNDS = 2
#: Times that documents without enough useful shingles leave the rest.
PEELS = 2
#: Members that meet a copy of their hub's text in one group.
GROUP = 500

_FLIP = np.uint64(1 << 63)


def profiles(width: int, k: int):
    @released
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, sign, low = [], [], []
            for s in shingle_sets(batch.column("text"), width, lower=True):
                size.append(len(s))
                sign.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                low.append((s[:k] ^ _FLIP).view(np.int64))     # signed, in the same order
            sign = np.frombuffer(b"".join(sign), np.int64).reshape(-1, 2)
            offs = np.concatenate([[0], np.cumsum([len(x) for x in low])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(sign[:, 0]), pa.array(sign[:, 1]),
                 pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate(low) if low else np.zeros(0, np.int64)))],
                ["doc_id", "n_shingles", "sign1", "sign2", "sketch"])
    return rows


def overlaps(reps: DataFrame, least: float, scratch: Scratch) -> DataFrame:
    """(v, id, common, must): inverted lists over the rarest values of every sketch; ``common`` tells how
    common the document's values are, ``must`` how many lists it shares at least with a document whose
    sketch is as similar as ``least``."""
    posts = reps.select("id", "sign1", F.size("sketch").alias("k"), F.explode("sketch").alias("v"))
    often = posts.groupBy("v").agg(F.count("*").alias("n")).where("n > 1").withColumn("df", F.col("n"))
    shared = hot_safe_lookup(posts, often, "v", "id", scratch).where("df is not null")
    own = Window.partitionBy("id", "sign1")     # rows of one document may differ
    listed = F.ceil(F.col("k") * PREFIX)
    must = F.greatest(F.lit(1), F.ceil(F.col("k") * F.lit(least)) - F.col("k") + listed)
    lists = (shared.withColumn("rank", F.row_number().over(own.orderBy("df", "v")))
             .withColumn("quota", listed - F.col("k") + F.count("*").over(own))
             .withColumn("common", F.sum("df").over(own)).withColumn("must", must.cast("int")).where("rank <= quota"))
    return lists.withColumn("lists", F.count("*").over(own)).where("lists >= must").select("v", "id", "common", "must")


def estimated(pairs: DataFrame, reps: DataFrame, least: float, k: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) whose union sketch estimates a resemblance of ``least`` or more; ``n`` tells how
    many pairs ``b`` is in."""
    pairs = scratch.written(pairs, "pairs")
    hubs = pairs.groupBy("b").agg(F.count("*").alias("n")).join(reps.select(F.col("id").alias("b"), F.col("sketch").alias("sb")), "b")
    both = hot_safe_lookup(pairs.join(reps.select(F.col("id").alias("a"), F.col("sketch").alias("sa")), "a"),
                           hubs.withColumn("many", F.col("n")), "b", "a", scratch)
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    both = both.withColumn("inter", F.array_intersect("sa", "sb")).withColumn("u", union)
    return (both.where(F.size(F.array_intersect("u", "inter")) >= least * F.size("u"))
            .select("a", "b", F.col("many").alias("n")).distinct())


def check_pairs(width: int, percent: int):
    """Rows come sorted by (hub, part), the hub's text first; the links among them go out."""
    @released
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hub_sets = None, []
        for batch in batches:
            out = []
            for key, i, s in zip(zip(batch.column("b").to_pylist(), batch.column("part").to_pylist()),
                                 batch.column("id").to_pylist(), shingle_sets(batch.column("text"), width, lower=True)):
                if key != now:
                    now, hub_sets = key, []
                if i == key[0]:
                    hub_sets.append(s)
                    continue
                for h in hub_sets:
                    both = np.intersect1d(s, h, assume_unique=True).size
                    if both and 100 * both >= percent * (len(s) + len(h) - both):
                        out.append((i, key[0]))
                        break
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in (0, 1)], ["a", "b"])
    return check


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b, n) whose full shingle sets are as similar as asked; ``b`` is the hub, its text
    meets its ``n`` members in groups of about ``GROUP``."""
    parts = F.ceil(F.col("n") / GROUP).cast("int")
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("a"), parts).cast("int"))
    need = (dealt.select(F.col("a").alias("id"), "b", "part")
            .unionByName(dealt.select(F.col("b").alias("id"), "b", "part").distinct()))
    return (need.join(texts, "id").repartition("b", "part").sortWithinPartitions("b", "part", (F.col("id") != F.col("b")), "id")
            .select("b", "part", "id", "text").mapInArrow(check_pairs(width, percent), "a long, b long"))


def hub_pairs(lists: DataFrame, hubs: DataFrame, scratch: Scratch) -> DataFrame:
    """Every member paired with the hub it shares the most lists with; ``hubs`` has (v, n, b, hub_label)."""
    met = hot_safe_lookup(lists, hubs, "v", "id", scratch).where("b is not null and id <> b and label <> hub_label")
    return (met.groupBy("id", "b").agg(F.count("*").alias("lists"), F.min("must").alias("must")).where("lists >= must")
            .groupBy(F.col("id").alias("a")).agg(F.max(F.struct("lists", -F.col("b"))).alias("best"))
            .select("a", (-F.col("best")["col2"]).alias("b")))


def labelled(lists: DataFrame, labels: DataFrame) -> DataFrame:
    return lists.select("v", "id", "common", "must").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))


def hubs_of(members: DataFrame) -> DataFrame:
    """(v, n, b, hub_label) of every list: the member with the most common values."""
    hub = F.max(F.struct("common", -F.col("id"), "label")).alias("h")
    return (members.groupBy("v").agg(hub, F.count("*").alias("n"))
            .select("v", "n", (-F.col("h")["col2"]).alias("b"), F.col("h")["label"].alias("hub_label")))


def open_members(members: DataFrame, scratch: Scratch) -> DataFrame:
    """The members of lists that hold several components, of documents in enough such lists; ``top`` is
    the component of a list's first hub."""
    size = members.groupBy("v").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n"),
                                    F.max(F.struct("common", -F.col("id"), "label"))["label"].alias("top")).where("lo < hi")
    among = hot_safe_lookup(members, size.select("v", "n", "top"), "v", "id", scratch).where("top is not null")
    return scratch.written(among.withColumn("lists", F.count("*").over(Window.partitionBy("id"))).where("lists >= must").drop("lists"), "open")


def list_sets(width: int):
    """(id, n, label, s): every document's full shingle set, row by row of the set."""
    @released
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, s in enumerate(shingle_sets(batch.column("text"), width, lower=True)):
                own = [np.full(len(s), batch.column(c)[k].as_py(), np.int64) for c in ("id", "label")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*own, np.full(len(s), len(s)), (s ^ _FLIP).view(np.int64))],
                                                 ["id", "label", "size", "s"])
    return rows


def useful(posts: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Postings whose shingle another component holds, of documents that have enough of them; ``held``
    counts a shingle's, ``own`` a document's."""
    held = (posts.groupBy("s").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n"))
            .where("lo < hi").select("s", "n", F.col("n").alias("held")))
    kept = hot_safe_lookup(posts.select("id", "label", "size", "s"), held, "s", "id", scratch).where("held is not null")
    own = Window.partitionBy("id")
    return scratch.written(kept.withColumn("own", F.count("*").over(own)).where(f"100 * own >= {percent} * size"), "useful")


def rest_pairs(posts: DataFrame, percent: int) -> DataFrame:
    """Pairs of documents in different components that may be as similar as asked, by their rarest shingles.

    A link has at least ``percent`` of either set, and of the smaller set even
    ``200 p / (100 + p)`` percent, in common; so its first common shingle, in the order of
    rarity, lies within what is left of the sets, and behind it enough must follow.
    """
    place = F.col("size") - F.col("own") + F.row_number().over(Window.partitionBy("id").orderBy("held", "s")) - 1
    lists = posts.withColumn("place", place.cast("long")).where(f"place <= size - ceil({percent} * size / 100)")
    side = lambda c: lists.select("s", *[F.col(x).alias(x + c) for x in ("id", "label", "size", "place")])
    small = side("_b").where(f"place_b <= size_b - ceil({2 * percent} * size_b / {100 + percent})")
    return (small.join(side("_a"), "s")
            .where("label_a <> label_b and (size_b < size_a or size_b = size_a and id_b < id_a)")
            .where(f"100 * size_b >= {percent} * size_a")
            .where(f"{100 + percent} * least(size_a - place_a, size_b - place_b) >= {percent} * (size_a + size_b)")
            .select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct())


def rest(members: DataFrame, texts: DataFrame, width: int, percent: int, scratch: Scratch) -> DataFrame:
    """Candidates (a, b) among the members of lists that are still open."""
    ids = members.select("id", "label").distinct()
    sets = texts.join(ids, "id").select("id", "label", "text").mapInArrow(list_sets(width), "id long, label long, size long, s long")
    posts = scratch.written(sets, "sets")
    for _ in range(PEELS):
        posts = useful(posts, percent, scratch)
    return rest_pairs(posts, percent)


def linked(docs: DataFrame, reps: DataFrame, width: int, percent: int, scratch: Scratch) -> DataFrame | None:
    """(id, label) of the representatives that have a link."""
    least = percent / 100 - MARGIN
    lists = scratch.written(overlaps(reps, least, scratch), "lists")
    texts = scratch.bucketed(docs.select(F.col("doc_id").alias("id"), "text"), "id", lists, "texts")
    links, labels = None, docs.sparkSession.createDataFrame([], "id long, label long")
    members = labelled(lists, labels)
    for n in range(ROUNDS + 1):
        if n:
            members = open_members(labelled(members, labels), scratch)
            if members.isEmpty():
                break
        if n == ROUNDS:
            pairs = rest(members, texts, width, percent, scratch)
        elif n:
            pairs = hub_pairs(members, hubs_of(members.where("label <> top")), scratch)
        else:       # every document is a component of its own
            pairs = hub_pairs(members, hubs_of(members).where("n > 1"), scratch)
        candidates = scratch.written(estimated(pairs, reps, least, K, scratch), "candidates")
        found = scratch.written(verified(candidates, texts, width, percent), "links")
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            labels = components(links, scratch)
    return None if links is None else labels


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document."""
    ship(docs.sparkSession)
    scratch, out = Scratch(docs.sparkSession, "near-dedup"), Scratch(docs.sparkSession, "near-classes")
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    made = scratch.written(docs.mapInArrow(profiles(width, K), "doc_id long, n_shingles long, sign1 long, sign2 long, "
                                           "sketch array<long>"), "profiles")
    some = made.where("doc_id is not null and n_shingles > 0")
    # one row per class, so that a class of a third of all rows is in no task as a whole
    classes = (some.groupBy("sign1", "sign2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"))
               .select(F.struct("sign1", "sign2").alias("sign"), "n", "rep"))
    signed = made.select("doc_id", "n_shingles", F.struct("sign1", "sign2").alias("sign"))
    member = (hot_safe_lookup(signed, classes, "sign", "doc_id", scratch)
              .select("doc_id", "n_shingles", F.expr("if(n_shingles > 0 and doc_id is not null, rep, null)").alias("rep")))
    member = out.written(member, "classes")
    reps = (some.join(member.where("doc_id = rep").select("doc_id").distinct(), "doc_id")
            .select(F.col("doc_id").alias("id"), "sign1", "sketch").distinct())
    labels = linked(docs, scratch.written(reps, "representatives"), width, percent, scratch)
    if labels is not None:
        labels = out.written(labels, "labels")
        member = hot_safe_lookup(member, labels.join(member.groupBy("rep").agg(F.count("*").alias("n")), labels["id"] == F.col("rep"))
                                 .select("rep", "n", "label"), "rep", "doc_id", out)
    else:
        member = member.withColumn("label", F.lit(None).cast("long"))
    scratch.clear()
    component = F.coalesce("label", "rep", "doc_id")
    return member.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the near duplicates of a document with a smaller id, all columns kept.

    Rows that share a doc_id are one document and stay or go together; null ids stay.
    """
    name = free(docs.columns, "gone")
    gone = near_duplicates(docs, width, percent).where("not kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col(name), "left_anti")
