"""Mixing sources to target weights by hierarchical budgets.

The tree has three levels: domain, language, source.  A budget of tokens runs down the
tree: every node shares its budget among its children by weight, but no child gets more
than its leaves can give in ``epochs`` passes over their documents.  What a child cannot
take goes to its siblings in proportion to their weights, and only what all siblings
together cannot take has already gone to the parent's siblings, since a parent's own
limit is the sum of its children's.  Shares are found in closed form: children in order
of ``limit / weight`` fill up one after the other (a window over the children of one
node); the others share the rest.  Whole-number arithmetic rounds shares down.

A leaf takes its tokens from seeded epochs: in epoch ``e`` its documents stand in the
order of md5(seed:e:doc_id).  Full epochs are taken whole; of the last one the longest
prefix of documents that fits.  The prefix ends at a hash value, found first among
hash buckets (counts per bucket, combined before the shuffle) and then inside the one
bucket where the budget ends; so no leaf's documents meet in one task, and a document
is selected by comparing its hash with its leaf's cut.

DataFrame functions only.  Edge cases: null and empty texts count no tokens and are
taken whenever their place in the order is inside the prefix; a leaf without tokens gives nothing; null languages and
sources count as ''; sources without a weight get weight 1, weights of 0 take nothing;
rows that share a doc_id have equal hashes and are taken or left together; an empty
table gives no rows; other columns pass through ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakehand.llm.common import free, word_array, written

SEED = 7
EPOCHS = 2
#: Budget as a share of all tokens, in percent.
BUDGET_PERCENT = 80
#: Hexadecimal digits of the bucket of a hash: 4096 buckets for each leaf and epoch.
BUCKET_DIGITS = 3
DIGITS = 15

#: Weights by level; a missing key has weight 1.
DOMAIN_WEIGHTS = {"web": 5, "books": 3, "code": 2}
LANGUAGE_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 1}
SOURCE_WEIGHTS: dict[str, int] = {}
LEVELS = ["domain", "lang", "source"]


def domain(source: Column) -> Column:
    """Domain of a source: by its number, the first third of each six web, then books, then code."""
    number = F.coalesce(F.regexp_extract(source, "([0-9]{1,9})$", 1).try_cast("long"), F.lit(0))
    return F.when(number % 6 < 3, "web").when(number % 6 < 5, "books").otherwise("code")


def weight(column: str, weights: dict[str, int]) -> Column:
    if not weights:
        return F.lit(1)
    return F.coalesce(*[F.when(F.col(column) == k, F.lit(v)) for k, v in weights.items()], F.lit(1))


def tree_columns(docs: DataFrame, names: list[str]) -> DataFrame:
    """``docs`` with the tree's three levels under ``names``."""
    source = F.coalesce("source", F.lit(""))
    return docs.withColumns(dict(zip(names, (domain(source), F.coalesce("lang", F.lit("")), source), strict=True)))


def order_hash(epoch: Column) -> Column:
    """First hexadecimal digits of the document's place in an epoch."""
    key = F.concat_ws(":", F.lit(str(SEED)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.substring(F.md5(key.cast("binary")), 1, DIGITS)


def shared_out(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """``nodes`` (parent columns, w, cap, total) with ``budget``: total shared by w, no more than cap."""
    order = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("w"), *[c for c in LEVELS if c in nodes.columns])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*parent)
    n = nodes.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
    n = n.withColumn("w_left", F.sum("w").over(group) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    n = n.withColumn("full", F.expr("cap * w_left <= (total - cap_before) * w"))
    n = n.withColumn("taken", F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(group))
    n = n.withColumn("w_open", F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(group))
    return n.withColumn("budget", F.expr("if(full, cap, (total - taken) * w div w_open)")).drop(
        "cap_before", "w_left", "full", "taken", "w_open", "total")


def budgets(leaves: DataFrame, epochs: int, percent: int) -> DataFrame:
    """(domain, lang, source, tokens, budget) from (domain, lang, source, tokens)."""
    weights = dict(zip(LEVELS, (DOMAIN_WEIGHTS, LANGUAGE_WEIGHTS, SOURCE_WEIGHTS), strict=True))
    # A leaf without weight takes nothing, so no limit above it may count on it.
    weighed = F.least(*[weight(x, w) for x, w in weights.items()], F.lit(1))
    caps = leaves.where(weighed > 0).withColumn("cap", F.col("tokens") * epochs)
    for depth, level in enumerate(LEVELS):
        keys = LEVELS[:depth + 1]
        nodes = caps.groupBy(*keys).agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("own"))
        nodes = nodes.withColumn("w", weight(level, weights[level]).cast("long"))
        if depth:
            nodes = nodes.join(down, keys[:-1])
        else:     # one row per domain
            nodes = nodes.withColumn("total", F.sum("own").over(Window.partitionBy(F.lit(1)))).withColumn(
                "total", F.expr(f"total * {percent} div 100"))
        down = shared_out(nodes, keys[:-1] or [F.lit(1)]).select(*keys, F.col("budget").alias("total"))
    return leaves.join(down, LEVELS, "left").select(*LEVELS, "tokens", F.coalesce("total", F.lit(0)).alias("budget"))


def leaf_cuts(sized: DataFrame, epochs: int, percent: int) -> DataFrame:
    """(domain, lang, source, budget, full, cut): full epochs, and the hash where the next one ends ('' takes nothing)."""
    leaves = sized.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    leaf = budgets(leaves, epochs, percent)
    leaf = leaf.withColumn("full", F.expr("if(tokens = 0, 0, budget div tokens)")).withColumn(
        "rest", F.expr("if(tokens = 0, 0, budget % tokens)"))
    leaf = written(leaf, "leaves")
    hashed = sized.join(leaf.drop("tokens"), LEVELS).select(*LEVELS, "rest", "tokens", order_hash(F.col("full")).alias("h"))
    hashed = hashed.withColumn("b", F.substring("h", 1, BUCKET_DIGITS))
    counts = hashed.groupBy(*LEVELS, "rest", "b").agg(F.sum("tokens").alias("n"))
    own = Window.partitionBy(*LEVELS).orderBy("b")
    counts = counts.withColumn("upto", F.sum("n").over(own)).withColumn("before", F.col("upto") - F.col("n"))
    # The bucket where the budget ends; the buckets before it are taken whole.
    edge = counts.where("upto > rest").groupBy(*LEVELS).agg(F.min("b").alias("b"), F.min("before").alias("before"))
    inside = hashed.join(edge, [*LEVELS, "b"]).groupBy(*LEVELS, "rest", "b", "before", "h").agg(F.sum("tokens").alias("n"))
    run = Window.partitionBy(*LEVELS).orderBy("h")
    inside = inside.withColumn("upto", F.col("before") + F.sum("n").over(run)).where("upto <= rest")
    last = inside.groupBy(*LEVELS).agg(F.max("h").alias("last"))
    return (leaf.join(edge, LEVELS, "left").join(last, LEVELS, "left")
            .select(*LEVELS, "tokens", "budget", "full", F.coalesce("last", "b", F.lit("")).alias("cut")))


def sized_docs(docs: DataFrame) -> DataFrame:
    """doc_id, the tree's columns and the number of words, written once."""
    tree = [f"_{c}" for c in LEVELS]
    d = tree_columns(docs.select(F.col("doc_id").cast("long"), "text", "lang", "source"), tree)
    return written(d.select("doc_id", *[F.col(t).alias(c) for c, t in zip(LEVELS, tree, strict=True)],
                            F.size(word_array(F.col("text"))).cast("long").alias("tokens")), "sizes")


def copies() -> Column:
    """How often a document is taken, from its leaf's cut."""
    return (F.col("full") + (order_hash(F.col("full")) <= F.col("cut")).cast("long")).cast("long")


def selection(docs: DataFrame, epochs: int = EPOCHS, percent: int = BUDGET_PERCENT) -> DataFrame:
    """doc_id, domain, lang, source, tokens, leaf_budget, copies for every document."""
    sized = sized_docs(docs)
    cuts = written(leaf_cuts(sized, epochs, percent).drop("tokens"), "cuts")
    return sized.join(cuts, LEVELS).select("doc_id", *LEVELS, "tokens", F.col("budget").alias("leaf_budget"), copies().alias("copies"))


def mixed(docs: DataFrame, epochs: int = EPOCHS, percent: int = BUDGET_PERCENT) -> DataFrame:
    """``docs`` with every row repeated as often as it is taken (or left out); all columns keep their values."""
    tree = [free(docs.columns, f"_{c}") for c in LEVELS]
    full, cut, often = (free(docs.columns, c) for c in ("_full", "_cut", "_taken"))
    # A row per leaf; its known size lets the join broadcast it, so that no text is shuffled.
    cuts = written(leaf_cuts(sized_docs(docs), epochs, percent).select(
        *[F.col(c).alias(t) for c, t in zip(LEVELS, tree, strict=True)], F.col("full").alias(full), F.col("cut").alias(cut)), "cuts")
    taken = F.col(full) + (order_hash(F.col(full)) <= F.col(cut)).cast("long")
    rows = tree_columns(docs, tree).join(cuts, tree).withColumn(often, taken).where(F.col(often) > 0)
    one = free(rows.columns, "_copy")
    return rows.withColumn(one, F.explode(F.sequence(F.lit(1).cast("long"), F.col(often)))).select(*docs.columns)
