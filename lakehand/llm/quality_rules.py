"""Quality rules with thresholds that adapt to each language and source.

Base rules drop texts of fewer than ``MIN_WORDS`` words or with more than half of the
words in repeated 3-word windows.  The other cutoffs are not fixed: every metric's
distribution is kept as a log-linear histogram sketch (32 buckets for each power of
two, so a quantile is off by 3 % at most) for each (language, source).  Sketches are
counts, so partial ones from any tasks merge exactly, in any order, and sources merge
into languages and languages into one.  A group's quartiles give its fences
``q3 + SPREAD * (q3 - q1) + slack`` and, for the word length, the like below; groups of
fewer than ``MIN_GROUP`` texts borrow their language's sketch, small languages the
global one.  The verdict is a join of the texts' metrics with the fences.

DataFrame functions only.  Edge cases: null and empty texts have no words and fail the
base rules; null languages and sources count as ''; equal rows are judged one by one;
ties at a fence pass; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakehand.llm.common import let, word_array, written

MIN_WORDS = 50
MIN_GROUP = 100
SPREAD = 6
#: metric: (numerator, denominator, scale, slack); compared as whole parts of the scale.
METRICS = {
    "m_symbols": ("n_symbols", "word_chars", 10_000, 300),
    "m_repeat": ("n_repeat_words", "n_words", 10_000, 1_500),
    "m_dup_lines": ("n_dup_lines", "n_words", 10_000, 200),
    "m_word_len": ("word_chars", "n_words", 100, 150),
}
#: Metrics with a lower fence too.
TWO_SIDED = ["m_word_len"]

SYMBOLS = "#*$%&|<>"


def repeated_words(words: Column) -> Column:
    """Words covered by 3-word windows that stand in the array twice or more."""
    def count(h: Column) -> Column:
        order = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def at(s: Column) -> Column:
            twice = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                             | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        covered = lambda q: F.aggregate(
            F.transform(q, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(q, i + 1), x + 3) - x)), F.lit(0), lambda a, x: a + x)
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(let(order, at), covered))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                          lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(windows, count))


def metrics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of the base rules."""
    d = docs.select("doc_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    dup = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    counts = let(word_array(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                                               repeated_words(w).cast("long").alias("n_repeat_words")))
    d = d.select("doc_id", "lang", "source", counts.alias("w"),
                 F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
                 (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
                 dup.cast("long").alias("n_dup_lines"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (d.select("doc_id", "lang", "source", "w.n_words", "word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words")
            .withColumn("base_failed", failed))


def ratio(metric: str) -> Column:
    top, bottom, scale, _ = METRICS[metric]
    return F.expr(f"{top} * {scale} div greatest({bottom}, 1)")


def bucket(v: str) -> Column:
    """Bucket of a whole number: itself below 32, then 32 for each power of two."""
    e = f"(length(bin({v})) - 6)"
    return F.expr(f"if({v} < 32, {v}, {e} * 32 + shiftright({v}, {e}))")


def bucket_floor(b: str) -> Column:
    return F.expr(f"if({b} < 64, {b}, shiftleft({b} - ({b} div 32 - 1) * 32, cast({b} div 32 - 1 as int)))")


def fences(counted: DataFrame) -> DataFrame:
    """(lang, source, <metric>_hi, <metric>_lo) from the sketches of the texts that pass the base rules."""
    values = counted.where("not base_failed").select(
        "lang", "source", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), ratio(m).alias("v")) for m in METRICS])).alias("x"))
    sketch = (values.select("lang", "source", "x.metric", bucket("x.v").cast("long").alias("b"))
              .groupBy("lang", "source", "metric", "b").agg(F.count("*").alias("n")))
    none = F.lit(None).cast("string")
    level = lambda n, lang, source: F.struct(F.lit(n).alias("level"), lang.alias("l"), source.alias("s"))
    levels = F.array(level(0, F.col("lang"), F.col("source")), level(1, F.col("lang"), none), level(2, none, none))
    merged = (sketch.select(F.explode(levels).alias("k"), "metric", "b", "n").select("k.*", "metric", "b", "n")
              .groupBy("level", "l", "s", "metric", "b").agg(F.sum("n").alias("n")))
    group = Window.partitionBy("level", "l", "s", "metric")
    merged = merged.withColumn("cum", F.sum("n").over(group.orderBy("b"))).withColumn("total", F.sum("n").over(group))
    quart = (merged.groupBy("level", "l", "s", "metric")
             .agg(F.expr("min(case when cum * 4 >= total then b end)").alias("b1"),
                  F.expr("min(case when cum * 4 >= total * 3 then b end)").alias("b3"), F.max("total").alias("total"))
             .select("level", "l", "s", "metric", "total", bucket_floor("b1").alias("q1"), bucket_floor("b3").alias("q3")))
    slack = F.create_map(*[F.lit(x) for m, (*_, s) in METRICS.items() for x in (m, s)])[F.col("metric")]
    quart = quart.withColumn("hi", F.col("q3") + SPREAD * (F.col("q3") - F.col("q1")) + slack).withColumn(
        "lo", F.col("q1") - SPREAD * (F.col("q3") - F.col("q1")) - slack)
    pick = lambda m, c: F.max(F.when(F.col("metric") == m, F.col(c)))
    wide = quart.groupBy("level", "l", "s").agg(F.max("total").alias("total"), *[pick(m, "hi").alias(m + "_hi") for m in METRICS],
                                                *[pick(m, "lo").alias(m + "_lo") for m in TWO_SIDED])
    wide = written(wide, "fences")     # a row per source, language and for all
    limits = [m + "_hi" for m in METRICS] + [m + "_lo" for m in TWO_SIDED]
    own = wide.where("level = 0").select(F.col("l").alias("lang"), F.col("s").alias("source"), F.struct("total", *limits).alias("own"))
    lang = wide.where("level = 1").select(F.col("l").alias("lang"), F.struct("total", *limits).alias("of_lang"))
    whole = wide.where("level = 2").first()     # one row, or none if no text passes
    of_all = F.struct(F.lit(whole["total"] if whole else 0).cast("long").alias("total"),
                      *[F.lit(whole[c] if whole else None).cast(wide.schema[c].dataType).alias(c) for c in limits])
    best = F.when(F.col("own.total") >= MIN_GROUP, F.col("own")).when(
        F.col("of_lang.total") >= MIN_GROUP, F.col("of_lang")).otherwise(of_all)
    return (own.join(lang, "lang").select("lang", "source", best.alias("f"))
            .select("lang", "source", *[f"f.{c}" for c in limits]))


def judged(docs: DataFrame) -> DataFrame:
    """The contract's counts, base_failed, kept, and the metrics with their fences."""
    counted = written(metrics(docs), "metrics")
    passes = F.lit(True)
    for m in METRICS:
        passes = passes & (F.col(m) <= F.col(m + "_hi"))
    for m in TWO_SIDED:
        passes = passes & (F.col(m) >= F.col(m + "_lo"))
    return (counted.join(fences(counted), ["lang", "source"], "left").withColumns({m: ratio(m) for m in METRICS})
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(passes, F.lit(True))))
