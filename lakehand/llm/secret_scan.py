"""Secret scans: key patterns, and strings whose characters are too evenly spread for language.

Base kinds (always reported): assign, access and hex.  The added kind ``entropy`` slides a
window of ``WINDOW`` characters over every candidate string (a run of base64 or hex
characters) and follows the Shannon entropy of its characters with incremental counts: one
count goes up, one goes down, and the sum of ``c * log2(c)`` changes by two known terms.
The highest entropy must exceed the limit of the string's character class.  An allow-list
of placeholder words, identifier forms and URL contexts suppresses candidates; base spans
are never suppressed.

DataFrame functions only.  Spans count code points, end exclusive.  Edge cases: null and
empty texts have no spans; spans of different kinds may overlap; equal rows give equal
rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehand.llm.common import blocks, cut, let, matches

ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}+"

BASE = ["assign", "access", "hex"]
WINDOW = 20
#: class: (pattern of the whole candidate, least entropy of a window in bits)
CLASSES = {
    "hex": (r"^(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]+$", 2.8),
    "mixed": (r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9+/_=-]+$", 3.6),
    "one_case": (r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9+/_=-]+$", 3.7),
    "letters": (r"^(?=.*[A-Z])(?=.*[a-z])[A-Za-z+/_=-]+$", 3.85),
    "one_case_letters": (r"^(?=.*[A-Za-z])[A-Za-z+/_=-]+$", 3.95),
}
#: Placeholders, looked for in the window that scores highest and ``AROUND`` characters on either side.
ALLOWED = r"(?i)example|sample|placeholder|changeme|dummy|lorem|xxxx|0123456|1234567|abcdefg"
AROUND = 8
IDENTIFIER = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CLOGC = [0.0, *[c * math.log2(c) for c in range(1, WINDOW + 2)]]


def top_window(s: Column) -> Column:
    """struct<entropy,start>: the highest Shannon entropy of ``WINDOW`` successive characters of a
    candidate, and where the first such window begins."""
    clogc = F.array(*map(F.lit, _CLOGC))
    code = F.transform(F.split(s, ""), lambda c: F.instr(F.lit(_ALPHABET), c))

    def slide(codes: Column) -> Column:
        zero = F.struct(F.array_repeat(F.lit(0), len(_ALPHABET) + 1).alias("n"), F.lit(0.0).alias("sum"), F.lit(99.0).alias("least"),
                        F.lit(0).alias("at"))

        def step(a: Column, i: Column) -> Column:
            new, old = F.get(codes, i), F.when(i >= WINDOW, F.get(codes, i - WINDOW)).otherwise(-1)
            up, down = F.get(a["n"], new), F.get(a["n"], old)
            change = F.get(clogc, up + 1) - F.get(clogc, up) + F.when(old >= 0, F.get(clogc, down - 1) - F.get(clogc, down)).otherwise(0.0)
            total = F.when(new == old, a["sum"]).otherwise(a["sum"] + change)
            counts = F.transform(a["n"], lambda c, k: c + (k == new).cast("int") - (k == old).cast("int"))
            better = (i >= WINDOW - 1) & (total < a["least"] - 1e-9)
            return F.struct(counts.alias("n"), total.alias("sum"), F.when(better, total).otherwise(a["least"]).alias("least"),
                            F.when(better, i - (WINDOW - 1)).otherwise(a["at"]).alias("at"))

        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), zero, step, lambda a: F.struct(
            (F.lit(math.log2(WINDOW)) - a["least"] / WINDOW).alias("entropy"), a["at"].alias("start")))

    return let(code, slide)


def _suspect(pieces: Column, x: Column) -> Column:
    """Entropy over the class's limit, and nothing on the allow-list about the window that has it."""
    hit = x["hit"]
    # A candidate may itself begin with the slashes of an address.
    start = F.greatest(x["start"] - 10, F.lit(0))
    before = cut(pieces, start, x["start"] - start + 2)
    allowed = hit.rlike(IDENTIFIER) | before.rlike("://|www\\.")
    limit = F.coalesce(*[F.when(hit.rlike(p), F.lit(v)) for p, v in CLASSES.values()])

    def high(w: Column) -> Column:
        begin = F.greatest(w["start"] - AROUND, F.lit(0))
        return (w["entropy"] >= limit) & ~F.substring(hit, begin + 1, w["start"] - begin + WINDOW + AROUND).rlike(ALLOWED)
    return F.when(limit.isNull() | allowed, F.lit(False)).otherwise(let(top_window(hit), high))


def found(text: Column) -> dict[str, Column]:
    none = F.array().cast("array<struct<start:int,end:int,hit:string,part:string>>")
    if_any = lambda test, spans: F.when(test, spans).otherwise(none)
    return {
        "assign": if_any(text.rlike("(?i:passw|secret|token|api_?key)"),
                         F.filter(matches(text, ASSIGN, 1), lambda x: F.length(x["part"]) >= 6)),
        "access": if_any(F.contains(text, F.lit("AKIA")), matches(text, ACCESS)),
        "hex": matches(text, HEX),
        "entropy": let(blocks(text), lambda pieces: F.filter(matches(text, CANDIDATE), lambda x: _suspect(pieces, x))),
    }


def spans(docs: DataFrame) -> DataFrame:
    """``docs`` with the column ``secrets``: array<struct<start,rank,kind,end>> by start, then kind."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def ranked(rank: int, kind: str, column: Column) -> Column:
        return F.transform(column, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
                                                      x["end"].alias("end")))

    rows = [ranked(r, k, c) for r, (k, c) in enumerate(found(text).items())]
    return docs.withColumn("secrets", F.sort_array(F.concat(*rows)))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans."""
    joined = lambda rows: F.array_join(F.transform(rows, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    of = lambda k: F.size(F.filter("secrets", lambda x: x["kind"] == k)).cast("long")
    base = F.filter("secrets", lambda x: x["kind"].isin(BASE))
    return spans(docs.select("doc_id", "text")).select(
        "doc_id", *[of(k).alias(f"n_{k}") for k in BASE], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"))
