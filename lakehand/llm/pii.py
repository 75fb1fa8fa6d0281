"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Base kinds (always reported): email, ip, card (Luhn) and phone.  Added kinds: iban
(confirmed by its mod-97 checksum), national ids of the form 123-45-6789 and phone
numbers without a country prefix, which count only if the score reaches ``LEAST``: a
prior for the kind, plus what a checksum confirms, plus or minus what words within
``NEAR`` characters say.

The patterns are written with possessive quantifiers and look-behinds so that each
match takes linear time on any text; the base kinds match the same spans as the plain
ones.  An iban is proposed at the length its country has, whatever follows it, and every
place where one can begin is tried, also inside another proposal.

DataFrame functions only.  Spans count code points, end exclusive.  Edge cases: null
and empty texts have no spans; spans of different kinds may overlap (``redacted``
merges them); equal rows give equal rows; other columns pass through ``redacted``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehand.llm.common import blocks, cut, free, let, matches, running

NEAR = 40
LEAST = 0.6

EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9]++(?:[\x20-][0-9]++)++|[0-9]{13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Characters of an IBAN by country: those of the registry, then those that use one without being in it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST AO CV GW MZ", 26: "IS TR DZ IR", 27: "BI DJ FR GR IT MC MR SM CF CG CM GA GQ KM MG TD",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV BF BJ CI MA ML NE SN TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_OF_LENGTH = [rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items()]
#: Takes the first four characters; group 1 looks ahead over the whole, the longest one for any other country.
IBAN = (r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?=(" + "|".join(_OF_LENGTH) + "|(?!" + "|".join(
    IBAN_LENGTHS.values()).replace(" ", "|") + r")[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9]))[A-Z]{2}[0-9]{2}")
NATIONAL = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
LOCAL_PHONE = r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z.-])"

BASE = ["email", "ip", "card", "phone"]
ADDED = ["iban", "national", "local_phone"]
#: kind: (score before context, words that raise it, words that lower it)
SCORES = {
    "email": (0.9, "mail|contact|write", "noreply|no-reply"),
    "ip": (0.6, r"\bip\b|address|host|server|login", r"version|release|\bv[0-9]|section"),
    "card": (0.8, "card|visa|master|amex|payment|credit", "isbn|order|serial|tracking"),
    "phone": (0.8, "phone|call|tel|mobile|fax|contact", "version|score"),
    "iban": (0.8, "iban|bank|account|konto|compte|cuenta", "serial"),
    "national": (0.4, r"ssn|social|security|\btax|identity", "version|part|model"),
    "local_phone": (0.3, "phone|call|tel|mobile|fax", "version|score|isbn|order"),
}


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits of a string pass the Luhn checksum."""
    total = F.aggregate(F.transform(F.split(F.reverse(number), ""), lambda d, i: F.when(
        i % 2 == 0, d.cast("int")).otherwise(F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))),
                                                          d.cast("int") + 1))), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN's checksum holds: letters as 10 to 35, the first four characters last."""
    plain = F.replace(iban, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, 5, 34), F.substring(plain, 1, 4))
    rest = F.aggregate(F.transform(F.split(moved, ""), F.ascii), F.lit(0), lambda r, a: F.when(
        a < 58, (r * 10 + a - 48) % 97).otherwise((r * 100 + a - 55) % 97))
    return rest == 1


def _ip_parts(hit: Column) -> Column:
    """Every part at most 255, with any number of leading zeros."""
    return ~F.exists(F.split(hit, r"\."), lambda p: ~F.regexp_replace(p, "^0+(?=.)", "").rlike(
        "^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def ibans(text: Column) -> Column:
    """What can be an IBAN by its country's length; proposals may overlap."""
    return F.transform(matches(text, IBAN, 1), lambda x: F.struct(
        x["start"].alias("start"), (x["start"] + F.length(x["part"])).alias("end"), x["part"].alias("hit"), x["part"].alias("part")))


def found(text: Column) -> dict[str, Column]:
    """For each kind the confirmed matches of a text, before scores."""
    none = F.array().cast("array<struct<start:int,end:int,hit:string,part:string>>")
    n = lambda x: F.length(digits(x["hit"]))
    if_any = lambda test, spans: F.when(test, spans).otherwise(none)
    return {
        "email": if_any(F.contains(text, F.lit("@")), matches(text, EMAIL)),
        "ip": F.filter(matches(text, IP), lambda x: _ip_parts(x["hit"])),
        "card": F.filter(matches(text, CARD), lambda x: n(x).between(13, 19) & luhn(digits(x["hit"]))),
        "phone": if_any(F.contains(text, F.lit("+")), F.filter(matches(text, PHONE), lambda x: n(x).between(9, 15))),
        "iban": F.filter(ibans(text), lambda x: mod97(x["hit"])),
        "national": matches(text, NATIONAL),
        "local_phone": F.filter(matches(text, LOCAL_PHONE), lambda x: n(x).between(9, 12)),
    }


def score(pieces: Column, kind: str, span: Column) -> Column:
    """From the words around a span; ``pieces`` are the text's ``blocks``."""
    prior, good, bad = SCORES[kind]
    start = F.greatest(span["start"] - NEAR, F.lit(0))
    near = F.lower(F.concat(cut(pieces, start, span["start"] - start), F.lit(" "), cut(pieces, span["end"], F.lit(NEAR))))
    return F.lit(prior) + F.when(near.rlike(good), 0.3).otherwise(0.0) - F.when(near.rlike(bad), 0.3).otherwise(0.0)


def spans(docs: DataFrame, name: str = "pii") -> DataFrame:
    """``docs`` with the column ``name``: array<struct<kind,start,end,score>> by kind, then start."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def scored(kind: str, column: Column, pieces: Column) -> Column:
        rows = F.transform(column, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                                                      F.round(score(pieces, kind, x), 2).alias("score")))
        return F.filter(rows, lambda x: x["score"] >= LEAST) if kind in ADDED else rows

    return docs.withColumn(name, let(blocks(text), lambda pieces: F.concat(*[scored(k, c, pieces) for k, c in found(text).items()])))


def joined(rows: Column) -> Column:
    return F.array_join(F.transform(rows, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans, scores."""
    of = lambda k: F.filter("pii", lambda x: x["kind"] == k)
    base = F.filter("pii", lambda x: x["kind"].isin(BASE))
    return spans(docs.select("doc_id", "text")).select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"),
        F.array_join(F.transform("pii", lambda x: x["score"].cast("string")), ",").alias("scores"))


def merged(rows: Column) -> Column:
    """Spans (start, end, kind) that overlap as one, under the kind of the one that starts first; by start."""
    order = F.sort_array(F.transform(rows, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))

    def ends(r: Column) -> Column:
        def heads(upto: Column) -> Column:
            first = F.filter(F.sequence(F.lit(0), F.size(r) - 1), lambda i: (i == 0) | (F.get(r, i)["start"] >= F.get(upto, i - 1)))
            return let(first, lambda h: F.transform(h, lambda i, k: F.struct(
                F.get(r, i)["start"].alias("start"), F.get(upto, F.coalesce(F.get(h, k + 1), F.size(r)) - 1).alias("end"),
                F.get(r, i)["kind"].alias("kind"))))
        return let(running(F.transform(r, lambda x: x["end"]), F.greatest, F.lit(0)), heads)

    return let(order, ends)


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets and n_chars to match.

    Overlapping spans are replaced together under the kind of the one that starts first.
    All other columns keep their values, whatever their names.
    """
    name = free(docs.columns, "pii")

    def replace(m: Column, pieces: Column) -> Column:
        end = lambda i: F.coalesce(F.get(m, i)["end"], F.lit(0))
        parts = F.transform(m, lambda x, i: F.concat(cut(pieces, end(i - 1), x["start"] - end(i - 1)), F.lit("["), F.upper(x["kind"]), F.lit("]")))
        last = end(F.size(m) - 1)
        return F.concat(F.array_join(parts, ""), cut(pieces, last, F.length("text") - last))

    some = F.size(name) > 0
    clean = let(merged(F.col(name)), lambda m: let(blocks(F.col("text")), lambda pieces: replace(m, pieces)))
    out = spans(docs, name).withColumn("text", F.when(some, clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(some, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
