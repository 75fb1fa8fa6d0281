"""DuckDB SQL of the queries that SQL can state; the other operators are tested against brute force."""

from __future__ import annotations

#: Steps of an order over a part's mask counts: a filter removes what passed all before it.
OP11 = r"""
WITH marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
firsts AS (SELECT t, min(doc_id) AS first FROM texts GROUP BY t),
listed AS (
  SELECT x.doc_id, x.part, x.t, f.first, regexp_extract_all(x.t, '[^\x20\x09-\x0D]+') AS w
  FROM texts x JOIN firsts f ON f.t = x.t),
flags AS (
  SELECT l.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END AS a,
    CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 1 ELSE 0 END AS b,
    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t) THEN 1 ELSE 0 END AS c,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 1 ELSE 0 END AS d,
    CASE WHEN l.doc_id > first THEN 1 ELSE 0 END AS e
  FROM listed l LEFT JOIN marks m ON m.doc_id = l.doc_id),
masks AS (
  SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM flags GROUP BY 1, 2),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT p.x || q.x || r.x || s.x || u.x AS filter_order, [p.bit, q.bit, r.bit, s.bit, u.bit] AS bits
  FROM letters p JOIN letters q ON q.x <> p.x JOIN letters r ON r.x NOT IN (p.x, q.x)
  JOIN letters s ON s.x NOT IN (p.x, q.x, r.x) JOIN letters u ON u.x NOT IN (p.x, q.x, r.x, s.x)),
steps AS (
  SELECT filter_order, step, bits[step] AS bit, CAST(list_sum(bits[1:step]) - bits[step] AS INTEGER) AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
counted AS (
  SELECT m.part, s.filter_order, s.step, s.bit,
    sum(CASE WHEN (mask & (earlier + bit)) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN (mask & earlier) = 0 AND (mask & bit) > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN (mask & earlier) > 0 AND (mask & bit) > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN (mask & earlier) = 0 AND (mask & bit) > 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN (mask & earlier) = 0 AND (mask & bit) > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM masks m, steps s GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""

#: The alphabet of base 32; five hex digits of a digest are four of its letters.
OP12 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
firsts AS (SELECT html, min(page_id) AS first FROM p GROUP BY html),
hashed AS (
  SELECT p.page_id, octet_length(encode(p.html)) AS payload_bytes, sha1(p.html) AS hex, f.first
  FROM p JOIN firsts f ON f.html = p.html),
digits AS (
  SELECT *, [('0x' || hex[5 * k + 1:5 * k + 5])::INTEGER FOR k IN [0, 1, 2, 3, 4, 5, 6, 7]] AS fives FROM hashed)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(flatten([['ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((v >> s) & 31) + 1] FOR s IN [15, 10, 5, 0]] FOR v IN fives]), '')
    AS payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM digits
"""

#: Words of a text, and its windows of ``width`` words with the word each begins at.
_WORDS = "regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')"
_WINDOWS = """SELECT doc_id, i, array_to_string(ws[i:i + {width} - 1], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {width} + 2)) AS i FROM w)"""

#: A window is gone if a smaller document has it anywhere; a word is if any window over it is.
OP6 = f"""
WITH w AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
win AS ({_WINDOWS.format(width=13)}),
firsts AS (SELECT k, min(doc_id) AS first FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM (SELECT doc_id, i FROM win JOIN firsts USING (k) WHERE first < doc_id),
  (SELECT unnest(range(0, 13)) AS j)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)
"""

#: All pairs that share a shingle, their similarity, and what is reachable over links.
OP10 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(
    text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
shingles AS (SELECT DISTINCT doc_id, k FROM ({_WINDOWS.format(width=3)})
  UNION SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 2),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS other FROM w UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""

#: metric: (numerator, denominator, scale, slack), as in ``quality_rules``.
_METRICS = {"symbols": ("n_symbols", "word_chars", 10_000, 300), "repeat": ("n_repeat_words", "n_words", 10_000, 1_500),
            "dup_lines": ("n_dup_lines", "n_words", 10_000, 200), "word_len": ("word_chars", "n_words", 100, 150)}
_VALUES = " UNION ALL ".join(f"SELECT doc_id, lang, source, base_failed, '{m}' AS metric, {top} * {scale} // greatest({bottom}, 1) AS v, "
                             f"{slack} AS slack FROM counted" for m, (top, bottom, scale, slack) in _METRICS.items())
#: Every group's quartiles from counts of log-linear buckets: 32 for each power of two.
OP3 = f"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t,
  {_WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
win AS ({_WINDOWS.format(width=3)}),
again AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS often FROM win),
  (SELECT unnest([0, 1, 2]) AS j) WHERE often > 1 GROUP BY doc_id),
counts AS (SELECT doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
    - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN again USING (doc_id)),
counted AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts),
vals AS ({_VALUES}),
sketch AS (SELECT lang, source, metric, slack, CASE WHEN v < 32 THEN v ELSE (length(bin(v)) - 6) * 32 + (v >> (length(bin(v)) - 6)) END AS b,
  count(*) AS n FROM vals WHERE NOT base_failed GROUP BY ALL),
leveled AS (SELECT 0 AS level, lang AS l, source AS s, metric, slack, b, n FROM sketch
  UNION ALL SELECT 1, lang, '', metric, slack, b, n FROM sketch UNION ALL SELECT 2, '', '', metric, slack, b, n FROM sketch),
summed AS (SELECT level, l, s, metric, slack, b, sum(n) AS n FROM leveled GROUP BY ALL),
cumulated AS (SELECT *, sum(n) OVER (PARTITION BY level, l, s, metric ORDER BY b) AS cum,
  sum(n) OVER (PARTITION BY level, l, s, metric) AS total FROM summed),
quart AS (SELECT level, l, s, metric, slack, max(total) AS total, min(b) FILTER (cum * 4 >= total) AS b1,
  min(b) FILTER (cum * 4 >= total * 3) AS b3 FROM cumulated GROUP BY ALL),
floors AS (SELECT *, CASE WHEN b1 < 64 THEN b1 ELSE (b1 - (b1 // 32 - 1) * 32) << CAST(b1 // 32 - 1 AS INTEGER) END AS q1,
  CASE WHEN b3 < 64 THEN b3 ELSE (b3 - (b3 // 32 - 1) * 32) << CAST(b3 // 32 - 1 AS INTEGER) END AS q3 FROM quart),
fences AS (SELECT level, l, s, metric, total, q3 + 6 * (q3 - q1) + slack AS hi, q1 - 6 * (q3 - q1) - slack AS lo FROM floors),
chosen AS (SELECT own.l AS lang, own.s AS source, own.metric,
    CASE WHEN own.total >= 100 THEN own.hi WHEN of_lang.total >= 100 THEN of_lang.hi ELSE whole.hi END AS hi,
    CASE WHEN own.total >= 100 THEN own.lo WHEN of_lang.total >= 100 THEN of_lang.lo ELSE whole.lo END AS lo
  FROM fences own JOIN fences of_lang ON of_lang.level = 1 AND of_lang.l = own.l AND of_lang.metric = own.metric
  JOIN fences whole ON whole.level = 2 AND whole.metric = own.metric WHERE own.level = 0),
passed AS (SELECT doc_id, bool_and(v <= coalesce(hi, v) AND (metric <> 'word_len' OR v >= coalesce(lo, v))) AS ok
  FROM vals LEFT JOIN chosen USING (lang, source, metric) GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ok AS kept
FROM counted JOIN passed USING (doc_id)
"""

ORACLE: dict[str, str] = {"op3_quality_rules": OP3, "op6_substring_dedup": OP6, "op10_near_dedup": OP10,
                          "op11_filter_audit": OP11, "op12_warc": OP12}

#: Queries without SQL, and what their tests compare them with instead.
NO_SQL = {
    "op1_quality_classifier": "random features and isotonic fits; held-out accuracy, normal equations against numpy",
    "op2_token_binary": "token ids; the tokenizers library on whole texts, round trip of the files",
    "op4_pii": "spans, checksums and scores; Python's regular expressions and plain checksums",
    "op5_fingerprints": "sketches of hashes; exact likeness of the texts",
    "op7_packing": "token ids; exact cover of all ids, windows and offsets, a scan of all open windows",
    "op8_secret_scan": "spans and entropies; Python's regular expressions and entropies",
    "op9_mixing": "budgets down a tree and seeded epochs; a plain walk of the tree",
    "op13_alignment": "token ids; both libraries on whole texts and plain counting",
    "pipeline": "scores, sketches and tokens; brute force of its stages",
}
