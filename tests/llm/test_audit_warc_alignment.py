"""Filter audit, WARC archives and tokenizer alignment against brute force."""

import base64
import gzip
import hashlib
import io
import itertools
import random
import re
from collections import Counter
from math import factorial

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from lakehand.llm import alignment, filter_audit, warc
from lakehand.llm.common import hot_safe_lookup
from tokenizers import Tokenizer

LABELS = "doc_id long, quality int, toxic int"


# ---- filter audit

def brute_steps(letters, counts):
    """Steps of every order by filtering the masks one filter after the other."""
    steps, shapley = {}, Counter()
    for order in itertools.permutations(range(len(letters))):
        live = dict(counts)
        for k, f in enumerate(order, 1):
            gone = {m: w for m, w in live.items() if m >> f & 1}
            live = {m: w for m, w in live.items() if not m >> f & 1}
            removed = [sum(w[i] for w in gone.values()) for i in range(3)]
            failing = sum(w[0] for m, w in counts.items() if m >> f & 1)
            shapley[f] += removed[0]
            steps["".join(letters[x] for x in order), k] = (f, [sum(w[0] for w in live.values()), removed[0], failing - removed[0],
                                                                counts.get(1 << f, (0,))[0], *removed[1:]])
    return {key: (*row, shapley[f]) for key, (f, row) in steps.items()}


@given(st.integers(1, 5).flatmap(lambda n: st.tuples(st.just(n), st.dictionaries(
    st.integers(0, 2**n - 1), st.tuples(st.integers(1, 9), st.integers(0, 9), st.integers(0, 9)), min_size=1))))
@settings(max_examples=40, deadline=None)
def test_diagram_paths_equal_filtering(case):
    n, counts = case
    letters = "ABCDE"[:n]
    got = {(r[1], r[2]): r[3:] for r in filter_audit.audit_part("p", letters, counts)}
    assert got == brute_steps(letters, counts)


@pytest.mark.parametrize("n", range(6))
def test_adjacent_swaps_visit_every_order_once(n):
    order = list(range(n))
    seen = {tuple(order)}
    swaps = list(filter_audit.adjacent_swaps(n))
    for level in swaps:
        order[level], order[level + 1] = order[level + 1], order[level]
        seen.add(tuple(order))
    assert len(seen) == factorial(n) and len(swaps) == factorial(n) - 1


def brute_audit(rows, labels):
    marks = {}
    for i, quality, toxic in labels:
        good, bad = marks.get(i, (0, 0))
        marks[i] = max(good, quality == 1), max(bad, toxic == 1)
    first = {}
    for i, text, *_ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    parts = {}
    for i, text, lang, *_ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        flags = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 bool(re.search(r"[#$%&*|]", t)), i is not None and i > first[t]]
        mask = sum(f << k for k, f in enumerate(flags))
        good, toxic = marks.get(i, (0, 0)) if i is not None else (0, 0)
        w = parts.setdefault(lang or "", {}).get(mask, (0, 0, 0))
        parts[lang or ""][mask] = (w[0] + 1, w[1] + good, w[2] + toxic)
    return {(p, *key): row for p, counts in parts.items() for key, row in brute_steps("ABCDE", counts).items()}


def audited(df):
    return {tuple(r[:3]): tuple(r[3:]) for r in map(tuple, df.collect())}


def test_audit_of_odd_rows(spark, odd_docs, no_docs):
    labels = [(5, 1, None), (5, None, 1), (6, 1, 0), (7, 0, 1), (None, 1, 1), (0, 1, 0)]
    frame = spark.createDataFrame(labels, LABELS)
    rows = [tuple(r)[:3] for r in odd_docs.collect()]
    got = filter_audit.report(odd_docs, frame)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                           "toxic_lost", "shapley"]
    assert audited(got) == brute_audit(rows, labels)
    assert filter_audit.report(no_docs, frame).count() == 0


def test_audit_of_a_hot_copy(spark, make_docs):
    rng = random.Random(4)
    texts = ["same TEXT # again"] * 200 + [" ".join(rng.choices("abcdefgh", k=rng.randint(0, 400))) for _ in range(60)]
    rows = [(i, rng.choice(texts), rng.choice(["en", "de", None]), "s") for i in range(600)]
    labels = [(i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 600, 2)]
    got = filter_audit.report(make_docs(rows), spark.createDataFrame(labels, LABELS))
    assert audited(got) == brute_audit(rows, labels)


# ---- WARC

def pages(spark, rows, extra=False):
    if extra:
        return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, digest string, first string")
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def brute_pages(rows, min_bytes=0):
    first = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= min_bytes:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        f = first.get(html or "")
        later = i is not None and f is not None and i > f
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if later else "response",
                    f if later else None))
    return sorted(out, key=repr)


PAGES = [(3, "http://a/b c", "<p>x</p>"), (1, "http://a/é\r\nX-Bad: 1", "<p>x</p>"), (2, None, None), (4, "", ""), (7, "u", "<p>x</p>"),
         (7, "u", "<p>x</p>"), (None, "n", "<p>x</p>"), (None, None, None), (9, "big", "z\U0001f600" * 300_000), (10, "big", "z" * 10),
         (11, "r", "random " + "".join(random.Random(1).choices("abcdef\r\n", k=5000)))]


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_pages_read_back(spark, tmp, min_bytes):
    warc.write_archives(pages(spark, PAGES, extra=True).repartition(3), f"{tmp}/w", min_bytes=min_bytes, archive_bytes=2000)
    read = warc.read_archives(spark, f"{tmp}/w")
    got = [tuple(r)[:5] for r in warc.page_records(read).collect()]
    assert sorted(got, key=repr) == brute_pages(PAGES, min_bytes)
    assert read.where("not verified").isEmpty() and warc.broken_revisits(read).isEmpty()
    payloads = warc.read_archives(spark, f"{tmp}/w", payloads=True).where("record_type = 'response' and record_id = 'urn:page:9'").first()
    assert payloads["payload"].decode() == PAGES[8][2]


def test_archives_are_plain_gzip_of_whole_records(spark, tmp):
    import glob
    warc.write_archives(pages(spark, PAGES).coalesce(1), f"{tmp}/w")
    (file,) = glob.glob(f"{tmp}/w/*.warc.gz")
    data = gzip.open(file).read()
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and data.endswith(b"\r\n\r\n")
    assert b"\r\nX-Bad" not in data
    found = list(warc.records(open(file, "rb")))
    assert len(found) == len(PAGES) + 1
    for r in found:     # an archive can be entered at every record
        stream = open(file, "rb")
        stream.seek(r.offset)
        assert next(warc.records(stream)).fields == r.fields


def test_no_pages(spark, tmp):
    warc.write_archives(pages(spark, []), f"{tmp}/w")
    assert warc.page_records(warc.read_archives(spark, f"{tmp}/w")).count() == 0


def test_broken_archives_are_told(spark):
    good = warc.page_record(1, "u", b"payload " * 500, None, None, "1970-01-01T00:00:00Z")
    assert [r.payload for r in warc.records(io.BytesIO(good + good), keep=True)] == [b"payload " * 500] * 2
    plain = gzip.decompress(good)
    for bad, why in [(good + good[:-20], "ends within"), (gzip.compress(plain.replace(b"payload p", b"payload q", 1)), "wrong digest"),
                     (gzip.compress(plain[:-9]), "before its content length"), (gzip.compress(plain + b"x"), "longer than"),
                     (gzip.compress(plain.replace(b"Content-Length", b"Content-Width")), "no content length"),
                     (gzip.compress(b"HTTP/1.1 200\r\n\r\n"), "no WARC"), (b"no gzip at all", "header")]:
        with pytest.raises(ValueError, match=why):
            list(warc.records(io.BytesIO(bad)))
    odd = list(warc.records(io.BytesIO(gzip.compress(plain.replace(b"payload p", b"payload q", 1))), strict=False))
    assert [r.verified for r in odd] == [False]


def test_foreign_records_read_alike():
    block = b"any bytes at all"
    fields = b"WARC/1.0\r\nwarc-type: resource\r\nWARC-Record-ID: <urn:uuid:1>\r\nX-Note: one\r\n two\r\nContent-Length: %d\r\n\r\n" % len(block)
    (r,) = warc.records(io.BytesIO(gzip.compress(fields + block + b"\r\n\r\n")), keep=True)
    assert r.payload == block and r.fields["x-note"] == "one two" and r.verified


def test_lookup_of_hot_keys_equals_a_join(spark):
    rows = spark.createDataFrame([(i, None if i % 11 == 0 else "hot" if i % 3 else f"k{i % 1500}") for i in range(6000)], "id long, k string")
    table = rows.where("k is not null").groupBy("k").agg({"id": "min", "*": "count"}).toDF("k", "low", "n")
    got = hot_safe_lookup(rows, table, "k", "id")
    assert got.columns == ["id", "k", "low"]
    expected = rows.join(table.drop("n"), "k", "left").select("id", "k", "low")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


# ---- alignment

@pytest.fixture(scope="module")
def brute_alignment():
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lib.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte = alignment.byte_alphabet()

    def spans(tokens):
        ends = list(itertools.accumulate(map(len, tokens)))
        return list(zip([0, *ends], ends))

    def align(rows):
        docs, held = [], Counter()
        for i, t in rows:
            docs.append([i, 0, 0, 0, [], ""])
            if not t:
                continue
            a, b = lib.encode(" " + t, add_special_tokens=False).ids, pieces.encode(t)
            bytes_a = [bytes(byte[c] for c in lib.id_to_token(x)) for x in a]
            names = [pieces.id_to_piece(x) for x in b]
            bytes_b = [bytes([int(n[3:5], 16)]) if pieces.is_byte(x) else n.replace("▁", " ").encode() for x, n in zip(b, names)]
            if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + t).encode():
                continue
            at_a, at_b = spans(bytes_a), spans(bytes_b)
            byte_a, byte_b = ([k for k, (s, e) in enumerate(at) for _ in range(s, e)] for at in (at_a, at_b))
            links = [(a[x], b[y]) for x, y in dict.fromkeys(zip(byte_a, byte_b))]
            ends = sorted({e for _, e in at_a} & {e for _, e in at_b})
            groups, k, m = [], 0, 0
            for end in ends:
                sides = []
                for ids, at, from_ in ((a, at_a, k), (b, at_b, m)):
                    to = next(n for n in range(from_, len(at)) if at[n][1] == end) + 1
                    sides.append((",".join(map(str, ids[from_:to])), to))
                (left, k), (right, m) = sides
                groups.append(f"{left}|{right}")
            held.update(set(links))
            docs[-1] = [i, len(a), len(b), len(ends), links, hashlib.sha256(";".join(groups).encode()).hexdigest()]
        most = {}
        for (x, _), n in held.items():
            most[x] = max(most.get(x, 0), n)
        return sorted(((i, na, nb, ng, len(ls), sum(held[p] == most[p[0]] for p in ls), sum(held[p] for p in ls), sha)
                       for i, na, nb, ng, ls, sha in docs), key=repr)
    return align


ALPHABET = ["a", "B", "the", " ", "  ", "\n", "\t", ".", "don't", "9", "é", "\U0001f600", "<s>", "<0x41>", "<|endoftext|>", "▁",
            "　", "\x0b", "\x85", "中文", "ing ", " token"]


def odd_texts(n):
    rng = random.Random(5)
    return [(i, "".join(rng.choices(ALPHABET, k=rng.randint(0, 25)))) for i in range(n)]


def test_alignment_equals_brute_force(spark, brute_alignment):
    rows = odd_texts(400) + [(None, "no id"), (None, None), (7, ""), (7, " "), (7, "twice"), (7, "twice"), (8, "x" * 3000)]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, block int, part string")
    got = alignment.align(docs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_alignment(rows)


def test_alignment_merges_in_levels(spark, brute_alignment, monkeypatch):
    monkeypatch.setattr(alignment, "FAN", 4)
    rows = odd_texts(60)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(11)
    assert sorted(map(tuple, alignment.align(docs).collect()), key=repr) == brute_alignment(rows)


def test_alignment_of_odd_and_no_rows(odd_docs, no_docs, brute_alignment):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert sorted(map(tuple, alignment.align(odd_docs).collect()), key=repr) == brute_alignment(rows)
    assert alignment.align(no_docs).count() == 0


def test_texts_in_parts_align_like_whole_ones(monkeypatch):
    import pyarrow as pa
    from lakehand.llm import pieces
    texts = pa.array([t for _, t in odd_texts(80)] + ["word " * 300, "a▁b " * 40])
    plain = [(d.row, d.counts, d.groups_sha256, d.pairs.tolist(), d.links.tolist())
             for d in alignment.align_texts(alignment.Aligner(*alignment.default_paths()), texts)]
    monkeypatch.setattr(pieces, "SLICE_BYTES", 30)
    parts = [(d.row, d.counts, d.groups_sha256, d.pairs.tolist(), d.links.tolist())
             for d in alignment.align_texts(alignment.Aligner(*alignment.default_paths()), texts)]
    assert sorted(parts) == sorted(plain)
