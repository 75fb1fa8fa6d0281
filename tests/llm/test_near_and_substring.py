"""Near duplicates, substring dedup and fingerprints against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from lakehand.llm import fingerprints, near_dedup, quality_classifier, substring_dedup, tokens
from lakehand.llm.words import window_hashes, word_slices
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingles(text, width):
    w = [re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in words(text)]
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def brute_components(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, n=60):
    """Texts with groups of edited copies that chain from one to the next, and a shared passage."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocab, k=60)
    rows, text = [], []
    for i in range(n):
        if i % 6 == 0:
            text = rng.choices(vocab, k=rng.randint(40, 160))
        elif i % 6 < 4:
            text = list(text)
            text[rng.randrange(len(text))] = "edit" + str(i)
        else:
            text = rng.choices(vocab, k=rng.randint(1, 40)) + passage
        rows.append((i, " ".join(text).upper() if i % 7 == 0 else "  ".join(text), "en", "s"))
    return rows


def test_near_dedup_is_the_brute_force_one(make_docs):
    for seed, width, percent in ((1, 3, 85), (2, 5, 80)):
        rows = corpus(seed)
        got = near_dedup.near_duplicates(make_docs(rows), width, percent).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components([r[:2] for r in rows], width, percent)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_lists_left_open_are_compared_in_full(make_docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "ROUNDS", 1)
    rows = corpus(3)
    got = near_dedup.near_duplicates(make_docs(rows), 3, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components([r[:2] for r in rows], 3, 85)


def test_near_dedup_odd_rows(odd_docs, no_docs):
    got = near_dedup.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[6].component_id == 5 and not by[6].kept and by[5].kept
    assert all(by[i].n_shingles == 0 and by[i].kept for i in (1, 2, 3)) and by[4].n_shingles == 1
    assert all(r.kept for r in got if r.doc_id is None)
    assert near_dedup.near_duplicates(no_docs).count() == 0
    kept = near_dedup.deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 1


def brute_substring(rows, width=13):
    starts = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - width + 1):
            key = tuple(w[k:k + width])
            starts[key] = min(starts.get(key, i), i)
    out = {}
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if starts[tuple(w[k:k + width])] < i:
                gone[k:k + width] = [True] * width
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out[i] = (len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def test_substring_dedup_is_the_brute_force_one(make_docs):
    for seed in (4, 5):
        rows = corpus(seed)
        got = substring_dedup.dedup(make_docs(rows)).collect()
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute_substring([r[:2] for r in rows])
        texts = {i: words(t) for i, t, *_ in rows}
        for r in got:       # factors are what is removed, one after the other, and stand in their sources
            assert sum(f.words for f in r.factors) == r.n_removed
            for f, after in zip(r.factors, [*r.factors[1:], None]):
                assert texts[r.doc_id][f.start:f.start + f.words] == texts[f.src_doc][f.src_start:f.src_start + f.words]
                assert f.src_doc < r.doc_id and (after is None or f.start + f.words <= after.start)
        assert any(r.factors for r in got)


@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 9), st.integers(0, 3), st.integers(0, 50)), max_size=12, unique_by=lambda r: r[0]))
@settings(max_examples=200, deadline=None)
def test_factors_tile_all_matches(runs):
    width = 5
    factors = substring_dedup.parse(runs, width)
    covered = {w for start, n, _, _ in runs for w in range(start, start + n + width - 1)}
    spans = [range(start, start + size) for start, size, _, _ in factors]
    assert all(len(x) > 0 for x in spans) and all(x.stop <= y.start for x, y in zip(spans, spans[1:]))
    assert {w for x in spans for w in x} == covered
    for start, size, src, src_start in factors:     # each lies in a match with its source, at its place
        assert all(any(s <= w < s + n + width - 1 and d == src and t + w - s == src_start + w - start for s, n, d, t in runs)
                   for w in range(start, start + size))


def test_common_phrase_is_dealt_over_blocks(spark, make_docs, monkeypatch):
    rng = random.Random(9)
    # The phrase of the least hash among many, so that it is the anchor of the windows around it.
    vocab = [f"w{i}" for i in range(3000)]
    texts = pa.array([" ".join(rng.choices(vocab, k=3)) for _ in range(3000)])
    grams = [window_hashes(w[o[i]:o[i + 1]], 3)[0] for _, _, w, o in word_slices(texts) for i in range(len(o) - 1)]
    phrase = texts[int(np.argmin(grams))].as_py()
    rows = [(i, " ".join([*rng.choices(vocab, k=15), phrase, *rng.choices(vocab, k=15)]), "en", "s") for i in range(300)]
    rows += [(300 + i, f"{rows[i][1]} tail{i}", "en", "s") for i in range(0, 300, 3)]
    monkeypatch.setattr(substring_dedup, "LEAST_WINDOWS", 100)
    docs = make_docs(rows).repartition(8, "doc_id")
    held = Counter()
    for r in substring_dedup.index_blocks(docs).collect():
        if r.posts:
            held[r.block] += len(substring_dedup.unpack(r.posts, [k for _, k in substring_dedup._POST] + ["<u4", "u1"])[-1])
    share = sum(len(words(t)) for _, t, _, _ in rows) // (4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    assert max(held.values()) <= 5 * max(share, 100)
    got = substring_dedup.dedup(docs).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute_substring([r[:2] for r in rows])
    assert sum(r.n_removed > 0 for r in got) == 100


def test_substring_dedup_odd_rows(odd_docs, no_docs):
    got = substring_dedup.dedup(odd_docs).collect()
    assert len(got) == odd_docs.count() and not any(r.n_removed for r in got)
    assert substring_dedup.dedup(no_docs).count() == 0


def test_fingerprints_edits_and_estimates(make_docs):
    rows = corpus(6)
    texts = dict(r[:2] for r in rows)
    got = {r.doc_id: r for r in fingerprints.report(make_docs(rows)).collect()}
    order = sorted(texts, reverse=True)
    for i, after in zip(order, order[1:] + order[:1], strict=True):
        half = len(texts[i]) // 2
        edited = texts[i][:len(texts[i]) - half] + texts[after][:half]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(texts[i])
        # Unedited case: fingerprint words are compared as they stand.
        cased = lambda t: {tuple(words(t)[k:k + 5]) for k in range(max(1, len(words(t)) - 4))}
        a, b = cased(texts[i]), cased(edited)
        if len(a | b) <= fingerprints.K:
            assert abs(got[i].near_edited - len(a & b) / len(a | b)) < 1e-9
        else:
            assert abs(got[i].near_edited - len(a & b) / len(a | b)) < 0.25


def test_fingerprint_parts_merge_into_the_whole(spark):
    a, b = [" ".join(f"{p}{i}" for i in range(300)) for p in "ab"]
    both = spark.createDataFrame([(1, a), (1, b)], "k long, text string").select("k", fingerprints.sketch(F.col("text")).alias("s"))
    merged = fingerprints.merged(both, "k", "s").first().s
    expected = sorted({v for r in both.collect() for v in r.s})[:fingerprints.K]
    assert merged == expected
    text = spark.createDataFrame([(merged,)], "s array<long>").select(fingerprints.as_text(F.col("s")).alias("t"))
    assert text.select(fingerprints.from_text(F.col("t")).alias("s")).first().s == expected


def test_fingerprints_odd_rows(odd_docs, no_docs):
    got = fingerprints.report(odd_docs).collect()
    assert len(got) == odd_docs.count()
    same = {r.fingerprint for r in got if r.doc_id in (5, 6)}
    assert len(same) == 1 and all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in got)
    assert fingerprints.report(no_docs).count() == 0


def test_workers_of_other_operators_hold_no_tokenizer():
    texts = ["one two three four five six", "", None]
    ids, label = pa.array([1, 2, 3], pa.int64()), pa.array([1, 2, 3], pa.int64())
    plain = pa.RecordBatch.from_arrays([ids, label, pa.array(texts)], ["doc_id", "label", "text"])
    pairs = pa.RecordBatch.from_arrays([pa.array([1, 1], pa.int64()), pa.array([0, 0], pa.int32()), pa.array([1, 2], pa.int64()),
                                        pa.array(texts[:1] * 2)], ["b", "part", "id", "text"])
    listed = plain.rename_columns(["id", "label", "text"])
    for rows, batch, column, out in [(near_dedup.profiles(5, 32), plain, "n_shingles", [2, 0, 0]), (near_dedup.check_pairs(5, 80), pairs, "a", [2]),
                                     (near_dedup.list_sets(5), listed, "size", [2, 2]), (quality_classifier.stat_rows, plain, "doc_id", [1, 2, 3])]:
        held = tokens.encoder(tokens.default_path())
        held.encode(["some words in the cache"])
        made = [x for b in rows(iter([batch])) for x in b.column(column).to_pylist()]
        assert not tokens._encoders, rows.__name__
        assert made == out
        again = tokens.encoder(tokens.default_path())      # made anew where it is asked for
        assert again is not held and [x.tolist() for x in again.encode(["some words"])] == [x.tolist() for x in held.encode(["some words"])]
