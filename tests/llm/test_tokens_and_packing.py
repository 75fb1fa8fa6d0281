"""Token files and packing against the tokenizers library on whole texts."""

import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from lakehand.llm import packing, pieces, simple8b, token_binary
from lakehand.llm.tokens import ByteBpe, PieceEncoder, default_path
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(default_path())
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@given(st.lists(st.integers(0, 2**32 - 1), max_size=600))
@settings(max_examples=60, deadline=None)
def test_simple8b_round_trip(ids):
    words, _ = simple8b.encode(np.array(ids, np.uint32))
    assert simple8b.decode(words).tolist() == ids


@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 2**32 - 1), st.integers(2**58 - 1, 2**64 - 1)), max_size=900),
       st.integers(0, 700))
@settings(max_examples=60, deadline=None)
def test_simple8b_blocks_decode_by_themselves(ids, zeros):
    ids = ids + [0] * zeros + ids[:50]
    words, offsets = simple8b.encode(np.array(ids, np.uint64))
    whole = simple8b.decode(words).tolist()
    assert whole == ids and len(offsets) == -(-len(ids) // simple8b.BLOCK)
    for b in range(len(offsets)):
        assert simple8b.decode_block(words, offsets, b).tolist() == whole[b * simple8b.BLOCK:(b + 1) * simple8b.BLOCK]


@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 2**64 - 1)), min_size=1, max_size=900), st.data())
@settings(max_examples=40, deadline=None)
def test_simple8b_ranges_read_their_blocks_alone(ids, data):
    words, offsets = simple8b.encode(np.array(ids, np.uint64))
    start = data.draw(st.integers(0, len(ids)))
    stop = data.draw(st.integers(start, len(ids)))
    first, last = start // simple8b.BLOCK, max(stop - 1, 0) // simple8b.BLOCK + 1
    spoilt = words.copy()
    spoilt[:offsets[first] if first < len(offsets) else 0] = 0      # other blocks are not looked at
    spoilt[offsets[last] if last < len(offsets) else len(words):] = 0
    assert simple8b.decode_range(spoilt, offsets, start, stop).tolist() == ids[start:stop]


def test_simple8b_packs_small_ids():
    words, _ = simple8b.encode(np.ones(6000, np.uint32))
    assert len(words) < 300


def test_pieces_encode_like_whole_texts(library, monkeypatch):
    rng = random.Random(1)
    alphabet = ["a", "B", "the", " ", "  ", "\n", "\t", ".", ",", "don't", "9", "123", "é", "\U0001f600", "'s", "-", "<|endoftext|>", " "]
    alphabet += ["word,", "Émile.", "a.b", "中文。", "x1!", "(y);", "\x0b", "\x1c", "\x85", "\u3000", "\u200b", "\u0301"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(600)] + [None, "", " ", "x" * 5000, "a ", "é, é, é,"]
    for size in (pieces.SLICE_BYTES, 50):       # whole texts, and texts in parts
        monkeypatch.setattr(pieces, "SLICE_BYTES", size)
        encoder = PieceEncoder(default_path())
        for _ in range(2):                      # learnt, then known
            for text, ids in zip(texts, encoder.encode(texts), strict=True):
                assert ids.tolist() == library(text), repr(text)


def test_words_are_learnt_without_punctuation_and_line_breaks(library):
    encoder = PieceEncoder(default_path())
    encoder.encode(["x alpha beta\nalpha", "x alpha$$$ beta!!"])
    learnt = encoder._n
    texts = ["x beta$$$ beta$$$\nalpha!! alpha!!\nalpha", "x alpha\nalpha$$$"]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == library(text)
    assert encoder._n == learnt


def test_words_about_line_breaks_encode_like_whole_texts(library):
    rng = random.Random(4)
    words = ["the", "Émile", "don't", "we'", "'s", "ll", "x1", "a_b", "9", "中文", "(y)", "é", "\u0301", "q" * 250]
    ends = ["", ".", "$$$", "!!", "'", "\"'", "_", "*" * 9, "…", "\u200b"]
    gaps = [" ", " ", "\n", "\n", "\n\n", " \n", "\n ", "\r\n", "\t", "\u3000", "\x85", "\x1c\n"]
    texts = ["".join(rng.choice(words) + rng.choice(ends) + rng.choice(gaps) for _ in range(rng.randint(1, 30))).rstrip(rng.choice(["", " \n"]))
             for _ in range(800)]
    encoder = PieceEncoder(default_path())
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert ids.tolist() == library(text), repr(text)


def test_a_batch_is_encoded_in_bounded_memory(monkeypatch):
    """The library gets few texts at a time, and arrays beside the ids grow with the words, not the ids."""
    most, library = [0], ByteBpe.library
    monkeypatch.setattr(ByteBpe, "library", lambda self, texts: most.append(sum(map(len, texts))) or library(self, texts))
    encoder = PieceEncoder(default_path())
    encoder.encode([f"x {' '.join(f'w{i}q{i * 7919}z' for i in range(60_000))}"])
    assert max(most) < 300_000
    text = "x " + "incomprehensibilitiesandmore123456789 " * 20_000 + "x"
    encoder.encode([text])
    tracemalloc.start()
    ids = encoder.encode([text] * 8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 * sum(i.nbytes for i in ids)


def test_token_files_read_back(spark, make_docs, library, tmp):
    rng = random.Random(2)
    rows = [(i * 3, " ".join(rng.choices(["alpha", "beta,", "x1", "Émile\n"], k=rng.randint(0, 80))), "en", "s") for i in range(90)]
    rng.shuffle(rows)
    token_binary.write_tokens(make_docs([*rows, (1000, None, None, None)]), f"{tmp}/tokens")
    got = sorted(token_binary.read_tokens(spark, f"{tmp}/tokens").collect())
    at = 0
    for r, (i, text, *_) in zip(got, [*sorted(rows), (1000, None)], strict=True):
        ids = library(text) + [2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(ids), crc(ids))
        at += len(ids)


def test_token_files_odd_rows(spark, odd_docs, no_docs, tmp):
    token_binary.write_tokens(odd_docs, f"{tmp}/odd")
    got = token_binary.read_tokens(spark, f"{tmp}/odd").collect()
    assert len(got) == odd_docs.count() and min(r.start for r in got) == 0
    token_binary.write_tokens(no_docs, f"{tmp}/none")
    assert token_binary.read_tokens(spark, f"{tmp}/none").count() == 0


def check_packing(rows, texts, library, window):
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append(r)
    for doc_id, text in texts.items():
        ids, at = library(text) + [1], 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[at:at + r.length])
            at += r.length
        assert at == len(ids)
    for own in places.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return len(places)


def test_packing_places_every_id_once(make_docs, library):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["tok", "longer", "x"], k=rng.randint(0, 260))), "en", "s") for i in range(120)]
    got = packing.pack(make_docs(rows), window=100).collect()
    used = check_packing(got, {r[0]: r[1] for r in rows}, library, 100)
    assert used * 100 < 1.05 * sum(r.length for r in got) + 100


def test_best_fit_takes_the_tightest_window():
    fit = packing.BestFit(10)
    assert [fit.put(n) for n in (7, 6, 4, 3, 10)] == [(0, 0), (1, 0), (1, 6), (0, 7), (2, 0)]


@given(st.lists(st.integers(1, 40), max_size=200))
@settings(max_examples=60, deadline=None)
def test_best_fit_equals_a_scan_of_all_windows(lengths):
    fit, room, made = packing.BestFit(40), {}, 0
    for n in sorted(lengths, reverse=True):
        window, offset = fit.put(n)
        fits = [r for r in room.values() if r >= n]
        if fits:        # the tightest open window, whichever of equal ones
            assert room[window] == min(fits) and offset == 40 - room[window]
        else:
            assert window == made and offset == 0
            room[window], made = 40, made + 1
        room[window] -= n
    assert fit.made == made


def test_packing_odd_rows(odd_docs, no_docs):
    got = packing.pack(odd_docs).collect()
    assert sum(r.doc_id is None for r in got) == 2
    assert [r.length for r in got if r.doc_id == 2] == [1] and sum(r.doc_id == 5 for r in got) == 2
    assert packing.pack(no_docs).count() == 0
