"""Vectorised hashes of words and word windows, for operators that run numpy inside tasks.

A slice of an Arrow string column is hashed as one byte array.  Word and window
hashes are 64-bit prefix polynomials over random byte values, so their cost is a
few passes over the bytes, whatever the number of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at a time; temporary arrays take about twenty times as much.
SLICE_BYTES = 400_000

_U = np.uint64
_BASE = (_U(0x9E3779B97F4A7C15), _U(0xD1B54A32D192ED03))
_INVERSE = tuple(_U(pow(int(b), -1, 1 << 64)) for b in _BASE)
_powers: dict[tuple[int, bool], np.ndarray] = {}

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
_VALUE_LOWER = _VALUE.copy()
_VALUE_LOWER[65:91] = _VALUE[97:123]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all output bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(n: int, which: int, inverse: bool = False) -> np.ndarray:
    have = _powers.get((which, inverse))
    if have is None or len(have) < n:
        size = max(n, 1 << 16, 2 * len(have) if have is not None else 0)
        out = np.full(size, (_INVERSE if inverse else _BASE)[which])
        out[0] = 1
        _powers[(which, inverse)] = have = np.multiply.accumulate(out)
    return have[:n]


def _byte_words(data: np.ndarray, bounds: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in ``data`` and the byte where each starts; no word crosses a bound."""
    n = len(data)
    space = _SPACE[data]
    begin, close = ~space, ~space
    begin[1:] &= space[:-1]
    close[:-1] &= space[1:]
    inner = bounds[(bounds > 0) & (bounds < n)]
    begin[inner] = ~space[inner]
    close[inner - 1] = ~space[inner - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(close) + 1
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((_VALUE_LOWER if lower else _VALUE)[data] * _power(n, 0), out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * _power(n, 0, True)[starts] + (ends - starts).astype(np.uint64)), starts


def _long_words(data: np.ndarray, lower: bool) -> np.ndarray:
    """Words of one very long text, piece by piece; pieces end at white space."""
    out, at = [], 0
    while at < len(data):
        to = min(len(data), at + SLICE_BYTES)
        while to < len(data):
            free = np.flatnonzero(_SPACE[data[to:to + SLICE_BYTES]])
            if len(free):
                to += int(free[0])
                break
            to = min(len(data), to + SLICE_BYTES)
        out.append(_byte_words(data[at:to], np.array([0]), lower)[0])
        at = to
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def word_slices(texts: pa.Array, lower: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, row after the last, word hashes, word offsets of each row in them).

    Null texts have no words.  ``lower`` maps A-Z to a-z first.
    """
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null(b"")
    n = len(texts)
    if not n:
        return
    offs = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        to = max(row + 1, int(np.searchsorted(offs, offs[row] + SLICE_BYTES, "right")) - 1)
        part = data[offs[row]:offs[to]]
        bounds = offs[row:to + 1] - offs[row]
        if to == row + 1 and len(part) > SLICE_BYTES:
            h = _long_words(part, lower)
            yield row, to, h, np.array([0, len(h)], np.int64)
        else:
            h, starts = _byte_words(part, bounds, lower) if len(part) else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            yield row, to, h, np.searchsorted(starts, bounds).astype(np.int64)
        row = to


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` successive words, also of windows that cross rows."""
    n = len(words)
    if n < width:
        return np.zeros(0, np.uint64)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(words * _power(n, 1), out=prefix[1:])
    return mix((prefix[width:] - prefix[:-width]) * _power(n, 1, True)[:n - width + 1] + _U(width))


def shingle_sets(texts: pa.Array, width: int, lower: bool = False) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its ``width``-word shingles; a shorter text
    has its whole word sequence as one shingle, a text without words has none."""
    for row, to, words, offs in word_slices(texts, lower):
        grams = window_hashes(words, width)
        for i in range(to - row):
            a, b = offs[i], offs[i + 1]
            if b - a >= width:
                yield np.unique(grams[a:b - width + 1])
            elif b > a:
                yield window_hashes(words[a:b], int(b - a))
            else:
                yield np.zeros(0, np.uint64)
