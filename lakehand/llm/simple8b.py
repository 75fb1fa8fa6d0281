"""Simple-8b: word-aligned coding of unsigned integers with numpy.

A 64-bit word holds a 4-bit selector and 60 bits: 240 or 120 zeros, or ``n`` values
of ``60 // n`` bits.  Values of 2**60 and more take two escape words (selector 15)
with 32 bits each, high half first.  Every block of ``BLOCK`` values starts at a
word of its own, whose offset is kept, so blocks are coded and decoded side by side.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256

#: Values per word and bits per value, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 15
# Selector 15 is both "one value of 60 bits" and the escape; bits 58-59 tell them apart:
# 0 for a value below 2**58, 2 for the high half and 3 for the low half of an escaped one.
_PLAIN_BITS = 58

# The most values that fit when the widest has so many bits, and the selector for a count.
_FIT = np.array([max([c for c, b in zip(COUNTS, BITS) if b >= w and not (c == 1 and w > _PLAIN_BITS)], default=1)
                 for w in range(65)])
_SELECTOR = np.array([next(s for s, c in enumerate(COUNTS) if c <= max(r, 1)) for r in range(241)])
_U = np.uint64


def bit_lengths(values: np.ndarray) -> np.ndarray:
    if not len(values) or values.max() < _U(1 << 32):
        return np.frexp(values.astype(np.float64))[1]
    high = (values >> _U(32)).astype(np.float64)
    low = (values & _U(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, np.frexp(high)[1] + 32, np.frexp(low)[1])


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, offset of each block's first word)."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    starts = np.arange(0, n, BLOCK)
    ends = np.minimum(starts + BLOCK, n)
    bits = bit_lengths(values) if n else np.zeros(0, np.int64)
    # Greedy choice for all blocks at once: each step takes one word of every block.
    pos, lane = starts.copy(), np.arange(len(starts))
    taken_at, taken_sel, taken_lane = [], [], []
    while len(pos):
        run, widest = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
        live, k = np.arange(len(pos)), 0
        end = ends[lane]
        while len(live) and k < 240:
            live = live[pos[live] + k < end[live]]
            widest[live] = np.maximum(widest[live], bits[pos[live] + k])
            live = live[_FIT[widest[live]] > k]
            run[live] = k + 1
            k += 1
        sel = _SELECTOR[run]
        taken_at.append(pos)
        taken_sel.append(sel)
        taken_lane.append(lane)
        pos = pos + COUNTS[sel]
        more = pos < end
        pos, lane = pos[more], lane[more]
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at, sel, lanes = map(np.concatenate, (taken_at, taken_sel, taken_lane))
    order = np.argsort(at, kind="stable")
    at, sel, lanes = at[order], sel[order], lanes[order]
    escaped = (sel == ESCAPE) & (bits[at] > _PLAIN_BITS)
    size = 1 + escaped
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for s in range(16):
        rows = np.flatnonzero((sel == s) & ~escaped)
        if not len(rows):
            continue
        word = np.full(len(rows), s << 60, np.uint64)
        if BITS[s]:
            for k in range(COUNTS[s]):
                word |= values[at[rows] + k] << _U(k * BITS[s])
        words[place[rows]] = word
    if escaped.any():
        v, to = values[at[escaped]], place[escaped]
        words[to] = _U((ESCAPE << 60) | (2 << 58)) | (v >> _U(32))
        words[to + 1] = _U((ESCAPE << 60) | (3 << 58)) | (v & _U(0xFFFFFFFF))
    first = np.searchsorted(lanes, np.arange(len(starts)))
    return words, place[first]


def decode(words: np.ndarray) -> np.ndarray:
    """All values of the words, in order."""
    words = np.ascontiguousarray(words, np.uint64)
    sel = (words >> _U(60)).astype(np.int64)
    kind = np.where(sel == ESCAPE, (words >> _U(58)) & _U(3), 0).astype(np.int64)
    size = np.where(kind == 3, 0, COUNTS[sel])
    place = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint64)
    for s in range(2, 16):
        rows = np.flatnonzero((sel == s) & (kind == 0))
        if len(rows):
            mask = _U((1 << int(BITS[s])) - 1) if s < ESCAPE else _U((1 << _PLAIN_BITS) - 1)
            for k in range(COUNTS[s]):
                out[place[rows] + k] = (words[rows] >> _U(k * BITS[s])) & mask
    high = np.flatnonzero(kind == 2)
    if len(high):
        half = _U(0xFFFFFFFF)
        out[place[high]] = ((words[high] & half) << _U(32)) | (words[high + 1] & half)
    return out


def decode_range(words: np.ndarray, offsets: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Values ``start`` to ``stop``, from the blocks that hold them alone."""
    if stop <= start:
        return np.zeros(0, np.uint64)
    first, last = start // BLOCK, (stop - 1) // BLOCK + 1
    to = offsets[last] if last < len(offsets) else len(words)
    return decode(words[offsets[first]:to])[start - first * BLOCK:stop - first * BLOCK]


def decode_block(words: np.ndarray, offsets: np.ndarray, block: int) -> np.ndarray:
    """Values of one block, without reading the others."""
    to = offsets[block + 1] if block + 1 < len(offsets) else len(words)
    return decode(words[offsets[block]:to])
