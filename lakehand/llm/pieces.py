"""Texts cut into pieces that tokenizers encode alike alone and in their text.

Neither byte-level BPE nor a piece vocabulary without inner spaces joins a character with
a space behind it.  So a text may be cut before every space that follows a character that
is no white space, and each piece be encoded by itself.  Pieces repeat far more often
than texts, so every distinct piece is encoded once.  ``tests/llm`` compare this with
encoding whole texts.

A *word* is a piece without its leading space; the first word of a text is all before
its first cut, whatever it begins with.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are cut at a time; a longer text comes in parts.
SLICE_BYTES = 8_000_000

_CUT = re.compile(r"(?<=\S)(?= )")
_SPACE = r"[\s\v\x1c-\x1f\x{85}\p{Z}]"
#: Texts where a space stands at the start or behind white space, or white space at the end.
_ODD = f"^ |{_SPACE} |{_SPACE}$"


def strings(texts: pa.Array) -> list[str | None]:
    """The array's strings as Python's; ``to_pylist`` takes twenty times as long."""
    return texts.to_numpy(zero_copy_only=False).tolist()


class Slice(NamedTuple):
    """Words of some rows: ``words[codes[offsets[i]:offsets[i + 1]]]`` are those of row ``rows[i]``.
    A long row comes in successive parts: ``begins`` and ``ends`` tell the first and the last.  The
    first word of a part that does not begin its row follows a space like the others."""
    rows: np.ndarray
    words: list[str]
    codes: np.ndarray
    offsets: np.ndarray
    begins: bool = True
    ends: bool = True


def _parts(text: str) -> Iterator[tuple[str, bool]]:
    """A long text in parts that begin at cuts, and whether each is the last."""
    at = 0
    while len(text) - at > SLICE_BYTES:
        cut = _CUT.search(text, at + SLICE_BYTES)
        if not cut:
            break
        yield text[at:cut.start()], False
        at = cut.start()
    yield text[at:], True


def _listed(rows: list[int], lists: list[list[str]], begins: bool = True, ends: bool = True) -> Slice:
    words: dict[str, int] = {}
    codes = np.array([words.setdefault(w, len(words)) for one in lists for w in one], np.int64)
    return Slice(np.array(rows), list(words), codes, np.cumsum([0, *map(len, lists)]), begins, ends)


def _odd_words(text: str, begins: bool) -> list[str]:
    first, *rest = _CUT.split(text)
    return [first if begins else first[1:], *[p[1:] for p in rest]]


def slices(texts: pa.Array) -> Iterator[Slice]:
    """Slices of an array of strings; null and empty texts come in none, the others in order of their parts."""
    texts = texts.cast(pa.large_string())
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(size)
    row = 0
    while row < len(texts):
        to = max(row + 1, int(np.searchsorted(total, (total[row - 1] if row else 0) + SLICE_BYTES, "right")))
        rows = np.arange(row, to)[size[row:to] > 0]
        row = to
        if len(rows) == 1 and size[rows[0]] > SLICE_BYTES:
            for k, (part, last) in enumerate(_parts(texts[int(rows[0])].as_py())):
                yield _listed([rows[0]], [_odd_words(part, k == 0)], k == 0, last)
            continue
        if not len(rows):
            continue
        part = texts.take(pa.array(rows))
        odd = pc.match_substring_regex(part, _ODD).to_numpy(zero_copy_only=False)
        if odd.any():
            yield _listed(rows[odd].tolist(), [_odd_words(t, True) for t in strings(part.filter(pa.array(odd)))])
            part, rows = part.filter(pa.array(~odd)), rows[~odd]
        if len(rows):
            split = pc.split_pattern(part, " ")
            flat = split.flatten().dictionary_encode()
            yield Slice(rows, strings(flat.dictionary), flat.indices.to_numpy(zero_copy_only=False).astype(np.int64),
                        np.asarray(split.offsets).astype(np.int64) - int(split.offsets[0].as_py()))


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers ``start[i] ... start[i] + size[i] - 1`` for all ``i``, one after the other."""
    total = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=total[1:])
    return np.arange(total[-1]) + np.repeat(start - total[:-1], size)
