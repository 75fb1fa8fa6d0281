"""Token ids of whole texts by the ``tokenizers`` library, each distinct piece of text encoded once."""

from __future__ import annotations

import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lakehand.llm.common import worker_cache
from lakehand.llm.pieces import ragged, slices, strings

#: Words kept by a worker before its cache starts anew; only speed depends on it.
CACHE_WORDS = 400_000
#: Longer words are encoded wherever they occur, so the cache stays small.
_LONG_WORD = _LONG_PIECE = 200
_INK = r"[^\s\v\x1c-\x1f\x{85}\p{Z}]"
#: Pieces whose neighbours do not change their ids: a space or line break before, no white space at the end.
_PLAIN = rf"(?s)^[ \n].*{_INK}$"
#: A word that ends in a letter and punctuation.
_TAIL = r"(?s)^(?P<stem>.*\p{L})(?P<tail>[!-/:-@\[-`{-~]{1,8})$"
#: Two words with nothing but a line break between them.
_BROKEN = rf"^(?P<word>{_INK}+)\n(?P<line>{_INK}+)$"
#: New pieces that go through the library as one text, and such texts at a time.
_JOINED, _TEXTS = 50, 200
#: Words whose ids are put together at a time.
_GATHERED = 100_000

_encoders: dict[str, PieceEncoder] = worker_cache()


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


class ByteBpe:
    """A byte-level BPE from a file of the ``tokenizers`` library."""

    def __init__(self, path: str, plain_special: bool = False):
        """``plain_special``: special tokens' strings in a text are plain text."""
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        if plain_special:
            self._tok.encode_special_tokens = True
        self.special = [t.content for t in self._tok.get_added_tokens_decoder().values()]
        self.vocabulary = self._tok.get_vocab()
        self.bytes = np.zeros(max(self.vocabulary.values(), default=0) + 1, np.int64)
        for token, i in self.vocabulary.items():     # one character of a byte-level token is one byte
            self.bytes[i] = len(token)

    def library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _flat(self, texts: list[str]) -> np.ndarray:
        """Ids of all texts; the library's results take some thirty times as much memory."""
        return np.concatenate([np.zeros(0, np.uint32), *(
            np.fromiter(chain.from_iterable(self.library(texts[i:i + _TEXTS])), np.uint32) for i in range(0, len(texts), _TEXTS))])

    def _joint(self, pieces: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Pieces that begin with white space and end without it are cuts of their joined text,
        found again by the tokens' bytes."""
        flat = self._flat(["".join(pieces[i:i + _JOINED]) for i in range(0, len(pieces), _JOINED)])
        ends = np.cumsum(sizes)
        token_ends = np.cumsum(self.bytes[flat])
        cuts = np.searchsorted(token_ends, ends)
        if len(cuts) and (cuts[-1] != len(flat) - 1 or np.any(token_ends[cuts] != ends)):
            return None
        return flat, np.diff(cuts, prepend=-1)

    def pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, and how many each has."""
        texts = pa.array(pieces, pa.large_string())
        sizes = pc.binary_length(texts).to_numpy()
        plain = pc.match_substring_regex(texts, _PLAIN).to_numpy(zero_copy_only=False) & (sizes <= _LONG_PIECE)
        joint = self._joint(pieces if plain.all() else strings(texts.filter(pa.array(plain))), sizes[plain])
        if joint is None:
            plain[:] = False
            joint = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        alone = self.library(strings(texts.filter(pa.array(~plain))))
        size = np.empty(len(pieces), np.int64)
        size[plain], size[~plain] = joint[1], list(map(len, alone))
        if not alone:
            return joint[0], size
        both = np.concatenate([joint[0], np.fromiter(chain.from_iterable(alone), np.uint32)])
        start = np.empty(len(pieces), np.int64)
        start[plain] = np.cumsum(size[plain]) - size[plain]
        start[~plain] = len(joint[0]) + np.cumsum(size[~plain]) - size[~plain]
        return both[ragged(start, size)], size


class PieceEncoder:
    """Encodes texts; a letter and punctuation behind it are never one token, nor are a line break
    and what stands about it, so the worker's cache holds words without their last punctuation and
    the two words about a line break each by itself."""

    def __init__(self, path: str):
        self._bpe = ByteBpe(path)
        self._special = "|".join(map(re.escape, self._bpe.special)) or None
        self._clear()

    def _clear(self):
        self._word: dict[str, int] = {}
        self._line: dict[str, int] = {"": 0}
        self._tail: dict[str, int] = {"": 0}
        self._ids = np.zeros(1 << 16, np.uint32)
        self._off = np.zeros(1 << 15, np.int64)
        self._used, self._n = 0, 1      # row 0 is empty

    def _learn(self, row: dict[str, int], words: list[str], pieces: list[str]):
        flat, size = self._bpe.pieces(pieces)
        if self._used + len(flat) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros(max(len(self._ids), len(flat)), np.uint32)])
        if self._n + len(words) + 1 > len(self._off):
            self._off = np.concatenate([self._off, np.zeros(max(len(self._off), len(words) + 1), np.int64)])
        self._ids[self._used:self._used + len(flat)] = flat
        self._off[self._n + 1:self._n + 1 + len(words)] = self._used + np.cumsum(size)
        row.update(zip(words, range(self._n, self._n + len(words))))
        self._used += len(flat)
        self._n += len(words)

    def _rows(self, row: dict[str, int], words: list[str], before: str) -> np.ndarray:
        rows = np.array(list(map(row.get, words, repeat(-1))), np.int64)
        new = np.flatnonzero(rows < 0)
        if len(new):
            unknown = list(dict.fromkeys(words[i] for i in new))
            self._learn(row, unknown, [before + w for w in unknown])
            rows[new] = [row[words[i]] for i in new]
            for w in unknown:
                if len(w) > _LONG_WORD:
                    del row[w]
        return rows

    def _ends(self, row: dict[str, int], texts: pa.Array, before: str) -> list[np.ndarray]:
        """Rows of the words in the cache and of their last punctuation."""
        parts = pc.extract_regex(texts, _TAIL)
        has = pc.is_valid(parts)
        stem = self._rows(row, strings(pc.if_else(has, parts.field("stem"), texts)), before)
        ends = pc.if_else(has, parts.field("tail"), "").dictionary_encode()     # a few hundred
        return [stem, self._rows(self._tail, strings(ends.dictionary), "")[ends.indices.to_numpy(zero_copy_only=False)]]

    def _table(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words that stand behind a space: all ids, each word's start and number."""
        if self._n > CACHE_WORDS:
            self._clear()
        rows = np.zeros((len(texts), 4), np.int64)      # word, its end, the line behind it, its end
        breaks = np.flatnonzero(pc.match_substring(texts, "\n").to_numpy(zero_copy_only=False))
        if len(breaks):
            parts = pc.extract_regex(texts.take(pa.array(breaks)), _BROKEN)
            has = pc.is_valid(parts)
            broken = np.zeros(len(texts), bool)
            broken[breaks] = has.to_numpy(zero_copy_only=False)
            parts = parts.filter(has)
            texts = pc.replace_with_mask(texts, pa.array(broken), parts.field("word"))
            rows[broken, 2:] = np.stack(self._ends(self._line, parts.field("line"), "\n"), 1)
        rows[:, :2] = np.stack(self._ends(self._word, texts, " "), 1)
        start = self._off[rows].ravel()
        size = self._off[rows + 1].ravel() - start
        ids = self._ids[ragged(start, size)]
        size = size.reshape(rows.shape).sum(1)
        return ids, np.cumsum(size) - size, size

    def encode(self, texts: pa.Array | list[str | None]) -> list[np.ndarray]:
        """Ids of every text (null: empty) as unsigned 32-bit arrays."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        for part in slices(texts):
            known, start, size = self._table(pa.array(part.words, pa.large_string()))
            size = size[part.codes]
            starts = part.offsets[:-1]
            heads = None
            if part.begins:     # what a text begins with has no space before it
                flat, head_size = self._bpe.pieces([part.words[c] for c in part.codes[starts]])
                heads = np.split(flat, np.cumsum(head_size)[:-1])
                size[starts] = 0
            ids = np.concatenate([known[ragged(start[part.codes[i:i + _GATHERED]], size[i:i + _GATHERED])]
                                  for i in range(0, len(size), _GATHERED)])
            bound = np.concatenate([[0], np.cumsum(size)])[part.offsets]
            for k, row in enumerate(part.rows):
                found = ids[bound[k]:bound[k + 1]]
                out[row] = np.concatenate([out[row] if heads is None else heads[k], found])
        if self._special is not None:
            for row in np.flatnonzero(pc.fill_null(pc.match_substring_regex(texts, self._special), False)):
                out[row] = np.array(self._bpe.library([texts[int(row)].as_py()])[0], np.uint32)
        return out
