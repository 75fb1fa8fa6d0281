"""Alignment of two tokenizers over a corpus, pair counts by external spill counting.

1. A task encodes its texts with both tokenizers, piece by piece (``pieces``): each distinct
   piece is aligned once.  Byte offsets where tokens of both end cut it into groups; tokens
   whose byte ranges overlap are linked.
2. *Spill.*  For a block of documents the task radix-partitions the records (side A id,
   side B id, document, links) by the side A id, sorts each partition by pair, and writes
   it as a run: a directory (pairs, documents of each) and a body (the documents and their
   links), both compressed with zstd.  A document lies in one block, so the directories'
   numbers add up to the pairs' document counts; a pair that a third of all documents
   hold is one entry per block.
3. *Merge.*  A k-way heap merge adds up the directories of about ``FAN`` runs at a time, level by
   level until one is left per partition, so a merge holds some ``FAN`` compressed
   directories, at any number of blocks.  Directories grow with the vocabularies alone.
4. In side A's order the last merge sees all pairs of an id together: their maximum marks
   the best ones.
5. *Contributions stream back.*  Each body meets its partition's counts once more and
   gives its documents their share of ``n_best`` and ``count_sum``.  Bodies are dealt by
   (partition, group of ``FAN`` blocks), so frequent ids make more tasks, not larger ones.

Edge cases: null and empty texts, and texts whose joined token bytes differ from a space
and the text on either side, have no tokens: zeros and the empty string; special tokens'
strings are plain text; repeated rows and null doc_ids count as documents of their own;
a very long text is encoded in parts; a table without rows gives none; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehand.llm.common import ship, worker_cache, written
from lakehand.llm.pieces import ragged, slices
from lakehand.llm.tokens import ByteBpe, default_path

#: Partitions of the records by their side A id.
PARTS = 64
#: Runs merged at a time, and blocks whose bodies share a copy of their partition's counts.
FAN = 128
#: Records (pair, document) and documents of a block.
BLOCK_RECORDS, BLOCK_DOCS = 2_000_000, 60_000
#: Words a worker keeps aligned, and the size of their texts and groups.
CACHE_WORDS, CACHE_CHARS = 400_000, 60_000_000
#: Pairs of one row of merged counts.
CHUNK_PAIRS = 100_000

#: A row is a document (``part`` null) or a run: pairs and their numbers of documents, then the documents
#: of every pair by their place in the block, with their links.
_SPILL = ("block long, part int, pairs binary, held binary, places binary, links binary, place int, doc_id long, "
          "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string")
_DIRECTORY = "part int, fan long, pairs binary, held binary"
_COUNTS = "part int, fan long, pairs binary, held binary, best binary"
_SHARES = "block long, part int, best binary, total binary"
_SUMS = "block long, place int, n_best long, count_sum long"


def default_paths() -> tuple[str, str]:
    import public_tokenizers
    return default_path(), public_tokenizers.path("piece_bpe_32k.model")


def packed(values: np.ndarray, kind: str = "<u8") -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values, kind).tobytes())


def unpacked(data: bytes, kind: str = "<u8") -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind).astype(np.int64)


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def byte_alphabet() -> dict[str, int]:
    """Byte of each character of byte-level tokens: printable Latin-1 stands for itself, the other
    bytes in ascending order for the characters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = sorted(set(range(256)) - set(own))
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(other)}


class PieceModel:
    """Side B: a piece vocabulary with byte fallback; every text gets a space before it."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self._model = SentencePieceProcessor(model_file=path)
        names = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        self.cuts_at_spaces = not any("▁" in n.lstrip("▁") for n in names)
        self.token = [bytes([int(n[3:5], 16)]) if self._model.is_byte(i) else n.replace("▁", " ").encode()
                      for i, n in enumerate(names)]
        self._space = [self._model.piece_to_id("▁")]

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words with a space before them, and how many each has."""
        ids = [i or self._space for i in self._model.encode(words, num_threads=1)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((x for one in ids for x in one), np.int64, int(size.sum())), size


class Aligned(NamedTuple):
    """The alignment of some words: counts per word, links of all of them, groups as text."""
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    links: np.ndarray
    groups: list[str]
    whole: np.ndarray


class Aligner:
    """Aligns words, each with a space before it, of one worker."""

    def __init__(self, path_a: str, path_b: str):
        bpe, self._b = ByteBpe(path_a, plain_special=True), PieceModel(path_b)
        if not self._b.cuts_at_spaces:
            raise ValueError("side B has pieces with inner spaces, texts cannot be cut at spaces")
        self._bpe = bpe
        alphabet = byte_alphabet()
        by_id = {i: bytes(alphabet[c] for c in t) for t, i in bpe.vocabulary.items() if all(c in alphabet for c in t)}
        self._token_a = [by_id.get(i, b"") for i in range(len(bpe.bytes))]
        self.n_b_ids = len(self._b.token)
        self._size_a, self._size_b = (np.array([len(t) for t in ts], np.int64) for ts in (self._token_a, self._b.token))
        # an id behind a mark: "," within a side, "|" before side B, ";" before a group
        self._text = np.array([f"{mark}{i}" for mark, n in ((",", len(self._token_a)), (";", len(self._token_a)),
                                                             (",", self.n_b_ids), ("|", self.n_b_ids)) for i in range(n)], object)
        self._clear()

    def _clear(self):
        self._row: dict[str, int] = {}
        self._chars = 0
        self._tables: list[Aligned] = []
        self._all: Aligned | None = None

    def align(self, words: list[str]) -> Aligned:
        a, size_a = self._bpe.pieces([" " + w for w in words])
        b, size_b = self._b.words(words)
        text = [f" {w}".encode() for w in words]
        size = np.fromiter(map(len, text), np.int64, len(text))
        tokens_a, tokens_b = [self._token_a[i] for i in a.tolist()], [self._b.token[i] for i in b.tolist()]
        whole = np.ones(len(words), bool)
        joined = b"".join(text)
        if b"".join(tokens_a) != joined or b"".join(tokens_b) != joined:
            at_a, at_b = (np.concatenate([[0], np.cumsum(s)]).tolist() for s in (size_a, size_b))
            whole = np.array([b"".join(tokens_a[at_a[k]:at_a[k + 1]]) == t == b"".join(tokens_b[at_b[k]:at_b[k + 1]])
                              for k, t in enumerate(text)], bool)
            if not whole.all():     # only the others can be laid over each other
                rest = self.align([w for w, ok in zip(words, whole) if ok])
                return self._spread(rest, whole)
        return self._overlay(a.astype(np.int64), size_a, b, size_b, size)

    @staticmethod
    def _spread(some: Aligned, whole: np.ndarray) -> Aligned:
        def wide(x):
            out = np.zeros(len(whole), np.int64)
            out[whole] = x
            return out
        texts = iter(some.groups)
        return Aligned(wide(some.n_a), wide(some.n_b), wide(some.n_groups), wide(some.n_links), some.links,
                       [next(texts) if ok else "" for ok in whole], whole)

    def _overlay(self, a, size_a, b, size_b, size) -> Aligned:
        """Tokens of both sides over the bytes of all words put one after the other."""
        n = len(size)
        ends_a, ends_b = np.cumsum(self._size_a[a]), np.cumsum(self._size_b[b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        word_ends = np.cumsum(size)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        n_groups = np.diff(np.searchsorted(common, word_ends, "right"), prepend=0)
        # links: the side B tokens from the one over a side A token's first byte to the one over its last
        first = np.searchsorted(ends_b, ends_a - self._size_a[a], "right")
        many = np.searchsorted(ends_b, ends_a) - first + 1
        links = np.repeat(a, many) * self.n_b_ids + b[ragged(first, many)]
        bound_a = np.concatenate([[0], np.cumsum(size_a)])
        n_links = np.diff(np.concatenate([[0], np.cumsum(many)])[bound_a])
        # group by group side A's ids, then side B's
        new_a, new_b = np.diff(group_a, prepend=-1) > 0, np.diff(group_b, prepend=-1) > 0
        codes = np.concatenate([a + len(self._token_a) * new_a, 2 * len(self._token_a) + b + self.n_b_ids * new_b])
        place = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        marks = self._text[codes[place]].tolist()
        bound = np.concatenate([[0], np.cumsum(size_a + size_b)]).tolist()
        texts = ["".join(marks[bound[k]:bound[k + 1]]) for k in range(n)]
        return Aligned(size_a, size_b, n_groups, n_links, links, texts, np.ones(n, bool))

    def rows(self, words: list[str]) -> tuple[np.ndarray, Aligned]:
        """Rows of the words in the worker's table, and the table."""
        get = self._row.get
        rows = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(rows < 0).tolist()
        if new and self._row and (len(self._row) + len(new) > CACHE_WORDS or self._chars > CACHE_CHARS):
            self._clear()
            return self.rows(words)
        if new:
            unknown = [words[i] for i in new]
            self._tables.append(self.align(unknown))
            at = len(self._row)
            self._row.update(zip(unknown, range(at, at + len(unknown))))
            rows[new] = np.arange(at, at + len(unknown))
            self._chars += sum(map(len, unknown)) + sum(map(len, self._tables[-1].groups))
            self._all = None
        if self._all is None:
            t = self._tables
            if len(t) > 1:
                joined = [np.concatenate([getattr(x, f) for x in t]) for f in Aligned._fields if f != "groups"]
                for x in t[1:]:
                    t[0].groups.extend(x.groups)
                t[:] = [Aligned(*joined[:5], t[0].groups, joined[5])]
            self._all = t[0]
            self._at = np.concatenate([[0], np.cumsum(self._all.n_links)])
        return rows, self._all

    def link_starts(self) -> np.ndarray:
        """Where each row's links begin in the table's; holds until the next call of ``rows``."""
        return self._at


def tally(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of each one's weights."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    start = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    return keys[start], np.add.reduceat(weights[order], start)


class Document(NamedTuple):
    row: int
    counts: list[int]
    groups_sha256: str
    pairs: np.ndarray
    links: np.ndarray


def align_texts(aligner: Aligner, texts: pa.Array) -> Iterator[Document]:
    """Every text that has tokens; ``pairs`` are its distinct pairs, ``links`` their occurrences."""
    counts, sha, parts, whole = [0, 0, 0, 0], hashlib.sha256(), [], True       # of a text that comes in parts
    for part in slices(texts):
        at, table = aligner.rows(part.words)
        rows = at[part.codes]
        bound = part.offsets.tolist()
        sums = np.stack([np.concatenate([[0], np.cumsum(x[rows])])[part.offsets] for x in
                         (table.n_a, table.n_b, table.n_groups, table.n_links, ~table.whole)], 1)
        links = table.links[ragged(aligner.link_starts()[rows], table.n_links[rows])]
        groups = [table.groups[r] for r in rows.tolist()]
        per_row = np.diff(sums, axis=0).tolist()
        cut = sums[:, 3].tolist()
        for k, row in enumerate(part.rows.tolist()):
            *own, broken = per_row[k]
            text = "".join(groups[bound[k]:bound[k + 1]]).encode()
            if part.begins and part.ends:
                if not broken:
                    pairs = links[cut[k]:cut[k + 1]]
                    yield Document(row, own, hashlib.sha256(text[1:]).hexdigest(), *tally(pairs, np.ones(len(pairs), np.int64)))
                continue
            if part.begins:
                counts, sha, parts, whole = [0, 0, 0, 0], hashlib.sha256(), [], True
            sha.update(text[1:] if part.begins else text)
            counts = [x + y for x, y in zip(counts, own)]
            parts.append(tally(links, np.ones(len(links), np.int64)))
            whole &= not broken
            if part.ends and whole:
                yield Document(row, counts, sha.hexdigest(), *tally(*(np.concatenate(x) for x in zip(*parts))))


class Block:
    """Documents and their records on the way to runs."""

    def __init__(self, n_b_ids: int):
        self._n_b_ids = n_b_ids
        self.documents: list[tuple] = []
        self._records: list[tuple[int, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, doc_ids: list, found: Iterator[Document]) -> None:
        base = len(self.documents)
        self.documents += [(i, 0, 0, 0, 0, "") for i in doc_ids]
        for d in found:
            self.documents[base + d.row] = (doc_ids[d.row], *d.counts, d.groups_sha256)
            self._records.append((base + d.row, d.pairs, d.links))
            self.size += len(d.pairs)

    def rows(self, number: int) -> Iterator[dict]:
        """The documents, then a run for every part."""
        for place, doc in enumerate(self.documents):
            yield dict(zip(("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"), doc), block=number, place=place)
        if not self._records:
            return
        pairs, links = (np.concatenate([r[k] for r in self._records]) for k in (1, 2))
        places = np.repeat([r[0] for r in self._records], [len(r[1]) for r in self._records])
        part = pairs // self._n_b_ids % PARTS
        order = np.lexsort((places, pairs, part))
        pairs, links, places, part = pairs[order], links[order], places[order], part[order]
        bound = np.searchsorted(part, np.arange(PARTS + 1))
        for p in np.flatnonzero(np.diff(bound)).tolist():
            at = slice(bound[p], bound[p + 1])
            start = np.flatnonzero(np.diff(pairs[at], prepend=-1))
            yield {"block": number, "part": p, "pairs": packed(np.diff(pairs[at][start], prepend=0)),
                   "held": packed(np.diff(start, append=at.stop - at.start)),
                   "places": packed(places[at], "<u2"), "links": packed(links[at], "<u4")}


_aligners: dict[tuple[str, str], Aligner] = worker_cache()


def spill(path_a: str, path_b: str):
    schema = arrow_schema(_SPILL)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path_a, path_b) not in _aligners:
            _aligners[path_a, path_b] = Aligner(path_a, path_b)
        aligner = _aligners[path_a, path_b]
        number = TaskContext.get().partitionId() << 32
        block = Block(aligner.n_b_ids)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                block.add(some.column("doc_id").to_pylist(), align_texts(aligner, some.column("text")))
                if block.size >= BLOCK_RECORDS or len(block.documents) >= BLOCK_DOCS:
                    yield pa.RecordBatch.from_pylist(list(block.rows(number)), schema)
                    block, number = Block(aligner.n_b_ids), number + 1
        if block.documents:
            yield pa.RecordBatch.from_pylist(list(block.rows(number)), schema)
    return runs


def entries(run: dict) -> Iterator[tuple[int, int]]:
    """(pair, documents) of a directory in order."""
    return zip(np.cumsum(unpacked(run["pairs"])).tolist(), unpacked(run["held"]).tolist())


def merged(runs: list[dict]) -> Iterator[tuple[int, int]]:
    """(pair, documents) over all runs, by a k-way heap merge."""
    now, total = -1, 0
    for pair, held in heapq.merge(*map(entries, runs)):
        if pair != now:
            if total:
                yield now, total
            now, total = pair, 0
        total += held
    if total:
        yield now, total


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows that come sorted by ``keys``, group by group."""
    rows = (row for batch in batches for k in range(batch.num_rows) for row in batch.slice(k, 1).to_pylist())
    return itertools.groupby(rows, lambda row: tuple(row[k] for k in keys))


def merge_fans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One directory for every (part, fan)."""
    schema = arrow_schema(_DIRECTORY)
    for (part, fan), runs in grouped(batches, ["part", "fan"]):
        pairs, held = np.array(list(merged(list(runs))), np.int64).T
        yield pa.RecordBatch.from_pylist([{"part": part, "fan": fan, "pairs": packed(np.diff(pairs, prepend=0)),
                                           "held": packed(held)}], schema)


def best_counts(n_b_ids: int):
    """The last merge: counts of a part's pairs in chunks that end between two side A ids, best ones marked."""
    schema = arrow_schema(_COUNTS)

    def chunk(part: int, fan: int, rows: list[tuple[int, int, bool]]) -> pa.RecordBatch:
        pairs, held, best = zip(*rows)
        return pa.RecordBatch.from_pylist([{"part": part, "fan": fan, "pairs": packed(np.diff(pairs, prepend=0)),
                                            "held": packed(np.array(held)), "best": packed(np.array(best), "u1")}], schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part,), runs in grouped(batches, ["part"]):
            out, number = [], 0
            for _, same in itertools.groupby(merged(list(runs)), lambda entry: entry[0] // n_b_ids):
                same = list(same)       # as many as side B has ids, at most
                most = max(held for _, held in same)
                out += [(pair, held, held == most) for pair, held in same]
                if len(out) >= CHUNK_PAIRS:
                    yield chunk(part, number, out)
                    out, number = [], number + 1
            if out:
                yield chunk(part, number, out)
    return merge


def contributions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What every run gives its documents; a group's counts come before its runs."""
    schema = arrow_schema(_SHARES)
    for _, rows in grouped(batches, ["part", "fan"]):
        counts, table = [], None
        for row in rows:
            if row["best"] is not None:
                counts.append((np.cumsum(unpacked(row["pairs"])), unpacked(row["held"]), unpacked(row["best"], "u1")))
                continue
            if table is None:
                table = [np.concatenate(x) for x in zip(*counts)]
            pairs, held, best = table
            at = np.repeat(np.searchsorted(pairs, np.cumsum(unpacked(row["pairs"]))), unpacked(row["held"]))
            places, links = unpacked(row["places"], "<u2"), unpacked(row["links"], "<u4")
            sums = np.zeros((2, places.max() + 1), np.int64)
            np.add.at(sums[0], places, links * best[at])
            np.add.at(sums[1], places, links * held[at])
            yield pa.RecordBatch.from_pylist([{"block": row["block"], "part": row["part"], "best": packed(sums[0]),
                                               "total": packed(sums[1])}], schema)


def block_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of a block's documents over all parts."""
    for (block,), rows in grouped(batches, ["block"]):
        sums = np.zeros((2, BLOCK_DOCS + max(500, BLOCK_DOCS)), np.int64)
        most = 0
        for row in rows:
            for k, c in enumerate(("best", "total")):
                share = unpacked(row[c])
                sums[k, :len(share)] += share
                most = max(most, len(share))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(most, block)), pa.array(np.arange(most, dtype=np.int32)),
                                          pa.array(sums[0, :most]), pa.array(sums[1, :most])],
                                         ["block", "place", "n_best", "count_sum"])


def pair_counts(spilled: DataFrame, n_b_ids: int) -> DataFrame:
    """Counts of all pairs, merged level by level from the runs' directories."""
    runs = spilled.where("part is not null").select("part", "block", "pairs", "held")
    while True:
        most = runs.groupBy("part").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= FAN:
            return (runs.repartition("part").sortWithinPartitions("part").select("part", "pairs", "held")
                    .mapInArrow(best_counts(n_b_ids), _COUNTS))
        fans = runs.withColumn("fan", F.pmod(F.xxhash64("block"), F.lit(-(-most // max(2, FAN // 2)))))
        runs = written(fans.repartition("part", "fan").sortWithinPartitions("part", "fan").select("part", "fan", "pairs", "held")
                       .mapInArrow(merge_fans, _DIRECTORY).withColumnRenamed("fan", "block"), "directories")


def align(docs: DataFrame, side_a: str | None = None, side_b: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document.

    ``side_a`` is a byte-level BPE file of the tokenizers library, ``side_b`` a sentencepiece model.
    """
    ship(docs.sparkSession)
    paths = tuple(a or b for a, b in zip((side_a, side_b), default_paths()))
    n_b_ids = len(PieceModel(paths[1]).token)
    spilled = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                      .mapInArrow(spill(*paths), _SPILL), "spill")
    counts = written(pair_counts(spilled, n_b_ids), "pairs")
    bodies = spilled.where("part is not null").select("part", "block", "pairs", "held", "places", "links")
    fans = F.lit(-(-max(1, bodies.select("block").distinct().count()) // FAN))
    bodies = bodies.withColumn("fan", F.pmod(F.xxhash64("block"), fans))
    copies = (counts.withColumnRenamed("fan", "block")
              .withColumn("fan", F.explode(F.sequence(F.lit(0).cast("long"), fans.cast("long") - 1))))
    both = bodies.unionByName(copies, allowMissingColumns=True)
    shares = (both.repartition("part", "fan").sortWithinPartitions("part", "fan", F.col("best").isNull(), "block")
              .select("part", "fan", "block", "pairs", "held", "best", "places", "links").mapInArrow(contributions, _SHARES))
    sums = shares.repartition("block").sortWithinPartitions("block").mapInArrow(block_sums, _SUMS)
    own = spilled.where("part is null").select("block", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return own.join(sums, ["block", "place"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
