"""Substring dedup by relative Lempel-Ziv parsing against an index of every document.

A document is parsed into factors: word runs that also stand in a document with a
smaller doc_id.  The index holds every window of ``width`` words.  It is cut into
reference blocks by the window's anchor: the least hash among its 3-word runs, which
equal windows share, so all copies of a window meet in one block.  Windows of one
anchor travel together (one posting with document and position instead of one per
window), and a window that a batch of documents holds more than once is answered
inside the batch for all but the first; so copies by the thousand send one posting per
batch.  Each block reports, for every window, the first document that holds it, as
runs with a source position.

The number of blocks follows the size of the texts, and the windows to post are counted
by block first.  Where that count is too much for one task (an anchor that is part of a
common phrase), the windows go by their own hash to as many further blocks as the count
asks for; equal windows still meet.  So a block grows with the input only through one
and the same window, by one posting a batch.

Parsing walks a document from left to right: a factor grows while the next window
continues in the same source; where it ends, the longest match that goes on past its end
gives the next one.  That match may begin inside the factor before (the windows across
the boundary are looked up as well, they may stand whole in a third document), and then
the next factor is what lies behind the boundary; without such a match the words up to
the next match stay.  Every factor is part of a match of ``width`` words or more, and
every word of such a match is in a factor: the factors are the duplicate spans.

Windows are compared by 40 hash bits within 32 bits of the anchor's hash and the
block's number: over 72 bits.

Edge cases: texts that are null, empty or shorter than a window have no factors; a null
doc_id is never a source and never cleaned; rows that share a doc_id are no duplicates
of each other (only a smaller doc_id counts); repeats inside one document stay; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehand.llm.common import ship
from lakehand.llm.words import mix, window_hashes, word_slices

WIDTH = 13
ANCHOR = 3
#: Reference blocks for each shuffle partition, at least; a task holds one block at a time.
BLOCKS_PER_PARTITION = 4
#: Windows a block should hold at most and is not split under; over ``HOT`` times its share a block is split.
BLOCK_WINDOWS, LEAST_WINDOWS, HOT = 250_000, 5_000, 4
#: Bytes of a word with its space, to size the blocks before the windows are counted.
WORD_BYTES = 6

_U = np.uint64
_POST = [("g", "<u4"), ("doc", "<i8"), ("crc", "<u4"), ("pos", "<u4"), ("off", "u1"), ("n", "u1")]
_RUN = [("doc", "<i8"), ("crc", "<u4"), ("start", "<u4"), ("n", "<u4"), ("src", "<i8"), ("src_start", "<u4")]
_RUN_SCHEMA = "doc_id long, crc long, start long, n long, src_doc long, src_start long"


def pack(columns: list[np.ndarray], kinds: list[str]) -> bytes:
    head = np.array([len(c) for c in columns], "<i8").tobytes()
    return head + b"".join(np.ascontiguousarray(c, k).tobytes() for c, k in zip(columns, kinds, strict=True))


def unpack(blob: bytes, kinds: list[str]) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(blob, "<i8", len(kinds)), 8 * len(kinds), []
    for n, k in zip(sizes.tolist(), kinds, strict=True):
        out.append(np.frombuffer(blob, k, n, at))
        at += n * np.dtype(k).itemsize
    return out


def _runs(doc, crc, start, src, src_start, unit) -> list[np.ndarray]:
    """Successive found windows with successive sources, as runs; ``unit``: what a run may not leave."""
    if not len(doc):
        return [np.zeros(0, k) for _, k in _RUN]
    same = (unit[1:] == unit[:-1]) & (start[1:] == start[:-1] + 1) & (src[1:] == src[:-1]) & (
        src_start[1:] == src_start[:-1] + 1)
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    n = np.diff(np.append(first, len(doc)))
    return [doc[first], crc[first], start[first], n, src[first], src_start[first]]


def _first_of_equal(keys: np.ndarray) -> np.ndarray:
    """For each element the index of the first equal one."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(keys) else np.zeros(0, bool)
    first = order[np.flatnonzero(new)]
    out = np.empty(len(keys), np.int64)
    out[order] = first[np.cumsum(new) - 1]
    return out


def _batch_windows(texts: pa.Array, width: int):
    """Per window of a batch: row, position in the row, hash, anchor position and anchor hash."""
    out = []
    for lo, to, words, offs in word_slices(texts):
        n = np.diff(offs)
        count = np.maximum(n - width + 1, 0)
        if not count.sum():
            continue
        row = np.repeat(np.arange(to - lo), count)
        pos = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        at = offs[:-1][row] + pos
        hashes = window_hashes(words, width)[at]
        grams = window_hashes(words, ANCHOR)
        least = np.lib.stride_tricks.sliding_window_view(grams, width - ANCHOR + 1)[at].argmin(axis=1)
        out.append((row + lo, pos, hashes, pos + least, grams[at + least]))
    return [np.concatenate(c) for c in zip(*out)] if out else None


def _answer(batch: pa.RecordBatch, width: int):
    """Texts, ids and windows of a batch by doc_id; of each window the first equal one, and whether an earlier document holds that."""
    batch = batch.take(pc.sort_indices(batch.column("doc_id")))
    texts = batch.column("text").cast(pa.large_binary())
    found = _batch_windows(texts, width)
    if found is None:
        return None
    ids = batch.column("doc_id").to_numpy()
    first = _first_of_equal(found[2])
    return texts, ids, found, first, ids[found[0]][first] < ids[found[0]]


def _home(gram: np.ndarray, blocks: int) -> np.ndarray:
    """Block of an anchor by its mixed hash."""
    return ((gram >> _U(32)) % _U(blocks)).astype(np.int64)


def count_batches(width: int, blocks: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            answer = _answer(batch, width)
            if answer is not None:
                _, _, found, _, known = answer
                block, n = np.unique(_home(mix(found[4][~known]), blocks), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(n.astype(np.int64))], ["block", "n"])
    return count


def index_batches(width: int, blocks: int, hot: np.ndarray, parts: np.ndarray):
    """``hot``: sorted blocks whose windows go to ``parts`` further blocks by their own hash."""
    kinds, run_kinds = [k for _, k in _POST] + ["<u4", "u1"], [k for _, k in _RUN]
    base = blocks + np.cumsum(parts) - parts

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            answer = _answer(batch, width)
            if answer is None:
                continue
            texts, ids, (row, pos, hashes, anchor, gram), first, known = answer
            crc = np.array([zlib.crc32(t or b"") for t in texts.to_pylist()], np.uint32)
            doc = ids[row]
            k = np.flatnonzero(known)
            runs = _runs(doc[k], crc[row[k]], pos[k], doc[first[k]], pos[first[k]], row[k])
            # Postings of the windows that this batch cannot answer, one for each anchor's run of windows in a block.
            k = np.flatnonzero(~known)
            row, pos, hashes, anchor, gram = row[k], pos[k], hashes[k], anchor[k], mix(gram[k])
            block = _home(gram, blocks)
            if len(hot):
                at = np.minimum(np.searchsorted(hot, block), len(hot) - 1)
                block = np.where(hot[at] == block, base[at] + ((hashes >> _U(40)) % parts[at].astype(np.uint64)).astype(np.int64), block)
            new = np.ones(len(k), bool)
            new[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1]) | (pos[1:] != pos[:-1] + 1) | (block[1:] != block[:-1])
            at = np.flatnonzero(new)
            size = np.diff(np.append(at, len(k)))
            order = np.argsort(block[at], kind="stable")
            present, begin = np.unique(block[at][order], return_index=True)
            out_block, out_posts, out_runs = [], [], []
            for b, lo, to in zip(present.tolist(), begin.tolist(), [*begin[1:].tolist(), len(at)], strict=True):
                p = order[lo:to]
                a, s = at[p], size[p]
                w = np.repeat(a - (np.cumsum(s) - s), s) + np.arange(s.sum())
                out_block.append(b)
                out_posts.append(pack([gram[a] & _U(0xFFFFFFFF), ids[row[a]], crc[row[a]], anchor[a],
                                       anchor[a] - pos[a], s, hashes[w] & _U(0xFFFFFFFF),
                                       (hashes[w] >> _U(32)) & _U(0xFF)], kinds))
                out_runs.append(b"")
            if len(runs[0]):
                out_block.append(int(runs[0][0]) % blocks)
                out_posts.append(b"")
                out_runs.append(pack(runs, run_kinds))
            yield pa.RecordBatch.from_arrays([pa.array(out_block, pa.int64()), pa.array(out_posts, pa.binary()),
                                              pa.array(out_runs, pa.binary())], ["block", "posts", "runs"])
    return index


def _search_block(blobs: list[bytes]) -> list[np.ndarray]:
    """Runs of the block's windows that an earlier document holds."""
    kinds = [k for _, k in _POST] + ["<u4", "u1"]
    g, doc, crc, pos, off, n, low, high = map(np.concatenate, zip(*(unpack(b, kinds) for b in blobs), strict=True))
    begin = np.cumsum(n, dtype=np.int64) - n
    order = np.lexsort((pos, doc))
    size = n[order].astype(np.int64)
    post = np.repeat(order, size)
    w = np.repeat(begin[order] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    start = (pos[post].astype(np.int64) - off[post]) + (w - begin[post])
    keys = low[w].astype(np.uint64) | (high[w].astype(np.uint64) << _U(32)) | (g[post].astype(np.uint64) << _U(40))
    first = _first_of_equal(keys)
    k = np.flatnonzero(doc[post[first]] < doc[post])
    return _runs(doc[post[k]], crc[post[k]], start[k], doc[post[first[k]]], start[first[k]], post[k])


def search_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block."""
    names = [f.split()[0] for f in _RUN_SCHEMA.split(", ")]

    def rows(columns) -> Iterator[pa.RecordBatch]:
        if len(columns[0]):
            yield pa.RecordBatch.from_arrays([pa.array(np.asarray(c, np.int64)) for c in columns], names)

    now, blobs = None, []
    for batch in batches:
        for block, posts, runs in zip(*(batch.column(c).to_pylist() for c in ("block", "posts", "runs")), strict=True):
            if block != now:
                if blobs:
                    yield from rows(_search_block(blobs))
                now, blobs = block, []
            if posts:
                blobs.append(posts)
            if runs:
                yield from rows(unpack(runs, [k for _, k in _RUN]))
    if blobs:
        yield from rows(_search_block(blobs))


def index_blocks(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """block, posts, runs: the postings of every batch by block, and the runs that the batch answers."""
    ship(docs.sparkSession)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null and text is not null")
    words = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // WORD_BYTES
    blocks = max(BLOCKS_PER_PARTITION * partitions, -(-words // BLOCK_WINDOWS))
    share = min(max(words // blocks, LEAST_WINDOWS), BLOCK_WINDOWS)
    rows = sorted(docs.mapInArrow(count_batches(width, blocks), "block long, n long").groupBy("block")
                  .agg(F.sum("n").alias("n")).where(F.col("n") > HOT * share).collect())
    hot, n = (np.array([r[c] for r in rows], np.int64) for c in ("block", "n"))
    return docs.mapInArrow(index_batches(width, blocks, hot, -(-n // share)), "block long, posts binary, runs binary")


def found_windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Runs of ``n`` successive windows of a document that an earlier one holds, with the source."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (index_blocks(docs, width).repartition(partitions, "block").sortWithinPartitions("block")
            .mapInArrow(search_blocks, _RUN_SCHEMA))


def parse(runs: list[tuple[int, int, int, int]], width: int) -> list[tuple[int, int, int, int]]:
    """Greedy factors (start, words, source document, source start) of one document.

    ``runs``: (start, windows, source, source start), the matches the index found.  Of the
    matches that reach past the last factor's end and begin no later than there, the
    longest gives the next factor, from that end on.
    """
    out, end, best, todo = [], 0, None, sorted(runs)

    def close(best):
        nonlocal end
        start, stop, src, src_start = best
        begin = max(start, end)
        last = out[-1] if out else None
        if last and begin == end and last[2] == src and last[3] + last[1] == src_start + begin - start:
            out[-1] = (last[0], stop - last[0], src, last[3])       # goes on in the same source
        else:
            out.append((begin, stop - begin, src, src_start + begin - start))
        end = stop

    for start, n, src, src_start in todo:
        if best and start > max(end, best[0]):
            close(best)
            best = None
        stop = start + n + width - 1
        if stop > end and (best is None or stop > best[1]):
            best = (start, stop, src, src_start)
    if best:
        close(best)
    return out


def clean_texts(width: int):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, runs in zip(batch.column("doc_id").to_pylist(),
                                          batch.column("text").cast(pa.large_binary()).to_pylist(),
                                          batch.column("runs").to_pylist(), strict=True):
                words = (text or b"").split()
                factors = parse([(r["start"], r["n"], r["src_doc"], r["src_start"]) for r in runs or []], width)
                kept, at = [], 0
                for start, size, _, _ in factors:
                    kept += words[at:start]
                    at = start + size
                kept += words[at:]
                out.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(),
                            [dict(zip(("start", "words", "src_doc", "src_start"), f)) for f in factors]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, (
                    pa.int64(), pa.int64(), pa.int64(), pa.string(), _FACTORS), strict=True)],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "factors"])
    return clean


_FACTORS = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "words", "src_doc", "src_start")]))


def dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the factors of every document."""
    docs = docs.select(F.col("doc_id").cast("long"), "text",
                       F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("crc"))
    runs = (found_windows(docs, width).groupBy("doc_id", "crc")
            .agg(F.collect_list(F.struct("start", "n", "src_doc", "src_start")).alias("runs")))
    return (docs.join(runs, ["doc_id", "crc"], "left").select("doc_id", "text", "runs")
            .mapInArrow(clean_texts(width), "doc_id long, n_words long, n_removed long, kept_sha256 string, "
                        "factors array<struct<start:long,words:long,src_doc:long,src_start:long>>"))
