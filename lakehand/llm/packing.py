"""Best-fit decreasing packing of token sequences into fixed windows.

A document is its ids plus an end id.  Full windows are cut off first; what is left of
a document is one piece shorter than a window.  Pieces are dealt by hash into groups
of about ``GROUP_PIECES`` and each group is packed by itself: longest piece first into
the open window with the least room that still fits, found in a segment tree over
remaining capacities.  Groups keep memory bounded at any input size; a group wastes at
most its last few windows.

Edge cases: null and empty texts are one piece with the end id alone; equal rows are
packed one by one; a null doc_id stays null; a table without rows gives none; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehand.llm.common import ship, trim, written
from lakehand.llm.token_binary import ids_crc32
from lakehand.llm.tokens import default_path, encoder

WINDOW = 2048
#: Pieces packed together, on average.
GROUP_PIECES = 20_000

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class BestFit:
    """Open windows by remaining capacity; the tree's nodes count the windows below them."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[tuple[int, int]]] = [[] for _ in range(window + 1)]
        self.window, self.made = window, 0

    def _add(self, capacity: int, n: int):
        node = capacity + self.leaves
        while node:
            self.count[node] += n
            node >>= 1

    def _tightest(self, length: int) -> int:
        """The least capacity of an open window that is ``length`` or more, or -1."""
        node = length + self.leaves
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return -1
            node += 1
            while node < self.leaves:
                node *= 2
                if not self.count[node]:
                    node += 1
        return node - self.leaves

    def put(self, length: int) -> tuple[int, int]:
        """(window, offset in it) for a piece."""
        capacity = self._tightest(length)
        if capacity < 0:
            window, capacity = self.made, self.window
            self.made += 1
        else:
            window = self.open[capacity].pop()
            self._add(capacity, -1)
        if capacity > length:
            self.open[capacity - length].append(window)
            self._add(capacity - length, 1)
        return window, self.window - capacity


def cut_pieces(path: str, end_id: int, window: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.encode(batch.column("text"))):
                ids = np.append(ids, np.uint32(end_id))
                rows += [(doc_id, at, min(window, len(ids) - at), ids_crc32(ids[at:at + window]), len(ids))
                         for at in range(0, len(ids), window)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                 ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            trim()      # two workers' leavings of a batch count beside the executor's heap
    return pieces


def pack_group(window: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable")
        fit = BestFit(window)
        placed = np.array([fit.put(n) for n in pdf["length"].tolist()], np.int64).reshape(-1, 2)
        pdf["sequence_id"] = (pdf["group"].to_numpy() << 32) + placed[:, 0]
        pdf["offset"] = placed[:, 1]
        return pdf.drop(columns="group")
    return pack


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    ship(docs.sparkSession)
    pieces = written(docs.select(F.col("doc_id").cast("long"), "text")
                     .mapInArrow(cut_pieces(tokenizer or default_path(), end_id, window), _PIECES), "pieces")
    groups = max(1, -(-pieces.count() // GROUP_PIECES))
    return (pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))
            .groupBy("group").applyInPandas(pack_group(window), f"{_PIECES}, sequence_id long, offset long"))
