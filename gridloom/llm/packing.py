"""Packing: best-fit decreasing with a segment tree indexed by remaining capacity.

Each task packs the documents of its own partition, a block of bounded size at a time, so there is
no shuffle and memory doesn't grow with the table. Overlong documents are first cut into full windows.
The few windows of a block that stay loose are cut into powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents
from .tokens import encoder, forget

#: Tokens that a task packs together at most (8 MB of two-byte ids), unless one document has more.
BLOCK_TOKENS = 4_000_000

#: A window with more padding than this is cut into powers of two.
LOOSE = 64

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class CapacityTree:
    """Open windows by remaining capacity; a node says whether any window below it is open."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.open = bytearray(2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, capacity: int, window: int) -> None:
        self.windows[capacity].append(window)
        node = capacity + self.leaves
        while node and not self.open[node]:
            self.open[node] = 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return the tightest window whose capacity is at least ``least``, with that capacity."""
        node = least + self.leaves
        if not self.open[node]:
            while node > 1 and (node & 1 or not self.open[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.open[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        window = self.windows[capacity].pop()
        if not self.windows[capacity]:
            while node and not (node < self.leaves and (self.open[2 * node] or self.open[2 * node + 1])):
                self.open[node] = 0
                node >>= 1
        return window, capacity


def pack(lengths: list[int], window: int, loose: int = LOOSE) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) for documents of these lengths."""
    sequences: list[list[tuple[int, int, int]]] = []
    tails = []
    for doc, n in enumerate(lengths):
        cut = n - n % window
        sequences += [[(doc, at, window)] for at in range(0, cut, window)]
        if n > cut:
            tails.append((n - cut, doc, cut))
    tails.sort(key=lambda x: (-x[0], x[1]))
    tree = CapacityTree(window)
    first = len(sequences)
    for n, doc, start in tails:
        if (found := tree.take(n)) is None:
            sequences.append([])
            found = len(sequences) - 1, window
        sequences[found[0]].append((doc, start, n))
        if found[1] > n:
            tree.put(found[1] - n, found[0])
    out = sequences[:first]
    for pieces in sequences[first:]:
        filled = sum(x[2] for x in pieces)
        out += [pieces] if window - filled <= loose else _powers(pieces, filled)
    return out


def _powers(pieces: list[tuple[int, int, int]], filled: int) -> list[list[tuple[int, int, int]]]:
    """Cut a window's content into sequences whose lengths are the powers of two of its binary form."""
    out, todo = [], pieces[::-1]
    for bit in range(filled.bit_length() - 1, -1, -1):
        if filled >> bit & 1:
            room, sequence = 1 << bit, []
            while room:
                doc, start, n = todo.pop()
                if n > room:
                    todo.append((doc, start + room, n - room))
                    n = room
                sequence.append((doc, start, n))
                room -= n
            out.append(sequence)
    return out


def pack_documents(docs: DataFrame, tokenizer: str, window: int = 4096, end_id: int = 2, block_tokens: int = BLOCK_TOKENS, release: bool = False) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) in sequences of at most ``window`` tokens.

    Each document's ids end with ``end_id``; a null or empty text is that id alone. Rows with null or
    repeated doc_id are documents of their own. sequence_id is unique, not dense; a sequence's pieces
    stand in the rows' order with gapless offsets. An empty table gives no rows. ``release`` frees a worker's cache of known
    words when a task ends, for workers that go on to other stages; it costs some two fifths more time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, made = encoder(tokenizer), TaskContext.get().partitionId() << 33
        docs_: list[int | None] = []
        ids: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal made
            rows = []
            for pieces in pack([len(x) for x in ids], window):
                at = 0
                for doc, start, n in pieces:
                    crc = zlib.crc32(ids[doc][start : start + n].astype("<u4").tobytes())
                    rows.append((docs_[doc], start, n, crc, len(ids[doc]), made, at))
                    at += n
                made += 1
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 7)], names=SCHEMA.replace(" long", "").split(", "))

        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, len(batch), 1000)):
                tokens, at = enc.encode(part.column("text"))
                for i, doc in enumerate(part.column("doc_id").to_pylist()):
                    docs_.append(doc)
                    ids.append(np.append(tokens[at[i] : at[i + 1]], np.array(end_id, dtype=tokens.dtype)))
                    size += len(ids[-1])
                if size >= block_tokens:
                    yield flush()
                    docs_.clear()
                    ids.clear()
                    size = 0
        if ids:
            yield flush()
        if release:
            forget(tokenizer)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
