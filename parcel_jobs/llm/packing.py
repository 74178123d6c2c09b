"""Packing documents into sequences of a fixed capacity by Karmarkar-Karp multiway differencing.

Each task packs the rows that it reads, in blocks of bounded size, so nothing is shuffled and no key can be hot.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .wordcache import runs_of, word_bpe

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Partition items into k windows of near-equal sums by the largest differencing method.

    A partial partition is k sums, kept as differences from the least. The two with the widest spread are merged, the
    largest sum of one with the smallest of the other, until one is left. Slots hold nodes of a tree, whose leaves are items.
    """
    left, right, heap = [-1] * len(sizes), [-1] * len(sizes), []
    for i, size in enumerate(sizes):
        sums, nodes = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        sums[0], nodes[0] = size, i
        heap.append((-size, i, sums, nodes))
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        (_, _, a, x), (_, _, b, y) = heapq.heappop(heap), heapq.heappop(heap)
        sums, y = a + b[::-1], y[::-1]
        nodes = np.where(x < 0, y, x)
        for i in np.flatnonzero((x >= 0) & (y >= 0)):
            left.append(int(x[i]))
            right.append(int(y[i]))
            nodes[i] = len(left) - 1
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        sums = sums - sums[-1]
        heapq.heappush(heap, (-int(sums[0]), serial, sums, nodes))
        serial += 1
    windows = []
    for node in heap[0][3] if heap else []:
        items, stack = [], [int(node)] if node >= 0 else []
        while stack:
            n = stack.pop()
            if left[n] < 0:
                items.append(n)
            else:
                stack += left[n], right[n]
        windows.append(items)
    return windows


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows within the capacity: their count rises from the least possible whenever one exceeds it."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        windows = difference(sizes, k)
        if all(sum(sizes[i] for i in w) <= capacity for w in windows):
            return [w for w in windows if w]
        k += 1


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, most_piece: int = 512, block_pieces: int = 384, with_ids: bool = False) -> DataFrame:
    """Pieces of documents (doc_id, text) with their places in sequences of at most `capacity` tokens.

    A document is its ids and end_id. Its full windows are sequences of their own; the rest is cut into near-equal
    pieces of at most most_piece, which are packed in blocks of block_pieces. Pieces of one document that follow each
    other in one sequence are joined. Null text is empty: one piece, the end id. Repeated rows are packed each; null
    doc_ids are documents like others, and doc_id may be of any type; other columns are ignored; an empty table gives
    no rows. with_ids adds the ids of each piece.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bpe = word_bpe(tokenizer)
        sequence = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        block: list[tuple] = []  # (row number, start, length, where in ids, ids of its run, doc_id, doc_tokens)

        def place(items: list[tuple]) -> None:
            nonlocal sequence
            offset, i = 0, 0
            items.sort(key=lambda x: x[:2])
            while i < len(items):
                n, start, length, at, ids, doc, total = items[i]
                i += 1
                while i < len(items) and items[i][0] == n and items[i][1] == start + length:
                    length += items[i][2]
                    i += 1
                piece = ids[at : at + length]
                rows.append((doc, start, length, zlib.crc32(piece), total, sequence, offset, piece if with_ids else None))
                offset += length
            sequence += 1

        def flush() -> None:
            for window in windows_of([x[2] for x in block], capacity):
                place([block[i] for i in window])
            block.clear()

        def out() -> pa.RecordBatch:
            names = [x.split()[0] for x in PIECE.split(", ")]
            cols = dict(zip(names, map(list, zip(*rows, strict=True)), strict=False)) if rows else {n: [] for n in names}
            arrays = {"doc_id": pa.array(cols["doc_id"], id_type), **{n: pa.array(cols[n], pa.int64()) for n in names[1:]}}
            if with_ids:
                arrays["ids"] = pa.array([x[-1].astype(np.int32) for x in rows], pa.list_(pa.int32()))
            rows.clear()
            return pa.RecordBatch.from_pydict(arrays)

        n, id_type = 0, pa.int64()
        for batch in batches:
            id_type = batch.schema.types[0]
            for first, texts in runs_of(batch.column(1)):
                coded, bounds = bpe.encode(texts)
                ids = np.insert(coded.astype("<u4"), bounds[1:], end_id)
                bounds = (bounds + np.arange(len(bounds))).tolist()
                for doc, low, high in zip(batch.column(0).slice(first, len(texts)).to_pylist(), bounds, bounds[1:], strict=False):
                    total, at = high - low, 0
                    while total - at >= capacity:
                        place([(n, at, capacity, low + at, ids, doc, total)])
                        at += capacity
                    if total > at:
                        parts = -(-(total - at) // most_piece)
                        cuts = [at + (total - at) * j // parts for j in range(parts + 1)]
                        block.extend((n, a, b - a, low + a, ids, doc, total) for a, b in zip(cuts, cuts[1:], strict=False))
                    n += 1
                    if len(block) >= block_pieces:
                        flush()
                    if len(rows) >= 5000:
                        yield out()
        if block:
            flush()
        if rows:
            yield out()

    docs = docs.select("doc_id", "text")
    kinds = PIECE.replace("doc_id long", f"doc_id {docs.schema['doc_id'].dataType.simpleString()}")
    return docs.mapInArrow(pack, kinds + ", ids array<int>" * with_ids)
