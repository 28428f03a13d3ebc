"""Packing token sequences by Karmarkar-Karp multiway differencing.

A document's ids are cut into full windows of CAPACITY ids, which stand alone, and a rest, cut into pieces of PIECE ids at
most. Pieces are gathered in batches of about BATCH, in the order in which a partition holds them, and each batch is divided
into windows of nearly equal sums: partial partitions into k sums start with one piece each; the two with the largest spread
are merged, the largest sums of one with the smallest of the other, until one is left. k starts at the least number that can
hold the batch and rises until no sum exceeds CAPACITY.

Batches are formed inside a task, so memory is bounded by a batch and no key can be hot. A partition's last, smaller batch isn't
divided there: what partitions have left is gathered, REST ids to a task, and divided in the same way, so that padding doesn't grow
with the number of partitions.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .textbytes import row_runs, text_bytes
from .word_tokens import tokenizer

CAPACITY = 2048
PIECE = 512
BATCH = 1536
END_ID = 1
#: Ids of partitions' last batches that a task divides.
REST = 1 << 22


def difference(sizes: np.ndarray, k: int) -> list[list[int]]:
    """Indexes of the sizes in each of k parts of nearly equal sums."""
    left, right = [np.full(len(sizes), -1)], [np.full(len(sizes), -1)]
    made = len(sizes)

    def single(i: int) -> tuple[np.ndarray, np.ndarray]:
        sums, holds = np.zeros(k, np.int64), np.full(k, -1)
        sums[0], holds[0] = sizes[i], i
        return sums, holds

    # the spread, negated; a number that makes the order total; the partition, or the piece that it would start with
    heap: list[tuple[int, int, object]] = [(-int(s), i, None) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, i, a), (_, j, b) = heapq.heappop(heap), heapq.heappop(heap)
        (sums_a, in_a), (sums_b, in_b) = a or single(i), b or single(j)
        sums, in_b = sums_a + sums_b[::-1], in_b[::-1]
        holds = np.where(in_a >= 0, in_a, in_b)
        both = np.flatnonzero((in_a >= 0) & (in_b >= 0))
        if len(both):
            left.append(in_a[both])
            right.append(in_b[both])
            holds[both] = np.arange(made, made + len(both))
            made += len(both)
        by = np.argsort(-sums, kind="stable")
        sums = sums[by] - sums[by[-1]]
        heapq.heappush(heap, (-int(sums[0]), i, (sums, holds[by])))
    lefts, rights = np.concatenate(left), np.concatenate(right)
    parts = []
    for root in (heap[0][2] or single(heap[0][1]))[1].tolist():
        found, stack = [], [root] if root >= 0 else []
        while stack:
            x = stack.pop()
            if x < len(sizes):
                found.append(x)
            else:
                stack += [int(lefts[x]), int(rights[x])]
        parts.append(sorted(found))
    return parts


def windows(sizes: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Indexes of the sizes, none above the capacity, in windows whose sums don't exceed it."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        parts = difference(sizes, k)
        most = max(int(sizes[p].sum()) for p in parts)
        if most <= capacity:
            return [p for p in parts if p]
        k += max(1, int(k * (most - capacity) / capacity / 4))


def cut_ids(n: int, capacity: int = CAPACITY, piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full windows, then pieces of nearly equal length."""
    whole = n // capacity * capacity
    parts = -(-(n - whole) // piece)
    edges = [whole + (n - whole) * i // parts for i in range(parts + 1)] if parts else []
    return [(s, capacity) for s in range(0, whole, capacity)] + [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def packed(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, piece: int = PIECE, batch: int = BATCH, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]) for each piece of each row of docs (doc_id, text; other columns are ignored).

    A null or empty text has the end id alone. A very long text is encoded by itself and cut like any other. Repeated rows, and rows
    that share an id or have none, are packed one by one. sequence_id holds a task's number above 32 bits and the sequence's number
    in it below, and bit 62 for what partitions had left. An empty table gives an empty table. with_ids adds the piece's ids. The
    pieces are written to the shared folder once, before what is left is gathered.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids

    def table(pieces: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*pieces, strict=True))
        arrays = [pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:7])]
        if with_ids:
            ends = np.concatenate(([0], np.cumsum(columns[2]))).astype(np.int32)
            arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(columns[7]), "<i4"))))
        return pa.RecordBatch.from_arrays(arrays, names)

    def divided(waiting: list[tuple], number: int) -> list[tuple]:
        """The pieces in windows, which are numbered from number on."""
        out = []
        for k, part in enumerate(windows(np.array([p[2] for p in waiting]), capacity)):
            at = 0
            for i in part:
                out.append((*waiting[i][:5], number + k, at, waiting[i][7]))
                at += waiting[i][2]
        return out

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        end = np.array([END_ID], "<u4").tobytes()
        encoder, waiting, kind = tokenizer(tokenizer_path), [], None
        for b in batches:
            doc_ids, texts, kind = b.column("doc_id"), b.column("text"), b.column("doc_id").type
            _, offsets = text_bytes(texts)
            for first, last in row_runs(offsets, 1 << 20):
                done = []
                encoded = encoder.encode([t or "" for t in texts.slice(first, last - first).to_pylist()])
                for doc_id, ids in zip(doc_ids.slice(first, last - first).to_pylist(), encoded, strict=True):
                    ids += end
                    n = len(ids) // 4
                    for start, length in cut_ids(n, capacity, piece):
                        own = ids[4 * start : 4 * (start + length)]
                        full = length == capacity
                        entry = (doc_id, start, length, zlib.crc32(own), n, number if full else None, 0 if full else None, own if with_ids else None)
                        number += full
                        (done if full else waiting).append(entry)
                        if len(waiting) >= batch:
                            done += divided(waiting, number)
                            number = done[-1][5] + 1
                            waiting = []
                if done:
                    yield table(done, kind)
        if waiting:
            yield table(waiting, kind)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 1 << 62 | TaskContext.get().partitionId() << 32
        waiting, kind = [], None
        for b in batches:
            kind = b.column("doc_id").type
            columns = [b.column(c).to_pylist() for c in names[:7]]
            columns.append([np.array(x.values, "<i4").tobytes() for x in b.column("ids")] if with_ids else [None] * b.num_rows)
            for entry in zip(*columns, strict=True):
                waiting.append(entry)
                if len(waiting) >= batch:
                    done = divided(waiting, number)
                    number, waiting = done[-1][5] + 1, []
                    yield table(done, kind)
        if waiting:
            yield table(divided(waiting, number), kind)

    pieces = written(docs.select("doc_id", "text").mapInArrow(pack, schema))
    left = pieces.where("sequence_id is null")
    n = left.agg(F.sum("length")).first()[0] or 0
    return pieces.where("sequence_id is not null").union(left.repartition(max(1, n // REST)).mapInArrow(gather, schema))
