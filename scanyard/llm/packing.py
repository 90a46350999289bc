"""Packing documents into training sequences by multiway differencing (Karmarkar and Karp).

Each task cuts its documents into pieces of at most ``PIECE`` tokens, fills a batch of ``WINDOWS``
windows less a small margin, cutting the last document where the batch is full, and deals the
pieces out: every piece starts as a partition with one loaded window, and the two partitions of
the largest imbalance are merged, full windows of one on empty windows of the other, until one is
left. The windows are then near equal. Where one exceeds the capacity, the batch is dealt out
again to one window more. Whole windows of a long document are windows of their own beforehand.

Every id lies in exactly one piece. A document is its ids and one end id, so an empty or null text
is one id; repeated rows are documents of their own; ``start`` counts within the row's document.
An empty table gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

import heapq
import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from scanyard.llm.common import pairs
from scanyard.llm.tokens import END, encoder, small, vocabulary_path

CAPACITY = 1024
WINDOWS = 256
PIECE = 256
# Tokens per window left free, so that near-equal windows stay within the capacity.
MARGIN = 8


def differencing(sizes: list[int], ways: int) -> list[list[int]]:
    """Deal numbers out to ``ways`` sets of near-equal sums; the positions in each set."""
    if not sizes:
        return [[] for _ in range(ways)]
    # A set is a tree: an index below len(sizes) is a piece, above it a pair of sets.
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    made = len(sizes)
    heap = []
    for at, size in enumerate(sizes):
        loads, sets = np.zeros(ways, np.int64), np.full(ways, -1, np.int64)
        loads[-1], sets[-1] = size, at
        heap.append((-size, at, loads, sets))
    heapq.heapify(heap)
    order = itertools.count(len(sizes))
    while len(heap) > 1:
        _, _, a_loads, a_sets = heapq.heappop(heap)
        _, _, b_loads, b_sets = heapq.heappop(heap)
        loads, b_sets = a_loads + b_loads[::-1], b_sets[::-1]
        both = (a_sets >= 0) & (b_sets >= 0)
        sets = np.where(a_sets >= 0, a_sets, b_sets)
        n = int(both.sum())
        if n:
            left.append(a_sets[both])
            right.append(b_sets[both])
            sets[both] = np.arange(made, made + n)
            made += n
        rank = np.argsort(loads, kind="stable")
        loads, sets = loads[rank], sets[rank]
        loads = loads - loads[0]
        heapq.heappush(heap, (-int(loads[-1]), next(order), loads, sets))
    a = np.concatenate(left).tolist() if left else []
    b = np.concatenate(right).tolist() if right else []
    out = []
    for top in heap[0][3].tolist():
        stack, found = [top] if top >= 0 else [], []
        while stack:
            node = stack.pop()
            if node < len(sizes):
                found.append(node)
            else:
                stack += (a[node - len(sizes)], b[node - len(sizes)])
        out.append(found)
    return out


def deal(sizes: list[int], capacity: int = CAPACITY, margin: int = MARGIN) -> list[list[int]]:
    """Sets of pieces of at most ``capacity`` tokens each; a window more until all fit."""
    ways = max(1, -(-sum(sizes) // (capacity - margin)))
    while True:
        sets = differencing(sizes, ways)
        if max((sum(sizes[i] for i in s) for s in sets), default=0) <= capacity:
            return [s for s in sets if s]
        ways += 1


_SCHEMA = ("id {id}, start long, length long, ids_crc32 long, doc_tokens long, "
           "sequence_id long, `offset` long")


class _Packer:
    """Pieces of one task, packed whenever a batch is full."""

    def __init__(self, task: int, capacity: int, windows: int, piece: int, margin: int):
        self.capacity, self.piece, self.margin = capacity, piece, margin
        self.room = windows * (capacity - margin)
        # The task's number leads the ids of its sequences.
        self.sequence = task << 40
        self._empty()

    def _empty(self):
        self.waiting: list[tuple[int, int, np.ndarray, object, int]] = []
        self.free = self.room

    def add(self, doc, ids: np.ndarray):
        total = len(ids)
        whole = total - total % self.capacity
        for at in range(0, whole, self.capacity):
            yield self._row(doc, at, ids[at:at + self.capacity], total, self.sequence, 0)
            self.sequence += 1
        at = whole
        while at < total:
            end = min(at + self.piece, total, at + self.free)
            self.waiting.append((at, end, ids[at:end], doc, total))
            self.free -= end - at
            at = end
            if not self.free:
                yield from self.flush()

    def flush(self):
        for members in deal([end - at for at, end, *_ in self.waiting],
                            self.capacity, self.margin):
            offset = 0
            for n in sorted(members):
                at, end, ids, doc, total = self.waiting[n]
                yield self._row(doc, at, ids, total, self.sequence, offset)
                offset += end - at
            self.sequence += 1
        self._empty()

    @staticmethod
    def _row(doc, start, ids, total, sequence, offset):
        crc = zlib.crc32(ids.astype("<u4").tobytes())
        return doc, start, len(ids), crc, total, sequence, offset


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         vocabulary: str | None = None, capacity: int = CAPACITY, windows: int = WINDOWS,
         piece: int = PIECE, margin: int = MARGIN) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    given = pairs(docs, id_col, text_col)
    schema = _SCHEMA.format(id=given.schema["id"].dataType.simpleString())
    path = vocabulary or vocabulary_path()

    def run(batches):
        from pyspark import TaskContext
        encode = encoder(path).encode
        packer = _Packer(TaskContext.get().partitionId(), capacity, windows, piece, margin)
        kind = None
        for batch in small(batches):
            kind = batch.schema.field("id").type
            rows = []
            texts = [b.decode("utf-8", "replace") for b in batch.column("body").to_pylist()]
            for doc, ids in zip(batch.column("id").to_pylist(), encode(texts)):
                rows += packer.add(doc, np.append(ids, np.uint32(END)))
            yield _batch(rows, kind)
        if kind is not None:
            yield _batch(list(packer.flush()), kind)

    return given.mapInArrow(run, schema)


_NAMES = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _batch(rows, kind) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:])], _NAMES)
