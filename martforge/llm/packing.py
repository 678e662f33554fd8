"""Pack tokenised documents into sequences of at most ``capacity`` tokens with little padding.

The documents of an input partition form one stream of ids. Whole windows are
cut off long documents and are sequences by themselves. What remains of each
document is gathered into groups of ``windows`` nearly full windows (the last
piece of a group is cut where the group is full; its rest opens the next), and
each group is dealt to windows by Karmarkar-Karp multiway differencing: every
piece is a partition of its own with one filled window; the two partitions
with the largest imbalance are merged, the fullest window of one with the
emptiest of the other, until one is left. If a window then exceeds the
capacity, the group is dealt again to one window more.

A task holds one group of pieces at a time, and nothing is shuffled. Sequence
ids are unique: the number of the input partition and a counter.

Defined results: a null or empty text is its end id alone; repeated rows are
packed one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import arrow_map
from .text import text_slices
from .tokens import END_ID, encoder

CAPACITY = 4096
WINDOWS = 64  # windows of a group
SLACK = 8  # tokens that a window of a full group lacks on average, so that the dealing fits
OUTPUT_TOKENS = 1 << 20


def largest_differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """The numbers of the items in each window, with window sums as equal as differencing makes them."""
    spread = np.zeros((len(sizes), windows), np.int64)
    spread[:, 0] = sizes
    nodes = np.full((len(sizes), windows), -1, np.int64)
    nodes[:, 0] = np.arange(len(sizes))
    joined: list[tuple[int, int]] = []  # node len(sizes) + k is the union of two nodes
    heap = [(-size, i, spread[i], nodes[i]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        _, _, a, of_a = heapq.heappop(heap)
        _, _, b, of_b = heapq.heappop(heap)
        sums, b_nodes = a + b[::-1], of_b[::-1]
        both = np.flatnonzero((of_a >= 0) & (b_nodes >= 0))
        merged = np.maximum(of_a, b_nodes)
        merged[both] = len(sizes) + len(joined) + np.arange(len(both))
        joined.extend(zip(of_a[both].tolist(), b_nodes[both].tolist()))
        order = np.argsort(-sums, kind="stable")
        sums, merged = sums[order] - sums[order[-1]], merged[order]
        heapq.heappush(heap, (-int(sums[0]), made, sums, merged))
        made += 1
    out = []
    for node in heap[0][3].tolist() if heap else []:
        items, stack = [], [node] if node >= 0 else []
        while stack:
            x = stack.pop()
            if x < len(sizes):
                items.append(x)
            else:
                stack.extend(joined[x - len(sizes)])
        out.append(sorted(items))
    return out


def pack_group(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """The least number of windows from ceil(total / capacity) on into which differencing deals the items."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        dealt = largest_differencing(sizes, windows)
        if all(sum(sizes[i] for i in items) <= capacity for items in dealt):
            return [items for items in dealt if items]
        windows += 1


class _Packer:
    """The pieces of one input partition."""

    def __init__(self, partition: int, capacity: int, windows: int):
        self.next_id, self.capacity = partition << 33, capacity
        self.room = windows * (capacity - min(SLACK, capacity - 1))
        self.pieces: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        self.held, self.rows, self.ready = 0, [], 0

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, whole in pieces:
            self.rows.append((doc, start, len(ids), ids.tobytes(), whole, self.next_id, offset))
            offset += len(ids)
        self.ready += offset
        self.next_id += 1

    def add(self, doc, ids: np.ndarray) -> None:
        start, total = 0, len(ids)
        while total - start >= self.capacity:
            self._emit([(doc, start, ids[start: start + self.capacity], total)])
            start += self.capacity
        while start < total:
            part = ids[start: start + self.room - self.held]
            self.pieces.append((doc, start, part, total))
            self.held += len(part)
            start += len(part)
            if self.held == self.room:
                self.close()

    def close(self) -> None:
        if self.pieces:
            for window in pack_group([len(p[2]) for p in self.pieces], self.capacity):
                self._emit([self.pieces[i] for i in window])
        self.pieces, self.held = [], 0

    def take(self, kind: pa.DataType) -> pa.RecordBatch:
        rows, self.rows, self.ready = self.rows, [], 0
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        kinds = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        columns = list(zip(*rows)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, windows: int = WINDOWS, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def pack(batches):
        tokens = encoder(tokenizer_path, end_id)
        packer = _Packer(TaskContext.get().partitionId(), capacity, windows)
        kind = None
        for part, texts in text_slices(batches):
            kind = part.schema.field("doc_id").type
            ids, sizes = tokens.encode(texts)
            ids = ids.astype("<u4")
            ends = np.cumsum(sizes)
            for doc, first, last in zip(part.column("doc_id").to_pylist(), (ends - sizes).tolist(), ends.tolist()):
                packer.add(doc, ids[first:last])
                if packer.ready >= OUTPUT_TOKENS:
                    yield packer.take(kind)
        packer.close()
        if packer.rows:
            yield packer.take(kind)

    return arrow_map(rows, pack, f"doc_id {dict(rows.dtypes)['doc_id']}, start long, length long, ids binary, "
                                 "doc_tokens long, sequence_id long, offset long")
