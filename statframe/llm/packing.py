"""Packing token ids into near-equal sequences by Karmarkar-Karp differencing (operator 4).

A document's ids beyond its last full window are cut into pieces of at most
``piece`` ids; full windows need no partner.  The pieces of ``batch_docs``
documents are divided among k windows by multiway differencing: every piece
starts as a partial partition (one window filled, the others empty), and the
two partitions with the largest imbalance are merged again and again, the
fullest window of one with the emptiest of the other.  k starts at the ids'
total over the capacity and rises while any window is above the capacity.

Work stays inside the input's partitions: no shuffle, memory for one batch.
Null text: empty, only the separator id.  Null or repeated doc_id: packed as any
other row.  Empty input: empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from statframe.llm.common import id_text, text_groups
from statframe.llm.token_cache import TEXT_BYTES, id_cache

PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")


def difference(sizes: list[int], k: int) -> np.ndarray:
    """Window (0..k-1) of every size, by multiway differencing."""
    # a node is a partial partition: the sums of its filled windows in ascending order, the last of
    # its k; before them it has only empty ones
    heap, nodes = [], []
    for i, s in enumerate(sizes):
        nodes.append(None)
        heap.append((-s if k > 1 else 0, i, np.array([s], np.int64)))
    heapq.heapify(heap)
    while len(heap) > 1:
        key, a, x = heapq.heappop(heap)
        # a node with an empty window and the largest sum of all takes in one size after the other, as
        # long as each is no larger than its sums: these merges are one step
        taken, least = [], int(x[0])
        while heap and heap[0][1] < len(sizes) and len(taken) + len(x) < k:
            s = sizes[heap[0][1]]
            if s > least or s == -key:
                break
            taken.append(heapq.heappop(heap)[1])
            least = s
        if taken:
            sums = np.concatenate([np.array([sizes[i] for i in taken[::-1]], np.int64), x])
            nodes.append((a, taken))
            heapq.heappush(heap, ((least if len(sums) == k else 0) + key, len(nodes) - 1, sums))
            continue
        _, b, y = heapq.heappop(heap)
        sums = np.zeros(min(k, len(x) + len(y)), np.int64)
        sums[:len(y)] = y[::-1]
        sums[len(sums) - len(x):] += x
        order = np.argsort(sums, kind="stable").astype(np.int32)
        sums = sums[order]
        nodes.append((a, len(x), b, len(y), order))
        least = int(sums[0]) if len(sums) == k else 0
        heapq.heappush(heap, (least - int(sums[-1]), len(nodes) - 1, sums))
    # from the last merge down: which window each filled place of a node has become
    window = np.zeros(len(sizes), np.int64)
    top = len(heap[0][2]) if heap else 0
    todo = [(len(nodes) - 1, np.arange(k - top, k))] if heap else []
    while todo:
        node, place = todo.pop()
        if nodes[node] is None:
            window[node] = place[-1]
            continue
        if len(nodes[node]) == 2:
            a, taken = nodes[node]
            window[taken] = place[:len(taken)][::-1]
            todo.append((a, place[len(taken):]))
            continue
        a, of_x, b, of_y, order = nodes[node]
        back = np.empty(len(place), np.int64)
        back[order] = place
        todo += [(a, back[len(back) - of_x:]), (b, back[:of_y][::-1])]
    return window


def near_equal(sizes: list[int], capacity: int) -> np.ndarray:
    """Windows of at most ``capacity``: their number rises until every window holds."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        window = difference(sizes, k)
        if int(np.bincount(window, sizes, k).max()) <= capacity:
            return window
        k += 1


def pack(docs: DataFrame, vocab: str, separator_id: int, capacity: int = 1024, piece: int = 256,
         batch_docs: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: (doc_id, start, length, ids, doc_tokens, sequence_id, offset); ids are
    little-endian unsigned 32-bit, the separator is each document's last id."""
    if not 0 < piece <= capacity:
        raise ValueError("piece must lie between 1 and capacity")
    def run(batches):
        from pyspark import TaskContext

        sequence = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        waiting: list[tuple] = []  # doc_id, start, ids, doc_tokens
        docs_waiting = 0

        def out():
            cols = list(zip(*rows))
            rows.clear()
            types = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)],
                names=[f.split()[0] for f in PIECES.split(", ")])

        def settle():
            nonlocal sequence, docs_waiting
            sizes = [len(w[2]) // 4 for w in waiting]
            window = near_equal(sizes, capacity)
            fill = np.zeros(int(window.max()) + 1, np.int64)
            used = np.unique(window)
            number = dict(zip(used.tolist(), range(sequence, sequence + len(used))))
            for (doc, start, ids, total), size, w in zip(waiting, sizes, window.tolist()):
                rows.append((doc, start, size, ids, total, number[w], int(fill[w])))
                fill[w] += size
            sequence += len(used)
            waiting.clear()
            docs_waiting = 0

        cache = id_cache(vocab)
        for b in text_groups(batches, TEXT_BYTES):
            every, ends = cache.batch(b.column("text"), separator_id)
            data = every.tobytes()
            at = [0, *(ends * 4).tolist()]
            for doc, lo, hi in zip(b.column("doc_id").to_pylist(), at, at[1:]):
                ids = data[lo:hi]
                n = len(ids) // 4
                full = n - n % capacity
                for s in range(0, full, capacity):
                    rows.append((doc, s, capacity, ids[4 * s:4 * (s + capacity)], n, sequence, 0))
                    sequence += 1
                if n > full:
                    cuts = np.linspace(full, n, -(-(n - full) // piece) + 1).astype(int).tolist()
                    waiting += [(doc, i, ids[4 * i:4 * j], n) for i, j in zip(cuts, cuts[1:])]
                    docs_waiting += 1
                if docs_waiting >= batch_docs:
                    settle()
                if len(rows) >= 4096:
                    yield out()
        if waiting:
            settle()
        if rows:
            yield out()

    return id_text(docs, id_col, text_col).mapInArrow(run, PIECES)
