"""Packing of whole documents into fixed-capacity token sequences (operator 2).

A document's ids are cut at multiples of the capacity; every full cut is a sequence of its own.  The remainders are
packed by Karmarkar-Karp multiway differencing: each remainder starts as a partition of ``m`` windows of which one is
filled; the two partitions with the largest imbalance are merged, the fullest windows of one with the emptiest of the
other, until one partition is left.  If its largest window exceeds the capacity, ``m`` rises and differencing
runs again.

Remainders are cut only where whole ones would waste over 2 % of the windows: then into parts of a quarter window.
The last full windows' worth of slack is removed by cutting: of each group of remainders, what exceeds a whole number
of windows is cut from the group's ends into sequences whose lengths are powers of two, which need no padding.

Distribution: documents are packed in the partitions they are read in, in groups of ``group`` remainders, without any
shuffle; memory is bounded by one Arrow batch, one part of its texts, the encoder's caches and one group.  A sequence id
is the partition's number and a count, so a partition computed again after a loss gives the same rows.

Texts: null counts as empty; an empty document is its end id alone.  Repeated rows are packed as often as they occur.
A null id is kept.  Columns besides the id and the text are not carried.
"""

from __future__ import annotations

import gc
import heapq
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulestream.llm import bpe as _bpe
from rulestream.llm.common import slices

CAPACITY = 4096
END_ID = 2
GROUP = 2048
SLACK = 0.004
WASTE = 0.02
PART_BYTES = 1 << 23  # of text or ids handled at a time
SMALL_PART_BYTES = 1 << 20
SMALL_CACHE = 1 << 16  # entries
_PIECE = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


def differencing(sizes: list[int], m: int) -> list[list[int]]:
    """Karmarkar-Karp multiway differencing: item numbers by window, for ``m`` windows."""
    if m == 1:
        return [list(range(len(sizes)))]
    left: list[int] = [-1] * len(sizes)  # nodes: an item, or two nodes whose items share a window
    right: list[int] = [-1] * len(sizes)
    # a partition holds its filled windows only, fullest first; its imbalance is the fullest less the emptiest, 0 if one is empty
    heap = [(-size, i, np.array([size]), np.array([i])) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, s, a = heapq.heappop(heap)
        _, _, t, b = heapq.heappop(heap)
        t, b = t[::-1], b[::-1]
        both = len(a) + len(b) - m
        if both > 0:  # the emptiest windows of one with the fullest of the other
            k = len(a) - both
            nodes = np.concatenate([a[:k], np.arange(len(left), len(left) + both), b[both:]])
            left.extend(a[k:].tolist())
            right.extend(b[:both].tolist())
            s = np.concatenate([s[:k], s[k:] + t[:both], t[both:]])
        else:
            nodes, s = np.concatenate([a, b]), np.concatenate([s, t])
        order = np.argsort(-s, kind="stable")
        s, nodes = s[order], nodes[order]
        count += 1
        heapq.heappush(heap, ((int(s[-1]) if len(s) == m else 0) - int(s[0]), count, s, nodes))
    out = []
    for node in heap[0][3].tolist():
        items, todo = [], [node] if node >= 0 else []
        while todo:
            k = todo.pop()
            if k < len(sizes):
                items.append(k)
            else:
                todo += [left[k], right[k]]
        out.append(sorted(items))
    return out + [[] for _ in range(m - len(out))]


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``: differencing with as few windows as the sum allows, and more when one overflows.

    Every size is at most the capacity, so as many windows as items always suffice.
    """
    m = max(1, -(-sum(sizes) // capacity))
    while True:
        got = differencing(sizes, m)
        largest = max(sum(sizes[i] for i in w) for w in got)
        if largest <= capacity:
            return [w for w in got if w]
        m = min(len(sizes), m + max(1, m * (largest - capacity) // (4 * capacity)))


def _powers(n: int, capacity: int) -> list[int]:
    return [capacity] * (n // capacity) + [1 << k for k in range(capacity.bit_length() - 1, -1, -1) if n % capacity >> k & 1]


def pack_group(sizes: list[int], capacity: int, slack: float = SLACK) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, start in the item, length).

    The tail that exceeds a whole number of nearly full windows is cut off the last items into powers of two.
    """
    total, out, keep = sum(sizes), [], list(sizes)
    extra = total - int((total // capacity) * capacity * (1 - slack))
    i = len(sizes) - 1
    for size in _powers(extra, capacity):
        seq, need = [], size
        while need:
            take = min(need, keep[i])
            keep[i] -= take
            if take:
                seq.append((i, keep[i], take))
            need -= take
            i -= not keep[i] and need > 0
        out.append(seq)
    items = [k for k, n in enumerate(keep) if n]
    if items:
        got = windows([keep[k] for k in items], capacity)
        parts = [(k, 0, keep[k]) for k in items]
        if len(got) > 1 + (1 + WASTE) * sum(keep) / capacity:  # a few large remainders a window: cut them, once
            parts = [(k, a, min(capacity // 4, keep[k] - a)) for k in items for a in range(0, keep[k], capacity // 4)]
            got = windows([n for _, _, n in parts], capacity)
        out += [[parts[i] for i in w] for w in got]
    return out


def text_parts(it, budget: int):
    """Every batch (id, text) in runs of rows of at most ``budget`` bytes of text (one row at least): only these become Python strings."""
    for batch in it:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        for a, b in slices(batch.num_rows, sizes, budget):
            yield batch.slice(a, b - a)


def pack_documents(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, group: int = GROUP, hold_encoder: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit).

    ``capacity`` is a power of two.  ``hold_encoder=False`` is for jobs whose other stages need the workers' memory: a task
    has an encoder of its own with small caches, encodes little text at a time, and frees the encoder at its end.
    """
    end = struct.pack("<I", end_id)
    part, cache = (PART_BYTES, _bpe.CACHE) if hold_encoder else (SMALL_PART_BYTES, SMALL_CACHE)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])

    def run(it):
        bpe = _bpe.load(tokenizer) if hold_encoder else _bpe.WordBpe(tokenizer, cache)
        count = TaskContext.get().partitionId() << 33
        rest: list[tuple[int | None, int, bytes, int]] = []

        def flush():
            nonlocal count, rest
            rows = []
            for seq in pack_group([len(x[2]) // 4 for x in rest], capacity):
                offset = 0
                for k, a, n in seq:
                    doc, start, ids, tokens = rest[k]
                    rows.append((doc, start + a, n, tokens, count, offset, ids[4 * a:4 * (a + n)]))
                    offset += n
                count += 1
            rest = []
            return rows

        def batch_of(rows):
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        for batch in text_parts(it, part):
            rows, held = [], 0
            for doc, ids in zip(batch.column(0).to_pylist(), bpe.encode_all(batch.column(1).to_pylist())):
                ids += end
                tokens = len(ids) // 4
                full = tokens - tokens % capacity
                for a in range(0, full, capacity):
                    rows.append((doc, a, capacity, tokens, count, 0, ids[4 * a:4 * (a + capacity)]))
                    count += 1
                if tokens > full:
                    rest.append((doc, full, ids[4 * full:], tokens))
                if len(rest) >= group:
                    rows += flush()
                held += len(ids)
                if held > part and rows:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)
        if rest:
            yield batch_of(flush())
        if not hold_encoder:
            del bpe
            gc.collect()
            pa.default_memory_pool().release_unused()

    return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, _PIECE)
