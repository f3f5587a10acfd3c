"""Hierarchical packing of documents into windows of several context sizes.

A document longer than the largest size fills windows of its own; the rest is routed to the smallest
size that holds it. The longest pieces go first: each opens a window of its tier, the gap is filled
with the longest pieces of shorter tiers that fit, and the last gap with a part cut from the shortest
one. So every window is full. What is left at the end of a partition is cut at powers of two, which
are windows too, so no position is padded. Windows are dealt to step groups of equal size, the
largest first, each to the group with the fewest tokens.

Each partition is packed by itself from a bounded buffer: nothing is shuffled, and a lost task is
computed again from its split with the same numbers.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from heapq import heapify, heapreplace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import column_or_null, text_slices
from .tokens import encoder, wide

TIERS = (512, 1024, 2048, 4096)
#: Tokens that are packed together; a longer document makes a buffer of its own.
BUFFER = 1 << 20
STEP_TOKENS = 1 << 17

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, window bigint, step_id bigint, ids binary"
)


def pack(lengths: list[int], tiers: tuple[int, ...], last: bool):
    """``(windows, left)``: windows are lists of pieces (document, start, length) with full sums.

    ``left`` are pieces that fill no window; there are none if this is the ``last`` call.
    """
    top, windows, pool = tiers[-1], [], []
    for k, n in enumerate(lengths):
        whole = n // top * top
        windows += [[(k, s, top)] for s in range(0, whole, top)]
        if n > whole:
            pool.append((n - whole, k, whole))
    pool.sort()
    left = []
    while pool:
        n, k, start = pool.pop()
        size = next(t for t in tiers if t >= n)
        window, gap = [(k, start, n)], size - n
        while gap and pool:
            at = bisect_right(pool, (gap, len(lengths), 0)) - 1
            if at >= 0:
                m, k, start = pool.pop(at)
            else:  # all are longer: cut the shortest
                m, k, start = pool.pop(0)
                insort(pool, (m - gap, k, start + gap))
                m = gap
            window.append((k, start, m))
            gap -= m
        if gap:
            left = window
        else:
            windows.append(window)
    return (windows + halves(left), []) if last else (windows, left)


def halves(pieces: list) -> list[list]:
    """Windows whose sizes are the powers of two that make up the sum, the largest first."""
    total, windows, pieces = sum(p[2] for p in pieces), [], list(pieces[::-1])
    for bit in reversed(range(total.bit_length())):
        gap, window = total & (1 << bit), []
        while gap:
            k, start, n = pieces.pop()
            take = min(n, gap)
            if n > take:
                pieces.append((k, start + take, n - take))
            window.append((k, start, take))
            gap -= take
        if window:
            windows.append(window)
    return windows


def step_groups(sizes: list[int], step_tokens: int) -> list[int]:
    """A step for each window, so that steps have nearly equal sums."""
    steps = max(1, round(sum(sizes) / step_tokens))
    heap, out = [(0, s) for s in range(steps)], [0] * len(sizes)
    heapify(heap)
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        total, step = heap[0]
        out[k] = step
        heapreplace(heap, (total + sizes[k], step))
    return out


def packer(path: str, end_id: int, spaced: bool, tiers: tuple[int, ...], step_tokens: int, cached: int | None = None):
    def run(batches):
        code = encoder(path, end_id, spaced, cached)
        width, base = code.dtype.itemsize, TaskContext.get().partitionId() << 40
        docs, held, sequence, step = [], 0, 0, 0  # docs: (doc_id, ids, start of the part, all tokens)

        def packed(last: bool):
            nonlocal docs, held, sequence, step
            windows, left = pack([len(d[1]) // width for d in docs], tiers, last)
            sizes = [sum(p[2] for p in w) for w in windows]
            steps = step_groups(sizes, step_tokens)
            out = []
            for window, size, group in zip(windows, sizes, steps, strict=True):
                offset = 0
                for k, start, n in window:
                    doc_id, ids, before, total = docs[k]
                    part = wide(ids[start * width : (start + n) * width], code.dtype)
                    out.append(
                        (doc_id, before + start, n, total, base + sequence, offset, size, base + step + group, part)
                    )
                    offset += n
                sequence += 1
            step += max(steps, default=-1) + 1
            docs = [
                (docs[k][0], docs[k][1][s * width : (s + n) * width], docs[k][2] + s, docs[k][3])
                for k, s, n in left
            ]
            held = sum(len(d[1]) // width for d in docs)
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            for first in range(0, len(out), 4096):
                columns = zip(*out[first : first + 4096], strict=True)
                kinds = [pa.int64()] * 8 + [pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
                )

        for rows, _, _ in text_slices(batches):
            coded = code.documents(rows.column("text").to_pylist())
            for doc_id, ids in zip(rows.column("doc_id").to_pylist(), coded, strict=True):
                docs.append((doc_id, ids, 0, len(ids) // width))
                held += len(ids) // width
                if held >= BUFFER:
                    yield from packed(False)
        yield from packed(True)

    return run


def pack_documents(
    docs: DataFrame,
    path: str,
    end_id: int = 2,
    spaced: bool = False,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
    cached: int | None = None,
) -> DataFrame:
    """One row per piece: its document, its place in the document and in a sequence, and its ids.

    ``window`` is the sequence's size, a tier or, once for the tail of a partition, other powers of
    two; ``step_id`` the training step that takes the sequence; ``ids`` are little-endian unsigned 32
    bits. A null or empty text is the end id alone. Rows are packed one by one, whatever their ids.
    An empty table gives no pieces. Columns other than doc_id and text aren't read. A worker remembers the ids
    of ``cached`` words, by default as many as ``tokens.CACHED``.
    """
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(tiers):
        raise ValueError("tiers are ascending powers of two")
    return docs.select(
        column_or_null(docs, "doc_id", "bigint").alias("doc_id"),
        column_or_null(docs, "text", "string").alias("text"),
    ).mapInArrow(packer(path, end_id, spaced, tiers, step_tokens, cached), SCHEMA)
