"""SimHash near-copies by BK-trees.

A document's fingerprint is the bitwise majority of the hashes of its word shingles. Fingerprints that
differ in at most ``radius`` bits link. Cut into ``radius + 1`` blocks of bits, two such fingerprints agree
in one block: every fingerprint belongs to the shards named by its blocks, and a shard's fingerprints are a
BK-tree, whose children are keyed by the integer distance to their parent. The shard trees are broadcast
while their counted bytes allow it (else they are shuffled to the fingerprints); a fingerprint walks the
trees of its shards and follows only edges within the radius of its distance to the node.

A shard of more than ``SHARD`` fingerprints is cut again by blocks of its other bits. Each cut leaves fewer
free bits, so that after a few cuts no shard can hold more than ``SHARD`` different fingerprints. Equal
fingerprints are one class from the start, and a task returns a spanning forest of the links that it finds:
a group of thousands of copies costs rows by its members and not by its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, attach, column_or_null, text_slices
from .components import components

WIDTH = 3
SEED = 42
BITS = 64
#: Fingerprints in a shard tree, 12 bytes each.
SHARD = 256
#: Trees that are broadcast have as many bytes at most.
BROADCAST_BYTES = 64 << 20
#: Shingles that are hashed at a time.
CHUNK = 1 << 16
#: Tree nodes that a task searches at a time.
NODES = 1 << 18


def fingerprint(text: bytes) -> int:
    """64 bits: a bit is 1 if it is set in over half the hashes of the shingles; 0 without words.

    The methods of bytes change A-Z only and split at ``[\\x20\\x09-\\x0D]``.
    """
    words = text.lower().split()
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(WIDTH, len(words))
    joined, n = b" ".join(words), len(words) - width + 1
    starts, ends = starts[:n].tolist(), ends[width - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    for a in range(0, n, CHUNK):
        shingles = [joined[x:y] for x, y in zip(starts[a : a + CHUNK], ends[a : a + CHUNK], strict=True)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8", len(shingles))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(doc_id, fingerprint)`` of rows with ``text``; the 64 bits as a signed number."""
    for rows, data, offsets in text_slices(batches):
        data = data.tobytes()
        found = [fingerprint(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(np.array(found, np.uint64).view(np.int64))],
            ["doc_id", "fingerprint"],
        )


def cut_masks(mask: int, radius: int) -> list[int]:
    """``mask`` with each of ``radius + 1`` blocks of the bits that it leaves free, as signed numbers."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    blocks = np.array_split(free, radius + 1)
    masks = [(mask & (1 << BITS) - 1) | sum(1 << int(b) for b in block) for block in blocks]
    return [m - (1 << BITS) if m >> BITS - 1 else m for m in masks]


# ---- trees


def bk_trees(members: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The BK-trees of groups of different fingerprints, all at once: ``(nodes, edges)`` group by group.

    A group's nodes are numbered level by level, children by parent and distance. A node's edge is
    ``128 * parent + distance``, so edges ascend within a tree and a node's children lie side by side in
    the order of their distance. Roots have edge -1.
    """
    tree = np.repeat(np.arange(len(sizes)), sizes)
    edge = np.full(len(members), -1, np.int64)
    made = np.zeros(len(sizes), np.int64)
    nodes, owners, edges = [], [], []
    while len(members):
        first = np.r_[True, (tree[1:] != tree[:-1]) | (edge[1:] != edge[:-1])]
        pivots, owner = members[first], tree[first]
        # numbers of the new nodes within their trees
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        rank = np.arange(len(owner)) - np.repeat(starts, np.diff(np.r_[starts, len(owner)]))
        number = made[owner] + rank
        made += np.bincount(owner, minlength=len(sizes))
        nodes.append(pivots)
        owners.append(owner)
        edges.append(edge[first])
        of = np.cumsum(first)[~first] - 1
        members, tree = members[~first], tree[~first]
        edge = 128 * number[of] + np.bitwise_count(members ^ pivots[of])
        order = np.lexsort((edge, tree))
        members, tree, edge = members[order], tree[order], edge[order]
    nodes, owners, edges = (np.concatenate(x) if x else members for x in (nodes, owners, edges))
    order = np.argsort(owners, kind="stable")
    return nodes[order], edges[order]


def within(queries: np.ndarray, nodes: np.ndarray, edges: np.ndarray, offsets: np.ndarray, radius: int):
    """``(query, node)`` positions of the nodes within ``radius`` of a query in the query's own tree.

    Query k walks the tree of nodes ``offsets[k]`` to ``offsets[k + 1]``.
    """
    own = np.repeat(np.arange(len(queries)) << 40, np.diff(offsets)) + edges  # ascending over all trees
    asks = np.flatnonzero(np.diff(offsets))
    at = offsets[asks]
    found = []
    while len(asks):
        far = np.bitwise_count(queries[asks] ^ nodes[at]).astype(np.int64)
        hit = far <= radius
        found.append(np.stack([asks[hit], at[hit]]))
        edge = (asks << 40) + 128 * (at - offsets[asks])
        low = np.searchsorted(own, edge + np.maximum(far - radius, 0), "left")
        high = np.searchsorted(own, edge + far + radius, "right")
        n = high - low
        asks = np.repeat(asks, n)
        at = np.arange(n.sum()) + np.repeat(low - np.cumsum(n) + n, n)
    return np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the components of the links ``(a, b)``, one less than a component has ends."""
    ends, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = at[: len(a)], at[len(a) :]
    label = np.arange(len(ends))
    while True:
        least = label.copy()
        np.minimum.at(least, label[one], label[two])
        np.minimum.at(least, label[two], label[one])
        least = np.minimum(least[label], least)
        while (least[least] != least).any():
            least = least[least]
        if (least == label).all():
            break
        label = least
    moved = label != np.arange(len(ends))
    return ends[label[moved]], ends[moved]


def _list(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), sizes


def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mapper from shards ``(mask, value, members)`` to their trees ``(mask, value, nodes, edges)``."""
    for batch in batches:
        members, sizes = _flat(batch.column("members"))
        nodes, edges = bk_trees(members.view(np.uint64), sizes)
        offsets = np.r_[0, np.cumsum(sizes)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("mask"), batch.column("value"),
                _list(offsets, nodes.view(np.int64)), _list(offsets, edges.astype(np.int32)),
            ],
            ["mask", "value", "nodes", "edges"],
        )


def follow(radius: int):
    """Mapper from fingerprints beside a tree of theirs to links ``(a, b)`` of a spanning forest."""

    def run(batches):
        for batch in batches:
            _, sizes = _flat(batch.column("nodes"))
            upto, first = np.cumsum(sizes), 0
            while first < batch.num_rows:
                limit = NODES + (upto[first - 1] if first else 0)
                end = max(first + 1, int(np.searchsorted(upto, limit, "right")))
                part = batch.slice(first, end - first)
                first = end
                nodes, sizes_ = _flat(part.column("nodes"))
                edges = _flat(part.column("edges"))[0].astype(np.int64)
                queries = part.column("fingerprint").to_numpy().view(np.uint64)
                nodes = nodes.view(np.uint64)
                asks, at = within(queries, nodes, edges, np.r_[0, np.cumsum(sizes_)], radius)
                a, b = spanning(queries[asks], nodes[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]
                )

    return run


def near_links(classes: DataFrame, radius: int, scratch: Scratch) -> DataFrame:
    """Links ``(a, b)`` with the components of ``classes(fingerprint)`` within ``radius`` bits."""
    shard, limit = ["mask", "value"], max(SHARD, 2 << radius)
    fp = F.col("fingerprint")

    def keyed(rows: DataFrame, masks) -> DataFrame:
        rows = rows.select("fingerprint", F.explode(masks).alias("mask"))
        return rows.withColumn("value", fp.bitwiseAND(F.col("mask")))

    rows = keyed(classes, F.array(*[F.lit(m) for m in cut_masks(0, radius)]))
    asked, shards = [], []
    while True:
        sizes = rows.groupBy(*shard).agg(F.count("*").alias("n"))
        full = scratch.keep(sizes.filter(F.col("n") > limit).select(*shard))
        if full.isEmpty():
            fine = rows
        else:
            fine = rows.join(full, shard, "left_anti")
        asked.append(fine)
        shards.append(
            fine.groupBy(*shard).agg(F.sort_array(F.collect_list("fingerprint")).alias("members"))
            .filter(F.size("members") > 1)
        )
        if full.isEmpty():
            break
        # (radius + 1) ** cuts masks at most, and few cuts
        finer = {r["mask"]: cut_masks(r["mask"], radius) for r in full.select("mask").distinct().collect()}
        children = F.create_map(
            *[x for m, c in finer.items() for x in (F.lit(m), F.array(*[F.lit(y) for y in c]))]
        )
        rows = scratch.keep(keyed(rows.join(full, shard, "left_semi"), children[F.col("mask")]))

    def union(parts: list[DataFrame]) -> DataFrame:
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole

    trees = scratch.keep(
        union(shards).mapInArrow(plant, "mask bigint, value bigint, nodes array<bigint>, edges array<int>")
    )
    n_bytes = trees.agg(F.coalesce(F.sum(F.size("nodes") * 12 + 64), F.lit(0))).first()[0]
    if n_bytes <= BROADCAST_BYTES:
        trees = F.broadcast(trees)
    return union(asked).join(trees, shard).mapInArrow(follow(radius), "a bigint, b bigint")


def simhash_groups(docs: DataFrame, radius: int = 2) -> DataFrame:
    """``doc_id, fingerprint, component_id``, one row per row of ``docs(doc_id, text)``.

    ``fingerprint`` is 16 hex digits; ``component_id`` the smallest doc_id reachable by links between
    fingerprints that differ in at most ``radius`` bits, itself included. Null, empty and blank texts have
    fingerprint zero and link like any other. Rows of null doc_id take part; a component of such rows only
    has a null id. Repeated rows are rows of their own. Texts are hashed whole, ``CHUNK`` shingles at a
    time. Empty input gives an empty table. Columns other than doc_id and text aren't read.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(
        docs.select(
            column_or_null(docs, "doc_id", "bigint").alias("doc_id"),
            column_or_null(docs, "text", "string").alias("text"),
        ).mapInArrow(fingerprints, "doc_id bigint, fingerprint bigint")
    )
    classes = scratch.keep(
        rows.groupBy("fingerprint").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least"))
    )
    labels = components(near_links(classes, radius, scratch), scratch)
    of_class = scratch.keep(
        classes.join(labels.withColumnRenamed("id", "fingerprint"), "fingerprint", "left")
        .withColumn("label", F.coalesce("label", "fingerprint"))
    )
    whole = of_class.groupBy("label").agg(F.min("least").alias("component_id"))
    of_class = scratch.keep(of_class.join(whole, "label").select("fingerprint", "copies", "component_id"))
    return attach(rows, of_class, ["fingerprint"], "copies", rows.count()).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
