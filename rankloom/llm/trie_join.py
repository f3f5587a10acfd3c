"""N-gram Jaccard join by prefix trees.

A document is the set of its word shingles. Shingles get a global order, frequent ones first; a set
is the sorted list of its codes, a path in a trie. Two sets that reach the threshold share one of
the last ``n - ceil(t n) + 1`` codes of either, the rarest ones, so these are the keys by which sets
meet. At the rarest code that they share, both have as many codes up to there as the overlap needs, which
bounds the length of a partner by the place of the key. A probe walks the trie of the sets that meet it: they arrive in the order of a depth-first walk,
take over the overlap counted on the path they share with the set before, and a subtree is skipped as
soon as what remains of the probe can't reach the threshold with a set of any length.

Equal sets are one class from the start. In each round a class is compared with one set only, the center
of its fullest key that still joins different components, so a group of thousands of copies costs as many
comparisons as it has members. When rounds stop paying, the sets of the keys that are still open meet in
tasks that hold a bounded part of one key each, and only pairs whose lengths and count sketches allow a
link leave the task. Keys are never joined with themselves, and no link is lost.

Before paths are sent to their probes, pairs are compared by bitmaps that have as many bins as a set has
codes, a fiftieth of its path: the bins of a count sketch are all full in long sets, which then look alike.

Hashes have 64 bits: of N distinct sets, about N^2 / 2^65 pairs are expected to be confused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    Scratch, attach, column_or_null, lower_ascii, mix, roller, shingle_hashes, text_slices, word_bounds,
)
from .components import components, extended

WIDTH = 5
#: Frequent shingles with a rank of their own, 8 bytes each in a broadcast; the order of the others is their hash.
RANKED = 1 << 17
#: A shingle in this share of a batch's documents is reported for ranking.
FREQUENT = 1e-3
#: Sets that are compared with a probe in one task, and sets of one block of a key.
BLOCK = 2048
#: Rounds of centers end when fewer than one in so many comparisons finds a link.
PAYS = 4
#: Rows whose keys are looked through at a time, and pairs of a batch that leaves.
CHUNK = 1 << 16
RARE = np.uint64(1 << 63)
#: Bins of the count sketch: 100 * sum of the bins' minima can't be below 100 * overlap.
BINS = 128
KEY_COLUMNS = ("x", "cid", "n", "most")
KEYS = "x bigint, cid bigint, n int, most int"
#: Classes whose texts are found by a broadcast (32 bytes each); more are found by a shuffle of the texts.
BROADCAST_CLASSES = 250_000


def shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of the rows and the sorted distinct shingle hashes of each."""
    for rows, data, offsets in text_slices(batches):
        low = lower_ascii(data)
        starts, ends, first = word_bounds(low, offsets)
        roll = roller(1)
        words = roll.hashes(roll.sums(low), starts, ends)
        hashes, where = shingle_hashes(words, first, WIDTH)
        yield rows, [np.unique(hashes[a:b]) for a, b in zip(where[:-1], where[1:], strict=True)]


def class_id(one: np.ndarray) -> np.uint64:
    return mix(np.array([mix(one).sum(dtype=np.uint64) + np.uint64(len(one))]))[0]


def sketch(one: np.ndarray) -> bytes | None:
    """How many of a set's hashes fall in each bin, or None if one byte can't tell."""
    counts = np.bincount((one >> np.uint64(20)).astype(np.int64) % BINS, minlength=BINS)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else None


def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document, and one per shingle that many documents of a slice share."""
    for rows, sets in shingle_sets(batches):
        ids = np.array([class_id(s) for s in sets], np.uint64).view(np.int64)
        n = len(sets)
        values, counts = np.unique(np.concatenate(sets), return_counts=True)
        often = counts >= max(2, FREQUENT * n)
        x, c = values[often].view(np.int64), counts[often]
        none, zero = pa.nulls(len(x), pa.int64()), pa.nulls(n, pa.int64())
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.concat_arrays([rows.column("doc_id").cast(pa.int64()), none]),
                "t": pa.concat_arrays([rows.column("t"), none]),
                "cid": pa.concat_arrays([pa.array(ids), none]),
                "n": pa.concat_arrays([pa.array([len(s) for s in sets], pa.int64()), none]),
                "sketch": pa.concat_arrays(
                    [pa.array(map(sketch, sets), pa.binary()), pa.nulls(len(x), pa.binary())]
                ),
                "x": pa.concat_arrays([zero, pa.array(x)]),
                "c": pa.concat_arrays([zero, pa.array(c, pa.int64())]),
            }
        )


class Order:
    """The global order: codes of ranked shingles are their ranks, those of others are above 2^63."""

    def __init__(self, ranked: np.ndarray):
        """``ranked``: hashes, the most frequent first."""
        by_value = np.argsort(ranked)
        self.values, self.ranks = ranked[by_value], by_value.astype(np.uint64)

    def codes(self, sets: list[np.ndarray]) -> list[np.ndarray]:
        every = np.concatenate(sets)
        codes = every | RARE
        if len(self.values) and len(every):
            at = np.minimum(np.searchsorted(self.values, every), len(self.values) - 1)
            found = self.values[at] == every
            codes[found] = self.ranks[at[found]]
        out, start = [], 0
        for s in sets:
            out.append(np.sort(codes[start : start + len(s)]))
            start += len(s)
        return out


def needed(n: int, percent: int) -> int:
    """Overlap that any partner of a set of ``n`` has at least."""
    return -(-percent * n // 100)


def rarest(order, percent: int):
    """Mapper to ``(x, cid, n, most)``: the keys by which a set meets its partners.

    ``most`` is the length of the longest partner whose rarest shared code is the key: the overlap is at
    most the number of codes up to the key, and has to be ``percent / (100 + percent)`` of both lengths.
    """

    def run(batches):
        for _, sets in shingle_sets(batches):
            ids = np.array([class_id(s) for s in sets], np.uint64).view(np.int64)
            # equal sets of a slice are one
            first = np.sort(np.unique(ids, return_index=True)[1])
            first = [k for k in first.tolist() if len(sets[k])]
            ids, sets = ids[first], [sets[k] for k in first]
            if sets:
                keys = [c[needed(len(c), percent) - 1 :] for c in order.value.codes(sets)]
                lengths, of = np.array([len(s) for s in sets]), [len(k) for k in keys]
                upto = np.concatenate([np.arange(needed(len(s), percent), len(s) + 1) for s in sets])
                n = np.repeat(lengths, of)
                yield pa.RecordBatch.from_pydict(
                    {
                        "x": pa.array(np.concatenate(keys).view(np.int64)),
                        "cid": pa.array(np.repeat(ids, of)),
                        "n": pa.array(n.astype(np.int32)),
                        "most": pa.array((upto * (100 + percent) // percent - n).astype(np.int32)),
                    }
                )

    return run


def kept_keys(rows: dict[str, np.ndarray], percent: int) -> np.ndarray:
    """Which rows of whole keys stay: ranked keys all, of rare ones those that a row of the key may link with."""
    x, n, most = rows["x"], rows["n"].astype(np.int64), rows["most"]
    same = x[1:] == x[:-1]
    near = same & (n[:-1] * 100 >= n[1:] * percent)
    starts = np.flatnonzero(np.concatenate([[True], ~same]))
    two = starts[np.diff(np.append(starts, len(x))) == 2]
    near[two] &= (n[two + 1] <= most[two]) & (n[two] <= most[two + 1])
    stays = x >= 0
    stays[1:] |= near
    stays[:-1] |= near
    return stays


def shared_keys(percent: int):
    """Mapper over rows ``(x, cid, n, most)`` sorted by x, n, cid: each once, and only those of :func:`kept_keys`.

    Of a key with over ``CHUNK`` rows all stay, so that no key is held whole.
    """

    def run(batches):
        held, hot = None, None
        for batch in batches:
            rows = {c: batch.column(c).to_numpy() for c in KEY_COLUMNS}
            if held is not None:
                rows = {c: np.concatenate([held[c], rows[c]]) for c in KEY_COLUMNS}
            x, cid = rows["x"], rows["cid"]
            if not len(x):
                continue
            fresh = np.ones(len(x), bool)
            fresh[1:] = (x[1:] != x[:-1]) | (cid[1:] != cid[:-1])
            rows = {c: rows[c][fresh] for c in KEY_COLUMNS}
            x = rows["x"]
            first = int(np.searchsorted(x, x[-1]))
            stays = kept_keys(rows, percent)
            if hot is not None:
                stays[x == hot] = True
            if len(x) - first < CHUNK and x[-1] != hot:
                held, stays[first:] = {c: rows[c][first:] for c in KEY_COLUMNS}, False
            else:
                held, hot, stays[first:] = None, x[-1], True
            yield pa.RecordBatch.from_pydict({c: pa.array(rows[c][stays]) for c in KEY_COLUMNS})
        if held is not None:
            stays = kept_keys(held, percent)
            yield pa.RecordBatch.from_pydict({c: pa.array(held[c][stays]) for c in KEY_COLUMNS})

    return run


def needed_of_both(n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    return -(-percent * (n_a + n_b) // (100 + percent))


def sketches(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bins of each row, and whether it has any."""
    known = column.is_valid().to_numpy(False)
    bins = np.zeros((len(column), BINS), np.uint8)
    if known.any():
        bins[known] = np.frombuffer(b"".join(column.drop_null().to_pylist()), np.uint8).reshape(-1, BINS)
    return bins, known


def plausible(percent: int):
    """Mapper from ``(a, b, n_a, n_b, sketch_a, sketch_b)`` to the pairs that may still link."""

    def run(batches):
        for batch in batches:
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            need = needed_of_both(n_a, n_b, percent)
            least = np.minimum(n_a, n_b)
            (one, known), (two, other) = (sketches(batch.column(c)) for c in ("sketch_a", "sketch_b"))
            known &= other
            least[known] = np.minimum(one[known], two[known]).sum(axis=1, dtype=np.int64)
            yield batch.select(["a", "b"]).filter(pa.array(least >= need))

    return run


def pairs_of_keys(rows: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of whole groups that may link, by growing distance in the group.

    Groups are sorted by length: where the next set is too long for one, all further ones are, too.
    """
    x, u, v, own, label = (rows.column(c).to_numpy() for c in ("x", "u", "v", "own", "label"))
    n, most = (rows.column(c).to_numpy().astype(np.int64) for c in ("n", "most"))
    bins, known = sketches(rows.column("sketch").combine_chunks())
    at, step = np.arange(len(x)), 1
    while len(at):
        at = at[at + step < len(x)]
        to = at + step
        near = (x[at] == x[to]) & (u[at] == u[to]) & (v[at] == v[to]) & (n[at] * 100 >= n[to] * percent)
        at, to = at[near], to[near]
        # pairs within a block meet where the block meets itself only
        open_ = (label[at] != label[to]) & ((own[at] != own[to]) | (u[at] == v[at]))
        open_ &= (n[to] <= most[at]) & (n[at] <= most[to])
        a, b = at[open_], to[open_]
        for k in range(0, len(a), CHUNK):
            one, two = a[k : k + CHUNK], b[k : k + CHUNK]
            least = np.minimum(bins[one], bins[two]).sum(axis=1, dtype=np.int64)
            least[~(known[one] & known[two])] = np.iinfo(np.int64).max
            may = np.minimum(least, n[one]) >= needed_of_both(n[one], n[two], percent)
            yield one[may], two[may]
        step += 1


def meet(percent: int):
    """Mapper from ``(x, u, v, own, cid, label, n, most, sketch)``, sorted by x, u, v, n, to pairs ``(a, b)``."""

    def pairs(rows):
        cid = rows.column("cid").to_numpy()
        for one, two in pairs_of_keys(rows, percent):
            a, b = np.minimum(cid[one], cid[two]), np.maximum(cid[one], cid[two])
            yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})

    def run(batches):
        held = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < CHUNK:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            x, u, v = (rows.column(c).to_numpy() for c in ("x", "u", "v"))
            starts = np.flatnonzero((x[1:] != x[:-1]) | (u[1:] != u[:-1]) | (v[1:] != v[:-1])) + 1
            if len(starts):  # the last group may go on
                yield from pairs(rows.slice(0, starts[-1]))
                rows = rows.slice(starts[-1])
            held = rows.to_batches()
        if held:
            yield from pairs(pa.Table.from_batches(held))

    return run


def trie_paths(order):
    """Mapper to ``(cid, path)``: the codes of a set, big-endian, so that paths sort as in the trie."""

    def run(batches):
        for rows, sets in shingle_sets(batches):
            paths = [c.astype(">u8").tobytes() for c in order.value.codes(sets)]
            yield pa.RecordBatch.from_pydict(
                {"cid": rows.column("cid"), "path": pa.array(paths, pa.binary())}
            )

    return run


def bitmap(path: bytes) -> bytes:
    """Which bins hold a code of the set: a bit for each, a power of two of them, at least as many as codes."""
    codes = np.frombuffer(path, ">u8").astype(np.uint64)
    held = np.zeros(max(8, 1 << max(len(codes) - 1, 0).bit_length()), bool)
    held[(mix(codes) & np.uint64(len(held) - 1)).astype(np.int64)] = True
    return np.packbits(held, bitorder="little").tobytes()


def overlap_at_most(one: bytes, n_one: int, two: bytes, n_two: int) -> int:
    """The bins that hold codes of both sets, and the codes that share a bin with others of their set."""
    a, b = np.frombuffer(one, np.uint8), np.frombuffer(two, np.uint8)
    # of half as many bins each is one or the other of two
    while len(a) > len(b):
        a = a[: len(a) // 2] | a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] | b[len(b) // 2 :]
    both, in_a, in_b = (int(np.bitwise_count(bits).sum()) for bits in (a & b, a, b))
    return both + min(n_one - in_a, n_two - in_b)


def bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mapper from ``(cid, path)`` to ``(cid, n, bits)``."""
    for batch in batches:
        paths = batch.column("path").to_pylist()
        yield pa.RecordBatch.from_pydict(
            {
                "cid": batch.column("cid"),
                "n": pa.array([len(path) // 8 for path in paths], pa.int64()),
                "bits": pa.array(map(bitmap, paths), pa.binary()),
            }
        )


def overlapping(percent: int):
    """Mapper from ``(a, b, n_a, n_b, bits_a, bits_b)`` to the pairs that may still link."""

    def run(batches):
        for batch in batches:
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            bits = zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist(), strict=True)
            most = [overlap_at_most(one, x, two, y) for (one, two), x, y in zip(bits, n_a, n_b, strict=True)]
            may = np.array(most, np.int64) >= needed_of_both(n_a, n_b, percent)
            yield batch.select(["a", "b"]).filter(pa.array(may))

    return run


class TrieWalk:
    """A probe's walk through sets that come in the depth-first order of their trie."""

    def __init__(self, probe: np.ndarray, percent: int):
        self.probe, self.percent = probe, percent
        self.path = np.zeros(0, np.uint64)
        self.count = np.zeros(1, np.int64)
        #: Big-endian prefix of the subtree that is skipped.
        self.cut: bytes | None = None

    def links(self, path: bytes) -> bool:
        """Whether the set reaches the threshold; ``path`` is big-endian."""
        if self.cut is not None and path.startswith(self.cut):
            return False
        self.cut = None
        path, n = np.frombuffer(path, ">u8").astype(np.uint64), len(self.probe)
        same = min(len(self.path), len(path))
        differs = np.flatnonzero(self.path[:same] != path[:same])
        depth = int(differs[0]) if len(differs) else same
        # the overlap at each depth of the path, and how much of the probe lies behind it
        tail = path[depth:]
        behind = np.searchsorted(self.probe, tail, "right")
        hit = (behind > 0) & (self.probe[behind - 1] == tail)
        overlap = self.count[depth] + np.cumsum(hit)
        self.path, self.count = path, np.concatenate([self.count[: depth + 1], overlap])
        # a set that goes on with all the rest of the probe, and nothing else, is the best of the subtree
        rest = n - behind
        at = np.arange(depth + 1, len(path) + 1)
        lost = np.flatnonzero(overlap + rest < needed_of_both(np.int64(n), at + rest, self.percent))
        if len(lost):
            self.cut = path[: depth + 1 + int(lost[0])].astype(">u8").tobytes()
            return False
        return int(self.count[-1]) >= needed_of_both(np.int64(n), np.int64(len(path)), self.percent)


def walk(percent: int):
    """Mapper over rows sorted by (a, block, b is given, path): a probe, then the sets that meet it."""

    def run(batches):
        now, probe = None, None
        for batch in batches:
            found = []
            columns = [batch.column(c) for c in ("a", "block", "b", "path")]
            for a, block, b, path in zip(*columns, strict=True):
                a, block, b, path = a.as_py(), block.as_py(), b.as_py(), path.as_py()
                if b is None:
                    now, probe = (a, block), TrieWalk(np.frombuffer(path, ">u8").astype(np.uint64), percent)
                else:
                    if now != (a, block):
                        raise ValueError("sets without their probe")
                    if probe.links(path):
                        found.append((a, b))
            yield pa.RecordBatch.from_pydict(
                {
                    "a": pa.array([x[0] for x in found], pa.int64()),
                    "b": pa.array([x[1] for x in found], pa.int64()),
                }
            )

    return run


class JaccardJoin:
    """The stages of one join; every table that is read twice is written."""

    def __init__(self, docs: DataFrame, percent: int = 80):
        """``percent``: sets link when 100 * intersection >= percent * union."""
        self.spark, self.percent = docs.sparkSession, percent
        self.scratch = Scratch(self.spark)
        text = column_or_null(docs, "text", "string")
        self.docs = docs.select(
            column_or_null(docs, "doc_id", "bigint").alias("doc_id"),
            F.xxhash64(text).alias("t"),
            text.alias("text"),
        )

    def prepare(self) -> None:
        """``self.rows(doc_id, t, cid, n)``, ``self.classes(cid, n, copies, doc_id, t)``, the order."""
        seen = self.scratch.keep(
            self.docs.mapInArrow(
                signatures,
                "doc_id bigint, t bigint, cid bigint, n bigint, sketch binary, x bigint, c bigint",
            )
        )
        self.rows = self.scratch.keep(seen.filter("c is null").select("doc_id", "t", "cid", "n"))
        top = (
            seen.filter("c is not null").groupBy("x").agg(F.sum("c").alias("c"))
            .orderBy(F.desc("c"), "x").limit(RANKED).toPandas()
        )
        ranked = top["x"].to_numpy(np.int64).view(np.uint64)
        self.order = self.spark.sparkContext.broadcast(Order(ranked))
        self.classes = self.scratch.keep(
            seen.filter("n > 0").groupBy("cid", "n").agg(
                # nulls sort first, so a row without id would hide the class's least id
                F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")).alias("one"),
                F.count("*").alias("copies"),
                F.min("sketch").alias("sketch"),
            ).select("cid", "n", "copies", "sketch", "one.doc_id", "one.t")
        )
        self.scratch.drop(seen)

    def meetings(self) -> DataFrame:
        """``(x, cid, n, most)``: the keys of classes. Of rare keys only those by which two may link.

        Keys are shuffled and sorted once; a task drops the others as they stream by.
        Ranked codes, the only ones that very many sets can have, are spread by class.
        """
        salt = F.when(F.col("x") < 0, 0).otherwise(F.pmod("cid", F.lit(64))).cast("int")
        return self.scratch.keep(
            self.docs.select("text")
            .mapInArrow(rarest(self.order, self.percent), KEYS)
            .repartition("x", salt)
            .sortWithinPartitions("x", "n", "cid")
            .mapInArrow(shared_keys(self.percent), KEYS)
        )

    def paths(self, pairs: DataFrame) -> DataFrame:
        """``(cid, path)`` of the classes in ``pairs(a, b)``, from one document of each."""
        wanted = self.scratch.keep(
            self.classes.join(
                pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct(), "cid", "left_semi"
            ).select("cid", F.col("doc_id").alias("_id"), F.col("t").alias("_t"))
        )
        n_wanted = wanted.count()
        near = F.broadcast if n_wanted <= BROADCAST_CLASSES else lambda table: table
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("t") == F.col("_t"))
        # rows of one id and text are one class's, and hold the same path; only their texts move for being equal
        found = self.rows.drop("cid").join(near(wanted), same).groupBy("cid").count()
        twice = self.scratch.keep(found.filter("count > 1").select("cid"))
        texts = self.docs.join(near(wanted.join(twice, "cid", "left_anti")), same).select("cid", "text")
        if not twice.isEmpty():
            again = self.docs.join(near(wanted.join(twice, "cid", "left_semi")), same).select("cid", "text")
            texts = texts.unionByName(again.dropDuplicates(["cid"]))
        paths = self.scratch.keep(texts.mapInArrow(trie_paths(self.order), "cid bigint, path binary"))
        self.scratch.drop(wanted, twice)
        return paths

    def verify(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs(a, b)`` that link; pairs are written, distinct, and ``a`` is the probe."""
        n_pairs = pairs.count()
        if not n_pairs:
            return pairs
        paths = self.paths(pairs)
        pairs = self.overlapping(pairs, paths)
        ends = self.scratch.keep(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct())
        moved = paths.join(F.broadcast(ends), "cid", "left_semi") if ends.count() <= BROADCAST_CLASSES else paths
        per_probe = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
        per_probe = self.scratch.keep(per_probe)
        split = F.broadcast(per_probe.filter("blocks > 1"))  # fewer than pairs / BLOCK
        if n_pairs > BLOCK * 1_000_000:
            split = per_probe.filter("blocks > 1")
        sets = (
            pairs.join(split, "a", "left")
            .withColumn("block", F.pmod(F.xxhash64("b"), F.coalesce("blocks", F.lit(1))))
            .select("a", "block", "b")
            .join(moved.withColumnRenamed("cid", "b"), "b")
        )
        probes = (
            per_probe.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
            .select("a", "block", F.lit(None).cast("bigint").alias("b"))
            .join(moved.withColumnRenamed("cid", "a"), "a")
        )
        found = self.scratch.keep(
            sets.select("a", "block", "b", "path")
            .unionByName(probes.select("a", "block", "b", "path"))
            .repartition("a", "block")
            .sortWithinPartitions("a", "block", F.col("b").isNotNull(), "path")
            .mapInArrow(walk(self.percent), "a bigint, b bigint")
        )
        self.scratch.drop(paths, pairs, ends, per_probe)
        return found

    def overlapping(self, pairs: DataFrame, paths: DataFrame) -> DataFrame:
        """Those of ``pairs(a, b)`` that the bitmaps of their paths don't rule out; a path is read, not moved."""
        bits = self.scratch.keep(paths.mapInArrow(bitmaps, "cid bigint, n bigint, bits binary"))
        of_a = bits.select(F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
        of_b = bits.select(F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
        may = self.scratch.keep(
            pairs.join(of_a, "a").join(of_b, "b").mapInArrow(overlapping(self.percent), "a bigint, b bigint")
        )
        self.scratch.drop(bits)
        return may

    def labels(self) -> DataFrame:
        """``(id, label)`` of the classes that link with another: equal labels are one component.

        Links are looked for until no key has sets of two components that weren't compared.
        """
        rest, labels, tested = self.meetings(), None, None
        turn = 0
        while True:
            turn += 1
            rest = self.still_open(rest, labels)
            pairs = self.centers(rest, tested, turn)
            links, n_pairs = self.verify(pairs), pairs.count()
            labels = components(links, self.scratch) if labels is None else extended(labels, links, self.scratch)
            tested = pairs if tested is None else tested.unionByName(pairs)
            if links.count() * PAYS <= n_pairs:
                break
        rest = self.still_open(rest, labels)
        return extended(labels, self.verify(self.remaining(rest, tested)), self.scratch)

    def still_open(self, met: DataFrame, labels: DataFrame | None) -> DataFrame:
        """``(x, cid, n, most, label, n_x)`` of the keys at which components meet; n_x are a key's rows."""
        rows, total = met.select(*KEY_COLUMNS), met.count()
        if labels is None:
            labelled = rows.withColumn("label", F.col("cid"))
        else:
            labelled = rows.join(labels.withColumnRenamed("id", "cid"), "cid", "left")
            labelled = self.scratch.keep(labelled.withColumn("label", F.coalesce("label", "cid")))
        keys = self.scratch.keep(
            labelled.groupBy("x").agg(
                F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n_x")
            ).filter("low != high").select("x", "n_x")
        )
        opened = self.scratch.keep(attach(labelled, keys, ["x"], "n_x", total, "inner"))
        self.scratch.drop(keys, labelled, met)
        return opened

    def centers(self, rest: DataFrame, tested: DataFrame | None, turn: int) -> DataFrame:
        """``(a, b)`` that may link and weren't tested: for a class b the center a of its fullest key.

        The first center of a key is the set whose keys have the most rows, as what others were copied from
        has; later ones are drawn.
        """
        draw = F.xxhash64(F.lit(turn), "cid")
        drawn = rest.withColumn("score", draw)
        if turn == 1:
            drawn = rest.join(rest.groupBy("cid").agg(F.sum("n_x").alias("score")), "cid")
        best = F.max(F.struct("score", draw.alias("draw"), "cid", "label", "n", "most")).alias("c")
        center = self.scratch.keep(
            drawn.groupBy("x").agg(best, F.count("*").alias("_n")).select(
                "x", "_n", F.col("c.cid").alias("a"), F.col("c.label").alias("label_a"),
                F.col("c.n").alias("n_a"), F.col("c.most").alias("most_a"),
            )
        )
        met = attach(rest, center, ["x"], "_n", rest.count(), "inner").filter(
            "label != label_a and n <= most_a and n_a <= most"
        )
        fullest = met.groupBy(F.col("cid").alias("b")).agg(F.max(F.struct("n_x", "a")).alias("c"))
        pairs = self.plausible(self.untested(fullest.select("c.a", "b"), tested))
        self.scratch.drop(center)
        return pairs

    def untested(self, pairs: DataFrame, tested: DataFrame | None) -> DataFrame:
        """Rows of ``pairs(a, b)`` that aren't among ``tested``, whichever of both was the probe."""
        if tested is None:
            return pairs
        ends = F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")
        return pairs.select("*", *ends).join(tested.select(*ends), ["low", "high"], "left_anti").drop("low", "high")

    def remaining(self, rest: DataFrame, tested: DataFrame) -> DataFrame:
        """``(a, b)`` of different components that meet at a key, may link and weren't tested.

        A key's sets are dealt over blocks, and every two blocks meet in a task of their own.
        """
        blocks = F.ceil(F.col("n_x") / BLOCK)
        dealt = (
            rest.join(self.classes.select("cid", "sketch"), "cid")
            .withColumn("blocks", blocks)
            .withColumn("own", F.pmod(F.xxhash64("cid"), "blocks"))
            .withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
            .withColumn("u", F.least("own", "k")).withColumn("v", F.greatest("own", "k"))
        )
        pairs = (
            dealt.select("x", "u", "v", "own", "cid", "label", "n", "most", "sketch")
            .repartition("x", "u", "v")
            .sortWithinPartitions("x", "u", "v", "n")
            .mapInArrow(meet(self.percent), "a bigint, b bigint")
            .distinct()
        )
        pairs = self.scratch.keep(self.untested(pairs, tested))
        self.scratch.drop(rest)
        return pairs

    def plausible(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs(a, b)`` that lengths and count sketches don't rule out."""
        of_b = self.classes.select(
            F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b")
        )
        of_a = self.classes.select(
            F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a")
        )
        return self.scratch.keep(
            pairs.join(of_a, "a").join(of_b, "b").mapInArrow(plausible(self.percent), "a bigint, b bigint")
        )

    def groups(self) -> DataFrame:
        """``doc_id, t, n_shingles, component_id, component, keep_t``, one row per document."""
        self.prepare()
        labels = self.labels()
        of_class = self.scratch.keep(
            self.classes.join(labels.withColumnRenamed("id", "cid"), "cid", "left")
            .withColumn("label", F.coalesce("label", "cid"))
        )
        whole = of_class.groupBy("label").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")).alias("least")
        ).select("label", F.col("least.doc_id").alias("component_id"), F.col("least.t").alias("keep_t"))
        of_class = self.scratch.keep(
            of_class.join(whole, "label")
            .select("cid", F.col("label").alias("component"), "component_id", "keep_t", "copies")
        )
        joined = attach(self.rows, of_class, ["cid"], "copies", self.rows.count())
        return joined.select(
            "doc_id", "t", F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
            "component",
            F.coalesce("keep_t", "t").alias("keep_t"),
        )


def near_duplicate_groups(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable by links, itself included. A null or empty
    text, or one of blanks only, has no shingles and links with nothing, not even its like. Equal
    texts link. Rows of null doc_id take part; a component of such rows only has a null id. Empty
    input gives an empty table. Columns other than doc_id and text aren't read.
    """
    return JaccardJoin(docs, percent).groups().select("doc_id", "n_shingles", "component_id")


def one_per_group(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest doc_id.

    Documents without shingles all stay. Of rows equal in doc_id and text one stays. All columns are
    kept as they are.
    """
    groups = JaccardJoin(docs, percent).groups()
    stays = groups.filter(
        "n_shingles = 0 or (doc_id <=> component_id and t = keep_t)"
    ).select(F.col("doc_id").alias("_id"), F.col("t").alias("_t")).distinct()
    hashed = docs.withColumn("_hash", F.xxhash64(column_or_null(docs, "text", "string")))
    ident = column_or_null(hashed, "doc_id", "bigint")
    kept = hashed.join(stays, ident.eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_t")), "left_semi")
    bare = kept.filter(~F.coalesce(column_or_null(kept, "text", "string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    full = kept.filter(F.coalesce(column_or_null(kept, "text", "string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    return full.dropDuplicates(["doc_id", "_hash"]).unionByName(bare).drop("_hash")
