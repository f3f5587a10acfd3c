"""Approximate nearest neighbours by a forest of random-projection trees.

A tree splits the rows at the median of a random projection, level by level; directions and medians
come from a bounded sample, every row gets a leaf in every tree. A query walks all trees through one
priority queue ordered by the largest distance to a plane it has crossed, and takes the leaves that
come first. How many is measured: the neighbours of some queries are found by brute force, and the
number of leaves is the smallest that finds the wanted share of them. Rows and queries meet in their
leaf, the exact distances are taken there, and only a query's best of each task's leaves go on.

Equal vectors are one class, which keeps its smallest ids; so a vector that a third of the rows hold is
one row in the trees.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, attach

TREES = 8
LEAF = 256
#: A tree has at most 2 ** MAX_DEPTH leaves, as many as the sample can split.
MAX_DEPTH = 12
SAMPLE = 20_000
#: Queries whose neighbours are found by brute force, and the share of them to be found.
MEASURED = 64
RECALL = 0.96
#: Rows and queries of a leaf that meet in one task.
BLOCK = 4096
#: Results, 32 bytes each, that a task gathers before it cuts them to the best of each query.
GATHERED = 1 << 20


class Tree:
    """Directions by level and medians by node; node k has the children 2k and 2k + 1."""

    def __init__(self, sample: np.ndarray, depth: int, seed: int):
        rng = np.random.default_rng(seed)
        self.directions = rng.standard_normal((depth, sample.shape[1]))
        self.directions /= np.linalg.norm(self.directions, axis=1, keepdims=True)
        self.medians, places, node = [], sample @ self.directions.T, np.zeros(len(sample), np.int64)
        for level in range(depth):
            place, order = places[:, level], np.lexsort((places[:, level], node))
            starts = np.searchsorted(node[order], np.arange(2**level + 1))
            middle = np.minimum((starts[:-1] + starts[1:]) // 2, len(sample) - 1)
            medians = np.where(starts[1:] > starts[:-1], place[order][middle], 0.0)
            self.medians.append(medians)
            node = node * 2 + (place >= medians[node])

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        places, node = vectors @ self.directions.T, np.zeros(len(vectors), np.int64)
        for level, medians in enumerate(self.medians):
            node = node * 2 + (places[:, level] >= medians[node])
        return node


class Forest:
    def __init__(self, sample: np.ndarray, n_rows: int):
        depth = int(np.clip(np.ceil(np.log2(max(n_rows, 1) / LEAF)), 0, MAX_DEPTH))
        depth = min(depth, int(np.log2(max(len(sample), 1))))
        self.trees = [Tree(sample, depth, seed) for seed in range(TREES)]

    def walk(self, query: np.ndarray):
        """Leaves (tree, leaf) of all trees, the most promising first."""
        places = [t.directions @ query for t in self.trees]
        queue = [(0.0, t, 0, 0) for t in range(len(self.trees))]
        while queue:
            far, t, level, node = heapq.heappop(queue)
            medians, place = self.trees[t].medians, places[t]
            while level < len(medians):
                side = place[level] - medians[level][node]
                node, other = node * 2 + (side >= 0), node * 2 + (side < 0)
                level += 1
                heapq.heappush(queue, (max(far, abs(side)), t, level, other))
            yield t, int(node)

    def leaves_needed(self, queries: np.ndarray, near: list[np.ndarray]) -> int:
        """Leaves after which the share ``RECALL`` of the neighbours ``near`` has been met."""
        met = []
        for query, vectors in zip(queries, near, strict=True):
            wanted: dict[tuple[int, int], list[int]] = {}
            for t, tree in enumerate(self.trees):
                for v, leaf in enumerate(tree.leaves(vectors).tolist()):
                    wanted.setdefault((t, leaf), []).append(v)
            missing = set(range(len(vectors)))
            for k, place in enumerate(self.walk(query), 1):
                found = missing.intersection(wanted.get(place, ()))
                met += [k] * len(found)
                missing -= found
                if not missing:
                    break
        return int(np.quantile(met, RECALL, method="higher")) if met else 1


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def distances(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact Euclidean distances in double precision, from the differences."""
    out = np.empty((len(queries), len(rows)))
    step = max(1, (1 << 20) // max(rows.size, 1))
    for k in range(0, len(queries), step):
        d = queries[k : k + step, None, :] - rows[None]
        out[k : k + step] = np.sqrt(np.einsum("qrd,qrd->qr", d, d))
    return out


def nearest(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` smallest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, k - 1)[k - 1]
        few = np.flatnonzero(scores <= edge)
    else:
        few = np.arange(len(scores))
    return few[np.lexsort((ids[few], scores[few]))[:k]]


def brute(queries, k: int):
    """Mapper from classes to the ``k`` best of the batch for each of a few queries."""

    def run(batches):
        numbers, vectors = queries.value
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, rows = batch.column("least").to_numpy(), _matrix(batch.column("vector"))
            scores = distances(vectors, rows)
            q, at = [], []
            for number, row in zip(numbers, scores, strict=True):
                best = nearest(row, ids, k)
                q += [number] * len(best)
                at.append(best)
            at = np.concatenate(at)
            order = np.repeat(np.arange(len(numbers)), [min(k, len(ids))] * len(numbers))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(q, pa.int64()), pa.array(scores[order, at]),
                    pa.array(ids[at]), batch.column("vector").take(pa.array(at)),
                ],
                ["query", "score", "least", "vector"],
            )

    return run


def assign(forest):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch.column("vector"))
            for t, tree in enumerate(forest.value.trees):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(rows), t, np.int32)),
                        pa.array(tree.leaves(rows).astype(np.int32)),
                        batch.column("cls"), batch.column("least"), batch.column("vector"),
                    ],
                    ["tree", "leaf", "cls", "least", "vector"],
                )

    return run


def probe(forest, n_leaves: int):
    def run(batches):
        for batch in batches:
            places, which = [], []
            for k, vector in enumerate(_matrix(batch.column("vector")) if batch.num_rows else []):
                for n, place in enumerate(forest.value.walk(vector)):
                    if n == n_leaves:
                        break
                    places.append(place)
                    which.append(k)
            if which:
                take = pa.array(which)
                tree, leaf = zip(*places, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(tree, pa.int32()), pa.array(leaf, pa.int32()),
                        batch.column("cls").take(take), batch.column("least").take(take),
                        batch.column("vector").take(take),
                    ],
                    ["tree", "leaf", "cls", "least", "vector"],
                )

    return run


class Best:
    """The ``k`` best rows of each query over the leaves of one task, bounded in memory."""

    NAMES = ("query", "cls", "least", "score")

    def __init__(self, k: int):
        self.k, self.parts, self.size = k, [], 0

    def add(self, *columns: np.ndarray) -> pa.RecordBatch | None:
        """Takes results; gives some back if those of all queries together are too many to hold."""
        self.parts.append(columns)
        self.size += len(columns[0])
        if self.size < GATHERED:
            return None
        self._cut()
        return self.take() if self.size > GATHERED // 2 else None

    def _cut(self) -> None:
        query, cls, least, score = map(np.concatenate, zip(*self.parts, strict=True))
        order = np.lexsort((score, least, query))  # a class met in several trees counts once
        q, x = query[order], least[order]
        order = order[np.r_[True, (q[1:] != q[:-1]) | (x[1:] != x[:-1])]]
        order = order[np.lexsort((least[order], score[order], query[order]))]
        q = query[order]
        starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
        order = order[rank < self.k]
        self.parts = [(query[order], cls[order], least[order], score[order])]
        self.size = len(order)

    def take(self) -> pa.RecordBatch | None:
        if not self.size:
            return None
        self._cut()
        out = pa.RecordBatch.from_arrays([pa.array(c) for c in self.parts[0]], list(self.NAMES))
        self.parts, self.size = [], 0
        return out


def search_leaves(k: int):
    """Mapper over leaves, sorted so that a leaf's queries come before its rows."""

    def run(batches):
        now, queries, vectors, matrix = None, [], [], None
        found = Best(k)
        for batch in batches:
            names = ("tree", "leaf", "row_block", "query_block", "is_row")
            keys = np.stack([batch.column(n).cast(pa.int64()).to_numpy(zero_copy_only=False) for n in names])
            cuts = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                group, is_row = tuple(keys[:4, a]), keys[4, a]
                ids, rows = part.column("least").to_numpy(), _matrix(part.column("vector"))
                cls = part.column("cls").to_numpy()
                if group != now:
                    now, queries, vectors, matrix = group, [], [], None
                if not is_row:
                    queries.append(cls)
                    vectors.append(rows)
                    continue
                if not queries:
                    continue
                if matrix is None:
                    matrix, numbers = np.concatenate(vectors), np.concatenate(queries)
                for first in range(0, len(matrix), 256):
                    scores = distances(matrix[first : first + 256], rows)
                    best = [nearest(s, ids, k) for s in scores]
                    at = np.concatenate(best)
                    of = np.repeat(np.arange(len(best)), [len(x) for x in best])
                    full = found.add(numbers[first + of], cls[at], ids[at], scores[of, at])
                    if full is not None:
                        yield full
        rest = found.take()
        if rest is not None:
            yield rest

    return run


def usable(vector: Column) -> Column:
    """No null, no component that is null or not finite, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def search(table: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``table(vec_id, embedding)`` that is a query
    the ``k`` nearest others found, ties to the smaller id.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do rows without
    an id or with another length than most. Repeated ids are the same row. Fewer rows than ``k`` give as
    many as there are; an empty table gives none.
    """
    spark = table.sparkSession
    scratch = Scratch(spark)
    rows = table.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.transform("embedding", lambda x: x.cast("double")).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    ).filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    size = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.filter(F.size("vector") == (size["n"] if size else 0))
    # one more id than asked for, as a query isn't its own neighbour
    low = Window.partitionBy("vector").orderBy("vec_id")
    least = (
        rows.groupBy("vector", "vec_id").agg(F.lit(1)).select("vector", "vec_id")
        .withColumn("r", F.row_number().over(low)).filter(F.col("r") <= k + 1)
        .groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    )
    asked = rows.groupBy("vector").agg(F.count_if("is_query").alias("n_queries"))
    classes = scratch.keep(
        least.join(asked, "vector")
        .withColumn("least", F.col("ids")[0])
        .withColumn("cls", F.monotonically_increasing_id())
    )
    n = classes.count()
    sample = classes.select("least", "vector").orderBy(F.xxhash64("least"), "least").limit(SAMPLE).toPandas()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    forest = Forest(np.stack(sample["vector"].to_list()), n)
    shared = spark.sparkContext.broadcast(forest)
    tried = (
        classes.filter("n_queries > 0").select("cls", "vector")
        .orderBy(F.xxhash64("cls"), "cls").limit(MEASURED).toPandas()
    )
    if tried.empty:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    numbers, vectors = tried["cls"].to_list(), np.stack(tried["vector"].to_list())
    by_score = Window.partitionBy("query").orderBy("score", "least")
    truth = (
        classes.select("least", "vector")
        .mapInArrow(
            brute(spark.sparkContext.broadcast((numbers, vectors)), k + 1),
            "query bigint, score double, least bigint, vector array<double>",
        )
        .withColumn("r", F.row_number().over(by_score)).filter(F.col("r") <= k + 1)
        .filter("score > 0").select("query", "vector").toPandas()
    )
    near = [
        np.array(truth["vector"][truth["query"] == q].to_list(), float).reshape(-1, vectors.shape[1])
        for q in numbers
    ]
    n_leaves = forest.leaves_needed(vectors, near)

    schema = "tree int, leaf int, cls bigint, least bigint, vector array<double>"
    index = scratch.keep(classes.select("cls", "least", "vector").mapInArrow(assign(shared), schema))
    probes = scratch.keep(
        classes.filter("n_queries > 0").select("cls", "least", "vector")
        .repartition("cls").mapInArrow(probe(shared, n_leaves), schema)
    )
    # TREES * 2 ** MAX_DEPTH leaves at most
    leaf = ["tree", "leaf"]
    held = index.groupBy(*leaf).agg(F.ceil(F.count("*") / BLOCK).alias("row_blocks"))
    visits = probes.groupBy(*leaf).agg(F.ceil(F.count("*") / BLOCK).alias("query_blocks"))
    blocks = F.broadcast(scratch.keep(held.join(visits, leaf)))

    def blocked(side: DataFrame, own: str, other: str, is_row: bool) -> DataFrame:
        return side.join(blocks, leaf).select(
            *leaf,
            F.pmod(F.xxhash64("cls"), F.col(f"{own}_blocks")).alias(f"{own}_block"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block"),
            "cls", "least", "vector", F.lit(is_row).alias("is_row"),
        )

    group = [*leaf, "row_block", "query_block"]
    met = (
        blocked(index, "row", "query", True)
        .unionByName(blocked(probes, "query", "row", False))
        .repartition(*group)
        .sortWithinPartitions(*group, "is_row")
        .mapInArrow(search_leaves(k + 1), "query bigint, cls bigint, least bigint, score double")
        .groupBy("query", "cls", "least").agg(F.min("score").alias("score"))
        .withColumn("r", F.row_number().over(by_score)).filter(F.col("r") <= k + 1)
    )
    best = (
        met.join(classes.select("cls", "ids"), "cls")
        .groupBy("query")
        .agg(F.array_sort(F.flatten(F.collect_list(
            F.transform("ids", lambda x: F.struct(F.col("score").alias("score"), x.alias("vec_id")))
        ))).alias("near"))
    )
    to_class = classes.filter("n_queries > 0").select("cls", "vector", "n_queries")
    answers = scratch.keep(best.join(to_class, F.col("query") == F.col("cls")).select("vector", "near", "n_queries"))
    queries = rows.filter("is_query").select("vec_id", "vector").distinct()
    own = queries.withColumnRenamed("vec_id", "query_id")
    return (
        attach(own, answers, ["vector"], "n_queries", rows.filter("is_query").count(), "inner")
        .select(
            "query_id",
            F.posexplode(F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)),
        )
        .select("query_id", (F.col("pos") + 1).alias("rank"), "col.vec_id", "col.score")
    )
