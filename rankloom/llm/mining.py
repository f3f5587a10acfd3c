"""Hard negatives by the threshold algorithm of Fagin.

Vectors are floored to integers. A task holds a shard of the rows and, for every dimension, the list of
its candidates in the order of that component. For an anchor the lists are read from the end that the
sign of its own component asks for; every row met is scored at once by its whole integer inner product.
What rows not yet met can score is at most the sum of the anchor's components times the values at which
the lists stand. Reading stops when this threshold lies strictly below the k-th score of every window, or
below the window's lower end; a tie is never cut off, as it could have the smaller id.

First the positives of all anchors are found that way, each among the rows of its label, then the
negatives in the windows that the positives' scores set. Anchors are broadcast in blocks of bounded size,
and only an anchor's best of each shard go on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Rows of a shard.
SHARD_ROWS = 8192
#: Anchors that are broadcast at a time; with 64 dimensions some 30 MB.
ANCHORS = 50_000
#: Entries read from each list in the first turn; every turn doubles them.
STEP = 32
NO_LABEL = np.iinfo(np.int64).min


class Lists:
    """Rows of a shard and, for every dimension, their order by that component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels, self.rows = ids, labels, rows
        self.ascending = np.argsort(rows, axis=0, kind="stable").astype(np.int32)

    def of_label(self) -> dict[int, Lists]:
        order = np.argsort(self.labels, kind="stable")
        values, starts = np.unique(self.labels[order], return_index=True)
        parts = np.split(order, starts[1:])
        return {
            int(v): Lists(self.ids[p], self.labels[p], self.rows[p])
            for v, p in zip(values, parts, strict=True)
        }


class Range:
    """Scores of which the best ``k`` are asked for, both ends included; None is no end."""

    __slots__ = ("low", "high", "k")

    def __init__(self, low: int | None, high: int | None, k: int):
        self.low, self.high, self.k = low, high, k


def best_in_windows(
    lists: Lists, anchor: np.ndarray, windows: list[Range], skip_id: int | None, skip_label: int
) -> tuple[list[np.ndarray], np.ndarray, int]:
    """For each window the positions of its best rows, the scores of all rows met, and how many were met.

    Rows of ``skip_id`` or ``skip_label`` aren't candidates.
    """
    n = len(lists.ids)
    dims = np.flatnonzero(anchor)
    forward = anchor[dims] < 0  # the smallest components give the largest products
    order, values = lists.ascending[:, dims], anchor[dims]
    met = np.zeros(n, bool)
    scores = np.zeros(n, np.int64)
    open_ = [w for w in windows if w.low is None or w.high is None or w.low <= w.high]
    allowed = np.zeros(0, np.int64)
    at, step = 0, STEP
    columns = np.arange(len(dims))
    while at < n and open_:
        end = min(at + step, n) if len(dims) else n
        if len(dims):
            met_now = np.zeros(n, bool)
            met_now[order[at:end, forward].ravel()] = True
            met_now[order[n - end : n - at, ~forward].ravel()] = True
            fresh = np.flatnonzero(met_now & ~met)
        else:
            fresh = np.arange(n)
        met[fresh] = True
        scores[fresh] = lists.rows[fresh] @ anchor
        usable = lists.labels[fresh] != skip_label
        if skip_id is not None:
            usable &= lists.ids[fresh] != skip_id
        allowed = np.concatenate([allowed, fresh[usable]])
        at, step = end, step * 2
        if at < n:
            stands = np.where(forward, order[at], order[n - 1 - at])
            limit = int((lists.rows[stands, dims[columns]] * values).sum())
            found = scores[allowed]
            open_ = [w for w in open_ if not _settled(w, found, limit)]
    best = []
    found = scores[allowed]
    for w in windows:
        inside = np.ones(len(allowed), bool)
        if w.low is not None:
            inside &= found >= w.low
        if w.high is not None:
            inside &= found <= w.high
        few = allowed[inside]
        if len(few) > 4 * w.k:
            edge = -np.partition(-scores[few], w.k - 1)[w.k - 1]
            few = few[scores[few] >= edge]
        best.append(few[np.lexsort((lists.ids[few], -scores[few]))[: w.k]])
    return best, scores, int(met.sum())


def _settled(w: Range, found: np.ndarray, limit: int) -> bool:
    """Whether no row that scores ``limit`` or less can still enter the window's best."""
    if w.low is not None and limit < w.low:
        return True
    inside = found if w.high is None else found[found <= w.high]
    if len(inside) < w.k:
        return False
    kth = -np.partition(-inside, w.k - 1)[w.k - 1]
    return limit < kth


# ---- tasks


def _shards(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[Lists]:
    parts, held = [], 0

    def whole():
        return Lists(*(np.concatenate(x) for x in zip(*parts, strict=True)))

    for rows in batches:
        if not rows.num_rows:
            continue
        matrix = rows.column("vector").flatten().to_numpy().reshape(rows.num_rows, -1)
        columns = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(), matrix
        first = 0
        while first < rows.num_rows:
            end = min(rows.num_rows, first + limit - held)
            parts.append(tuple(c[first:end] for c in columns))
            held, first = held + end - first, end
            if held == limit:
                yield whole()
                parts, held = [], 0
    if held:
        yield whole()


def _batch(names: list[str], parts: list[tuple]) -> pa.RecordBatch:
    columns = zip(*parts, strict=True) if parts else [[np.zeros(0, np.int64)]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names)


def positives(anchors, k: int, limit: int):
    """Mapper from rows to ``(anchor_id, vec_id, score)``: the best of the anchor's label in each shard."""

    def run(batches):
        ids, labels, vectors = anchors.value
        for lists in _shards(batches, limit):
            by_label, out = lists.of_label(), []
            for anchor, label, vector in zip(ids.tolist(), labels.tolist(), vectors, strict=True):
                own = by_label.get(label)
                if own is not None:
                    (best,), scores, _ = best_in_windows(
                        own, vector, [Range(None, None, k)], anchor, NO_LABEL
                    )
                    out.append((np.full(len(best), anchor), own.ids[best], scores[best]))
            yield _batch(["anchor_id", "vec_id", "score"], out)

    return run


def negatives(anchors, k: int, low: int, high: int, limit: int):
    """Mapper from rows to the best of other labels in the windows of each shard.

    ``anchors`` also gives, for each anchor, the ids and scores of its positives.
    """

    def run(batches):
        ids, labels, vectors, found = anchors.value
        for lists in _shards(batches, limit):
            out = []
            for anchor, label, vector in zip(ids.tolist(), labels.tolist(), vectors, strict=True):
                asked = found.get(anchor, ())
                windows = [Range(-(-low * s // 100), high * s // 100, k) for _, s in asked]
                best, scores, _ = best_in_windows(lists, vector, windows, None, label)
                for (positive, score), rows in zip(asked, best, strict=True):
                    n = len(rows)
                    out.append((
                        np.full(n, anchor), np.full(n, positive), lists.ids[rows],
                        np.full(n, score), scores[rows],
                    ))
            names = ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]
            yield _batch(names, out)

    return run


def usable(vector: Column) -> Column:
    """No null and no component that is null or not finite."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )


def integer_rows(table: DataFrame, label: Column, is_anchor: Column, scale: int = 256) -> DataFrame:
    """``vec_id, label, vector, is_anchor`` of the rows that take part, one per vec_id."""
    value = F.col("embedding")
    rows = table.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"),
        F.transform(value, lambda x: x.cast("double")).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    whole = F.transform("vector", lambda x: F.floor(x * scale))
    row = F.struct("label", whole.alias("vector"), "is_anchor")
    return rows.groupBy("vec_id").agg(F.min(row).alias("r")).select("vec_id", "r.*")


def mine_negatives(
    table: DataFrame, is_anchor: Column, label: Column | None = None, n_positives: int = 5,
    n_negatives: int = 10, low: int = 30, high: int = 90,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    For each anchor of ``table(vec_id, embedding, label)`` its ``n_positives`` best rows of the same label
    and for each of these the ``n_negatives`` best rows of other labels whose score is between ``low`` and
    ``high`` percent of the positive's. Scores are inner products of the components times 256, floored;
    ties go to the smaller vec_id. An anchor is no positive of its own. ``label`` and ``is_anchor`` are
    expressions over the table.

    Rows with a null id, label, vector or component, or a component that is not finite, take no part, nor
    do rows with another length than most. Of rows with the same vec_id the one with the least label, then
    vector counts. An anchor without positives, or a window without rows, gives no rows; an empty table
    gives an empty one. Components so large that a score could leave 56 bits raise an error.
    """
    spark = table.sparkSession
    scratch = Scratch(spark)
    label = F.col("label") if label is None else label
    rows = integer_rows(table, label, is_anchor)
    size = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = spark.createDataFrame(
        [], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
        "negative_score bigint",
    )
    if size is None:
        return empty
    n_shards = -(-size["count"] // SHARD_ROWS)
    rows = scratch.keep(rows.filter(F.size("vector") == size["n"]).repartition(n_shards, "vec_id"))
    largest = F.max(F.array_max(F.transform("vector", F.abs)))
    n_anchors, largest = rows.agg(F.count_if(F.col("is_anchor")), largest).first()
    if size["n"] * (largest or 0) ** 2 >= 1 << 56:
        raise ValueError("components are too large for scores in 64 bits")
    if not n_anchors:
        return empty

    turns = -(-n_anchors // ANCHORS)
    turn = F.pmod(F.xxhash64("vec_id"), F.lit(turns))
    mined = None
    for number in range(turns):
        found = _mine(rows, turn == number, size["n"], n_positives, n_negatives, low, high, scratch)
        mined = found if mined is None else mined.unionByName(found)
    return mined


def _mine(
    rows: DataFrame, chosen: Column, dims: int, n_positives: int, n_negatives: int, low: int, high: int,
    scratch: Scratch,
) -> DataFrame:
    """:func:`mine_negatives` for the anchors that are ``chosen``."""
    context = rows.sparkSession.sparkContext
    block = rows.filter(F.col("is_anchor") & chosen).select("vec_id", "label", "vector").toPandas()
    if block.empty:
        vectors = np.zeros((0, dims), np.int64)
    else:
        vectors = np.stack(block["vector"].to_list()).astype(np.int64)
    anchors = block["vec_id"].to_numpy(np.int64), block["label"].to_numpy(np.int64), vectors
    rows = rows.select("vec_id", "label", "vector")

    by_score = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    first = scratch.keep(
        rows.mapInArrow(
            positives(context.broadcast(anchors), n_positives, SHARD_ROWS),
            "anchor_id bigint, vec_id bigint, score bigint",
        )
        .withColumn("r", F.row_number().over(by_score)).filter(F.col("r") <= n_positives).drop("r")
    )
    found: dict[int, list[tuple[int, int]]] = {}
    for r in first.toLocalIterator():  # n_positives for each anchor of the block
        found.setdefault(r["anchor_id"], []).append((r["vec_id"], r["score"]))

    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (
        rows.mapInArrow(
            negatives(context.broadcast((*anchors, found)), n_negatives, low, high, SHARD_ROWS),
            "anchor_id bigint, positive_id bigint, negative_id bigint, positive_score bigint, "
            "negative_score bigint",
        )
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n_negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
