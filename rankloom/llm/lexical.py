"""Ranked lexical search with per-term geometric blocks.

Documents become vectors over the terms that the queries ask for; a component is the integer share that
the term adds to a score. A task gathers a bounded number of postings into a shard and orders its documents
by the cells of random planes, so that similar ones are neighbours. A term's posting list in that order is
cut into blocks of near documents, and each block stores the coordinatewise maximum of its documents. The
sum of a query's maxima bounds the score of every document in the block: the block is read only if the
bound reaches the query's tenth best score so far, and a list only if it and the lists after it could.

Bounds are exact integers. Lists are taken in the same order for all queries, those of the largest possible
share first, and a document is scored at the first of its lists that is read; so the bound of a list
counts the shares of this list and of those after it only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, column_or_null, lower_ascii, roller, text_slices

#: Documents in a block.
BLOCK = 32
#: Postings that a shard holds, some 40 bytes each.
SHARD_POSTINGS = 2_000_000
#: Bytes of query texts that are broadcast at a time; more queries are taken in turn.
QUERY_BYTES = 16 << 20
#: Planes that order a shard's documents.
PLANES = 12

_TERM = np.ones(256, bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _TERM[_low : _high + 1] = False


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased terms of some texts, and for each text its first term.

    A term is a maximal run of ASCII letters, digits and other than ASCII characters.
    """
    low = lower_ascii(data)
    inside = np.zeros(len(low) + 1, bool)
    inside[:-1] = _TERM[low]
    starting = inside[:-1].copy()
    starting[1:] &= ~inside[:-2]
    firsts = offsets[:-1][offsets[:-1] < len(low)]
    starting[firsts] |= inside[firsts]
    starts = np.flatnonzero(starting)
    ending = inside[:-1] & ~inside[1:]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    ending[lasts] |= inside[lasts]
    roll = roller(3)
    hashes = roll.hashes(roll.sums(low), starts, np.flatnonzero(ending) + 1)
    return hashes, np.searchsorted(starts, offsets)


def hashed(texts: list[str]) -> list[np.ndarray]:
    """Hashes of the different terms of each text."""
    out = []
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        out.append(np.unique(term_hashes(data, np.array([0, len(data)]))[0]))
    return out


@dataclass(frozen=True)
class Batch:
    """Some queries; terms are numbered in the order of their hashes."""

    terms: np.ndarray
    queries: list[np.ndarray]  # numbers of the terms of each query


def batch_of(texts: list[str]) -> Batch:
    own = hashed(texts)
    terms = np.unique(np.concatenate(own)) if own else np.zeros(0, np.uint64)
    return Batch(terms, [np.searchsorted(terms, x) for x in own])


def vectors(batch):
    """Mapper from texts to ``(doc_id, n, terms, tfs)``: all terms counted, those of the batch listed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = batch.value.terms
        for rows, data, offsets in text_slices(batches):
            hashes, first = term_hashes(data, offsets)
            doc = np.repeat(np.arange(rows.num_rows), np.diff(first))
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                asked = known[at] == hashes
                key, tf = np.unique(doc[asked] * len(known) + at[asked], return_counts=True)
                doc, at = key // len(known), key % len(known)
            else:
                doc = at = tf = np.zeros(0, np.int64)
            cuts = pa.array(np.searchsorted(doc, np.arange(rows.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"), pa.array(np.diff(first)),
                    pa.ListArray.from_arrays(cuts, pa.array(at, pa.int32())),
                    pa.ListArray.from_arrays(cuts, pa.array(tf, pa.int64())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    return run


@dataclass(frozen=True)
class Weights:
    """Corpus figures that a share depends on."""

    n_docs: int
    n_terms: int
    weight: np.ndarray  # of each term of the batch


def weights(n_docs: int, n_terms: int, df: np.ndarray) -> Weights:
    weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1)))
    return Weights(n_docs, n_terms, weight.astype(np.int64))


def shares(w: Weights, n: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
    """What postings add to a score, in 64-bit integers; the constants are fixed values."""
    m = 100 - 90 + (90 * n * w.n_docs) // max(w.n_terms, 1)
    return w.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Shard:
    """Vectors of some documents and the posting lists over them."""

    def __init__(self, w: Weights, n: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray):
        doc = np.repeat(np.arange(len(n)), sizes)
        share = shares(w, n[doc], term, tf)
        place = np.empty(len(n), np.int64)
        place[self._order(len(n), doc, term, share, len(w.weight))] = np.arange(len(n))
        doc = place[doc]
        self.place = place
        order = np.lexsort((term, doc))
        self.doc, self.term, self.share = doc[order], term[order], share[order]
        self.rows = np.searchsorted(self.doc, np.arange(len(n) + 1))
        by_term = np.lexsort((self.doc, self.term))
        self.listed, self.listed_share = self.doc[by_term], self.share[by_term]
        self.lists = np.searchsorted(self.term[by_term], np.arange(len(w.weight) + 1))
        self.highest = np.zeros(len(w.weight), np.int64)
        held = np.flatnonzero(np.diff(self.lists))
        if len(held):
            self.highest[held] = np.maximum.reduceat(self.listed_share, self.lists[held])

    @staticmethod
    def _order(n: int, doc: np.ndarray, term: np.ndarray, share: np.ndarray, n_terms: int) -> np.ndarray:
        """Documents in the order of the cells of random planes, each split at its median."""
        planes = np.random.default_rng(0).standard_normal((PLANES, n_terms))
        norm = np.sqrt(np.bincount(doc, share.astype(float) ** 2, n))
        cell = np.zeros(n, np.int64)
        for plane in planes:
            side = np.bincount(doc, share * plane[term], n) / np.maximum(norm, 1)
            order = np.lexsort((side, cell))
            starts = np.searchsorted(cell[order], np.unique(cell))
            size = np.diff(np.r_[starts, n])
            rank = np.arange(n) - np.repeat(starts, size)
            upper = np.empty(n, np.int64)
            upper[order] = rank >= np.repeat((size + 1) // 2, size)
            cell = 2 * cell + upper
        return np.argsort(cell, kind="stable")

    def gather(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the postings of ``docs`` and, for each, the number of its document in ``docs``."""
        first, n = self.rows[docs], self.rows[docs + 1] - self.rows[docs]
        at = np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)
        return at, np.repeat(np.arange(len(docs)), n)

    def summaries(self, term: int, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(docs, maxima)`` of the blocks of a list: the largest share of each of ``columns`` in a block.

        ``columns`` ascend; the others can't be asked for by a query of the term.
        """
        docs = self.listed[self.lists[term] : self.lists[term + 1]]
        maxima = np.zeros((-(-len(docs) // BLOCK), len(columns)), np.int64)
        at, of = self.gather(docs)
        column = np.minimum(np.searchsorted(columns, self.term[at]), len(columns) - 1)
        known = columns[column] == self.term[at]
        np.maximum.at(maxima, (of[known] // BLOCK, column[known]), self.share[at[known]])
        return docs, maxima


class Search:
    """The ``k`` best documents of a shard for each query of a batch."""

    def __init__(self, shard: Shard, batch: Batch, ids: np.ndarray, k: int):
        self.shard, self.batch, self.k = shard, batch, k
        self.ids = np.empty_like(ids)  # by place in the shard; a missing id is the largest number
        self.ids[shard.place] = ids
        n = len(batch.queries)
        self.docs = [np.zeros(0, np.int64)] * n
        self.scores = [np.zeros(0, np.int64)] * n
        self.seen: list[np.ndarray | None] = [None] * n
        self.blocks = self.read = 0

    def least(self, query: int) -> int:
        """What a score has to reach: the query's k-th best so far, 1 before there are k."""
        scores = self.scores[query]
        return int(scores[-1]) if len(scores) == self.k else 1

    def run(self) -> None:
        shard, queries = self.shard, self.batch.queries
        asking: dict[int, list[int]] = {}
        left = np.zeros(len(queries), np.int64)  # what the lists not yet taken can add
        for q, terms in enumerate(queries):
            left[q] = shard.highest[terms].sum()
            for t in terms[shard.highest[terms] > 0].tolist():
                asking.setdefault(t, []).append(q)
        done = np.zeros(len(shard.highest), bool)
        for term in sorted(asking, key=lambda t: (-shard.highest[t], t)):
            open_ = [q for q in asking[term] if left[q] >= self.least(q)]
            if open_:
                own = {q: queries[q][~done[queries[q]]] for q in open_}
                columns = np.unique(np.concatenate(list(own.values())))
                docs, maxima = shard.summaries(term, columns)
                for q in open_:
                    self._visit(q, docs, maxima[:, np.searchsorted(columns, own[q])].sum(axis=1))
            done[term] = True
            left[asking[term]] -= shard.highest[term]

    def _visit(self, query: int, docs: np.ndarray, bound: np.ndarray) -> None:
        """Score the documents of the blocks whose bound reaches the query's threshold."""
        if self.seen[query] is None:
            self.seen[query] = np.zeros(len(self.shard.rows) - 1, bool)
        seen, self.blocks = self.seen[query], self.blocks + len(bound)
        order = np.argsort(-bound, kind="stable")
        step = 8
        for first in range(0, len(order), step):
            blocks = order[first : first + step]
            blocks = blocks[bound[blocks] >= self.least(query)]
            if not len(blocks):
                break
            self.read += len(blocks)
            at = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            fresh = docs[at[at < len(docs)]]
            fresh = fresh[~seen[fresh]]
            seen[fresh] = True
            if len(fresh):
                self._score(query, fresh)

    def _score(self, query: int, docs: np.ndarray) -> None:
        at, of = self.shard.gather(docs)
        terms = self.batch.queries[query]
        place = np.minimum(np.searchsorted(terms, self.shard.term[at]), len(terms) - 1)
        own = terms[place] == self.shard.term[at]
        scores = np.zeros(len(docs), np.int64)
        np.add.at(scores, of[own], self.shard.share[at[own]])
        docs = np.concatenate([self.docs[query], docs[scores > 0]])
        scores = np.concatenate([self.scores[query], scores[scores > 0]])
        best = np.lexsort((self.ids[docs], -scores))[: self.k]
        self.docs[query], self.scores[query] = docs[best], scores[best]


MISSING = np.iinfo(np.int64).max


def best_of_shards(batch, w, k: int, limit: int):
    """Mapper from vectors to ``(query, doc_id, score)``, ``k`` of each query at most for each shard."""

    def search(ids, n, sizes, term, tf):
        shard = Shard(w.value, *map(np.concatenate, (n, sizes, term, tf)))
        found = Search(shard, batch.value, np.concatenate(ids), k)
        found.run()
        docs = np.concatenate(found.docs)
        doc_ids = found.ids[docs]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(found.docs)), [len(x) for x in found.docs]), pa.int32()),
                pa.array(doc_ids, mask=doc_ids == MISSING),
                pa.array(np.concatenate(found.scores)),
            ],
            ["query", "doc_id", "score"],
        )

    def run(batches):
        parts, held = [], 0
        for rows in batches:
            sizes = rows.column("terms").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            term = rows.column("terms").flatten().to_numpy().astype(np.int64)
            tf = rows.column("tfs").flatten().to_numpy()
            ids = rows.column("doc_id").fill_null(MISSING).to_numpy()
            n, upto, first = rows.column("n").to_numpy(), np.cumsum(sizes), 0
            while first < len(n):
                before = int(upto[first - 1]) if first else 0
                end = max(first + 1, int(np.searchsorted(upto, before + limit - held, "right")))
                cut = slice(before, int(upto[end - 1]))
                parts.append((ids[first:end], n[first:end], sizes[first:end], term[cut], tf[cut]))
                held += cut.stop - cut.start
                first = end
                if held >= limit:
                    yield search(*zip(*parts, strict=True))
                    parts, held = [], 0
        if held:
            yield search(*zip(*parts, strict=True))

    return run


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``items(item_id, text)`` the ``k`` documents of
    ``docs(doc_id, text)`` with the highest scores above 0, equal scores by ascending doc_id.

    Null and empty texts have no terms; an item without terms, or of terms that no document has, gets no
    rows. Every row is a document or an item of its own, repeated ones too; a null doc_id comes after
    others of the same score. Texts are read whole. Empty tables give an empty one. Terms are told apart by
    64-bit hashes. Columns other than the two of each table aren't read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    items = scratch.keep(
        items.select(
            column_or_null(items, "item_id", "bigint").alias("item_id"),
            F.coalesce(column_or_null(items, "text", "string"), F.lit("")).alias("text"),
        )
    )
    docs = docs.select(
        column_or_null(docs, "doc_id", "bigint").alias("doc_id"),
        column_or_null(docs, "text", "string").alias("text"),
    )
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    turns = -(-max(size, 1) // QUERY_BYTES)
    turn = F.pmod(F.xxhash64("item_id", "text"), F.lit(turns))
    found = None
    for number in range(turns):
        rows = items.filter(turn == number).toPandas()
        best = scratch.keep(_search(docs, rows["text"].to_list(), k, scratch))
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        asked = spark.createDataFrame(
            [(q, None if x != x or x is None else int(x)) for q, x in enumerate(rows["item_id"])],
            "query int, item_id bigint",
        )
        best = best.join(F.broadcast(asked), "query").select("item_id", "rank", "doc_id", "score")
        found = best if found is None else found.unionByName(best)
    return found


def _search(docs: DataFrame, texts: list[str], k: int, scratch: Scratch) -> DataFrame:
    context = docs.sparkSession.sparkContext
    batch = batch_of(texts)
    shared = context.broadcast(batch)
    kept = scratch.keep(
        docs.mapInArrow(vectors(shared), "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>")
    )
    n_docs, n_terms = kept.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(batch.terms), np.int64)
    for term, held in kept.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[term] = held
    w = context.broadcast(weights(n_docs, n_terms, df))
    held = kept.filter(F.size("terms") > 0)
    return held.mapInArrow(
        best_of_shards(shared, w, k, SHARD_POSTINGS), "query int, doc_id bigint, score bigint"
    )
