"""Scoring of a table of queries against an index.

Every scorer returns ``(qid, doc_id, score)`` for all candidates, i.e. documents sharing a term
with the query. A repeated query term counts once per repetition (factor ``qtf``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.stemming import stem_vocabulary
from ..functions.text import idf, term_bucket, term_counts
from .index import Index
from ..sources.workspace import Workspace
from . import joins
from .joins import BROADCAST_ROWS, count_keys, lookup_join, spread_join

#: Terms that a scan is told by name; with more, only the join selects.
NAMED_TERMS = 64


@dataclass(frozen=True)
class QueryBatch:
    """Queries and their terms, analyzed like the index they are meant for."""

    queries: DataFrame  # qid, query
    terms: DataFrame  # qid, term_bucket, term, qtf
    limit: int = BROADCAST_ROWS

    @cached_property
    def size(self) -> tuple[int, int]:
        """Term rows and queries with terms; counted, not assumed."""
        row = self.terms.agg(F.count("*").alias("rows"), F.count_distinct("qid").alias("n")).first()
        return row["rows"], row["n"]

    @cached_property
    def rows(self) -> DataFrame:
        """The terms; those of a batch that can't be broadcast are computed once and written."""
        return self.terms if self.bounded else Workspace(self.terms.sparkSession).save("terms", self.terms)

    @cached_property
    def named(self) -> list[tuple[int, str]] | None:
        """Directory and name of the different terms, or None if there are many."""
        rows = self.terms.select("term_bucket", "term").distinct().limit(NAMED_TERMS + 1).collect()
        return None if len(rows) > NAMED_TERMS else sorted(map(tuple, rows))

    def reaches(self, postings: DataFrame) -> DataFrame:
        """Only directories and row groups of ``postings`` that can hold a term of a small batch."""
        if self.named is None:
            return postings
        buckets, terms = sorted({b for b, _ in self.named}), sorted({t for _, t in self.named})
        return postings.filter(F.col("term_bucket").isin(buckets) & F.col("term").isin(terms))

    @property
    def bounded(self) -> bool:
        """Whether the terms are few enough to broadcast."""
        return self.size[0] <= self.limit

    def results_within(self, per_query: int, limit: int) -> bool:
        """Whether ``per_query`` results for every query are at most ``limit`` rows."""
        return self.size[1] * per_query <= limit


def query_batch(queries: DataFrame, index: Index, limit: int = BROADCAST_ROWS) -> QueryBatch:
    """Analyze ``queries(qid, query)``. Blank and stop-word-only queries simply have no terms."""
    terms = term_counts(queries.select("qid", F.trim("query").alias("text")), ["qid"])
    if index.analyzer == "stemmed":
        stems = stem_vocabulary(terms.select("term").distinct())
        terms = (
            terms.join(stems, "term")
            .groupBy("qid", F.col("stem").alias("term"))
            .agg(F.sum("tf").alias("tf"))
        )
    terms = terms.select(
        "qid",
        term_bucket("term", index.term_buckets).alias("term_bucket"),
        "term",
        F.col("tf").cast("bigint").alias("qtf"),
    )
    return QueryBatch(queries, terms, limit)


def weigh(index: Index, batch: QueryBatch, field: str, n: Column | None = None) -> DataFrame:
    """Query terms that occur in the field, with ``df`` and ``idf``.

    ``n`` is the N of the IDF; the default is the number of documents.
    """
    n = index.corpus(field, "n_docs") if n is None else n
    terms = index.field_terms(field).select("term_bucket", "term", "df")
    keys = ["term_bucket", "term"]
    if batch.bounded:
        found = terms.join(F.broadcast(batch.terms), keys)
    else:
        found = lookup_join(batch.rows, terms, keys, bounded=False, how="inner")
    return found.select(
        "qid", "term_bucket", "term", "qtf", "df", idf(n, "df").alias("idf")
    )


def match(
    index: Index,
    batch: QueryBatch,
    field: str,
    terms: DataFrame,
    doc_table: DataFrame | None = None,
) -> DataFrame:
    """Postings of the query terms. ``terms`` holds at most the rows of ``batch.terms``.

    ``doc_table``, one row per document, is attached on the way; postings of documents it does
    not have are dropped. A batch within its limit is broadcast and the postings are read where
    they lie, those of a few terms from their directories only. Of a larger one the query rows of
    terms with very many postings are broadcast, if need be in blocks; the other postings, few of
    each term, are shuffled.
    """
    postings = index.field_postings(field)
    keys = ["term_bucket", "term"]
    if batch.bounded:
        matches = batch.reaches(postings).join(F.broadcast(terms), keys)
        return matches if doc_table is None else matches.join(doc_table, "doc_id")
    if doc_table is not None:
        postings = postings.join(doc_table, "doc_id")
    workspace = Workspace(terms.sparkSession)
    terms = workspace.save("weighed", terms)
    total = index.corpus_stats.filter(F.col("field") == field).select("n_postings").first()
    least = max(joins.ROWS_PER_TASK, (total["n_postings"] if total else 0) / BROADCAST_ROWS)
    wide = index.field_terms(field).filter(F.col("df") > least).select(*keys)  # fewer than BROADCAST_ROWS
    wide = workspace.save("wide", wide.join(terms.select(*keys), keys, "left_semi"))
    asked = workspace.save("asked", terms.join(F.broadcast(wide), keys))
    blocks = -(-asked.count() // BROADCAST_ROWS)
    if not blocks:
        return postings.join(terms, keys)
    narrow = terms.join(F.broadcast(wide), keys, "left_anti")
    matches = postings.join(F.broadcast(wide), keys, "left_anti").join(narrow, keys)
    block = F.pmod(F.xxhash64("qid", "term"), F.lit(blocks))
    for number in range(blocks):
        matches = matches.unionByName(postings.join(F.broadcast(asked.filter(block == number)), keys))
    return matches


def accumulate(matches: DataFrame, contribution: Column) -> DataFrame:
    return matches.groupBy("qid", "doc_id").agg(F.sum(contribution).alias("score"))


def tfidf(index: Index, batch: QueryBatch, field: str, n: Column | None = None) -> DataFrame:
    matches = match(index, batch, field, weigh(index, batch, field, n))
    return accumulate(matches, F.col("qtf") * F.col("tf") * F.col("idf"))


def bm25_contribution(avg_len: Column, k1: Column | float, b: Column | float) -> Column:
    k1, b = (x if isinstance(x, Column) else F.lit(float(x)) for x in (k1, b))
    tf = F.col("tf")
    length = F.lit(1.0) - b + b * F.col("doc_len") / avg_len
    return F.col("qtf") * F.col("idf") * (tf * (k1 + 1.0)) / (tf + k1 * length)


def bm25(
    index: Index,
    batch: QueryBatch,
    field: str,
    k1: float = 1.2,
    b: float = 0.75,
    n: Column | None = None,
) -> DataFrame:
    """BM25; a posting whose document has no length is dropped."""
    terms = weigh(index, batch, field, n)
    matches = match(index, batch, field, terms, index.field_docs(field))
    return accumulate(matches, bm25_contribution(index.corpus(field, "avg_len"), k1, b))


def query_vector(index: Index, batch: QueryBatch, field: str) -> DataFrame:
    """``(qid, term, qtf, weight, norm)``; N is the vocabulary size.

    Terms the index does not know have weight 0 and are left out; they change no norm.
    """
    weighed = weigh(index, batch, field, index.corpus(field, "n_terms"))
    weight = F.col("qtf") * F.col("idf")
    return weighed.withColumn("weight", weight).withColumn(
        "norm", F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(W.partitionBy("qid")))
    )


def cosine(index: Index, batch: QueryBatch, field: str, mode: str = "full") -> DataFrame:
    """Cosine similarity.

    ``full`` compares the query with the whole document vector. ``per_term`` adds up, for every
    query token, the cosine with a document holding that term only; tf cancels out of it.
    """
    vector = query_vector(index, batch, field)
    weight, norm, zero = F.col("weight"), F.col("norm"), F.lit(0.0)
    if mode == "per_term":
        return accumulate(
            match(index, batch, field, vector),
            F.when(norm == 0, zero).otherwise(F.col("qtf") * F.abs(weight) / norm),
        )
    if mode != "full":
        raise ValueError(f"unknown cosine mode {mode!r}")
    matches = match(index, batch, field, vector, index.field_norms(field))
    product = norm * F.col("doc_norm")
    return accumulate(
        matches,
        F.when(product == 0, zero).otherwise(
            weight * F.col("tf") * F.col("idf") / product
        ),
    )


def cosine_of_vectors(left: DataFrame, right: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """Cosine of every pair of sparse vectors ``(id, term, weight)`` that share a term.

    Norms are over whole vectors. A pair with a zero norm has cosine 0.
    """
    def norms(vectors: DataFrame, key: str, name: str) -> DataFrame:
        square = F.col("weight") * F.col("weight")
        return vectors.groupBy(key).agg(F.sqrt(F.sum(square)).alias(name))

    # a vector's norm goes with its components, so no later join meets all pairs of one vector
    left = Workspace(left.sparkSession).save(
        "left", left.join(norms(left, left_id, "_ln"), left_id).withColumnRenamed("weight", "_l")
    )
    weighed = right.withColumnRenamed("weight", "_r")
    if left.count() <= BROADCAST_ROWS:
        pairs = weighed.join(F.broadcast(left), "term")
    else:
        pairs = spread_join(
            left,
            weighed,
            ["term"],
            left_by=[left_id],
            left_counts=count_keys(left, ["term"]),
            right_by=[right_id],
            right_counts=count_keys(right, ["term"]),
        )
    dots = pairs.groupBy(right_id, left_id).agg(
        F.sum(F.col("_l") * F.col("_r")).alias("_dot"), F.first("_ln").alias("_ln")
    )
    product = F.col("_ln") * F.col("_rn")
    return (
        dots.join(norms(right, right_id, "_rn"), right_id)
        .select(
            left_id,
            right_id,
            F.when(product == 0, F.lit(0.0)).otherwise(F.col("_dot") / product).alias("cosine"),
        )
    )


def word_count(index: Index, batch: QueryBatch, field: str) -> DataFrame:
    """Query tokens found in the document, repetitions in the query included."""
    return accumulate(match(index, batch, field, batch.rows), F.col("qtf"))


def distinct_match(index: Index, batch: QueryBatch, field: str) -> DataFrame:
    """Distinct query words found in the document."""
    matches = match(index, batch, field, batch.rows)
    return accumulate(matches, F.lit(1).cast("bigint"))


def tf_count(index: Index, batch: QueryBatch, field: str) -> DataFrame:
    """Occurrences of query tokens in the document."""
    return accumulate(match(index, batch, field, batch.rows), F.col("qtf") * F.col("tf"))
