"""Inverted index as tables: postings, term, document and corpus statistics."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stemming import stem_vocabulary
from ..functions.text import STOP_WORDS, idf, raw_tokens, term_bucket, term_counts
from ..sources.workspace import Workspace, text_buckets
from .joins import join_vocabulary

POSTING_BLOCK = 65_536
LEAST_TERM_BUCKETS = 4
#: Tokens that Python counts together, and rows that it hands over at a time; a longer document is counted alone.
COUNTED_TOKENS = 1 << 18
HANDED_ROWS = 65_536
TERM_STATS = "term string, df bigint, term_total bigint, field string, term_bucket int"


@dataclass(frozen=True)
class Index:
    """The tables of one index; all may hold several fields."""

    postings: DataFrame  # field, term_bucket, term, doc_id, tf
    term_stats: DataFrame  # field, term_bucket, term, df, term_total
    doc_stats: DataFrame  # field, doc_id, doc_len
    corpus_stats: DataFrame  # field, n_docs, n_terms, n_postings, sum_len, avg_len
    doc_norms: DataFrame | None = None  # field, doc_id, doc_norm
    analyzer: str = "plain"
    term_buckets: int = 4
    workspace: Workspace | None = None  # where norms that are missing are written
    buckets: int | None = None

    @cached_property
    def norms(self) -> DataFrame:
        """``doc_norms``, written now if the index was built without: only cosines read them."""
        if self.doc_norms is not None:
            return self.doc_norms
        if self.workspace is None:
            return norms_of(self)
        return write_norms(self, self.workspace, self.buckets)

    def field_postings(self, field: str) -> DataFrame:
        return self.postings.filter(F.col("field") == field).drop("field")

    def field_terms(self, field: str) -> DataFrame:
        return self.term_stats.filter(F.col("field") == field).drop("field")

    def field_docs(self, field: str) -> DataFrame:
        return self.doc_stats.filter(F.col("field") == field).drop("field")

    def field_norms(self, field: str) -> DataFrame:
        return self.norms.filter(F.col("field") == field).drop("field")

    def corpus(self, field: str, column: str):
        """One corpus number as a scalar subquery; no row of it reaches the driver."""
        return self.corpus_stats.filter(F.col("field") == field).select(column).scalar()


def _counted(batches: Iterator) -> Iterator:
    """Arrow function from ``(doc_id, tokens)`` to ``(doc_id, term, tf)``, a batch's rows by term and document.

    As :func:`term_counts`, but documents are counted together: the words of a slice of a batch are numbered in
    their order, and its tokens are sorted as numbers.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def slices(batch):
        ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("tokens")), 0).to_numpy(), dtype=np.int64)
        first, before = 0, 0
        while first < batch.num_rows:
            end = max(first + 1, int(np.searchsorted(ends, before + COUNTED_TOKENS, "right")))
            yield batch.slice(first, end - first)
            first, before = end, ends[end - 1]

    for batch in (some for whole in batches for some in slices(whole)):
        rows = batch.num_rows
        lists = batch.column("tokens")
        tokens = lists.flatten().dictionary_encode()
        if not len(tokens):
            continue
        words = tokens.dictionary
        order = pc.sort_indices(words).to_numpy()
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        words = words.take(pa.array(order))
        stop = pc.is_in(words, value_set=pa.array(STOP_WORDS, words.type)).to_numpy(zero_copy_only=False)
        by_id = pc.sort_indices(batch.column("doc_id")).to_numpy()
        at = np.empty(rows, np.int64)
        at[by_id] = np.arange(rows)
        ids = batch.column("doc_id").take(pa.array(by_id))
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
        keys = place[tokens.indices.to_numpy()] * rows + np.repeat(at, sizes)
        keys.sort()
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        tf = np.diff(np.append(starts, len(keys))).astype(np.int32)
        word, row = np.divmod(keys[starts], rows)
        kept = np.flatnonzero(~stop[word])
        for first in range(0, len(kept), HANDED_ROWS):
            some = kept[first : first + HANDED_ROWS]
            found = [ids.take(pa.array(row[some])), words.take(pa.array(word[some])), pa.array(tf[some])]
            yield pa.RecordBatch.from_arrays(found, ["doc_id", "term", "tf"])


def count_terms(
    fields: dict[str, DataFrame], merge: tuple[str, ...] = (), buckets: int | None = None
) -> DataFrame:
    """``(field, doc_id, term, tf)`` from one ``(doc_id, text)`` table per field.

    A row is a document: adding an id twice counts it twice. Fields named in ``merge`` instead
    gather all rows of an id into one document (anchor texts of a page); equal terms are added
    up before they are shuffled, so a page with very many anchors is no hot group.
    """
    parts = []
    for name, docs in fields.items():
        rows = docs.select("doc_id", "text")
        if buckets and name not in merge:
            # counted together, so that a bucket's rows come in long runs by term to where they are sorted
            id_type = rows.schema["doc_id"].dataType.simpleString()
            tokens = rows.repartition(buckets, "doc_id").select("doc_id", raw_tokens("text").alias("tokens"))
            counts = tokens.mapInArrow(_counted, f"doc_id {id_type}, term string, tf int")
        else:
            counts = term_counts(rows, ["doc_id"])
        if name in merge:
            counts = counts.groupBy("doc_id", "term").agg(F.sum("tf").alias("tf"))
            if buckets:
                counts = counts.repartition(buckets, "doc_id")
        parts.append(
            counts.select(F.lit(name).alias("field"), "doc_id", "term", F.col("tf").cast("int"))
        )
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def stem_counts(counts: DataFrame, workspace: Workspace, buckets: int) -> DataFrame:
    """Replace terms by their stems, stemming every distinct term once.

    The result stays partitioned by document, which is enough to add up equal stems.
    """
    counts = workspace.save("plain_counts", counts)  # texts are analyzed once
    vocabulary = stem_vocabulary(
        counts.groupBy("field", "term").agg(F.count("*").alias("df")), workspace
    )
    size = vocabulary.agg(F.count("*").alias("terms"), F.sum("df").alias("postings")).first()
    stems = join_vocabulary(counts, vocabulary, size.terms, size.postings or 0)
    by_document = stems.repartition(buckets, "doc_id")
    return by_document.groupBy("field", "doc_id", F.col("stem").alias("term")).agg(
        F.sum("tf").cast("int").alias("tf")
    )


def term_statistics(postings: DataFrame) -> DataFrame:
    """Document and collection frequency per term; combined map-side, so no term is hot."""
    keys = [c for c in ("field", "term_bucket", "term") if c in postings.columns]
    return postings.groupBy(*keys).agg(
        F.count("*").alias("df"), F.sum("tf").cast("bigint").alias("term_total")
    )


def document_lengths(postings: DataFrame) -> DataFrame:
    keys = [c for c in ("field", "doc_id") if c in postings.columns]
    return postings.groupBy(*keys).agg(F.sum("tf").cast("bigint").alias("doc_len"))


def corpus_statistics(term_stats: DataFrame, corpus_sizes: DataFrame) -> DataFrame:
    """``corpus_sizes(field, n_docs)`` counts all documents, also those without any token."""
    totals = term_stats.groupBy("field").agg(
        F.count("*").alias("n_terms"),
        F.sum("df").cast("bigint").alias("n_postings"),
        F.sum("term_total").cast("bigint").alias("sum_len"),
    )
    zero = F.lit(0).cast("bigint")
    return corpus_sizes.join(totals, "field", "left").select(
        "field",
        "n_docs",
        *(F.coalesce(c, zero).alias(c) for c in ("n_terms", "n_postings", "sum_len")),
        (F.coalesce("sum_len", zero) / F.col("n_docs")).alias("avg_len"),
    )


def document_norms(
    postings: DataFrame, term_stats: DataFrame, n_terms: dict[str, int], n_postings: int
) -> DataFrame:
    """Length of every document's TF-IDF vector; N is the vocabulary size of the field."""
    n = F.lit(None).cast("bigint")
    for field, terms in n_terms.items():
        n = F.when(F.col("field") == field, F.lit(terms)).otherwise(n)
    vocabulary = term_stats.select("field", "term", "df", idf(n, "df").alias("idf"))
    weighted = join_vocabulary(postings, vocabulary, sum(n_terms.values()), n_postings)
    weight = F.col("tf") * F.col("idf")
    return weighted.groupBy("field", "doc_id").agg(
        F.sqrt(F.sum(weight * weight)).alias("doc_norm")
    )


def norms_of(index: Index) -> DataFrame:
    sizes = index.corpus_stats.select("field", "n_terms", "n_postings").collect()
    return document_norms(
        index.postings,
        index.term_stats,
        {r.field: r.n_terms for r in sizes},
        sum(r.n_postings for r in sizes),
    )


def write_norms(index: Index, workspace: Workspace, buckets: int) -> DataFrame:
    return workspace.save_bucketed("doc_norms", norms_of(index), buckets, partition_by=("field",))


def corpus_sizes(spark: SparkSession, n_docs: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(n_docs.items()), "field string, n_docs bigint")


def build_index(
    fields: dict[str, DataFrame],
    workspace: Workspace,
    n_docs: dict[str, int] | None = None,
    merge: tuple[str, ...] = (),
    analyzer: str = "plain",
    term_buckets: int | None = None,
    buckets: int | None = None,
    norms: bool = True,
) -> Index:
    """Analyze documents and write their index; parameters as in :func:`count_terms`.

    ``n_docs`` are the corpus sizes, by default the numbers of rows. By default there are as many
    directories of terms as a bucket of documents has splits of text, so that a file, which a query
    reads in part or not at all, stays below a split's bytes however large the corpus is.
    Without ``norms`` the first cosine writes them.
    """
    n_docs = n_docs or {name: docs.count() for name, docs in fields.items()}
    buckets = buckets or max(text_buckets(docs) for docs in fields.values())
    if term_buckets is None:
        splits = max(docs.rdd.getNumPartitions() for docs in fields.values())
        term_buckets = max(LEAST_TERM_BUCKETS, -(-splits // buckets))
    counts = count_terms(fields, merge, buckets)
    if analyzer == "stemmed":
        counts = stem_counts(counts, workspace, buckets)
    elif analyzer != "plain":
        raise ValueError(f"unknown analyzer {analyzer!r}")
    sizes = corpus_sizes(workspace.spark, n_docs)
    return write_index(counts, sizes, workspace, buckets, analyzer, term_buckets, norms)


def write_index(
    counts: DataFrame,
    sizes: DataFrame,
    workspace: Workspace,
    buckets: int,
    analyzer: str = "plain",
    term_buckets: int = 4,
    norms: bool = True,
) -> Index:
    """Write the tables of an index, given term counts that are partitioned by document.

    Postings are split into directories by term, so a query reads only those of its terms, and
    hash-bucketed by document inside, so that scoring groups by document without a shuffle and
    the postings of a frequent term are spread over all tasks.
    """
    spark = workspace.spark
    postings = workspace.save_bucketed(
        "postings",
        counts.withColumn("term_bucket", term_bucket("term", term_buckets)),
        buckets,
        partition_by=("field", "term_bucket"),
        sort_by=("term", "doc_id"),
        directories=sizes.count() * term_buckets,
    )
    term_statistics(postings).sortWithinPartitions("field", "term_bucket", "term").write.mode(
        "overwrite"
    ).partitionBy("field", "term_bucket").parquet(workspace.path("term_stats"))
    term_stats = spark.read.schema(TERM_STATS).parquet(workspace.path("term_stats"))
    doc_stats = workspace.save_bucketed(
        "doc_stats", document_lengths(postings), buckets, partition_by=("field",)
    )
    corpus = workspace.save("corpus_stats", corpus_statistics(term_stats, sizes).coalesce(1))
    index = Index(
        postings, term_stats, doc_stats, corpus,
        analyzer=analyzer, term_buckets=term_buckets, workspace=workspace, buckets=buckets,
    )
    if norms:
        index = replace(index, doc_norms=write_norms(index, workspace, buckets))
    spark.createDataFrame(
        [(analyzer, term_buckets, buckets, norms)],
        "analyzer string, term_buckets int, buckets int, norms boolean",
    ).coalesce(1).write.mode("overwrite").json(workspace.path("manifest"))
    return index


def open_index(spark: SparkSession, root: str) -> Index:
    """Open the tables :func:`build_index` wrote below ``root``, also in a later application."""
    manifest = spark.read.json(f"{root}/manifest").first()
    # the whole root, as folders of different roots may have the same name
    prefix = hashlib.sha256(root.rstrip("/").encode()).hexdigest()[:16]

    def bucketed(name: str, columns: str, partitions: str, sort: str) -> DataFrame:
        table = f"rankloom_{prefix}_{name}"
        if not spark.catalog.tableExists(table):
            spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({partitions}) "
                f"CLUSTERED BY (doc_id) SORTED BY ({sort}) INTO {manifest.buckets} BUCKETS "
                f"LOCATION '{root}/{name}'"
            )
            spark.sql(f"MSCK REPAIR TABLE {table}")
        return spark.table(table)

    return Index(
        bucketed(
            "postings",
            "doc_id bigint, term string, tf int, field string, term_bucket int",
            "field, term_bucket",
            "term, doc_id",
        ),
        spark.read.schema(TERM_STATS).parquet(f"{root}/term_stats"),
        bucketed("doc_stats", "doc_id bigint, doc_len bigint, field string", "field", "doc_id"),
        spark.read.parquet(f"{root}/corpus_stats"),
        bucketed("doc_norms", "doc_id bigint, doc_norm double, field string", "field", "doc_id")
        if manifest.asDict().get("norms", True)
        else None,
        manifest.analyzer,
        manifest.term_buckets,
    )


def posting_lists(postings: DataFrame) -> DataFrame:
    """List view for export: one row per term and block of document ids.

    Blocks keep every list bounded however frequent its term is; a term's lists in block order
    are its whole posting list.
    """
    keys = [c for c in ("field", "term") if c in postings.columns]
    block = F.floor(F.col("doc_id") / POSTING_BLOCK).cast("bigint").alias("block")
    return postings.groupBy(*keys, block).agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings")
    )


def read_postings(index: Index, field: str, term: str) -> DataFrame:
    """Postings of one term; empty when the term is unknown."""
    bucket = term_bucket(F.lit(term), index.term_buckets)
    return index.field_postings(field).filter(
        (F.col("term_bucket") == bucket) & (F.col("term") == term)
    )
