"""Postings in blocks of neighbouring documents, a skip table of their bounds, and exact pruned top-k.

A block is one row: the postings of a term in a range of ``width`` document ids. Blocks lie in directories
(parts) of about ``PART_BYTES``, sorted by term. A term has its blocks in one part, a term with more than a
part's bytes in as many parts as it needs, by document range. The skip table has a row per block without its
postings: where it lies, how many postings it has, the largest tf and the shortest document. Its columns lie
beside the postings in the same files. It is read first, without the column of postings, so that only the
parts and rows of blocks that matter are read from that one.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.workspace import ANY_BYTES, BATCH_BYTES, FILES_KEPT_OPEN, Workspace, settings
from .index import Index
from .joins import BROADCAST_ROWS
from .ranking import top_k
from .scoring import QueryBatch, accumulate, bm25_contribution, weigh

#: Bytes of a directory; a posting counts ``POSTING_BYTES``.
PART_BYTES = 64 << 20
POSTING_BYTES = 16
#: Bytes of a part that one task sorts and gathers.
TASK_BYTES = 16 << 20
#: Documents that a block spans on average.
BLOCK_DOCS = 16
#: Terms and parts named in a filter of the scan; with more, the join alone selects.
LITERALS = 1000
#: Scores that differ by less are equal after rounding, and sums differ in their last bits.
MARGIN = 1e-8

POSTINGS = "postings array<struct<doc_id:bigint,tf:int,doc_len:bigint>>"
SKIPS = "term string, block bigint, n bigint, copies bigint, max_tf int, min_len bigint, field string, part int"
BLOCKS = f"{POSTINGS}, {SKIPS}"
GATHERED = f"{POSTINGS}, term string, block bigint, copies bigint, max_tf int, min_len bigint, place int"
WIDE = "term string, spans bigint, field string"


@dataclass(frozen=True)
class BlockIndex:
    index: Index
    blocks: DataFrame  # field, part, term, block, postings
    skips: DataFrame  # field, home, term, block, part, n, copies, max_tf, min_len
    wide: DataFrame  # field, term, spans: the terms that lie in several parts, fewer than there are parts
    parts: int
    width: int

    def home(self, term: Column | str) -> Column:
        """The part that a term's blocks, or the first of them, lie in."""
        return F.pmod(F.xxhash64(term), F.lit(self.parts)).cast("int")


def part_of(term: Column | str, span: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(term) + span, F.lit(parts)).cast("int")


def _gathered(batches: Iterator) -> Iterator:
    """Arrow function from postings in the order of term, place and document to rows of their blocks."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def other(column):
        """Whether a row has another value than the one before."""
        return pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)

    def rows(batch, starts):
        doc, tf, length = (batch.column(c) for c in ("doc_id", "tf", "doc_len"))
        ends = np.append(starts[1:], batch.num_rows)
        postings = pa.StructArray.from_arrays([doc, tf, length], ["doc_id", "tf", "doc_len"])
        seen = np.ones(batch.num_rows, np.int64)
        seen[1:] = other(doc)
        seen[starts] = 1
        sizes = ends - starts
        first = pa.array(starts)
        found = {
            "postings": pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), postings),
            "term": batch.column("term").take(first),
            "block": batch.column("block").take(first),
            # an id that was added several times has as many postings here at most
            "copies": pa.array(sizes - np.add.reduceat(seen, starts) + 1),
            "max_tf": pa.array(np.maximum.reduceat(tf.to_numpy(), starts)),
            "min_len": pa.array(np.minimum.reduceat(length.to_numpy(), starts)),
            "place": batch.column("place").take(first),
        }
        return pa.RecordBatch.from_arrays(list(found.values()), list(found))

    held, last = [], None  # the postings of a block that may go on, and its keys
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c) for c in ("term", "place", "block")]
        new = np.zeros(batch.num_rows, bool)
        new[0] = last is not None and last != [k[0].as_py() for k in keys]
        for key in keys:
            new[1:] |= other(key)
        starts = np.flatnonzero(new)
        if len(starts):
            whole = pa.concat_batches([*held, batch.slice(0, starts[-1])])
            before = whole.num_rows - starts[-1]
            begins = np.unique(np.append(0, before + starts[:-1]))
            if whole.num_rows:
                yield rows(whole, begins)
            held, batch = [], batch.slice(starts[-1])
        held.append(batch)
        last = [k[-1].as_py() for k in keys]
    if held:
        yield rows(pa.concat_batches(held), np.zeros(1, np.int64))


def build_blocks(
    index: Index, workspace: Workspace, block_docs: int = BLOCK_DOCS, part_bytes: int = PART_BYTES
) -> BlockIndex:
    """Write the blocks of all fields of ``index``; the postings move once, to their part."""
    spark = workspace.spark
    fields = [r["field"] for r in index.corpus_stats.select("field").collect()]
    size = index.corpus_stats.agg(F.sum("n_postings")).first()[0] or 0
    ends = index.doc_stats.agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count_distinct("doc_id").alias("n")
    ).first()
    low, high = ends["low"] or 0, ends["high"] or 0
    width = max(1, -(-block_docs * (high - low + 1) // max(ends["n"], 1)))
    parts = max(1, -(-size * POSTING_BYTES // part_bytes))
    n_blocks = high // width - low // width + 1

    whole = None
    for number, field in enumerate(fields):
        found = index.field_postings(field).select("doc_id", "term", "tf")
        # a bucket has few documents: they are hashed, and its postings keep their order by term
        docs = index.field_docs(field).hint("shuffle_hash")
        found = found.join(docs, "doc_id").withColumns({"field": F.lit(field), "number": F.lit(number)})
        whole = found if whole is None else whole.unionByName(found)
    # more of them than this can't be: a wide term has more than a part's bytes
    index.term_stats.filter(F.col("df") * POSTING_BYTES > part_bytes).select(
        "term", F.ceil(F.col("df") * POSTING_BYTES / part_bytes).alias("spans"), "field"
    ).write.mode("overwrite").parquet(workspace.path("wide"))
    wide = F.broadcast(spark.read.schema(WIDE).parquet(workspace.path("wide")))
    block = F.floor(F.coalesce("doc_id", F.lit(low)) / width)
    span = F.floor((F.col("block") - low // width) * F.coalesce("spans", F.lit(1)) / n_blocks)
    place = part_of("term", span, parts) * len(fields) + F.col("number")
    placed = whole.join(wide, ["field", "term"], "left").withColumn("block", block).select(
        "term", place.alias("place"), "block",
        F.col("doc_id").cast("bigint").alias("doc_id"), "tf", F.col("doc_len").cast("bigint").alias("doc_len"),
    )
    part = F.floor(F.col("place") / len(fields)).cast("int")
    # a task has a share of one part
    shares = max(-(-spark.sparkContext.defaultParallelism // parts), -(-part_bytes // TASK_BYTES))
    share = F.pmod(F.xxhash64("term", "block"), F.lit(shares)).cast("int")
    gathered = (
        placed.repartitionById(parts * shares, part * shares + share)
        # runs of postings come in this order; it begins with terms, as eight bytes of them decide most places
        .sortWithinPartitions("term", "place", "doc_id", "tf", "doc_len")
        .mapInArrow(_gathered, GATHERED)
    )
    blocks = gathered.select(
        "postings", "term", "block", F.size("postings").cast("bigint").alias("n"), "copies", "max_tf", "min_len",
        F.element_at(F.array(*map(F.lit, fields)), F.col("place") % len(fields) + 1).alias("field"),
        part.alias("part"),
    )
    with settings(spark, {FILES_KEPT_OPEN: len(fields), BATCH_BYTES: ANY_BYTES}):
        blocks.write.mode("overwrite").partitionBy("field", "part").parquet(workspace.path("blocks"))
    manifest = json.dumps({"parts": parts, "width": width})
    spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.mode("overwrite").text(
        workspace.path("block_manifest")
    )
    return open_blocks(spark, workspace.root, index)


def open_blocks(spark: SparkSession, root: str, index: Index) -> BlockIndex:
    """The blocks that :func:`build_blocks` wrote below ``root`` for ``index``."""
    setting = json.loads(spark.read.text(f"{root}/block_manifest").first()[0])
    written = spark.read.schema(BLOCKS).parquet(f"{root}/blocks")
    home = part_of("term", F.lit(0), setting["parts"])
    return BlockIndex(
        index,
        written.select("field", "part", "term", "block", "postings"),
        written.drop("postings").withColumn("home", home),
        spark.read.schema(WIDE).parquet(f"{root}/wide"),
        setting["parts"],
        setting["width"],
    )


def _named(rows: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """``rows`` with a filter that names the ``values`` of a column, if they are few."""
    few = [r[0] for r in values.distinct().limit(LITERALS + 1).collect()]
    return rows if len(few) > LITERALS else rows.filter(F.col(column).isin(few))


def _near(rows: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if its counted rows allow it."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _skips(blocks: BlockIndex, field: str, terms: DataFrame) -> DataFrame:
    """Skip rows of written ``terms(term, ...)``."""
    wide = blocks.wide.filter(F.col("field") == field).drop("field")
    span = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("spans", F.lit(1)) - 1))
    asked = terms.join(F.broadcast(wide), "term", "left").withColumn("span", span)
    asked = asked.withColumn("part", part_of("term", F.col("span"), blocks.parts)).drop("span", "spans")
    rows = blocks.skips.filter(F.col("field") == field).drop("field", "home")
    rows = _named(rows, "part", asked.select("part"))
    rows = _named(rows, "term", asked.select("term"))
    return rows.join(_near(asked), ["part", "term"])


def _postings(blocks: BlockIndex, field: str, wanted: DataFrame) -> DataFrame:
    """Postings of the blocks in written ``wanted(part, term, block, ...)``, of all of a part's without ``block``."""
    rows = blocks.blocks.filter(F.col("field") == field).drop("field")
    rows = _named(rows, "part", wanted.select("part"))
    rows = _named(rows, "term", wanted.select("term"))
    found = rows.join(_near(wanted), [c for c in ("part", "term", "block") if c in wanted.columns])
    return found.withColumn("_p", F.explode("postings")).select("*", "_p.*").drop("_p", "postings")


def matching_postings(blocks: BlockIndex, batch: QueryBatch, field: str, workspace: Workspace) -> DataFrame:
    """``(qid, term, doc_id, tf)``: all postings of the query terms, read from their parts only.

    All blocks of a term are wanted, so a part's rows are told by their term, whatever the number of blocks.
    Only a batch with more terms than can be broadcast names every block and moves them.
    """
    terms = workspace.save("asked", batch.terms.select("qid", "term"))
    different = workspace.save("different", terms.select("term").distinct())
    places = workspace.save("places", _skips(blocks, field, different).select("part", "term").distinct())
    wanted = workspace.save("wanted", terms.join(_near(places), "term"))
    if wanted.count() > BROADCAST_ROWS:
        wanted = workspace.save("wanted_blocks", _skips(blocks, field, terms).select("qid", "part", "term", "block"))
    return _postings(blocks, field, wanted).select("qid", "term", "doc_id", "tf")


@dataclass(frozen=True)
class Pruned:
    """Ranked results, and how many postings of the query terms there are and were read."""

    ranked: DataFrame  # qid, doc_id, score, rank
    postings: int
    read: int


def pruned_top_k(
    blocks: BlockIndex, batch: QueryBatch, field: str, k: int, contribution: Callable[[], Column],
    workspace: Workspace,
) -> Pruned:
    """The rows of ``top_k`` over all scores, without reading blocks that can't hold any of them.

    ``contribution`` gives what a posting adds, from the columns ``qtf, idf, tf, doc_len``; it must not be
    negative, nor fall with tf, nor grow with the length. A range of documents can score what the largest
    tf and the shortest length of its blocks would. The ``k`` ranges with the highest bounds are read first;
    the k-th best of their documents bounds the k-th best of all from below, and of the other ranges only
    those are read that can reach it.
    """
    weighed = workspace.save("weighed", weigh(blocks.index, batch, field).drop("term_bucket", "df"))
    skips = _skips(blocks, field, weighed).withColumnsRenamed({"max_tf": "tf", "min_len": "doc_len"})
    bounds = workspace.save(
        "bounds",
        skips.withColumn("bound", F.col("copies") * contribution()).drop("copies", "tf", "doc_len"),
    )
    ranges = workspace.save(
        "ranges", bounds.groupBy("qid", "block").agg(F.sum("bound").alias("bound"), F.sum("n").alias("n"))
    )

    def scores(name: str, chosen: DataFrame) -> DataFrame:
        wanted = bounds.drop("bound", "n").join(chosen, ["qid", "block"])
        wanted = workspace.save(f"{name}_wanted", wanted)
        return workspace.save(
            f"{name}_scores", accumulate(_postings(blocks, field, wanted), contribution())
        )

    order = W.partitionBy("qid").orderBy(F.desc("bound"), "block")
    first = workspace.save(
        "first", ranges.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).drop("r")
    )
    seen = scores("first", first.select("qid", "block"))
    least = top_k(seen, k).filter(F.col("rank") == k).select("qid", F.col("score").alias("least"))
    second = workspace.save(
        "second",
        ranges.join(first.select("qid", "block"), ["qid", "block"], "left_anti")
        .join(_near(workspace.save("least", least)), "qid", "left")
        .filter(F.col("least").isNull() | (F.col("bound") * (1 + MARGIN) + MARGIN >= F.col("least"))),
    )
    more = scores("second", second.select("qid", "block"))

    def count(rows: DataFrame) -> int:
        return rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    return Pruned(top_k(seen.unionByName(more), k), count(ranges), count(first) + count(second))


def tfidf_top_k(
    blocks: BlockIndex, batch: QueryBatch, field: str, k: int, workspace: Workspace
) -> Pruned:
    """As ``top_k(tfidf(...), k)``."""
    return pruned_top_k(
        blocks, batch, field, k, lambda: F.col("qtf") * F.col("tf") * F.col("idf"), workspace
    )


def bm25_top_k(
    blocks: BlockIndex, batch: QueryBatch, field: str, k: int, workspace: Workspace,
    k1: float = 1.2, b: float = 0.75,
) -> Pruned:
    """As ``top_k(bm25(...), k)``."""
    mean = blocks.index.corpus(field, "avg_len")
    return pruned_top_k(
        blocks, batch, field, k, lambda: bm25_contribution(mean, k1, b), workspace
    )
