"""A corpus pipeline: documents to packed training sequences, by the operators of ``rankloom.llm``.

Every stage reads the documents its predecessor kept from Parquet, and what it decides takes effect: the
next stage sees only its rows and texts. Stages but the last return the columns they got.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import Scratch
from rankloom.llm.importance import resample
from rankloom.llm.line_dedup import dedup_lines
from rankloom.llm.mixing import mix_sources
from rankloom.llm.packing import pack_documents
from rankloom.llm.trie_join import one_per_group


#: Rows of an Arrow batch; with Spark's 10,000 the texts of all tasks at work take some 100 MB each.
BATCH_ROWS = 1000
#: Words whose ids a worker remembers; the other stages' workers and tables leave little room for more.
CACHED = 200_000

#: The input row beside what an operator reads and adds, so that none of its columns clashes.
ROW = "_input_row"


def carried(docs: DataFrame) -> DataFrame:
    """``doc_id, source, text`` and all columns but the text as one struct."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    return docs.select("doc_id", "source", "text", rest.alias(ROW))


def restored(rows: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of the input, the text as ``rows`` has it, others as they were or ``changed``."""
    row = {c: F.col("text") if c == "text" else F.col(f"{ROW}.`{c}`") for c in columns} | {
        c: value for c, value in changed.items() if c in columns
    }
    return rows.select(*[row[c].alias(c) for c in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws; the share is that of good labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return restored(resample(carried(docs), labels).filter("kept"), docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated chunks of lines; documents of which nothing is left go."""
    cut = dedup_lines(carried(docs)).filter(
        (F.col("removed_chunks") == 0) | F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    )
    return restored(cut, docs.columns, n_chars=F.length("text").cast("bigint"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return restored(one_per_group(carried(docs)), docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    mixed = mix_sources(carried(docs), carry=("text", ROW)).filter("copies > 0")
    copies = mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return restored(copies, docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and the sequences they lie in."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, cached=CACHED)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources", mixture),
    ("packing", packing),
]

#: Hashes, tokenizers and components have no SQL form; tests check what the stages must keep.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, sf_dir = Scratch(spark), sf_dir.rstrip("/")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
