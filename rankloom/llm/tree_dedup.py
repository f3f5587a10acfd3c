"""Exact dedup by a tree-merge of sorted digest runs.

Each partition of the input is one run of (identity, best row, size), sorted by identity. In every
round the runs of ``fanout`` neighbours meet and are merged; the run numbers shrink by that factor,
as in a binomial reduction, until one run is left. A run is cut by leading digest bits, so the parts
of a run, also of the last one, lie in different tasks, and no task ever holds a whole run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, attach, column_or_null

#: What separates words in the contract, deleted before texts are compared (fixed values).
BLANKS = " \t\n\x0b\x0c\r"
IDENTITY = ["digest", "check", "n_bytes"]


def without_blanks(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def merge_runs(runs: DataFrame, n_runs: int, fanout: int) -> DataFrame:
    """Merge ``runs(run, digest, check, n_bytes, best, n)`` until one is left.

    Sorting and merging is Spark's sort aggregate: the parts of the runs that meet are sorted by
    identity and stream through it. Entries meet only if digest, an independent second hash and the
    length agree, at every level.
    """
    part = F.substring("digest", 1, 2)
    while True:
        n_runs = -(-n_runs // fanout)
        runs = (
            runs.withColumn("run", F.floor(F.col("run") / fanout))
            .withColumn("part", part)
            .repartition("run", "part")
            .sortWithinPartitions("run", "part", *IDENTITY)
            .groupBy("run", "part", *IDENTITY)
            .agg(F.min("best").alias("best"), F.sum("n").alias("n"))
            .drop("part")
        )
        if n_runs <= 1:
            return runs.drop("run")


def exact_groups(docs: DataFrame, fanout: int = 16) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, one row per row of ``docs``.

    Texts are equal when they are after deleting blanks; null counts as empty. The row with the most
    code points stays, then the smallest doc_id (null last); of rows equal in both, exactly one is
    ``kept``. Empty input gives an empty table. Other columns aren't read.
    """
    scratch = Scratch(docs.sparkSession)
    text = column_or_null(docs, "text", "string")
    rows = scratch.keep(
        docs.select(
            column_or_null(docs, "doc_id", "bigint").alias("doc_id"),
            F.coalesce(F.length(text), F.lit(0)).alias("chars"),
            without_blanks(text).alias("bare"),
        )
        .select(
            "doc_id", "chars",
            F.unhex(F.sha2("bare", 256)).alias("digest"),
            F.xxhash64("bare").alias("check"),
            F.octet_length("bare").alias("n_bytes"),
        )
        .withColumn("run", F.spark_partition_id())
        .withColumn("row", F.monotonically_increasing_id())
    )
    best = F.struct(
        (-F.col("chars")).alias("chars"), F.col("doc_id").isNull().alias("none"), "doc_id", "row"
    )
    sizes = rows.agg(F.count("*").alias("n"), F.max("run").alias("last")).first()
    first = rows.groupBy("run", *IDENTITY).agg(F.min(best).alias("best"), F.count("*").alias("n"))
    merged = scratch.keep(
        merge_runs(first, (sizes["last"] or 0) + 1, fanout).select(
            *IDENTITY,
            F.col("best.doc_id").alias("keep_id"),
            F.col("best.row").alias("keep_row"),
            F.col("n").alias("group_size"),
        )
    )
    return attach(rows, merged, IDENTITY, "group_size", sizes["n"], "inner").select(
        "doc_id", "keep_id", "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
