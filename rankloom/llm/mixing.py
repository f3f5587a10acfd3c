"""Mixing sources to target weights by hash thresholds.

Every document has a random but fixed ticket of 60 bits. A source with target T and size S gives
``floor(T / S)`` copies of all its documents and one more of those whose ticket lies below its
threshold. The threshold comes from histograms: words are summed by source and leading ticket bits,
the bucket in which the running sum crosses the budget is split by the next bits, and so on until
the bucket is one ticket. Nothing is sorted but buckets. Budgets are nested: a document that a
smaller budget takes is taken by every larger one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, attach, column_or_null

TICKET_BITS = 60
LEVEL_BITS = 12
#: Sources whose state is broadcast (some 100 bytes each); more are joined by :func:`attach`.
BROADCAST_SOURCES = 100_000
#: Rows of a key that are numbered in one task: a part is 2 ** PART_SHIFT numbers of written rows.
PART_SHIFT = 16


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def ticket(name: Column, occurrence: Column, seed: int) -> Column:
    named = F.concat(F.lit(f"{seed}|"), name, F.lit("|"), occurrence.cast("string"))
    return F.conv(F.substring(F.md5(named), 1, TICKET_BITS // 4), 16, 10).cast("bigint")


def with_occurrences(items: DataFrame, keys: list[str], scratch: Scratch) -> DataFrame:
    """Written rows with an ``occurrence`` that numbers those of equal ``keys`` from 0.

    Keys of one row, most of them, need no numbers. The others are numbered within the parts that the
    rows were written in, and the numbers of a part begin after those of the parts before: a key that
    holds a third of all rows is numbered in many tasks.
    """
    often = scratch.keep(
        items.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").select(*keys)
    )
    first = F.lit(0).cast("bigint")
    if often.isEmpty():
        return items.withColumn("occurrence", first)
    alone = items.join(often, keys, "left_anti").withColumn("occurrence", first)
    part = [*keys, "_part"]
    equal = items.join(often, keys, "left_semi").withColumn("_part", F.shiftright("_number", PART_SHIFT))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = equal.groupBy(*part).agg(F.count("*").alias("_n")).withColumn(
        "_start", F.coalesce(F.sum("_n").over(before), first)
    )
    within = F.row_number().over(Window.partitionBy(*part).orderBy("_number")) - 1
    numbered = equal.withColumn("_within", within).join(starts.drop("_n"), part)
    numbered = numbered.withColumn("occurrence", F.col("_start") + F.col("_within"))
    return scratch.keep(alone.unionByName(numbered.select(*alone.columns)))


def source_targets(sources: DataFrame, weights: tuple[int, ...], max_repeat: int) -> DataFrame:
    """``target`` for ``sources(source, source_size)``: shares by weight, at most ``max_repeat`` sizes.

    With the sources ordered by ``cap / weight``, let all before one be at their cap: the level that
    is left per unit of weight is largest at the right place, so the maximum is the level wanted.
    One row per source is in a single task.
    """
    everything = Window.partitionBy()
    turn = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    choices = F.array(*[F.lit(w) for w in weights])
    filled = everything.orderBy((F.col("cap") / F.col("weight")), F.col("turn")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        sources.withColumn("turn", turn)
        .withColumn("weight", F.element_at(choices, (F.col("turn") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * max_repeat)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("caps_before", F.sum("cap").over(filled) - F.col("cap"))
        .withColumn(
            "weight_left",
            F.sum("weight").over(everything) - F.sum("weight").over(filled) + F.col("weight"),
        )
        .withColumn(
            "level",
            F.max((F.col("total") - F.col("caps_before")) / F.col("weight_left")).over(everything),
        )
        .withColumn(
            "target", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
        )
        .drop("turn", "weight", "cap", "total", "caps_before", "weight_left", "level")
    )


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    max_repeat: int = 3,
    seed: int = 0,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` and ``carry``, one row per document.

    Sources take the weights in turn, in order of their names, null last, and share the words of all
    documents. ``copies`` is 0 to ``max_repeat``, ``taken = size * copies``. A source misses its
    target by at most half the document at its threshold. Null text has size 0. The ticket hashes
    doc_id, text and, for rows equal in both and in their source, an occurrence number: rows of no id and
    repeated rows are taken one by one. An empty table gives an empty one. Only the columns doc_id,
    source, text and ``carry`` are read.
    """
    scratch = Scratch(docs.sparkSession)
    text = column_or_null(docs, "text", "string")
    name = F.concat_ws(
        "|", F.coalesce(column_or_null(docs, "doc_id", "bigint").cast("string"), F.lit("null")),
        F.md5(F.coalesce(text, F.lit(""))),
    )
    items = scratch.keep(
        docs.select(
            column_or_null(docs, "doc_id", "bigint").alias("doc_id"),
            column_or_null(docs, "source", "string").alias("source"),
            word_count(text).alias("size"),
            name.alias("_name"),
            *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_carried")] if carry else []),
        )
        .withColumn(
            "_key", F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source"))
        )
        .withColumn("_number", F.monotonically_increasing_id())
    )
    items = with_occurrences(items, ["_key", "_name"], scratch)
    items = items.withColumn("ticket", ticket(F.col("_name"), F.col("occurrence"), seed))
    sources = items.groupBy("_key", "source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("_rows")
    )
    size = F.col("source_size")
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0)
    state = scratch.keep(
        source_targets(sources, weights, max_repeat)
        .drop("source")
        .withColumn("whole", whole)
        .withColumn("budget", F.col("target") - F.col("whole") * size)
        .withColumn("prefix", F.lit(0).cast("bigint"))
        .withColumn("used", F.lit(0).cast("bigint"))
        .withColumn("edge", F.lit(0).cast("bigint"))
    )
    n_sources, total = state.count(), items.count()

    def with_state(rows: DataFrame, table: DataFrame) -> DataFrame:
        if n_sources <= BROADCAST_SOURCES:
            return rows.join(F.broadcast(table), "_key")
        return attach(rows, table, ["_key"], "_rows", total, "inner")

    sized = items.filter("size > 0").select("_key", "ticket", "size")
    for level in range(TICKET_BITS // LEVEL_BITS):
        shift = TICKET_BITS - LEVEL_BITS * level
        inside = F.shiftright("ticket", shift) == F.col("prefix")
        running = Window.partitionBy("_key").orderBy("bucket")
        edge = (
            with_state(sized, state.select("_key", "prefix", "used", "budget", "_rows"))
            .filter(inside & (F.col("budget") > 0))
            .groupBy("_key", F.shiftright("ticket", shift - LEVEL_BITS).alias("bucket"))
            .agg(
                F.sum("size").alias("words"),
                F.first("used").alias("used"),
                F.first("budget").alias("budget"),
            )
            .withColumn("upto", F.col("used") + F.sum("words").over(running))
            .filter(F.col("upto") > F.col("budget"))
            .groupBy("_key")
            .agg(F.min_by(F.struct("bucket", "words", "upto"), "bucket").alias("at"))
            .select(
                "_key",
                F.col("at.bucket").alias("prefix"),
                (F.col("at.upto") - F.col("at.words")).alias("used"),
                F.col("at.words").alias("edge"),
            )
        )
        state = scratch.keep(
            state.drop("prefix", "used", "edge").join(edge, "_key", "left").withColumns(
                {
                    # a budget that no bucket crosses takes every ticket
                    "prefix": F.coalesce("prefix", F.lit((1 << (LEVEL_BITS * (level + 1))) - 1)),
                    "used": F.coalesce("used", F.lit(0).cast("bigint")),
                    "edge": F.coalesce("edge", F.lit(0).cast("bigint")),
                }
            )
        )
    # the document at the threshold is taken if that comes nearer to the budget
    nearer = F.col("used") + F.col("edge") - F.col("budget") < F.col("budget") - F.col("used")
    more = (F.col("budget") > 0) & (
        (F.col("ticket") < F.col("prefix")) | ((F.col("ticket") == F.col("prefix")) & nearer)
    )
    return (
        with_state(items, state)
        .withColumn("copies", (F.col("whole") + F.when(more, 1).otherwise(0)).cast("int"))
        .select(
            "doc_id", "source", "size", "source_size", "target", "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
            *[F.col(f"_carried.`{c}`").alias(c) for c in carry],
        )
    )
