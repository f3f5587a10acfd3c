"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import Workspace

# Rows allowed in a broadcast. Terms are at most 49 characters, ids and weights 8 bytes,
# so a broadcast stays under about 100 MB.
BROADCAST_ROWS = 250_000
# Rows of one key that one task takes; keys with more are spread over several tasks.
ROWS_PER_TASK = 5_000_000
# Rows that may be shuffled on a key as they are: were all of one key, a task could hold them.
SHUFFLE_ROWS = 10_000_000


def hot_keys(
    counts: DataFrame, keys: list[str], parts: str = "parts", rows_per_task: int | None = None
) -> DataFrame:
    """``(*keys, parts)`` for the keys of ``counts(*keys, n)`` that deserve more than one task.

    There are never more than ``BROADCAST_ROWS`` of them: a hot key has more than
    ``total / BROADCAST_ROWS`` of the total rows.
    """
    total = counts.agg(F.sum("n")).scalar()
    per_task = F.greatest(
        F.lit(rows_per_task or ROWS_PER_TASK).cast("double"), total / F.lit(BROADCAST_ROWS)
    )
    return (
        counts.withColumn(parts, F.ceil(F.col("n") / per_task))
        .filter(F.col(parts) > 1)
        .select(*keys, parts)
    )


def count_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def part_of(spread_by: list[str], parts: str) -> Column:
    return F.pmod(F.xxhash64(*spread_by), F.coalesce(parts, F.lit(1)))


def all_parts(parts: str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(parts, F.lit(1)) - 1))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_by: list[str],
    left_counts: DataFrame,
    right_by: list[str] | None = None,
    right_counts: DataFrame | None = None,
    how: str = "inner",
) -> DataFrame:
    """Shuffled equi-join that spreads the rows of hot keys over several tasks.

    ``left_counts(*keys, n)`` tells which keys of ``left`` are hot. Their rows are divided by
    ``left_by``, and the matching rows of ``right`` are copied to every part; other keys are not
    copied. With ``right_counts`` the same is done the other way round as well.
    """
    names, hot = ["_part"], F.broadcast(hot_keys(left_counts, keys, "_n"))
    left = left.join(hot, keys, "left").withColumn("_part", part_of(left_by, "_n")).drop("_n")
    right = right.join(hot, keys, "left").withColumn("_part", all_parts("_n")).drop("_n")
    if right_counts is not None:
        if how != "inner":
            raise ValueError("only an inner join can copy rows of both sides")
        names, hot = ["_part", "_other"], F.broadcast(hot_keys(right_counts, keys, "_n"))
        right = (
            right.join(hot, keys, "left").withColumn("_other", part_of(right_by, "_n")).drop("_n")
        )
        left = left.join(hot, keys, "left").withColumn("_other", all_parts("_n")).drop("_n")
    return left.join(right, [*keys, *names], how).drop(*names)


def frequent_keys(left: DataFrame, keys: list[str]) -> DataFrame | None:
    """Written keys, nulls included, that hold so many rows of written ``left`` that a task had too many.

    There are fewer than ``BROADCAST_ROWS`` of them.
    """
    least = max(ROWS_PER_TASK, left.count() / BROADCAST_ROWS)
    hot = Workspace(left.sparkSession).save(
        "hot", count_keys(left, keys).filter(F.col("n") > least).select(*keys)
    )
    return None if hot.isEmpty() else hot


def lookup_join(
    left: DataFrame, table: DataFrame, keys: list[str], bounded: bool, how: str = "left"
) -> DataFrame:
    """Join with a large table holding one row per key, which does not move if it is bucketed on it.

    ``bounded`` says that ``left`` was counted and is small. Otherwise it is written, so that it is
    computed once, and its keys are counted. Of those that it repeats very often the table's rows are
    broadcast and the rows of ``left`` stay where they are; the others go to the table's buckets.
    """
    if bounded:
        return left.join(table, keys, how)
    left = Workspace(left.sparkSession).save("left", left)
    hot = frequent_keys(left, keys)
    if hot is None:
        return left.join(table, keys, how)
    named = F.broadcast(hot.select(*[F.col(c).alias(f"_hot_{c}") for c in keys]))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in keys])
    their_rows = F.broadcast(table.join(F.broadcast(hot), keys, "left_semi"))
    near = left.join(named, same, "left_semi").join(their_rows, keys, how)
    far = left.join(named, same, "left_anti").join(table, keys, how)
    return near.unionByName(far)


def join_vocabulary(
    postings: DataFrame, vocabulary: DataFrame, n_terms: int, n_postings: int,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Inner join of postings with a table of one row per (field, term) that has a ``df`` column.

    A vocabulary within ``limit`` is broadcast whole. Beyond it, terms in at least
    ``n_postings / limit`` documents are: there cannot be more than ``limit`` of those, and under
    a Zipf distribution they cover most postings, which then do not move. Only the rare tail is
    shuffled, and none of its terms is hot.
    """
    keys = ["field", "term"]
    if n_terms <= limit:
        return postings.join(F.broadcast(vocabulary.drop("df")), keys)
    frequent = F.col("df") >= n_postings / limit
    hot = vocabulary.filter(frequent).drop("df")
    cold = vocabulary.filter(~frequent).drop("df")
    tail = postings.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return postings.join(F.broadcast(hot), keys).unionByName(tail.join(cold, keys))
