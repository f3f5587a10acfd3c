"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(id, label)`` for all ends of ``links(a, b)``; the label is one of the component's ids.

    In each round every end points to its smallest neighbour, pointers are followed once more, and the
    links between what they point to are the links of the next round. Every join has one row per key
    on its right, so adaptive execution can split the rows of an end with very many links over tasks.
    Every round is written.
    """
    edges = scratch.keep(links.filter("a != b").select("a", "b").distinct())
    labels = scratch.keep(
        edges.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("label", F.col("id"))
    )
    n = edges.count()
    while n:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = scratch.keep(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")))
        onward = near.select(F.col("a").alias("to"), F.col("to").alias("next"))
        near = scratch.keep(near.join(onward, "to").select("a", F.col("next").alias("to")))
        of_label = near.withColumnRenamed("a", "label")
        labels = scratch.keep(
            labels.join(of_label, "label", "left").select("id", F.coalesce("to", "label").alias("label"))
        )
        for end in ("a", "b"):
            of_end = near.withColumnRenamed("a", end)
            edges = edges.join(of_end, end).drop(end).withColumnRenamed("to", end)
        edges = scratch.keep(edges.filter("a != b").distinct())
        n = edges.count()
    return labels


def extended(labels: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """:func:`components` of the links that ``labels(id, label)`` came from and of ``links(a, b)``.

    Only links between different labels are contracted.
    """
    for end in ("a", "b"):
        of_end = labels.select(F.col("id").alias(end), F.col("label").alias(f"label_{end}"))
        links = links.join(of_end, end, "left").withColumn(end, F.coalesce(f"label_{end}", end))
    moved = components(links.select("a", "b"), scratch)
    if moved.isEmpty():
        return labels
    fresh = moved.join(labels.select("id"), "id", "left_anti")
    moves = moved.select(F.col("id").alias("label"), F.col("label").alias("to"))
    kept = labels.join(moves, "label", "left").select("id", F.coalesce("to", "label").alias("label"))
    return scratch.keep(kept.unionByName(fresh))
