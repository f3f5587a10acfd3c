"""Ordered lookups of a list of document ids; order and duplicates of the list are kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import lookup_join


def ids_table(id_lists: DataFrame, ids: str = "ids") -> DataFrame:
    """``(pos, doc_id)`` from an array column."""
    return id_lists.select(F.posexplode(ids).alias("pos", "doc_id")).withColumn(
        "doc_id", F.expr("try_cast(doc_id AS bigint)")
    )


def lookup(
    ids: DataFrame, table: DataFrame, column: str, default: Column | None, bounded: bool = False
) -> DataFrame:
    """``(pos, doc_id, column)`` for ``ids(pos, doc_id)``, in the order of ``pos``."""
    found = lookup_join(ids, table.select("doc_id", column), ["doc_id"], bounded)
    value = F.col(column) if default is None else F.coalesce(F.col(column), default)
    return found.select("pos", "doc_id", value.alias(column)).orderBy("pos")


def pagerank_of(
    ids: DataFrame, page_rank: DataFrame, normalized: bool = False, bounded: bool = False
) -> DataFrame:
    if normalized:
        best = page_rank.agg(F.max("pagerank")).scalar()
        page_rank = page_rank.withColumn("pagerank", F.col("pagerank") / best)
    return lookup(ids, page_rank, "pagerank", F.lit(0.0), bounded)


def pageviews_of(ids: DataFrame, page_views: DataFrame, bounded: bool = False) -> DataFrame:
    return lookup(ids, page_views, "views", F.lit(0).cast("bigint"), bounded)


def titles_of(ids: DataFrame, titles: DataFrame, bounded: bool = False) -> DataFrame:
    return lookup(ids, titles, "title", None, bounded)
