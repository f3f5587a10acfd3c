"""Top-k lists and their presentation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .joins import lookup_join

# Distributed sums differ in their last bits, so scores are compared after rounding.
SCORE_DIGITS = 9


def by_score(score: str = "score") -> list[Column]:
    return [F.round(score, SCORE_DIGITS).desc(), F.col("doc_id").asc()]


def top_k(scores: DataFrame, k: int, by: tuple[str, ...] = ("qid",)) -> DataFrame:
    """Rank and keep the ``k`` best of every query.

    Spark cuts to ``k`` inside every task before the shuffle, so a query with very many
    candidates moves few rows.
    """
    order = W.partitionBy(*by).orderBy(*by_score())
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def all_ordered(scores: DataFrame) -> DataFrame:
    """Every result, best first within its query, as a global sort.

    There is no rank column on purpose: numbering an uncut list would put a whole query's
    candidates into one task, while a range-partitioned sort splits them.
    """
    return scores.orderBy("qid", *by_score())


def attach_titles(
    results: DataFrame, titles: DataFrame, bounded: bool, placeholder: bool = False
) -> DataFrame:
    """Title per result, null (or ``Article <id>``) if unknown. Apply after the cut."""
    titled = lookup_join(results, titles.select("doc_id", "title"), ["doc_id"], bounded)
    if placeholder:
        name = F.concat(F.lit("Article "), F.col("doc_id").cast("string"))
        titled = titled.withColumn("title", F.coalesce("title", name))
    return titled


def result_link(doc_id: str = "doc_id") -> Column:
    return F.concat(F.lit("https://en.wikipedia.org/?curid="), F.col(doc_id).cast("string"))


def keep_all_queries(queries: DataFrame, results: DataFrame) -> DataFrame:
    """Queries without any result stay, with nulls."""
    return queries.select("qid").join(results, "qid", "left")
