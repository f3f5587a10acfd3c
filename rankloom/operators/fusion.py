"""Combination of field scores with page rank and page views."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .index import Index
from .joins import SHUFFLE_ROWS, lookup_join
from .ranking import top_k
from .scoring import QueryBatch, bm25, tfidf, word_count

CANDIDATES = 500
RESULTS = 100


@dataclass(frozen=True)
class Weights:
    text: float = 0.65
    title: float = 0.25
    anchor: float = 0.1
    pagerank: float = 1.0
    pageviews: float = 1.0


@dataclass(frozen=True)
class Signals:
    """Query-independent tables, one row per document."""

    page_rank: DataFrame  # doc_id, pagerank
    page_views: DataFrame  # doc_id, views


@dataclass(frozen=True)
class TwoField:
    """Setting of the two-field search; fixed values."""

    text_k1: float = 1.2
    text_b: float = 0.6
    title_k1: float = 1.5
    title_b: float = 0.4
    weights: Weights = field(
        default_factory=lambda: Weights(
            text=1.9, title=1.1, anchor=0.0, pagerank=0.4, pageviews=0.6
        )
    )


def max_normalize(scores: DataFrame, by: str = "qid", bounded: bool = False) -> DataFrame:
    """Divide by the best score of the query; 0 if that is 0.

    The maxima are aggregated map-side and joined back, so no query is gathered in one task.
    """
    best = scores.groupBy(by).agg(F.max("score").alias("_best"))
    if bounded:
        joined = scores.join(F.broadcast(best), by)
    else:
        joined = lookup_join(scores, best, [by], bounded=False)
    return joined.withColumn("score", normalized("score", "_best")).drop("_best")


def normalized(score: str, best: str) -> Column:
    return F.coalesce(F.col(score) / F.nullif(F.col(best), F.lit(0.0)), F.lit(0.0))


def best_candidates(scores: DataFrame, k: int = CANDIDATES) -> DataFrame:
    """Cut to ``k`` per query, then max-normalize. The window spans at most ``k`` rows."""
    cut = top_k(scores, k)
    return cut.withColumn("_best", F.max("score").over(W.partitionBy("qid"))).select(
        "qid", "doc_id", normalized("score", "_best").alias("score")
    )


def side_by_side(field_scores: dict[str, DataFrame]) -> DataFrame:
    """Union of the candidates of all fields, one score column each, 0 where a field has none."""
    union = None
    for name, scores in field_scores.items():
        part = scores.select("qid", "doc_id", F.lit(name).alias("_field"), "score")
        union = part if union is None else union.unionByName(part)
    columns = [
        F.coalesce(F.max(F.when(F.col("_field") == name, F.col("score"))), F.lit(0.0)).alias(name)
        for name in field_scores
    ]
    return union.groupBy("qid", "doc_id").agg(*columns)


def with_signals(candidates: DataFrame, signals: Signals, bounded: bool) -> DataFrame:
    """Max-normalized page rank and page views, 0 where missing."""
    ranks, views = signals.page_rank, signals.page_views
    best_rank = ranks.agg(F.max("pagerank").cast("double")).scalar()
    best_views = views.agg(F.max("views").cast("double")).scalar()
    joined = lookup_join(candidates, ranks, ["doc_id"], bounded)
    joined = lookup_join(joined, views, ["doc_id"], bounded)
    zero = F.lit(0.0)
    return joined.select(
        *candidates.columns,
        F.coalesce(F.col("pagerank") / F.nullif(best_rank, zero), zero).alias("pagerank"),
        F.coalesce(F.col("views") / F.nullif(best_views, zero), zero).alias("pageviews"),
    )


def weighted_sum(candidates: DataFrame, weights: Weights) -> Column:
    total = F.lit(0.0)
    for name, weight in asdict(weights).items():
        if name in candidates.columns:
            total = total + F.col(name) * F.lit(float(weight))
    return total


def two_field_search(
    index: Index,
    batch: QueryBatch,
    signals: Signals,
    setting: TwoField | None = None,
    candidates: int = CANDIDATES,
    k: int = RESULTS,
) -> DataFrame:
    """BM25 of body and title, page rank and page views."""
    s = setting or TwoField()
    wide = side_by_side(
        {
            "text": best_candidates(bm25(index, batch, "body", s.text_k1, s.text_b), candidates),
            "title": best_candidates(
                bm25(index, batch, "title", s.title_k1, s.title_b), candidates
            ),
        }
    )
    wide = with_signals(wide, signals, batch.results_within(2 * candidates, SHUFFLE_ROWS))
    scores = wide.select("qid", "doc_id", weighted_sum(wide, s.weights).alias("score"))
    return top_k(scores, k)


def three_field_candidates(
    index: Index,
    batch: QueryBatch,
    signals: Signals,
    k1: float = 1.2,
    b: float = 0.5,
    candidates: int = CANDIDATES,
) -> DataFrame:
    """``(qid, doc_id, text, title, anchor, pagerank, pageviews)``, all normalized."""
    wide = side_by_side(
        {
            "text": best_candidates(bm25(index, batch, "body", k1, b), candidates),
            "title": best_candidates(word_count(index, batch, "title"), candidates),
            "anchor": best_candidates(word_count(index, batch, "anchor"), candidates),
        }
    )
    return with_signals(wide, signals, batch.results_within(3 * candidates, SHUFFLE_ROWS))


def three_field_search(
    index: Index,
    batch: QueryBatch,
    signals: Signals,
    weights: Weights | None = None,
    k1: float = 1.2,
    b: float = 0.5,
    candidates: int = CANDIDATES,
    k: int = RESULTS,
) -> DataFrame:
    """BM25 of the body, word counts of title and anchors, page rank and page views."""
    wide = three_field_candidates(index, batch, signals, k1, b, candidates)
    total = weighted_sum(wide, weights or Weights())
    return top_k(wide.select("qid", "doc_id", total.alias("score")), k)


def weight_grid_search(
    index: Index,
    batch: QueryBatch,
    signals: Signals,
    grid: list[Weights],
    k1: float = 1.2,
    b: float = 0.5,
    candidates: int = CANDIDATES,
    k: int = RESULTS,
) -> DataFrame:
    """Three-field search under several weightings; the index is read once for all of them."""
    wide = three_field_candidates(index, batch, signals, k1, b, candidates)
    variants = F.array(
        *[
            F.struct(F.lit(i).alias("setting"), weighted_sum(wide, weights).alias("score"))
            for i, weights in enumerate(grid)
        ]
    )
    scores = wide.select("qid", "doc_id", F.explode(variants).alias("_v"))
    scores = scores.select("_v.setting", "qid", "doc_id", "_v.score")
    return top_k(scores, k, by=("setting", "qid"))


def pagerank_hybrid(
    index: Index,
    batch: QueryBatch,
    page_rank: DataFrame,
    field: str = "body",
    text_weight: float = 0.8,
    rank_weight: float = 0.2,
    k: int = RESULTS,
) -> DataFrame:
    """``text_weight * tfidf + rank_weight * log1p(pagerank)`` over all candidates."""
    scores = tfidf(index, batch, field).withColumnRenamed("score", "_tfidf")
    ranked = scores.join(page_rank.select("doc_id", "pagerank"), "doc_id", "left")
    boost = F.log1p(F.coalesce("pagerank", F.lit(0.0)))
    return top_k(
        ranked.select(
            "qid",
            "doc_id",
            (F.lit(text_weight) * F.col("_tfidf") + F.lit(rank_weight) * boost).alias("score"),
        ),
        k,
    )
