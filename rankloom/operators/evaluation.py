"""Evaluation of ranked runs against relevance judgments, all queries in one job.

Runs are ``(qid, rank, doc_id)``, judgments ``(qid, doc_id)``, queries ``(qid, ...)``. Every query
stays in the result, also one without results or without judgments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DIGITS = 3


def rounded(value: Column) -> Column:
    """Half-even rounding to three digits."""
    return F.bround(value, DIGITS)


def mark_hits(runs: DataFrame, judgments: DataFrame, depth: int) -> DataFrame:
    """The first ``depth`` results with ``hit`` and the running number of hits.

    The window spans at most ``depth`` rows of a query.
    """
    relevant = judgments.select("qid", "doc_id").distinct().withColumn("_relevant", F.lit(1))
    marked = (
        runs.select("qid", "rank", "doc_id")
        .filter(F.col("rank") <= depth)
        .join(relevant, ["qid", "doc_id"], "left")
        .select("qid", "rank", "doc_id", F.coalesce("_relevant", F.lit(0)).alias("hit"))
    )
    so_far = W.partitionBy("qid").orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    return marked.withColumn("hits_so_far", F.sum("hit").over(so_far))


def judged_counts(judgments: DataFrame) -> DataFrame:
    """Judgments and distinct relevant documents per query."""
    pairs = judgments.groupBy("qid", "doc_id").agg(F.count("*").alias("_n"))
    return pairs.groupBy("qid").agg(
        F.sum("_n").alias("total_relevant"), F.count("*").alias("n_relevant")
    )


def _within(k: int) -> Column:
    return F.col("rank") <= k


def _hits(k: int) -> Column:
    return F.coalesce(F.sum(F.when(_within(k), F.col("hit"))), F.lit(0))


def _retrieved(k: int) -> Column:
    return F.count(F.when(_within(k), F.lit(1)))


def harmonic(p: Column, r: Column) -> Column:
    """Harmonic mean, 0 if either is 0."""
    return F.when((p == 0) | (r == 0), F.lit(0.0)).otherwise(
        F.lit(2.0) / (F.lit(1.0) / F.nullif(p, F.lit(0.0)) + F.lit(1.0) / F.nullif(r, F.lit(0.0)))
    )


def _per_query(
    runs: DataFrame, judgments: DataFrame, queries: DataFrame, depth: int, **aggregates: Column
) -> DataFrame:
    hits = mark_hits(runs, judgments, depth)
    results = hits.groupBy("qid").agg(*(a.alias(name) for name, a in aggregates.items()))
    zero = F.lit(0).cast("bigint")
    joined = (
        queries.select("qid")
        .join(results, "qid", "left")
        .join(judged_counts(judgments), "qid", "left")
    )
    for name in ("total_relevant", "n_relevant"):
        joined = joined.withColumn(name, F.coalesce(name, zero))
    return joined


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _ratio(hits: str, n: str) -> Column:
    return F.coalesce(_or_zero(hits) / F.nullif(_or_zero(n), F.lit(0)), F.lit(0.0))


def precision_at_fixed_k(
    runs: DataFrame, judgments: DataFrame, queries: DataFrame, k: int = 10
) -> DataFrame:
    """Precision with denominator ``k`` over distinct documents, with the hits and their ids."""
    best = runs.groupBy("qid", "doc_id").agg(F.min("rank").alias("rank"))
    table = _per_query(
        best, judgments, queries, k,
        relevant_found=F.sum("hit"),
        hit_ids=F.array_sort(
            F.collect_list(F.when(F.col("hit") == 1, F.col("doc_id").cast("string")))
        ),
    )
    precision = _or_zero("relevant_found") / F.lit(k) if k > 0 else F.lit(0.0)
    return table.select(
        "qid",
        precision.cast("double").alias("precision"),
        _or_zero("relevant_found").cast("bigint").alias("relevant_found"),
        F.coalesce("hit_ids", F.array().cast("array<string>")).alias("hit_ids"),
    )


def query_report(
    runs: DataFrame, judgments: DataFrame, queries: DataFrame, k: int = 10
) -> DataFrame:
    """Per-query record: precision, hits, relevant and retrieved totals and ids."""
    record = _per_query(
        runs, judgments, queries, k,
        total_retrieved=F.count("*"),
        retrieved_ids=F.transform(
            F.array_sort(F.collect_list(F.struct("rank", F.col("doc_id").cast("string").alias("d")))),
            lambda r: r["d"],
        ),
    ).drop("n_relevant")
    precision = precision_at_fixed_k(runs, judgments, queries, k)
    return precision.join(record, "qid").select(
        "qid",
        "precision",
        "relevant_found",
        "total_relevant",
        _or_zero("total_retrieved").cast("bigint").alias("total_retrieved"),
        "hit_ids",
        F.coalesce("retrieved_ids", F.array().cast("array<string>")).alias("retrieved_ids"),
    )


def precision_at_k(
    runs: DataFrame, judgments: DataFrame, queries: DataFrame, k: int
) -> DataFrame:
    """Precision with the number of retrieved documents (at most ``k``) as denominator."""
    table = _per_query(runs, judgments, queries, k, _h=_hits(k), _n=_retrieved(k))
    return table.select("qid", rounded(_ratio("_h", "_n")).alias("precision"))


def _recall(hits: str) -> Column:
    return F.when(F.col("n_relevant") == 0, F.lit(1.0)).otherwise(
        _or_zero(hits) / F.nullif(F.col("n_relevant"), F.lit(0))
    )


def recall_at_k(runs: DataFrame, judgments: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Share of the relevant documents found; 1 if there is none to find."""
    table = _per_query(runs, judgments, queries, k, _h=_hits(k))
    return table.select("qid", rounded(_recall("_h")).alias("recall"))


def f1_at_k(runs: DataFrame, judgments: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Harmonic mean of the rounded precision and recall."""
    table = _per_query(runs, judgments, queries, k, _h=_hits(k), _n=_retrieved(k))
    f1 = harmonic(rounded(_ratio("_h", "_n")), rounded(_recall("_h")))
    return table.select("qid", rounded(f1).alias("f1"))


def results_quality(
    runs: DataFrame, judgments: DataFrame, queries: DataFrame, p_at: int = 5, f1_at: int = 30
) -> DataFrame:
    """Harmonic mean of the rounded P@5 and F1@30."""
    table = _per_query(
        runs, judgments, queries, max(p_at, f1_at),
        _h5=_hits(p_at), _n5=_retrieved(p_at), _h30=_hits(f1_at), _n30=_retrieved(f1_at),
    )
    p5 = rounded(_ratio("_h5", "_n5"))
    f1 = rounded(harmonic(rounded(_ratio("_h30", "_n30")), rounded(_recall("_h30"))))
    return table.select("qid", rounded(harmonic(p5, f1)).alias("quality"))


def average_precision(
    runs: DataFrame, judgments: DataFrame, queries: DataFrame, k: int = 40
) -> DataFrame:
    """Mean of the precision at every hit, over the hits found."""
    at_hit = F.when(F.col("hit") == 1, F.col("hits_so_far") / F.col("rank"))
    table = _per_query(runs, judgments, queries, k, _ap=F.avg(at_hit))
    return table.select("qid", rounded(F.coalesce("_ap", F.lit(0.0))).alias("average_precision"))


def reciprocal_rank(
    runs: DataFrame, judgments: DataFrame, queries: DataFrame, k: int = 100
) -> DataFrame:
    first_hit = F.min(F.when(F.col("hit") == 1, F.col("rank")))
    table = _per_query(runs, judgments, queries, k, _first=first_hit)
    return table.select(
        "qid", F.coalesce(F.lit(1.0) / F.col("_first"), F.lit(0.0)).alias("reciprocal_rank")
    )


def _ndcg(dcg: str, k: int) -> Column:
    ideal = F.aggregate(
        F.filter(F.sequence(F.lit(1), F.lit(k)), lambda i: i <= F.col("n_relevant")),
        F.lit(0.0),
        lambda total, i: total + F.lit(1.0) / F.log2(i + 1),
    )
    return F.coalesce(F.col(dcg) / F.nullif(ideal, F.lit(0.0)), F.lit(0.0))


def ndcg_at_k(
    runs: DataFrame, judgments: DataFrame, queries: DataFrame, k: int = 10
) -> DataFrame:
    """Normalized discounted gain with binary relevance; 0 if nothing is relevant."""
    table = _per_query(
        runs, judgments, queries, k, _dcg=F.sum(F.col("hit") / F.log2(F.col("rank") + 1))
    )
    return table.select("qid", _ndcg("_dcg", k).alias("ndcg"))


def summarize(per_query: DataFrame, metric: str = "precision") -> DataFrame:
    """One row of summary statistics of a per-query metric."""
    value = F.col(metric)
    return per_query.agg(
        F.count("*").alias("total_queries"),
        F.avg(value).alias("mean_precision"),
        F.median(value).alias("median_precision"),
        F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("stdev_precision"),
        F.min(value).alias("min_precision"),
        F.max(value).alias("max_precision"),
        F.count_if(value == 1.0).alias("perfect_scores"),
        F.count_if(value == 0.0).alias("zero_scores"),
    )


def precision_histogram(per_query: DataFrame, metric: str = "precision") -> DataFrame:
    """Queries per precision, in steps of 0.1."""
    return per_query.groupBy(F.bround(metric, 1).alias("precision")).agg(
        F.count("*").alias("n_queries")
    )


def evaluate(runs: DataFrame, judgments: DataFrame, queries: DataFrame) -> DataFrame:
    """All per-query metrics from one pass over the runs."""
    rank, hit = F.col("rank"), F.col("hit") == 1
    table = _per_query(
        runs, judgments, queries, 100,
        _h5=_hits(5), _n5=_retrieved(5),
        _h10=_hits(10), _n10=_retrieved(10),
        _h30=_hits(30), _n30=_retrieved(30),
        _h100=_hits(100),
        _ap=F.avg(F.when(hit & _within(40), F.col("hits_so_far") / rank)),
        _first=F.min(F.when(hit, rank)),
        _dcg=F.sum(F.when(_within(10), F.col("hit") / F.log2(rank + 1))),
    )
    zero = F.lit(0.0)
    p5 = rounded(_ratio("_h5", "_n5"))
    f1 = rounded(harmonic(rounded(_ratio("_h30", "_n30")), rounded(_recall("_h30"))))
    return table.select(
        "qid",
        rounded(F.coalesce("_ap", zero)).alias("average_precision"),
        p5.alias("p_at_5"),
        rounded(_ratio("_h10", "_n10")).alias("p_at_10"),
        rounded(_recall("_h100")).alias("recall_at_100"),
        f1.alias("f1_at_30"),
        rounded(harmonic(p5, f1)).alias("quality"),
        F.coalesce(F.lit(1.0) / F.col("_first"), zero).alias("reciprocal_rank"),
        _ndcg("_dcg", 10).alias("ndcg_at_10"),
    )


def mean_metrics(runs: DataFrame, judgments: DataFrame, queries: DataFrame) -> DataFrame:
    """Means over all queries; the mean of the average precisions is MAP."""
    names = {"average_precision": "map", "reciprocal_rank": "mrr"}
    table = evaluate(runs, judgments, queries)
    return table.agg(
        *(F.avg(c).alias(names.get(c, c)) for c in table.columns if c != "qid")
    )
