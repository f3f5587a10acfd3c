"""The judged-query test: search, evaluate, report."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from ..operators import evaluation
from ..operators.index import Index
from ..operators.ranking import top_k
from ..operators.scoring import query_batch, tfidf
from ..sources.judged_queries import read_judged_queries
from ..sources.report import write_report
from ..sources.workspace import Workspace


def run_judged_queries(
    index: Index,
    queries_path: str,
    workspace: Workspace,
    report_base: str | None = None,
    k: int = 10,
    field: str = "body",
    now: datetime | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Per-query records and summary of the main search on judged queries.

    All queries are scored in one job; those without results count with precision 0.
    """
    queries, judgments = read_judged_queries(workspace.spark, queries_path, workspace)
    scores = tfidf(index, query_batch(queries, index), field)
    runs = workspace.save("judged_runs", top_k(scores, k))
    per_query = evaluation.query_report(runs, judgments, queries, k)
    summary = evaluation.summarize(per_query)
    if report_base is not None:
        write_report(per_query, summary, queries, report_base, now, k)
    return per_query, summary
