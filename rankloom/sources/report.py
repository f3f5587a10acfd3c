"""Sinks for evaluation results: CSV, JSON and a Markdown report in a timestamped folder."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def report_folder(base: str, now: datetime | None = None) -> str:
    return f"{base.rstrip('/')}/{(now or datetime.now()).strftime('%Y%m%d_%H%M%S')}"


def write_tables(per_query: DataFrame, summary: DataFrame, folder: str) -> None:
    """Per-query metrics as CSV (lists joined by commas) and JSON, the summary as JSON."""
    flat = per_query.select(
        *(
            F.concat_ws(", ", c).alias(c) if t.startswith("array") else F.col(c)
            for c, t in per_query.dtypes
        )
    )
    flat.write.mode("overwrite").option("header", True).csv(f"{folder}/per_query_csv")
    per_query.write.mode("overwrite").json(f"{folder}/per_query_json")
    summary.write.mode("overwrite").json(f"{folder}/summary_json")


def _listed(ids: str) -> Column:
    return F.when(F.size(ids) == 0, F.lit("None")).otherwise(F.concat_ws(", ", ids))


def report_lines(
    per_query: DataFrame, summary: DataFrame, queries: DataFrame, now: datetime, k: int = 10
) -> DataFrame:
    """``(section, part, value)``: Markdown lines in order of section and part."""
    stamp = now.strftime("%Y-%m-%d %H:%M:%S")

    def number(label: str, column: str) -> Column:
        return F.format_string(f"| {label} | %.4f |", F.col(column))

    def count(label: str, column: str) -> Column:
        return F.format_string(f"| {label} | %d |", F.col(column))

    head = summary.select(
        F.lit(-1).cast("bigint").alias("section"),
        F.posexplode(
            F.array(
                F.lit(f"# Precision@{k} evaluation"),
                F.lit(""),
                F.lit(f"**Generated:** {stamp}"),
                F.lit(""),
                F.lit("## Summary"),
                F.lit(""),
                F.lit("| Metric | Value |"),
                F.lit("| --- | --- |"),
                count("Queries", "total_queries"),
                number(f"Mean P@{k}", "mean_precision"),
                number(f"Median P@{k}", "median_precision"),
                number("Standard deviation", "stdev_precision"),
                number(f"Min P@{k}", "min_precision"),
                number(f"Max P@{k}", "max_precision"),
                count("Perfect", "perfect_scores"),
                count("Zero", "zero_scores"),
                F.lit(""),
                F.lit("## Queries"),
                F.lit(""),
            )
        ).alias("part", "value"),
    )
    detail = per_query.join(queries.select("qid", "query"), "qid").select(
        F.col("qid").alias("section"),
        F.posexplode(
            F.array(
                F.format_string("### %d. %s", F.col("qid") + 1, F.col("query")),
                F.lit(""),
                F.format_string(f"- **Precision@{k}:** %.4f", F.col("precision")),
                F.format_string(f"- **Found:** %d/{k}", F.col("relevant_found")),
                F.format_string("- **Relevant in total:** %d", F.col("total_relevant")),
                F.concat(F.lit("- **Hits:** "), _listed("hit_ids")),
                F.concat(F.lit("- **Retrieved:** "), _listed("retrieved_ids")),
                F.lit(""),
            )
        ).alias("part", "value"),
    )
    return head.unionByName(detail)


def write_report(
    per_query: DataFrame,
    summary: DataFrame,
    queries: DataFrame,
    base: str,
    now: datetime | None = None,
    k: int = 10,
) -> str:
    """Write tables and report; the report's part files are in reading order."""
    now = now or datetime.now()
    folder = report_folder(base, now)
    write_tables(per_query, summary, folder)
    lines = report_lines(per_query, summary, queries, now, k)
    lines.orderBy("section", "part").select("value").write.mode("overwrite").text(
        f"{folder}/report_md"
    )
    return folder
