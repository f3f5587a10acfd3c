"""Reader of page-rank files: headerless ``id,rank`` CSV, gzipped, any number per folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_page_rank(spark: SparkSession, folder: str, normalize: bool = False) -> DataFrame:
    """``(doc_id, pagerank)``; of repeated ids the last one wins, files taken by name.

    A folder without such files gives an empty table. A gzip file is read by one task in line
    order, so line order within a file is that of the generated ids.
    """
    rows = (
        spark.read.schema("doc_id bigint, pagerank double")
        .option("pathGlobFilter", "*.csv.gz")
        .csv(folder)
        .select(
            "doc_id",
            "pagerank",
            F.struct(F.input_file_name(), F.monotonically_increasing_id()).alias("_order"),
        )
    )
    ranks = rows.groupBy("doc_id").agg(F.max_by("pagerank", "_order").alias("pagerank"))
    if normalize:
        best = ranks.agg(F.max("pagerank")).scalar()
        ranks = ranks.withColumn("pagerank", F.col("pagerank") / best)
    return ranks
