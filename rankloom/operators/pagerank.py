"""PageRank with a fixed number of rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import Workspace, bucket_count
from .joins import all_parts, count_keys, hot_keys, part_of

# Out-links of one page handled by one task; pages with more are split.
LINKS_PER_SHARD = 1_000_000


def pagerank(
    vertices: DataFrame,
    edges: DataFrame,
    workspace: Workspace,
    rounds: int = 10,
    damping: float = 0.85,
    links_per_shard: int = LINKS_PER_SHARD,
    buckets: int | None = None,
) -> DataFrame:
    """``(doc_id, pagerank)`` for ``vertices(doc_id)`` and distinct ``edges(src, dst)``.

    Links from or to pages that are no vertices don't count, also not for the degree of their source.
    Ranks add up to 1: the rank of pages without links is spread over all pages. One round is a
    join on the source and one aggregation on the target. The links are bucketed by source, so
    only ranks are shuffled to them. The aggregation is combined map-side, so a page with very
    many in-links is no hot group; one with very many out-links is split into shards. The ranks
    of every round are written out, which cuts the lineage.
    """
    buckets = buckets or bucket_count(vertices)
    known = vertices.select("doc_id").distinct()
    edges = workspace.save(
        "pagerank_edges",
        edges.join(known.withColumnRenamed("doc_id", "src"), "src", "left_semi")
        .join(known.withColumnRenamed("doc_id", "dst"), "dst", "left_semi")
        .select("src", "dst"),
    )
    degrees = count_keys(edges, ["src"])
    hot = hot_keys(degrees, ["src"], "shards", links_per_shard)
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    nodes = workspace.save(
        "pagerank_nodes",
        vertices.select("doc_id")
        .join(degrees.withColumnsRenamed({"src": "doc_id", "n": "out"}), "doc_id", "left")
        .join(F.broadcast(hot.withColumnRenamed("src", "doc_id")), "doc_id", "left")
        .select("doc_id", F.coalesce("out", zero).alias("out"), F.coalesce("shards", one)
                .alias("shards")),
    )
    counts = nodes.agg(
        F.count("*").alias("n"), F.count_if(F.col("out") == 0).alias("dangling")
    ).first()
    n, has_dangling = counts["n"], counts["dangling"] > 0
    sharded = edges.join(F.broadcast(hot), "src", "left").select(
        "src", part_of(["dst"], "shards").alias("shard"), "dst"
    )
    links = workspace.save_bucketed(
        "pagerank_links",
        sharded.repartition(buckets, "src", "shard"),
        buckets,
        keys=("src", "shard"),
        sort_by=("src",),
    )
    ranks = nodes.withColumn("pagerank", F.lit(1.0) / n)
    for i in range(1, rounds + 1):
        # A round reads the ranks more than once; unsaved, the plan would double every time.
        ranks = workspace.save(
            f"pagerank_round_{i}", one_round(ranks, links, n, damping, has_dangling)
        )
    return ranks.select("doc_id", "pagerank")


def one_round(
    ranks: DataFrame, links: DataFrame, n: int, damping: float, has_dangling: bool
) -> DataFrame:
    sources = ranks.filter(F.col("out") > 0).select(
        F.col("doc_id").alias("src"),
        all_parts("shards").alias("shard"),
        (F.col("pagerank") / F.col("out")).alias("gain"),
    )
    none = F.lit(None).cast("bigint")
    gains = links.join(sources, ["src", "shard"]).select(
        F.col("dst").alias("doc_id"), "gain", none.alias("out"), none.alias("shards")
    )
    kept = ranks.select("doc_id", F.lit(0.0).alias("gain"), "out", "shards")
    spread = F.lit(0.0)
    if has_dangling:
        lost = ranks.filter(F.col("out") == 0).agg(F.sum("pagerank")).scalar()
        spread = F.coalesce(lost, F.lit(0.0)) / n
    return (
        kept.unionByName(gains)
        .groupBy("doc_id")
        .agg(F.max("out").alias("out"), F.max("shards").alias("shards"), F.sum("gain").alias("g"))
        .select(
            "doc_id",
            "out",
            "shards",
            (F.lit((1.0 - damping) / n) + damping * (F.col("g") + spread)).alias("pagerank"),
        )
    )
