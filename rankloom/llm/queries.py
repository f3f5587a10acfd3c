"""The dealt operators applied to whole tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .forest import search
from .importance import resample
from .lexical import ranked_search
from .line_dedup import dedup_lines
from .mining import mine_negatives
from .mixing import mix_sources
from .packing import pack_documents
from .revisits import resolve_revisits
from .simhash import simhash_groups
from .substrings import remove_repeats
from .token_files import read_token_files, write_token_files
from .tree_dedup import exact_groups
from .trie_join import near_duplicate_groups


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def op1_line_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = dedup_lines(_read(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return cut.select(
        "doc_id", "removed_chunks", "removed_lines",
        F.length(text).cast("bigint").alias("kept_chars"), F.sha2(text, 256).alias("kept_sha256"),
    )


def op2_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(
        _read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2
    )
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return drawn.select("doc_id", "weight", "kept")


def op4_tree_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_read(spark, sf_dir, "documents"))


def op5_suffix_doubling_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(_read(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def archive_records(pages: DataFrame) -> DataFrame:
    """Each page as a full response (few as errors), a revisit after it and a revisit before it.

    The pages of a host are captures of 20 URLs of it at different times. Revisits name them in other
    forms; every seventh has another etag, every fifth response has none.
    """
    host = F.substring_index("url", "/", 3)
    path = F.concat(F.lit("/"), F.pmod("page_id", F.lit(20)))
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    ts = F.pmod(F.col("page_id") * 7919, F.lit(100_003)) * 10
    date = F.concat(F.lit("day "), F.floor(ts / 1000).cast("string"))

    def headers(**named):
        entries = F.array(
            *[F.struct(F.lit(k.replace("_", "-")).alias("key"), v.alias("value")) for k, v in named.items()]
        )
        return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))

    response = F.struct(
        (F.col("page_id") * 4).alias("record_id"),
        F.lit("response").alias("kind"),
        F.concat(host, path).alias("url"),
        ts.alias("ts"),
        F.when(F.pmod("page_id", F.lit(17)) == 3, 404).otherwise(200).alias("status"),
        headers(
            ETag=F.when(F.pmod("page_id", F.lit(5)) != 1, tag), Last_Modified=date, Date=date,
            Content_Type=F.lit("text/html"),
            Content_Length=F.octet_length(F.coalesce("html", F.lit(""))).cast("string"),
        ).alias("headers"),
    )
    after = F.struct(
        (F.col("page_id") * 4 + 1).alias("record_id"),
        F.lit("revisit").alias("kind"),
        F.concat(F.upper(F.substring_index(host, "/", 1)), F.substring(host, F.locate("//", host), 1000),
                 F.when(host.startswith("http:"), ":80").otherwise(":443"), path, F.lit("#part")).alias("url"),
        (ts + 5).alias("ts"),
        F.lit(304).alias("status"),
        headers(
            etag=F.when(F.pmod("page_id", F.lit(7)) == 2, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), tag)),
            date=F.concat(date, F.lit(" later")), cache_control=F.lit("no-cache"),
            content_type=F.lit("none"),
        ).alias("headers"),
    )
    before = F.struct(
        (F.col("page_id") * 4 + 2).alias("record_id"),
        F.lit("revisit").alias("kind"),
        F.concat(host, path).alias("url"),
        (ts - 5).alias("ts"),
        F.lit(304).alias("status"),
        headers(date=date).alias("headers"),
    )
    return pages.select(F.explode(F.array(response, after, before)).alias("r")).select("r.*")


def op6_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = resolve_revisits(archive_records(_read(spark, sf_dir, "pages")))
    entries = F.array_sort(F.map_entries("headers"))
    merged = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")
    return resolved.withColumns(
        {"headers": merged, "response_id": F.coalesce("response_id", F.lit(-1).cast("bigint"))}
    )


def op7_seekable_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, files = write_token_files(
        _read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2
    )
    documents = read_token_files(folder, files)
    return documents.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op8_trie_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(_read(spark, sf_dir, "documents"))


def op9_threshold_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op10_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op11_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(_read(spark, sf_dir, "documents"))


def op12_geometric_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), k=10)


def op13_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_chunk_dedup": op1_line_chunk_dedup,
    "op2_hierarchical_packing": op2_hierarchical_packing,
    "op3_importance_resampling": op3_importance_resampling,
    "op4_tree_merge_dedup": op4_tree_merge_dedup,
    "op5_suffix_doubling_dedup": op5_suffix_doubling_dedup,
    "op6_revisit_resolution": op6_revisit_resolution,
    "op7_seekable_token_files": op7_seekable_token_files,
    "op8_trie_jaccard_join": op8_trie_jaccard_join,
    "op9_threshold_mixing": op9_threshold_mixing,
    "op10_projection_forest": op10_projection_forest,
    "op11_simhash_bk_trees": op11_simhash_bk_trees,
    "op12_geometric_block_search": op12_geometric_block_search,
    "op13_threshold_negatives": op13_threshold_negatives,
}
