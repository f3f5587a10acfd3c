"""Registered queries over the test tables. Each takes ``(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stemming, text
from ..operators import blocks, evaluation, fusion, lookups, pages, pagerank, ranking, scoring
from ..operators import index as indexing
from ..operators.joins import join_vocabulary
from ..operators.judgments import containing_documents
from ..sources.judged_queries import read_judged_queries, write_judged_queries
from ..sources.page_rank_files import read_page_rank
from ..sources.report import write_tables
from ..sources.workspace import Workspace, spread, text_buckets
from ..streaming.live_index import LiveIndex
from .judged_run import run_judged_queries
from .search import Searcher

MONTH = ("2024-01-01", "2024-02-01")
GRID = [
    fusion.Weights(),
    fusion.Weights(text=0.5, title=0.3, anchor=0.2, pagerank=0.5, pageviews=0.5),
    fusion.Weights(text=0.8, title=0.1, anchor=0.1, pagerank=0.0, pageviews=0.0),
]
DEPTH = 100


class Tables:
    """Inputs of one scale factor, and the tables built from them once per application."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def docs(self) -> DataFrame:
        return self.read("documents").select("doc_id", "text")

    @property
    def pages(self) -> DataFrame:
        return self.read("pages")

    @property
    def queries(self) -> DataFrame:
        return self.read("benchmark").select(
            F.col("item_id").alias("qid"), F.col("text").alias("query")
        )

    @property
    def ids(self) -> DataFrame:
        """A list of ids to look up: with duplicates, and with ids no page has."""
        return self.read("events").select(
            F.col("event_id").alias("pos"), (F.col("user_id") * 2).alias("doc_id")
        )

    @cached_property
    def doc_index(self) -> indexing.Index:
        return indexing.build_index({"body": self.docs}, Workspace(self.spark), norms=False)

    @cached_property
    def stemmed_index(self) -> indexing.Index:
        return indexing.build_index({"body": self.docs}, Workspace(self.spark), analyzer="stemmed", norms=False)

    @cached_property
    def doc_blocks(self) -> blocks.BlockIndex:
        return blocks.build_blocks(self.doc_index, Workspace(self.spark))

    @cached_property
    def links(self) -> DataFrame:
        return Workspace(self.spark).save("links", pages.synthetic_links(spread(self.pages)))

    @cached_property
    def page_index(self) -> indexing.Index:
        fields = {
            "body": pages.body_text(self.pages),
            "title": pages.titles(self.pages).withColumnRenamed("title", "text"),
            "anchor": pages.anchor_text(self.links),
        }
        n_pages = self.pages.count()
        return indexing.build_index(
            fields,
            Workspace(self.spark),
            n_docs={name: n_pages for name in fields},
            merge=("anchor",),
            buckets=self.page_buckets,
            norms=False,
        )

    @cached_property
    def page_buckets(self) -> int:
        return text_buckets(self.pages, "html")

    @cached_property
    def titles(self) -> DataFrame:
        return Workspace(self.spark).save_bucketed(
            "titles", pages.titles(self.pages).repartition(self.page_buckets, "doc_id"),
            self.page_buckets,
        )

    @cached_property
    def page_rank(self) -> DataFrame:
        workspace = Workspace(self.spark)
        edges = pages.link_edges(self.links)
        vertices = self.pages.select(F.col("page_id").alias("doc_id"))
        ranks = pagerank.pagerank(vertices, edges, workspace)
        return workspace.save_bucketed(
            "page_rank", ranks.repartition(self.page_buckets, "doc_id"), self.page_buckets
        )

    @cached_property
    def page_views(self) -> DataFrame:
        views = pages.page_views(self.read("events"), *MONTH)
        return Workspace(self.spark).save_bucketed(
            "page_views", views.repartition(self.page_buckets, "doc_id"), self.page_buckets
        )

    @property
    def signals(self) -> fusion.Signals:
        return fusion.Signals(self.page_rank, self.page_views)

    @cached_property
    def doc_batch(self) -> scoring.QueryBatch:
        return scoring.query_batch(self.queries, self.doc_index)

    @cached_property
    def page_batch(self) -> scoring.QueryBatch:
        return scoring.query_batch(self.queries, self.page_index)

    @property
    def searcher(self) -> Searcher:
        return Searcher(self.page_index, self.titles, self.signals)

    @cached_property
    def judgments(self) -> DataFrame:
        workspace = Workspace(self.spark)
        found = containing_documents(self.queries, self.docs, self.doc_index, workspace)
        return workspace.save("judgments", found)

    @cached_property
    def runs(self) -> DataFrame:
        scores = scoring.tfidf(self.doc_index, self.doc_batch, "body")
        return Workspace(self.spark).save("runs", ranking.top_k(scores, DEPTH))

    @property
    def evaluated(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.runs, self.judgments, self.queries


_TABLES: dict[tuple[str, str], Tables] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return _TABLES.setdefault((spark.sparkContext.applicationId, sf_dir), Tables(spark, sf_dir))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def registered(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    REGISTRY[function.__name__] = lambda spark, sf_dir: function(tables(spark, sf_dir))
    return function


def r6(column: str) -> Column:
    return F.round(column, 6).alias(column)


def scored(scores: DataFrame) -> DataFrame:
    return scores.select("qid", "doc_id", r6("score"))


def ranked(runs: DataFrame, *more: str) -> DataFrame:
    return runs.select(*more, "qid", F.col("rank").cast("bigint"), "doc_id", r6("score"))


# Analyzers and index tables


@registered
def tokenize_docs(t: Tables) -> DataFrame:
    tokens = spread(t.docs).select("doc_id", text.tokenize("text").alias("tokens"))
    return tokens.select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.array_join("tokens", " ").alias("tokens"),
    )


def _doc_counts(t: Tables) -> DataFrame:
    return indexing.count_terms({"body": spread(t.docs)}).drop("field")


@registered
def postings(t: Tables) -> DataFrame:
    return _doc_counts(t).select("term", "doc_id", F.col("tf").cast("bigint"))


@registered
def term_stats(t: Tables) -> DataFrame:
    return indexing.term_statistics(_doc_counts(t))


@registered
def doc_lengths(t: Tables) -> DataFrame:
    return indexing.document_lengths(_doc_counts(t))


@registered
def posting_lists(t: Tables) -> DataFrame:
    lists = indexing.posting_lists(t.doc_index.field_postings("body"))
    pairs = F.transform("postings", lambda p: F.concat_ws(":", p["doc_id"], p["tf"]))
    return lists.select("term", "block", F.array_join(pairs, " ").alias("postings"))


@registered
def corpus_stats(t: Tables) -> DataFrame:
    return t.page_index.corpus_stats.select("field", "n_docs", "n_terms", "sum_len", r6("avg_len"))


@registered
def doc_norms(t: Tables) -> DataFrame:
    return t.doc_index.field_norms("body").select("doc_id", r6("doc_norm"))


@registered
def field_postings(t: Tables) -> DataFrame:
    return t.page_index.postings.select("field", "term", "doc_id", F.col("tf").cast("bigint"))


@registered
def query_postings(t: Tables) -> DataFrame:
    """Point reads of all query terms at once."""
    terms = t.doc_batch.terms.select("qid", "term_bucket", "term")
    found = scoring.match(t.doc_index, t.doc_batch, "body", terms)
    return found.select("qid", "term", "doc_id", F.col("tf").cast("bigint"))


@registered
def query_postings_from_blocks(t: Tables) -> DataFrame:
    """As ``query_postings``, reading only the parts that the terms lie in."""
    found = blocks.matching_postings(t.doc_blocks, t.doc_batch, "body", Workspace(t.spark))
    return found.withColumn("tf", F.col("tf").cast("bigint"))


@registered
def stemmed_terms(t: Tables) -> DataFrame:
    terms = _doc_counts(t).groupBy("term").agg(F.count("*").alias("df"))
    return stemming.stem_vocabulary(terms)


@registered
def stemmed_search(t: Tables) -> DataFrame:
    """TF-IDF of stemmed queries on stemmed documents."""
    batch = scoring.query_batch(t.queries, t.stemmed_index)
    return ranked(ranking.top_k(scoring.tfidf(t.stemmed_index, batch, "body"), 10))


@registered
def stream_index(t: Tables) -> DataFrame:
    """Documents arrive in files, one in each batch; one batch is delivered twice."""
    workspace = Workspace(t.spark)
    live = LiveIndex(workspace, fan=3)
    t.docs.repartition(4, "doc_id").write.parquet(workspace.path("arriving"))
    stream = t.spark.readStream.schema(t.docs.schema).option("maxFilesPerTrigger", 1)
    take = live.take()

    def twice(batch: DataFrame, batch_id: int) -> None:
        take(batch, batch_id)
        if batch_id == 1:
            take(batch, batch_id)

    live.stream(
        stream.parquet(workspace.path("arriving")), workspace.path("stream_checkpoint"), take=twice
    ).awaitTermination()
    live.retire()
    return live.index().term_stats.select("term", "df", "term_total")


@registered
def replaced_documents(t: Tables) -> DataFrame:
    """Documents that are first indexed with a foreign text and then replaced by id."""
    live = LiveIndex(Workspace(t.spark), fan=2)
    old = t.docs.filter("doc_id % 2 = 0").withColumn("text", F.concat(F.lit("outdated words "), F.md5("text")))
    live.append({"body": old}, 0)
    live.append({"body": t.docs.filter("doc_id % 2 = 1")}, 1)
    live.fold()
    live.append({"body": t.docs.filter("doc_id % 2 = 0")}, 2, replace=True)
    index = live.index()
    return index.term_stats.select("term", "df", "term_total", index.corpus("body", "n_docs").alias("n_docs"))


# Scores


@registered
def idf(t: Tables) -> DataFrame:
    terms = t.doc_index.field_terms("body")
    n = t.doc_index.corpus("body", "n_docs")
    return terms.select("term", "df", F.round(text.idf(n, "df"), 6).alias("idf"))


@registered
def query_vector(t: Tables) -> DataFrame:
    vector = scoring.query_vector(t.doc_index, t.doc_batch, "body")
    return vector.select("qid", "term", "qtf", r6("weight"), r6("norm"))


@registered
def tfidf_topk(t: Tables) -> DataFrame:
    return ranked(ranking.top_k(scoring.tfidf(t.doc_index, t.doc_batch, "body"), 10))


@registered
def tfidf_topk_pruned(t: Tables) -> DataFrame:
    """As ``tfidf_topk``, without reading blocks that can't hold any of the best."""
    found = blocks.tfidf_top_k(t.doc_blocks, t.doc_batch, "body", 10, Workspace(t.spark))
    return ranked(found.ranked)


@registered
def bm25_topk_pruned(t: Tables) -> DataFrame:
    found = blocks.bm25_top_k(t.doc_blocks, t.doc_batch, "body", 100, Workspace(t.spark))
    return ranked(found.ranked)


@registered
def cosine_per_term(t: Tables) -> DataFrame:
    scores = scoring.cosine(t.doc_index, t.doc_batch, "body", mode="per_term")
    return ranked(ranking.top_k(scores, 100))


@registered
def cosine_full(t: Tables) -> DataFrame:
    return ranked(ranking.top_k(scoring.cosine(t.doc_index, t.doc_batch, "body"), 100))


@registered
def vector_cosine(t: Tables) -> DataFrame:
    """Cosine of all query and document vectors that share a term, without stored norms."""
    n = t.doc_index.corpus("body", "n_terms")
    weights = t.doc_index.term_stats.select("field", "term", "df", text.idf(n, "df").alias("idf"))
    size = t.doc_index.corpus_stats.select("n_terms", "n_postings").first()
    documents = join_vocabulary(t.doc_index.postings, weights, size.n_terms, size.n_postings)
    cosines = scoring.cosine_of_vectors(
        scoring.query_vector(t.doc_index, t.doc_batch, "body").select("qid", "term", "weight"),
        documents.select("doc_id", "term", (F.col("tf") * F.col("idf")).alias("weight")),
        "qid",
        "doc_id",
    )
    return cosines.select("qid", "doc_id", r6("cosine"))


@registered
def bm25_topk(t: Tables) -> DataFrame:
    return ranked(ranking.top_k(scoring.bm25(t.doc_index, t.doc_batch, "body"), 100))


@registered
def word_count(t: Tables) -> DataFrame:
    return scoring.word_count(t.doc_index, t.doc_batch, "body")


@registered
def tf_count(t: Tables) -> DataFrame:
    return scoring.tf_count(t.doc_index, t.doc_batch, "body")


@registered
def distinct_match_title(t: Tables) -> DataFrame:
    return t.searcher.search_title(t.queries)


@registered
def distinct_match_anchor(t: Tables) -> DataFrame:
    return t.searcher.search_anchor(t.queries)


@registered
def title_per_term(t: Tables) -> DataFrame:
    runs = t.searcher.search_title(t.queries, mode="per_term")
    return ranked(runs, "title")


@registered
def anchor_per_term(t: Tables) -> DataFrame:
    runs = t.searcher.search_anchor(t.queries, mode="per_term")
    return ranked(runs, "title")


@registered
def body_search(t: Tables) -> DataFrame:
    return ranked(t.searcher.search_body(t.queries), "title")


@registered
def results_per_query(t: Tables) -> DataFrame:
    """Queries without any result included."""
    return _result_counts(t.queries, scoring.tfidf(t.page_index, t.page_batch, "title"))


def _result_counts(queries: DataFrame, scores: DataFrame) -> DataFrame:
    """Counted map-side before the join, so a query with very many results is no hot key."""
    counts = scores.groupBy("qid").agg(F.count("*").alias("n_results"))
    kept = ranking.keep_all_queries(queries, counts)
    return kept.select("qid", F.coalesce("n_results", F.lit(0)).alias("n_results"))


@registered
def unusual_queries(t: Tables) -> DataFrame:
    """Three queries per item: blank, of stop words only, and with a word no page has."""
    kinds = F.array(F.lit("   "), F.lit("the of and"), F.concat(F.lit("zzqqxxunknown "), "query"))
    asked = t.queries.select("qid", F.posexplode(kinds).alias("kind", "_q")).select(
        (F.col("qid") * 3 + F.col("kind")).alias("qid"), F.col("_q").alias("query")
    )
    batch = scoring.query_batch(asked, t.page_index)
    return _result_counts(asked, scoring.distinct_match(t.page_index, batch, "title"))


@registered
def main_search(t: Tables) -> DataFrame:
    runs = t.searcher.search(t.queries, k=10)
    return ranked(runs, "title").withColumn("link", ranking.result_link())


@registered
def max_normalize(t: Tables) -> DataFrame:
    scores = scoring.tfidf(t.doc_index, t.doc_batch, "body")
    return scored(fusion.max_normalize(scores, bounded=t.doc_batch.bounded))


# Fusion


@registered
def fusion_two_field(t: Tables) -> DataFrame:
    return ranked(t.searcher.search_two_field(t.queries), "title")


@registered
def fusion_three_field(t: Tables) -> DataFrame:
    return ranked(t.searcher.search_three_field(t.queries), "title")


@registered
def fusion_weight_grid(t: Tables) -> DataFrame:
    runs = fusion.weight_grid_search(t.page_index, t.page_batch, t.signals, GRID, k=20)
    return ranked(runs.withColumn("setting", F.col("setting").cast("bigint")), "setting")


@registered
def hybrid_pagerank(t: Tables) -> DataFrame:
    return ranked(fusion.pagerank_hybrid(t.page_index, t.page_batch, t.page_rank))


# Derived inputs and lookups


@registered
def pageviews_month(t: Tables) -> DataFrame:
    return pages.page_views(t.read("events"), *MONTH)


@registered
def titles_extract(t: Tables) -> DataFrame:
    return pages.titles(spread(t.pages))


@registered
def anchors_extract(t: Tables) -> DataFrame:
    links = pages.synthetic_links(spread(t.pages))
    return links.select("page_id", F.col("pos").cast("bigint"), "target", "text")


def written_links(all_pages: DataFrame) -> DataFrame:
    """Six links on every page, to it and to another page, in the forms that links are written in."""
    after = all_pages.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("next"))
    both = all_pages.select("page_id", "url").join(after, "page_id")
    scheme, host = F.regexp_extract("next", "^([a-z]+):", 1), F.regexp_extract("next", "//([^/]*)", 1)
    rest, own = (F.regexp_extract(c, "^[a-z]+://[^/]*(/[^#]*)", 1) for c in ("next", "url"))
    port = F.when(scheme == "http", ":80").otherwise(":443")
    hrefs = F.array(
        F.concat(F.upper(scheme), F.lit("://"), F.upper(host), port, rest, F.lit("#part")),
        F.concat(F.lit("//"), host, rest),
        F.concat(F.lit(" "), scheme, F.lit("://"), host, F.lit("./none/&#46;&#x2e;"), F.replace(rest, F.lit("&"), F.lit("&amp;"))),
        F.lit("#here"),
        F.concat(F.lit("../../../.."), own),
        F.lit("mailto:someone@example.org"),
    )
    return both.select("page_id", F.posexplode(hrefs).alias("pos", "href"), F.lit("text").alias("text"))


@registered
def resolved_links(t: Tables) -> DataFrame:
    found = pages.resolve_links(written_links(t.pages), t.pages)
    return found.select("page_id", F.col("pos").cast("bigint"), "target")


@registered
def link_edges(t: Tables) -> DataFrame:
    return pages.link_edges(t.links)


@registered
def page_rank(t: Tables) -> DataFrame:
    return t.page_rank.select("doc_id", F.round("pagerank", 9).alias("pagerank"))


@registered
def page_rank_round_trip(t: Tables) -> DataFrame:
    """Page rank written as gzipped CSV files and read back."""
    folder = Workspace(t.spark).path("page_rank_files")
    ranks = t.page_rank.select("doc_id", "pagerank")
    ranks.write.option("compression", "gzip").csv(folder)
    back = read_page_rank(t.spark, folder)
    return back.select("doc_id", F.round("pagerank", 9).alias("pagerank"))


@registered
def page_rank_normalized(t: Tables) -> DataFrame:
    """Page rank from files, as a share of the largest one."""
    folder = Workspace(t.spark).path("page_rank_files")
    t.page_rank.select("doc_id", "pagerank").write.option("compression", "gzip").csv(folder)
    back = read_page_rank(t.spark, folder, normalize=True)
    return back.select("doc_id", F.round("pagerank", 9).alias("pagerank"))


@registered
def pagerank_lookup(t: Tables) -> DataFrame:
    found = lookups.pagerank_of(t.ids, t.page_rank)
    return found.select("pos", "doc_id", F.round("pagerank", 9).alias("pagerank"))


@registered
def pagerank_lookup_normalized(t: Tables) -> DataFrame:
    found = lookups.pagerank_of(t.ids, t.page_rank, normalized=True)
    return found.select("pos", "doc_id", r6("pagerank"))


@registered
def pageview_lookup(t: Tables) -> DataFrame:
    return lookups.pageviews_of(t.ids, t.page_views)


@registered
def title_lookup(t: Tables) -> DataFrame:
    return lookups.titles_of(t.ids, t.titles)


# Evaluation


@registered
def judgments(t: Tables) -> DataFrame:
    return t.judgments


@registered
def eval_hits(t: Tables) -> DataFrame:
    """Precision at every rank."""
    hits = evaluation.mark_hits(t.runs, t.judgments, DEPTH)
    return hits.select(
        "qid",
        F.col("rank").cast("bigint"),
        "doc_id",
        F.col("hit").cast("bigint"),
        F.round(F.col("hits_so_far") / F.col("rank"), 6).alias("precision"),
    )


@registered
def eval_p_at_k(t: Tables) -> DataFrame:
    return evaluation.precision_at_k(*t.evaluated, 5)


@registered
def eval_p_at_k_fixed(t: Tables) -> DataFrame:
    table = evaluation.query_report(*t.evaluated)
    return table.withColumns({c: F.array_join(c, ",") for c in ("hit_ids", "retrieved_ids")})


@registered
def report_round_trip(t: Tables) -> DataFrame:
    """The per-query records of a report, written as JSON and read back."""
    table, folder = evaluation.query_report(*t.evaluated), Workspace(t.spark).path("report")
    write_tables(table, evaluation.summarize(table), folder)
    back = t.spark.read.schema(table.schema).json(f"{folder}/per_query_json")
    return back.withColumns({c: F.array_join(c, ",") for c in ("hit_ids", "retrieved_ids")})


@registered
def judged_queries_round_trip(t: Tables) -> DataFrame:
    """The benchmark and its judgments written as one JSON object and read back."""
    folder = Workspace(t.spark).path("judged_queries")
    write_judged_queries(t.queries, t.judgments, folder)
    queries, judgments = read_judged_queries(t.spark, folder)
    ids = judgments.groupBy("qid").agg(F.array_join(F.array_sort(F.collect_list("doc_id")), ",").alias("ids"))
    return queries.join(ids, "qid", "left").select("qid", "query", F.coalesce("ids", F.lit("")).alias("ids"))


@registered
def judged_query_run(t: Tables) -> DataFrame:
    """The whole test: a judged-query file is read, searched, evaluated and reported."""
    workspace = Workspace(t.spark)
    write_judged_queries(t.queries, t.judgments, workspace.path("judged_queries"))
    per_query, _ = run_judged_queries(
        t.doc_index, workspace.path("judged_queries"), workspace, workspace.path("report")
    )
    return per_query.withColumns({c: F.array_join(c, ",") for c in ("hit_ids", "retrieved_ids")})


@registered
def eval_recall(t: Tables) -> DataFrame:
    return evaluation.recall_at_k(*t.evaluated, 30)


@registered
def eval_f1(t: Tables) -> DataFrame:
    return evaluation.f1_at_k(*t.evaluated, 30)


@registered
def eval_results_quality(t: Tables) -> DataFrame:
    return evaluation.results_quality(*t.evaluated)


@registered
def eval_ap(t: Tables) -> DataFrame:
    return evaluation.average_precision(*t.evaluated)


@registered
def eval_mrr(t: Tables) -> DataFrame:
    table = evaluation.reciprocal_rank(*t.evaluated)
    return table.agg(F.round(F.avg("reciprocal_rank"), 6).alias("mrr"))


@registered
def eval_ndcg(t: Tables) -> DataFrame:
    return evaluation.ndcg_at_k(*t.evaluated).select("qid", r6("ndcg"))


@registered
def eval_summary(t: Tables) -> DataFrame:
    summary = evaluation.summarize(evaluation.precision_at_fixed_k(*t.evaluated))
    return summary.select(
        *(r6(c) if kind == "double" else F.col(c) for c, kind in summary.dtypes)
    )


@registered
def eval_histogram(t: Tables) -> DataFrame:
    return evaluation.precision_histogram(evaluation.precision_at_fixed_k(*t.evaluated))


@registered
def eval_mean(t: Tables) -> DataFrame:
    means = evaluation.mean_metrics(*t.evaluated)
    return means.select(*(r6(c) for c in means.columns))
