import pytest
from brute import Corpus, ranked
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankloom.operators import index as ix
from rankloom.operators import joins, ranking, scoring
from rankloom.sources.workspace import Workspace


@pytest.fixture(scope="module")
def setting(spark, small_corpus):
    docs, queries = small_corpus
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    index = ix.build_index({"body": table}, Workspace(spark))
    asked = spark.createDataFrame(list(queries.items()), "qid long, query string")
    return index, asked, Corpus(docs), queries


SCORERS = {
    "tfidf": (lambda i, b: scoring.tfidf(i, b, "body"), Corpus.tfidf),
    "bm25": (lambda i, b: scoring.bm25(i, b, "body"), Corpus.bm25),
    "bm25_set": (
        lambda i, b: scoring.bm25(i, b, "body", k1=1.5, b=0.4),
        lambda c, q: c.bm25(q, 1.5, 0.4),
    ),
    "per_term": (lambda i, b: scoring.cosine(i, b, "body", "per_term"), Corpus.per_term),
    "full": (lambda i, b: scoring.cosine(i, b, "body"), Corpus.full),
    "words": (lambda i, b: scoring.word_count(i, b, "body"), Corpus.word_count),
    "tf": (lambda i, b: scoring.tf_count(i, b, "body"), Corpus.tf_count),
    "distinct": (lambda i, b: scoring.distinct_match(i, b, "body"), Corpus.distinct),
}


def collected(scores):
    return {(r.qid, r.doc_id): float(r.score) for r in scores.collect()}


@pytest.mark.parametrize("limit", [1000, 0], ids=["broadcast", "shuffled"])
@pytest.mark.parametrize("name", SCORERS)
def test_scorer_equals_brute_force(setting, monkeypatch, name, limit):
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 2)  # makes several terms hot
    index, asked, corpus, queries = setting
    ours, brute = SCORERS[name]
    batch = scoring.query_batch(asked, index, limit)
    assert batch.bounded == bool(limit)
    expected = {
        (qid, doc): score
        for qid, query in queries.items()
        for doc, score in brute(corpus, query).items()
    }
    assert collected(ours(index, batch)) == pytest.approx(expected)


def test_batch_is_the_union_of_single_queries(setting):
    index, asked, _, queries = setting
    together = collected(scoring.bm25(index, scoring.query_batch(asked, index), "body"))
    alone = {}
    for qid in (0, 1, 7):
        batch = scoring.query_batch(asked.filter(F.col("qid") == qid), index)
        alone |= collected(scoring.bm25(index, batch, "body"))
    assert {k: v for k, v in together.items() if k[0] in (0, 1, 7)} == pytest.approx(alone)


def test_posting_without_length_is_dropped(spark, setting):
    from dataclasses import replace

    index, asked, corpus, _ = setting
    short = replace(index, doc_stats=index.doc_stats.filter("doc_id <> 3"))
    found = collected(scoring.bm25(short, scoring.query_batch(asked, index), "body"))
    assert found and all(doc != 3 for _, doc in found)


def test_other_corpus_size(setting):
    index, asked, corpus, queries = setting
    batch = scoring.query_batch(asked.filter("qid = 5"), index)
    scores = collected(scoring.tfidf(index, batch, "body", n=F.lit(600)))
    assert scores[(5, 1)] == pytest.approx(2.0)


def test_top_k_breaks_ties_by_id(setting):
    index, asked, corpus, queries = setting
    batch = scoring.query_batch(asked, index)
    runs = ranking.top_k(scoring.tfidf(index, batch, "body"), 2).collect()
    for qid, query in queries.items():
        got = [r.doc_id for r in sorted(runs, key=lambda r: r["rank"]) if r.qid == qid]
        assert got == [doc for doc, _ in ranked(corpus.tfidf(query), 2)]


def test_queries_without_results_are_kept(spark, setting):
    index, asked, _, _ = setting
    runs = ranking.top_k(scoring.tfidf(index, scoring.query_batch(asked, index), "body"), 2)
    kept = ranking.keep_all_queries(asked, runs)
    empty = {r.qid for r in kept.filter("doc_id is null").collect()}
    assert empty == {3, 4, 6}


def test_titles_and_links(spark):
    results = spark.createDataFrame([(0, 1, 1.0), (0, 2, 0.5)], "qid long, doc_id long, score double")
    titles = spark.createDataFrame([(1, "One")], "doc_id long, title string")
    for bounded in (True, False):
        rows = ranking.attach_titles(results, titles, bounded).collect()
        assert {r.doc_id: r.title for r in rows} == {1: "One", 2: None}
    named = ranking.attach_titles(results, titles, True, placeholder=True)
    named = named.withColumn("link", ranking.result_link()).collect()
    assert {r.doc_id: r.title for r in named} == {1: "One", 2: "Article 2"}
    assert {r.link for r in named} == {
        "https://en.wikipedia.org/?curid=1", "https://en.wikipedia.org/?curid=2"
    }


def test_stemmed_index_stems_queries(spark):
    docs = spark.createDataFrame([(1, "hopping"), (2, "cats")], "doc_id long, text string")
    index = ix.build_index({"body": docs}, Workspace(spark), analyzer="stemmed")
    asked = spark.createDataFrame([(0, "hopped hop hopping")], "qid long, query string")
    batch = scoring.query_batch(asked, index)
    assert collected(scoring.word_count(index, batch, "body")) == {(0, 1): 3.0}


def test_cosine_of_vectors(spark):
    left = spark.createDataFrame(
        [(1, "a", 3.0), (1, "b", 4.0), (2, "c", 0.0)], "l long, term string, weight double"
    )
    right = spark.createDataFrame(
        [(5, "a", 1.0), (6, "b", 2.0), (6, "z", 2.0), (7, "c", 1.0)],
        "r long, term string, weight double",
    )
    rows = scoring.cosine_of_vectors(left, right, "l", "r").collect()
    assert {(r.l, r.r): r.cosine for r in rows} == pytest.approx(
        {(1, 5): 0.6, (1, 6): 8 / (5 * 8**0.5), (2, 7): 0.0}
    )


def test_bounded_scoring_moves_only_the_best(setting):
    """Documents are scored where their postings lie; the one shuffle is that of the top lists."""
    index, asked, _, _ = setting
    batch = scoring.query_batch(asked, index)
    for scores in (scoring.tfidf(index, batch, "body"), scoring.bm25(index, batch, "body")):
        runs = ranking.top_k(scores, 3)
        plan = runs._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        assert "WindowGroupLimit" in plan and "dynamicpruning" in plan
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


words = st.sampled_from(["apple", "banana", "cherry", "durian", "elder", "common", "zzz"])


@settings(max_examples=4, deadline=None)
@given(
    st.lists(st.lists(words, max_size=8), min_size=1, max_size=6),
    st.lists(st.lists(words, max_size=4), min_size=1, max_size=3),
)
def test_random_corpora(spark, docs, queries):
    docs = {i: " ".join(d) for i, d in enumerate(docs)}
    queries = {i: " ".join(q) for i, q in enumerate(queries)}
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    index = ix.build_index({"body": table}, Workspace(spark), buckets=2, term_buckets=2)
    asked = spark.createDataFrame(list(queries.items()), "qid long, query string")
    batch, corpus = scoring.query_batch(asked, index), Corpus(docs)
    for name in ("bm25", "per_term", "full"):
        ours, brute = SCORERS[name]
        expected = {
            (qid, doc): score
            for qid, query in queries.items()
            for doc, score in brute(corpus, query).items()
        }
        assert collected(ours(index, batch)) == pytest.approx(expected, abs=1e-12)
