import math

import pytest
from brute import Corpus, ranked

from rankloom.operators import fusion, scoring
from rankloom.operators import index as ix
from rankloom.plans.search import Searcher
from rankloom.sources.workspace import Workspace

PAGES = {
    1: ("apple pie recipes", "apple banana cherry apple"),
    2: ("banana bread", "banana banana bread apple"),
    3: ("cherry", "cherry cherry pie"),
    4: ("durian", "smelly fruit"),
}
ANCHORS = [(1, "apple pie"), (1, "apple"), (2, "best banana"), (9, "apple link nowhere")]
RANK = {1: 0.5, 2: 0.25, 4: 0.25}
VIEWS = {2: 10, 3: 5}
QUERIES = {0: "apple pie", 1: "banana banana cherry", 2: "smelly", 3: "missing"}


@pytest.fixture(scope="module")
def setting(spark):
    def table(rows):
        return spark.createDataFrame(rows, "doc_id long, text string")

    fields = {
        "body": table([(i, p[1]) for i, p in PAGES.items()]),
        "title": table([(i, p[0]) for i, p in PAGES.items()]),
        "anchor": table(ANCHORS),
    }
    index = ix.build_index(
        fields, Workspace(spark), n_docs=dict.fromkeys(fields, 4), merge=("anchor",)
    )
    signals = fusion.Signals(
        spark.createDataFrame(list(RANK.items()), "doc_id long, pagerank double"),
        spark.createDataFrame(list(VIEWS.items()), "doc_id long, views long"),
    )
    asked = spark.createDataFrame(list(QUERIES.items()), "qid long, query string")
    titles = spark.createDataFrame(
        [(i, p[0]) for i, p in PAGES.items()], "doc_id long, title string"
    )
    return index, signals, asked, titles


BODY = Corpus({i: p[1] for i, p in PAGES.items()})
TITLE = Corpus({i: p[0] for i, p in PAGES.items()})
ANCHOR = Corpus({1: "apple pie apple", 2: "best banana", 9: "apple link nowhere", 4: ""})


def normalized(scores, k=500):
    cut = ranked(scores, k)
    best = cut[0][1] if cut else 0
    return {doc: score / best if best else 0.0 for doc, score in cut}


def fused(parts, w):
    found = {}
    for doc in set().union(*(p for p, _ in parts)):
        score = sum(p.get(doc, 0) * weight for p, weight in parts)
        score += RANK.get(doc, 0) / 0.5 * w.pagerank + VIEWS.get(doc, 0) / 10 * w.pageviews
        found[doc] = score
    return ranked(found, 100)


def check(runs, expected):
    got = {}
    for r in sorted(runs.collect(), key=lambda r: (r.qid, r["rank"])):
        got.setdefault(r.qid, []).append((r.doc_id, r.score))
    for qid in QUERIES:
        assert [d for d, _ in got.get(qid, [])] == [d for d, _ in expected[qid]]
        assert [s for _, s in got.get(qid, [])] == pytest.approx([s for _, s in expected[qid]])


@pytest.mark.parametrize("limit", [1000, 0], ids=["broadcast", "shuffled"])
@pytest.mark.parametrize("cut", [500, 1])
def test_two_field(setting, limit, cut):
    index, signals, asked, _ = setting
    batch = scoring.query_batch(asked, index, limit)
    w = fusion.TwoField().weights
    expected = {
        qid: fused(
            [(normalized(BODY.bm25(q, 1.2, 0.6), cut), w.text),
             (normalized(TITLE.bm25(q, 1.5, 0.4), cut), w.title)],
            w,
        )
        for qid, q in QUERIES.items()
    }
    check(fusion.two_field_search(index, batch, signals, candidates=cut), expected)


def three_field_expected(w):
    return {
        qid: fused(
            [(normalized(BODY.bm25(q, 1.2, 0.5)), w.text),
             (normalized(TITLE.word_count(q)), w.title),
             (normalized(ANCHOR.word_count(q)), w.anchor)],
            w,
        )
        for qid, q in QUERIES.items()
    }


def test_three_field_and_grid(setting):
    index, signals, asked, _ = setting
    batch = scoring.query_batch(asked, index)
    check(fusion.three_field_search(index, batch, signals), three_field_expected(fusion.Weights()))
    grid = [fusion.Weights(), fusion.Weights(0.1, 0.2, 0.3, 0.4, 0.5)]
    runs = fusion.weight_grid_search(index, batch, signals, grid)
    for i, weights in enumerate(grid):
        check(runs.filter(f"setting = {i}"), three_field_expected(weights))


def test_max_normalize_guards_zero(spark):
    scores = spark.createDataFrame(
        [(0, 1, 4.0), (0, 2, 1.0), (1, 1, 0.0)], "qid long, doc_id long, score double"
    )
    for bounded in (True, False):
        rows = fusion.max_normalize(scores, bounded=bounded).collect()
        assert {(r.qid, r.doc_id): r.score for r in rows} == {
            (0, 1): 1.0, (0, 2): 0.25, (1, 1): 0.0
        }


def test_hybrid(setting):
    index, signals, asked, _ = setting
    batch = scoring.query_batch(asked, index)
    expected = {
        qid: ranked(
            {d: 0.8 * s + 0.2 * math.log1p(RANK.get(d, 0)) for d, s in BODY.tfidf(q).items()}, 100
        )
        for qid, q in QUERIES.items()
    }
    check(fusion.pagerank_hybrid(index, batch, signals.page_rank), expected)


def test_services(setting):
    index, signals, asked, titles = setting
    searcher = Searcher(index, titles, signals)
    first = searcher.search(asked, k=1).filter("qid = 2").collect()
    assert [(r["rank"], r.doc_id, r.title) for r in first] == [(1, 4, "durian")]
    by_title = searcher.search_title(asked).collect()
    assert [(r.qid, r.doc_id, r.score) for r in by_title] == [
        (0, 1, 2), (1, 2, 1), (1, 3, 1),
    ]
    by_anchor = searcher.search_anchor(asked).filter("qid = 0").collect()
    assert [(r.doc_id, r.title, r.score) for r in by_anchor] == [
        (1, "apple pie recipes", 2), (9, None, 1),
    ]
    for mode in ("full", "per_term"):
        assert searcher.search_body(asked, mode).filter("qid = 0").count() == 3
    assert searcher.search_title(asked, "per_term").count() == 3
    assert searcher.search_two_field(asked).columns == ["qid", "rank", "doc_id", "title", "score"]
    assert searcher.search_three_field(asked, k=1).filter("rank > 1").count() == 0
    with pytest.raises(ValueError):
        searcher.search_title(asked, "other")


def test_large_batch_reads_postings_a_few_times(setting, monkeypatch):
    """Beyond every limit: equal results, and a plan that doesn't repeat its inputs."""
    from rankloom.operators import joins

    index, signals, asked, _ = setting
    small = scoring.query_batch(asked, index)
    expected = sorted(map(tuple, fusion.two_field_search(index, small, signals).collect()))
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 1)
    monkeypatch.setattr(fusion, "SHUFFLE_ROWS", 0)
    large = scoring.query_batch(asked, index, limit=0)
    wide = fusion.side_by_side(
        {
            name: fusion.best_candidates(scoring.bm25(index, large, field, 1.2, 0.6))
            for name, field in (("text", "body"), ("title", "title"))
        }
    )
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert 0 < plan.count("_postings[") <= 4 and plan.count("Exchange hashpartitioning") < 20
    found = fusion.two_field_search(index, large, signals)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") < 20 and plan.count("FileScan") < 20
    got = sorted(map(tuple, found.collect()))
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    assert [g[3] for g in got] == pytest.approx([e[3] for e in expected])
