import pytest
from pyspark.sql import functions as F

from rankloom.operators import index as ix
from rankloom.operators import judgments as judging
from rankloom.operators import lookups, pages
from rankloom.operators.judgments import containing_documents
from rankloom.operators.pagerank import pagerank
from rankloom.sources.workspace import Workspace


def power_iteration(nodes, edges, rounds, damping=0.85):
    n = len(nodes)
    rank = dict.fromkeys(nodes, 1 / n)
    out = {v: [d for s, d in edges if s == v] for v in nodes}
    for _ in range(rounds):
        dangling = sum(rank[v] for v in nodes if not out[v])
        new = dict.fromkeys(nodes, (1 - damping) / n + damping * dangling / n)
        for v in nodes:
            for d in out[v]:
                new[d] += damping * rank[v] / len(out[v])
        rank = new
    return rank


@pytest.mark.parametrize("shard", [1, 1_000_000])
@pytest.mark.parametrize(
    "edges",
    [
        [(0, 1), (1, 2), (2, 0), (3, 0), (0, 3)],
        [(0, 1), (0, 2), (0, 3), (1, 0), (2, 0)],  # 3 has no links
        [],
    ],
)
def test_pagerank(spark, workspace, edges, shard):
    vertices = spark.range(4).withColumnRenamed("id", "doc_id")
    table = spark.createDataFrame(edges, "src long, dst long")
    ranks = pagerank(vertices, table, workspace, rounds=4, links_per_shard=shard)
    got = {r.doc_id: r.pagerank for r in ranks.collect()}
    assert got == pytest.approx(power_iteration(range(4), edges, 4))
    assert sum(got.values()) == pytest.approx(1.0)


def test_pagerank_with_foreign_links(spark, workspace):
    vertices = spark.createDataFrame([(1,), (2,), (3,)], "doc_id long")
    table = spark.createDataFrame([(1, 2), (2, 1), (1, 99), (98, 3)], "src long, dst long")
    got = {r.doc_id: r.pagerank for r in pagerank(vertices, table, workspace, rounds=5).collect()}
    assert got.keys() == {1, 2, 3} and sum(got.values()) == pytest.approx(1.0)


HTML = (
    "<html><head><title>Some\nTitle</title><style>p{}</style><script>var t = '<p>';</script></head>"
    '<body><a href="/one">first link</a> text &amp; more <a href="/two" class="x">second</a>'
    "</body></html>"
)


@pytest.fixture
def html(spark):
    return spark.createDataFrame(
        [(0, "/one", HTML), (1, "/two", "<p>plain</p>"), (2, "/x", '<a href="/x">self</a>')],
        "page_id long, url string, html string",
    )


def test_fields_of_pages(html):
    assert [r.title for r in pages.titles(html).orderBy("doc_id").collect()] == [
        "Some\nTitle", None, None
    ]
    body = pages.body_text(html).orderBy("doc_id").first().text
    assert body.split() == "Some Title first link text more second".split()
    links = pages.anchors(html).orderBy("page_id", "pos").collect()
    assert [(r.page_id, r.pos, r.href, r.text) for r in links] == [
        (0, 0, "/one", "first link"), (0, 1, "/two", "second"), (2, 0, "/x", "self"),
    ]


def test_tags_in_any_form(spark):
    text = """<TITLE lang="en">Big</TITLE><a class='x' href="/y">one</a> <A HREF='/z'>two</A>
        <a data-href="/no">none</a>"""
    page = spark.createDataFrame([(1, "/u", text)], "page_id long, url string, html string")
    assert pages.titles(page).first().title == "Big"
    found = pages.anchors(page).orderBy("pos").collect()
    assert [(r.href, r.text) for r in found] == [("/y", "one"), ("/z", "two")]


def test_links(html):
    links = pages.resolve_links(pages.anchors(html), html)
    assert {(r.doc_id, r.text) for r in pages.anchor_text(links).collect()} == {
        (0, "first link"), (1, "second"), (2, "self"),
    }
    assert [tuple(r) for r in pages.link_edges(links).collect()] == [(0, 1)]
    targets = pages.synthetic_links(html).select("target").collect()
    assert len(targets) == 3 and all(0 <= r.target < 3 for r in targets)


def test_page_views_of_one_month(spark):
    events = spark.createDataFrame(
        [
            (1, "view", "2024-01-01 00:00:00"), (1, "view", "2024-01-31 23:59:59"),
            (1, "view", "2024-02-01 00:00:00"), (1, "click", "2024-01-05 00:00:00"),
            (2, "view", "2023-12-31 23:59:59"),
        ],
        "user_id long, event_type string, ts string",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    rows = pages.page_views(events, "2024-01-01", "2024-02-01").collect()
    assert [(r.doc_id, r.views) for r in rows] == [(1, 2)]


@pytest.mark.parametrize("bounded", [True, False])
def test_lookups_keep_order_and_duplicates(spark, bounded):
    lists = spark.createDataFrame([(["3", "1", "3", "no", "8"],)], "ids array<string>")
    ids = lookups.ids_table(lists)
    ranks = spark.createDataFrame([(1, 0.2), (3, 0.4)], "doc_id long, pagerank double")
    views = spark.createDataFrame([(8, 11)], "doc_id long, views long")
    titles = spark.createDataFrame([(3, "Three")], "doc_id long, title string")

    def values(df, column):
        return [r[column] for r in df.collect()]

    assert values(lookups.pagerank_of(ids, ranks, bounded=bounded), "pagerank") == [
        0.4, 0.2, 0.4, 0.0, 0.0
    ]
    assert values(lookups.pagerank_of(ids, ranks, True, bounded), "pagerank") == [1, 0.5, 1, 0, 0]
    assert values(lookups.pageviews_of(ids, views, bounded), "views") == [0, 0, 0, 0, 11]
    assert values(lookups.titles_of(ids, titles, bounded), "title") == [
        "Three", None, "Three", None, None
    ]
    empty = lookups.ids_table(spark.createDataFrame([([],)], "ids array<string>"))
    assert lookups.pagerank_of(empty, ranks, bounded=bounded).count() == 0


@pytest.mark.parametrize("limits", [None, (40, 0)])
def test_containing_documents_equals_brute_force(spark, monkeypatch, limits):
    if limits:
        monkeypatch.setattr(judging, "AUTOMATON_BYTES", limits[0])
        monkeypatch.setattr(judging, "BROADCAST_ROWS", limits[1])
    passages = {
        0: "quick brown foxes jump over",
        1: "lazy dogs\nsleep deeply today",
        2: "Brown foxes Jump over",
        3: "nowhere written words here",
        4: "over common common over",
        5: "foxes jump",
        6: "common",
        7: "is it and that is",
        8: "sleep deep",
        9: None,
        10: "",
        11: "the",
        12: "is it and that is",
        13: ", ",
        14: "it and",
    }
    docs = {
        0: "the quick brown foxes jump over fences",
        1: "xquick brown foxes jump overx",
        2: "some lazy dogs\nsleep deeply today. " * 3,
        3: "quick brown foxes, jump over",
        4: "over common common over common",
        5: "common",
        6: "",
        7: "so is it and that is, they say",
        8: None,
        9: "é, the " * 50_000 + "is it and that",
    }
    documents = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    asked = spark.createDataFrame(list(passages.items()), "qid long, query string")
    index = ix.build_index({"body": documents}, Workspace(spark))
    table = containing_documents(asked, documents, index, Workspace(spark))
    assert "NestedLoop" not in table._jdf.queryExecution().executedPlan().toString()
    found = table.collect()
    assert sorted((r.qid, r.doc_id) for r in found) == sorted(
        (q, d) for q, p in passages.items() for d, t in docs.items() if None not in (p, t) and p in t
    )
