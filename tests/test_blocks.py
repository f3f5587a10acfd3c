"""Block layout: equal results from fewer parts, rows and postings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.operators import blocks as layout
from rankloom.operators import scoring
from rankloom.operators.index import build_index
from rankloom.operators.ranking import top_k
from rankloom.sources.workspace import Workspace


@pytest.fixture(scope="module")
def corpus(spark):
    """Topics of neighbouring documents, a word in every document, rare words, an id added twice."""
    rng = np.random.default_rng(9)
    rows = []
    for k in range(1200):
        words = [f"topic{k // 60}x{w}" for w in rng.integers(0, 12, rng.integers(1, 30))]
        words += ["common"] * int(rng.integers(1, 9)) + [f"word{w}" for w in rng.zipf(1.4, 10) if w < 400]
        rows.append((k * 3, " ".join(words)))
    rows += [(9, "common rareone"), (30, "common topic0x1 topic0x1"), (30, "common topic0x1"), (7, ""), (8, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)


@pytest.fixture(scope="module")
def built(spark, corpus):
    workspace = Workspace(spark)
    index = build_index({"body": corpus, "title": corpus.filter("doc_id < 300")}, workspace, buckets=3)
    return index, layout.build_blocks(index, workspace, block_docs=8, part_bytes=16_000)


QUERIES = [
    (0, "topic3x1 topic3x2 common"), (1, "common"), (2, "rareone"), (3, "topic0x1 word1 word2 word2"),
    (4, "unknownword"), (5, ""), (6, "topic7x1 topic12x4 word30 common common"),
]


def batch_of(spark, index, rows=QUERIES, **more):
    return scoring.query_batch(spark.createDataFrame(rows, "qid bigint, query string"), index, **more)


def rounded(rows):
    return sorted((r.qid, r["rank"], r.doc_id, round(r.score, 9)) for r in rows.collect())


@pytest.mark.parametrize("k,near", [(1, 0), (10, 250_000)])
def test_equal_to_full_scores(spark, built, monkeypatch, k, near):
    monkeypatch.setattr(layout, "BROADCAST_ROWS", near)
    monkeypatch.setattr(layout, "LITERALS", 1000 if near else 0)
    index, blocks = built
    batch = batch_of(spark, index)
    for full, pruned in (
        (scoring.tfidf(index, batch, "body"), layout.tfidf_top_k(blocks, batch, "body", k, Workspace(spark))),
        (scoring.bm25(index, batch, "body"), layout.bm25_top_k(blocks, batch, "body", k, Workspace(spark))),
    ):
        assert rounded(pruned.ranked) == rounded(top_k(full, k))
        assert pruned.read < pruned.postings


def test_more_than_there_are(spark, built):
    index, blocks = built
    batch = batch_of(spark, index)
    found = layout.tfidf_top_k(blocks, batch, "title", 5000, Workspace(spark))
    assert rounded(found.ranked) == rounded(top_k(scoring.tfidf(index, batch, "title"), 5000))


def test_topics_are_found_in_few_blocks(spark, built):
    index, blocks = built
    batch = batch_of(spark, index, [(0, "topic3x1 topic3x2 common"), (1, "topic9x5 topic9x7 common")])
    found = layout.tfidf_top_k(blocks, batch, "body", 5, Workspace(spark))
    assert found.read < 0.25 * found.postings


def test_postings(spark, built):
    index, blocks = built
    batch = batch_of(spark, index)
    got = layout.matching_postings(blocks, batch, "body", Workspace(spark))
    want = scoring.match(index, batch, "body", batch.terms).select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def scans(df):
    """(directories, rows) that the file scans of an executed plan have read."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    df.sparkSession.sparkContext._jvm.java.lang.System.gc()
    while todo:
        node = todo.pop()
        metrics = node.metrics()
        if metrics.contains("numPartitions") and metrics.contains("numOutputRows"):
            out.append((metrics.apply("numPartitions").value(), metrics.apply("numOutputRows").value()))
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


def test_a_rare_word_reads_a_small_part(spark, built):
    index, blocks = built
    total = blocks.skips.filter("field = 'body'").count()
    batch = batch_of(spark, index, [(0, "rareone")])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = layout.matching_postings(blocks, batch, "body", Workspace(spark))
        assert [(r.doc_id, r.tf) for r in found.collect()] == [(9, 1)]
        read = [s for s in scans(found) if s[0] > 0]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert blocks.parts > 8
    assert read and max(d for d, _ in read) == 1
    assert sum(rows for _, rows in read) < total / blocks.parts * 3


def test_wide_terms_are_spread_by_documents(built):
    _, blocks = built
    parts = blocks.skips.filter("field = 'body' and term = 'common'").groupBy("part").agg(
        F.min("block").alias("low"), F.max("block").alias("high"), F.sum("n").alias("n")
    ).orderBy("low").collect()
    assert len(parts) > 1 and max(p.n for p in parts) * layout.POSTING_BYTES < 2 * 16_000
    assert all(a.high < b.low for a, b in zip(parts, parts[1:]))
    narrow = blocks.skips.filter("field = 'body' and term = 'rareone'").select("part", "home").distinct().collect()
    assert len(narrow) == 1 and narrow[0].part == narrow[0].home


def test_open(spark, built):
    index, blocks = built
    root = blocks.blocks.inputFiles()[0].split("/blocks/")[0]
    again = layout.open_blocks(spark, root, index)
    assert (again.parts, again.width) == (blocks.parts, blocks.width)
    assert again.skips.count() == blocks.skips.count()


@pytest.mark.parametrize("near", [0, 60])
def test_many_blocks_of_few_terms_stay_in_place(spark, built, monkeypatch, near):
    """More blocks are wanted than can be broadcast; only terms beyond the limit move blocks."""
    monkeypatch.setattr(layout, "BROADCAST_ROWS", near)
    index, blocks = built
    batch = batch_of(spark, index, [*QUERIES, (0, "topic3x1 topic3x2 common")])
    terms = [r.term for r in batch.terms.select("term").distinct().collect()]
    assert blocks.skips.filter(F.col("term").isin(terms) & (F.col("field") == "body")).count() > 60
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = layout.matching_postings(blocks, batch, "body", Workspace(spark))
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("Exchange hashpartitioning" in plan) == (near == 0)
    want = scoring.match(index, batch, "body", batch.terms).select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_blocks_are_gathered_across_batches(spark, corpus, built, monkeypatch):
    index, wanted = built
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        blocks = layout.build_blocks(index, Workspace(spark), block_docs=8, part_bytes=16_000)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    lengths = {(r.field, r.doc_id): r.doc_len for r in index.doc_stats.collect()}
    lists = {}
    for r in index.postings.collect():
        key = r.field, r.term, r.doc_id // blocks.width
        lists.setdefault(key, []).append((r.doc_id, r.tf, lengths[r.field, r.doc_id]))
    expected = {
        key: (sorted(p), len(p), len(p) - len({d for d, _, _ in p}) + 1, max(t for _, t, _ in p), min(n for *_, n in p))
        for key, p in lists.items()
    }
    for built_now in (blocks, wanted):
        skips = {
            (r.field, r.term, r.block): (r.n, r.copies, r.max_tf, r.min_len) for r in built_now.skips.collect()
        }
        rows = built_now.blocks.collect()
        assert len(rows) == len(expected)
        assert {
            (key := (r.field, r.term, r.block)): (list(map(tuple, r.postings)), *skips[key]) for r in rows
        } == expected
    assert max(v[2] for v in expected.values()) == 3


def test_files_of_blocks_lie_in_the_order_of_their_terms(spark, built):
    _, blocks = built
    keys = blocks.blocks.select(F.input_file_name().alias("file"), "term", "block").collect()
    by_file = {}
    for r in keys:
        by_file.setdefault(r.file, []).append((r.term, r.block))
    assert len(by_file) >= blocks.parts and all(rows == sorted(rows) for rows in by_file.values())


def test_postings_move_once_to_their_blocks(spark, built, tmp_path):
    """One shuffle of postings, also for a single field, whose name is a constant to the planner."""
    index, _ = built
    seen = []
    frame = type(index.postings)
    original = frame.mapInArrow

    def watched(self, function, schema, *more):
        if function is layout._gathered:
            seen.append(self._jdf.queryExecution().executedPlan().toString())
        return original(self, function, schema, *more)

    docs = spark.createDataFrame([(k, f"common word{k % 5}") for k in range(60)], "doc_id bigint, text string")
    single = build_index({"body": docs}, Workspace(spark), buckets=3)
    frame.mapInArrow = watched
    try:
        built_now = layout.build_blocks(single, Workspace(spark), block_docs=8, part_bytes=400)
    finally:
        frame.mapInArrow = original
    assert len(seen) == 1 and sum("Exchange" in x and "Broadcast" not in x for x in seen[0].splitlines()) == 1
    assert built_now.skips.agg(F.sum("n")).first()[0] == 120
