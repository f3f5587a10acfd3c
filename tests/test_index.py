from collections import Counter

import pytest
from brute import Corpus
from pyspark.sql import functions as F

from brute_stemmer import stem_word
from rankloom.operators import index as ix
from rankloom.operators import joins
from rankloom.operators.joins import join_vocabulary, lookup_join, spread_join
from rankloom.sources import workspace as folders
from rankloom.sources.workspace import Workspace, exists


@pytest.fixture(scope="module")
def built(spark, small_corpus):
    docs = spark.createDataFrame(list(small_corpus[0].items()), "doc_id long, text string")
    return ix.build_index({"body": docs}, Workspace(spark)), Corpus(small_corpus[0])


def test_tables_equal_definition(built):
    index, corpus = built
    postings = {(r.doc_id, r.term): r.tf for r in index.postings.collect()}
    assert postings == {(d, t): n for d, c in corpus.tf.items() for t, n in c.items()}
    terms = {r.term: (r.df, r.term_total) for r in index.term_stats.collect()}
    totals = sum(corpus.tf.values(), Counter())
    assert terms == {t: (n, totals[t]) for t, n in corpus.df.items()}
    assert {r.doc_id: r.doc_len for r in index.doc_stats.collect()} == corpus.length
    stats = index.corpus_stats.first()
    assert (stats.n_docs, stats.n_terms) == (corpus.n_docs, len(corpus.df))
    assert stats.avg_len == pytest.approx(corpus.average)


def test_buckets_hold_bounded_text(spark, built, small_corpus, monkeypatch):
    monkeypatch.setattr(folders, "BUCKET_BYTES", 16)
    docs = spark.createDataFrame(list(small_corpus[0].items()), "doc_id long, text string").coalesce(1)
    size = sum(len(x or "") for x in small_corpus[0].values())
    workspace = Workspace(spark)
    index = ix.build_index({"body": docs}, workspace)
    assert spark.read.json(workspace.path("manifest")).first().buckets == -(-size // 16) > 4
    columns = ["field", "term", "doc_id", "tf"]
    assert sorted(index.postings.select(*columns).collect()) == sorted(built[0].postings.select(*columns).collect())


def test_point_read(built):
    index, _ = built
    assert {r.doc_id for r in ix.read_postings(index, "body", "cherry").collect()} == {2, 3, 6}
    assert ix.read_postings(index, "body", "nothing").count() == 0


def test_point_read_prunes_directories(built):
    index, _ = built
    plan = ix.read_postings(index, "body", "cherry")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(field" in plan
    assert "(term_bucket#" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_posting_lists_are_bounded_and_whole(spark):
    ids = [1, 70_000, 65_535, 65_536, 200_000]
    postings = spark.createDataFrame([("x", i, 2) for i in ids], "term string, doc_id long, tf int")
    lists = ix.posting_lists(postings).orderBy("block").collect()
    assert [r.block for r in lists] == [0, 1, 3]
    assert [p.doc_id for r in lists for p in r.postings] == sorted(ids)


def test_readding_an_id_counts_twice_unless_merged(spark, workspace):
    docs = spark.createDataFrame([(1, "apple pear"), (1, "apple")], "doc_id long, text string")
    twice = ix.count_terms({"body": docs})
    assert {r.term: r.df for r in ix.term_statistics(twice).collect()} == {"apple": 2, "pear": 1}
    merged = ix.count_terms({"anchor": docs}, merge=("anchor",))
    assert {(r.term, r.tf) for r in merged.collect()} == {("apple", 2), ("pear", 1)}


def test_reopen(spark, built, small_corpus):
    docs = spark.createDataFrame(list(small_corpus[0].items()), "doc_id long, text string")
    workspace = Workspace(spark)
    ix.build_index({"body": docs}, workspace)
    for name in ("postings", "doc_stats", "doc_norms"):
        spark.sql(f"DROP TABLE {workspace.table_name(name)}")
    again = ix.open_index(spark, workspace.root)
    columns = ["field", "term_bucket", "term", "doc_id", "tf"]
    assert sorted(again.postings.select(*columns).collect()) == sorted(
        built[0].postings.select(*columns).collect()
    )
    assert again.doc_norms.count() == built[0].doc_norms.count()
    plan = again.postings.groupBy("doc_id").count()._jdf.queryExecution().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan


def test_norms_are_left_to_the_first_cosine(spark, built, small_corpus, workspace):
    docs = spark.createDataFrame(list(small_corpus[0].items()), "doc_id long, text string")
    index = ix.build_index({"body": docs}, workspace, norms=False)
    assert not exists(spark, workspace.path("doc_norms"))

    def rows(norms):
        return sorted((r.doc_id, round(r.doc_norm, 9)) for r in norms.collect())

    expected = rows(built[0].field_norms("body"))
    again = ix.open_index(spark, workspace.root)
    assert again.doc_norms is None and rows(again.field_norms("body")) == expected
    assert not exists(spark, workspace.path("doc_norms"))
    assert rows(index.field_norms("body")) == expected
    assert exists(spark, workspace.path("doc_norms")) and index.norms is index.norms


def test_stemmed_index_merges_terms(spark, workspace):
    docs = spark.createDataFrame(
        [(1, "hopping hops hopped"), (2, "running hop")], "doc_id long, text string"
    )
    index = ix.build_index({"body": docs}, workspace, analyzer="stemmed")
    assert stem_word("hopping") == "hop"
    assert {(r.doc_id, r.term): r.tf for r in index.postings.collect()} == {
        (1, "hop"): 3, (2, "hop"): 1, (2, "run"): 1,
    }


def _skewed(spark, rows=6000):
    """A third of all postings belong to one term."""
    return spark.range(rows).select(
        F.lit("body").alias("field"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 700))
        .alias("term"),
        F.col("id").alias("doc_id"),
        F.lit(1).alias("tf"),
    )


def test_vocabulary_join_is_the_same_above_the_limit(spark):
    postings = _skewed(spark)
    vocabulary = ix.term_statistics(postings).withColumn("v", F.hash("term")).drop("term_total")
    n_terms = vocabulary.count()
    whole = join_vocabulary(postings, vocabulary, n_terms, 6000)
    split = join_vocabulary(postings, vocabulary, n_terms, 6000, limit=50)
    columns = ["doc_id", "term", "v"]
    assert sorted(whole.select(*columns).collect()) == sorted(split.select(*columns).collect())
    assert whole.count() == 6000


def test_norms_are_the_same_above_the_limit(spark, monkeypatch):
    postings = _skewed(spark)
    stats = ix.term_statistics(postings)
    sizes = {"body": stats.count()}
    whole = ix.document_norms(postings, stats, sizes, 6000).collect()
    monkeypatch.setattr(
        ix, "join_vocabulary",
        lambda p, v, terms, n: join_vocabulary(p, v, terms, n, limit=50),
    )
    assert sorted(ix.document_norms(postings, stats, sizes, 6000).collect()) == sorted(whole)


def test_hot_keys_are_few_and_only_the_large_ones(spark, monkeypatch):
    counts = spark.createDataFrame([("a", 100), ("b", 7), ("c", 10)], "k string, n long")
    assert [tuple(r) for r in joins.hot_keys(counts, ["k"], rows_per_task=10).collect()] == [
        ("a", 10)
    ]
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 2)
    assert [tuple(r) for r in joins.hot_keys(counts, ["k"], rows_per_task=1).collect()] == [
        ("a", 2)
    ]


@pytest.mark.parametrize("both", [True, False])
def test_spread_join_keeps_every_row(spark, monkeypatch, both):
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 100)
    left = _skewed(spark)
    right = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "t5").otherwise(F.concat(F.lit("t"), F.col("id") % 50))
        .alias("term"),
        F.col("id").alias("qid"),
    ).unionByName(spark.createDataFrame([("hot", 1000), ("hot", 1001)], "term string, qid long"))
    columns = ["doc_id", "term", "qid"]
    plain = left.join(right, "term").select(*columns)
    other = {"right_by": ["qid"], "right_counts": joins.count_keys(right, ["term"])}
    spread = spread_join(
        left, right, ["term"], ["doc_id"], joins.count_keys(left, ["term"]),
        **(other if both else {}),
    )
    assert sorted(plain.collect()) == sorted(spread.select(*columns).collect())


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_both_ways(spark, monkeypatch, how):
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 100)
    hot = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 7 > 0, F.col("id"))  # a number and null
    left = spark.range(3000).select(F.col("id").alias("qid"), hot.alias("k"))
    table = spark.range(0, 2000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    rows = [
        sorted(
            (r.qid, r.k or -1, -1 if r.v is None else r.v)
            for r in lookup_join(left, table, ["k"], bounded, how).collect()
        )
        for bounded in (True, False)
    ]
    assert rows[0] == rows[1]
    assert len(rows[0]) == (3000 if how == "left" else len(rows[0]))


@pytest.mark.parametrize("per_task", [100, 5_000_000])
def test_lookup_leaves_the_buckets_in_place(spark, workspace, monkeypatch, per_task):
    monkeypatch.setattr(joins, "ROWS_PER_TASK", per_task)
    table = workspace.save_bucketed("signals", spark.range(500).withColumnRenamed("id", "doc_id"), 4)
    left = spark.range(2000).select((F.col("id") * F.col("id") % 7).alias("doc_id"))
    plan = lookup_join(left, table, ["doc_id"], False)._jdf.queryExecution().executedPlan().toString()
    scans = [k for k, line in enumerate(plan.splitlines()) if "signals" in line]
    lines = plan.splitlines()
    assert scans
    for k in scans:  # nothing between the table's scan and its join moves rows by hash
        depth, up = lines[k].index("FileScan") if "FileScan" in lines[k] else 0, k
        while up > 0 and "Join" not in lines[up]:
            up -= 1
            assert "Exchange hashpartitioning" not in lines[up] or lines[up].index("Exchange") >= depth


ODD = [
    (5, "Pear apple apple the pear, PEAR"), (1, None), (3, "zoo Ärger übung apple"), (3, "apple zoo"),
    (None, "apple apple orphan"), (9, ""), (4, "the of and"), (2, "日本語 apple 𝒳𝒳𝒳 ﬁre pear"), (7, "zz-top o'clock zoo"),
]


@pytest.mark.parametrize("rows", [1, 3, 10_000])
def test_documents_counted_together_equal_each_by_itself(spark, rows):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        together = ix.count_terms({"body": docs}, buckets=1).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    alone = ix.count_terms({"body": docs}).collect()
    assert Counter(map(tuple, together)) == Counter(map(tuple, alone))
    if rows > len(ODD):  # a whole run, in the order that a bucket is sorted by
        keys = [(r.term.encode(), r.doc_id) for r in together if r.doc_id is not None]
        assert keys == sorted(keys)


@pytest.mark.parametrize("files", [0, 32])
def test_files_of_postings_lie_by_term_and_document(spark, workspace, monkeypatch, files):
    monkeypatch.setattr(folders, "OPEN_FILES", files)
    docs = spark.createDataFrame(
        [(k, f"word{k % 7} word{k % 5} common {'rare' * (k % 3)}") for k in range(200)], "doc_id long, text string"
    )
    index = ix.build_index({"body": docs, "title": docs.filter("doc_id < 50")}, workspace, buckets=3)
    by_file = {}
    for r in index.postings.select("*", F.input_file_name().alias("file")).collect():
        by_file.setdefault(r.file, []).append((r.term, r.doc_id))
    assert len(by_file) > 3 and all(keys == sorted(keys) for keys in by_file.values())
    assert len({(r.field, r.doc_id) for r in index.doc_stats.collect()}) == index.doc_stats.count() == 250
    plan = index.postings.groupBy("doc_id").count()._jdf.queryExecution().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_a_worker_counts_a_bounded_number_of_tokens(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(ix, "COUNTED_TOKENS", 4)
    lists = [["zoo", "ant"], None, ["ant"], [], ["bee"] * 9, ["ant", "zoo"], ["cat"], ["ant", "bee", "cat"]]
    batch = pa.record_batch({"doc_id": list(range(8)), "tokens": pa.array(lists, pa.list_(pa.string()))})
    found = [[tuple(r.values()) for r in some.to_pylist()] for some in ix._counted([batch])]
    assert [sum(tf for *_, tf in some) for some in found] == [3, 9, 3, 3]
    expected = [(k, word, n) for k, words in enumerate(lists) for word, n in Counter(words or []).items()]
    assert sorted(r for some in found for r in some) == sorted(expected)
