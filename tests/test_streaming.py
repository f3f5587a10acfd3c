import pytest
from pyspark.sql import functions as F

from rankloom.operators import index as ix
from rankloom.operators import scoring
from rankloom.sources.workspace import Workspace
from rankloom.streaming.live_index import LiveIndex

DOCS = {i: f"common word{i % 3} word{i % 5} word{i % 5} extra{i}" for i in range(20)}


def table(spark, ids):
    return spark.createDataFrame([(i, DOCS[i]) for i in ids], "doc_id long, text string")


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def same(one, other):
    assert rows(one.postings, "term", "doc_id", "tf") == rows(
        other.postings, "term", "doc_id", "tf"
    )
    assert rows(one.term_stats, "term", "df", "term_total") == rows(
        other.term_stats, "term", "df", "term_total"
    )
    assert rows(one.doc_stats, "doc_id", "doc_len") == rows(other.doc_stats, "doc_id", "doc_len")
    columns = ["field", "n_docs", "n_terms", "sum_len", "avg_len"]
    assert rows(one.corpus_stats, *columns) == rows(other.corpus_stats, *columns)


@pytest.fixture(scope="module")
def bulk(spark):
    return ix.build_index({"body": table(spark, range(20))}, Workspace(spark))


def test_batches_equal_bulk_build_and_replay_counts_once(spark, bulk):
    live = LiveIndex(Workspace(spark))
    for batch in range(4):
        live.append({"body": table(spark, range(batch * 5, batch * 5 + 5))}, batch)
    live.append({"body": table(spark, range(10, 15))}, 2)
    same(live.index(), bulk)
    compact = live.compact(Workspace(spark))
    same(compact, bulk)
    asked = spark.createDataFrame([(0, "common word1 extra3")], "qid long, query string")
    scores = [
        {
            r.doc_id: r.score
            for r in scoring.bm25(index, scoring.query_batch(asked, index), "body").collect()
        }
        for index in (live.index(), compact, bulk)
    ]
    assert scores[0] == pytest.approx(scores[2]) and scores[1] == pytest.approx(scores[2])


def test_document_added_again_counts_again(spark):
    live = LiveIndex(Workspace(spark))
    live.append({"body": table(spark, [1])}, 0)
    live.append({"body": table(spark, [1, 2])}, 1)
    stats = {r.term: r.df for r in live.index().term_stats.collect()}
    assert (stats["extra1"], stats["extra2"], stats["common"]) == (2, 1, 3)
    assert live.index().corpus_stats.first().n_docs == 3


def test_stream_of_files(spark, bulk, tmp_path):
    source = tmp_path / "docs"
    for part in range(3):
        ids = range(part, 20, 3)
        table(spark, ids).coalesce(1).write.mode("append").parquet(str(source))
    stream = (
        spark.readStream.schema("doc_id long, text string")
        .option("maxFilesPerTrigger", 1)
        .parquet(str(source))
    )
    live = LiveIndex(Workspace(spark))
    query = live.stream(stream, str(tmp_path / "checkpoint"))
    query.awaitTermination()
    assert query.exception() is None
    same(live.index(), bulk)


def test_merged_field_in_batches(spark):
    anchors = spark.createDataFrame([(1, "apple"), (1, "apple pie")], "doc_id long, text string")
    live = LiveIndex(Workspace(spark))
    live.append({"anchor": anchors}, 0, merge=("anchor",))
    assert rows(live.index().postings, "term", "tf") == [("apple", 2), ("pie", 1)]
    assert live.index().corpus_stats.first().n_docs == 1


def test_merged_field_over_batches(spark):
    live = LiveIndex(Workspace(spark))
    first = spark.createDataFrame([(1, "alpha beta"), (2, "alpha"), (3, "of")], "doc_id long, text string")
    again = spark.createDataFrame([(1, "alpha")], "doc_id long, text string")
    live.append({"anchor": first}, 0, merge=("anchor",))
    live.append({"anchor": again}, 1, merge=("anchor",))
    live.append({"anchor": again}, 1, merge=("anchor",))  # delivered twice
    for index in (live.index(), live.compact(Workspace(spark))):
        assert rows(index.postings, "term", "doc_id", "tf") == [
            ("alpha", 1, 2), ("alpha", 2, 1), ("beta", 1, 1)
        ]
        assert rows(index.term_stats, "term", "df") == [("alpha", 2), ("beta", 1)]
        assert index.corpus_stats.first().n_docs == 3


def test_folding_keeps_results_and_retires_segments(spark, bulk):
    live = LiveIndex(Workspace(spark), fan=2)
    take = live.take()
    for batch in range(5):
        take(table(spark, range(batch * 4, batch * 4 + 4)), batch)
    assert 1 <= len(live.segments()) <= 2
    assert sorted(b for s in live.segments() for b in s.batches) == list(range(5))
    same(live.index(), bulk)
    # delivered again after it was folded
    take(table(spark, range(4, 8)), 1)
    assert not live.append({"body": table(spark, range(4, 8))}, 1)
    gone = live.retire()
    assert set(gone).isdisjoint(s.name for s in live.segments()) and "batch0" in gone
    same(live.index(), bulk)
    assert live.retire() == []


def test_half_written_batch_is_written_anew(spark, bulk):
    live = LiveIndex(Workspace(spark))
    live.append({"body": table(spark, range(10))}, 0)
    # a batch that failed before the manifest named it
    live._write("batch1", "postings", live.index().postings, ("field", "term_bucket"))
    assert live.index().corpus_stats.first().n_docs == 10
    live.append({"body": table(spark, range(10, 20))}, 1)
    same(live.index(), bulk)


@pytest.mark.parametrize("fan", [2, 99])
def test_replaced_by_id(spark, bulk, fan):
    live = LiveIndex(Workspace(spark), fan=fan)
    outdated = spark.createDataFrame(
        [(i, "outdated common") for i in (1, 2, 3, 3)] + [(18, "gone")], "doc_id long, text string"
    )
    live.append({"body": outdated}, 0)
    live.append({"body": table(spark, [i for i in range(20) if i not in (1, 2, 3, 18)])}, 1)
    live.fold()
    live.append({"body": table(spark, [1, 3])}, 2, replace=True)
    live.append({"body": table(spark, [2, 18])}, 3, replace=True)
    live.fold()
    for index in (live.index(), live.compact(Workspace(spark))):
        same(index, bulk)


def test_a_batch_dealt_by_id_fills_all_tasks(spark, workspace):
    dealt = spark.range(400).filter(F.pmod(F.hash("id"), F.lit(4)) == 1)
    live = LiveIndex(workspace)
    live.append({"body": dealt.select(F.col("id").alias("doc_id"), F.concat(F.lit("word"), "id").alias("text"))}, 0)
    files = spark.read.parquet(workspace.path("live/batch0/postings")).select(F.input_file_name().alias("f"))
    tasks = {r.f.rsplit("/part-", 1)[1].split("-")[0] for r in files.distinct().collect()}
    assert len(tasks) == 4
