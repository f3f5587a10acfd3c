import gzip
import json
from datetime import datetime

import pytest

from rankloom.operators import evaluation as ev
from rankloom.sources import workspace as ws
from rankloom.sources.judged_queries import read_judged_queries, write_judged_queries
from rankloom.sources.page_rank_files import read_page_rank
from rankloom.sources.report import write_report


def test_judged_queries(spark, tmp_path):
    path = tmp_path / "queries.json"
    path.write_text(json.dumps({"Mount Everest": ["5", "7"], "first flight": ["9", "x"], "z": []}))
    queries, judgments = read_judged_queries(spark, str(path))
    assert [tuple(r) for r in queries.orderBy("qid").collect()] == [
        (0, "Mount Everest"), (1, "first flight"), (2, "z"),
    ]
    found = {tuple(r) for r in judgments.collect()}
    assert found == {(0, 5), (0, 7), (1, 9), (1, None)}


def test_judged_queries_in_many_splits(spark, tmp_path):
    """Brackets, quotes and escapes in queries, null lists, and cuts of the file at any place."""
    odd = ['a] "b', "\\", 'x\\"], "y": [1', "]]", "[", "}", "é ] \n{", "", "no list", "z" * 3000 + "]"]
    asked = {f"{q}{k}": None if q == "no list" else [str(k), f"{k}1"] for k in range(12) for q in odd}
    path = tmp_path / "many.json"
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for indent, split in ((None, "1000"), (2, "7000"), (None, size)):
            path.write_text(json.dumps(asked, indent=indent))
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            queries, judgments = read_judged_queries(spark, str(path))
            assert [tuple(r) for r in queries.orderBy("qid").collect()] == list(enumerate(asked))
            want = sorted((k, int(i)) for k, ids in enumerate(asked.values()) for i in ids or [])
            assert sorted(map(tuple, judgments.collect())) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


@pytest.mark.parametrize("text", ["", "{not json", '{"a": ["1"]', '{"a": ["1"] "b": []}', '"a": []}', '{"a": [1], "b'])
def test_bad_judged_queries_fail(spark, tmp_path, text):
    path = tmp_path / "broken.json"
    path.write_text(text)
    with pytest.raises(Exception, match="not a JSON object"):
        read_judged_queries(spark, str(path))[0].collect()


def test_judged_queries_written_in_parts(spark, tmp_path):
    asked = [(5 * k, None if k == 7 else f'q] {k}", \n') for k in range(40)]
    queries = spark.createDataFrame(asked, "qid long, query string").repartition(8)
    judged = [(q, d) for q, _ in asked for d in range(q % 4)]
    judgments = spark.createDataFrame(judged, "qid long, doc_id long")
    write_judged_queries(queries, judgments, str(tmp_path / "parts"))
    parts = sorted((tmp_path / "parts").glob("part-*"))
    whole = json.loads("".join(p.read_text() for p in parts))
    assert list(whole) == [q or "" for _, q in asked]
    back, ids = read_judged_queries(spark, str(tmp_path / "parts"))
    assert [tuple(r) for r in back.orderBy("qid").collect()] == [(k, q or "") for k, (_, q) in enumerate(asked)]
    assert sorted(map(tuple, ids.collect())) == sorted((q // 5, d) for q, d in judged)
    write_judged_queries(queries.limit(0), judgments, str(tmp_path / "none"))
    assert read_judged_queries(spark, str(tmp_path / "none"))[0].count() == 0


def test_missing_judged_queries_fail(spark, tmp_path):
    with pytest.raises(Exception):
        read_judged_queries(spark, str(tmp_path / "missing.json"))[0].collect()


def test_page_rank_files(spark, tmp_path):
    for name, text in [
        ("a.csv.gz", "1,0.5\n2,0.25\n1,0.75\n"), ("b.csv.gz", "2,3.0\n"), ("c.txt", "4,4\n")
    ]:
        with gzip.open(tmp_path / name, "wt") as f:
            f.write(text)
    ranks = {r.doc_id: r.pagerank for r in read_page_rank(spark, str(tmp_path)).collect()}
    assert ranks == {1: 0.75, 2: 3.0}
    normal = {r.doc_id: r.pagerank for r in read_page_rank(spark, str(tmp_path), True).collect()}
    assert normal == {1: 0.25, 2: 1.0}


def test_no_page_rank_files(spark, tmp_path):
    (tmp_path / "other.txt").write_text("1,2\n")
    assert read_page_rank(spark, str(tmp_path)).count() == 0


def test_report(spark, tmp_path):
    runs = spark.createDataFrame([(0, 1, 4), (0, 2, 5)], "qid long, rank int, doc_id long")
    judgments = spark.createDataFrame([(0, 5)], "qid long, doc_id long")
    queries = spark.createDataFrame([(0, "alpha"), (1, "beta")], "qid long, query string")
    per_query = ev.query_report(runs, judgments, queries)
    now = datetime(2024, 1, 2, 3, 4, 5)
    folder = write_report(per_query, ev.summarize(per_query), queries, str(tmp_path), now)
    assert folder.endswith("20240102_030405")
    lines = [r.value for r in spark.read.text(f"{folder}/report_md").collect()]
    assert "| Queries | 2 |" in lines and "| Mean P@10 | 0.0500 |" in lines
    first, second = lines.index("### 1. alpha"), lines.index("### 2. beta")
    assert lines.index("| Zero | 1 |") < first < second
    assert lines[first + 2 : first + 7] == [
        "- **Precision@10:** 0.1000", "- **Found:** 1/10", "- **Relevant in total:** 1",
        "- **Hits:** 5", "- **Retrieved:** 4, 5",
    ]
    assert "- **Hits:** None" in lines[second:]
    assert spark.read.json(f"{folder}/per_query_json").count() == 2
    table = spark.read.option("header", True).csv(f"{folder}/per_query_csv")
    assert {r.retrieved_ids for r in table.collect()} == {"4, 5", None}
    assert spark.read.json(f"{folder}/summary_json").first().total_queries == 2


def test_shared_root_comes_from_the_session(spark):
    assert ws.shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert ws.Workspace(spark).root.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_cluster_without_shared_folder_is_refused():
    class Context:
        master = "spark://somewhere"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ws.shared_root(Session())


def test_spread_only_when_cores_would_idle(spark):
    few = spark.range(10).coalesce(1)
    many = spark.range(100, numPartitions=9)
    assert ws.spread(few).rdd.getNumPartitions() == 4
    assert ws.spread(many) is many
    assert ws.bucket_count(spark.range(10, numPartitions=640)) == 10
    assert ws.bucket_count(few) == 4


def test_judged_query_run(spark, tmp_path, workspace):
    from rankloom.operators.index import build_index
    from rankloom.plans.judged_run import run_judged_queries

    docs = {1: "apple pie", 2: "apple tart", 3: "banana bread", 4: "cherry pie"}
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    path = tmp_path / "q.json"
    path.write_text(json.dumps({"apple": ["1", "3"], "the of": ["2"], "pie bread": ["4", "3"]}))
    index = build_index({"body": table}, workspace)
    now = datetime(2024, 5, 6, 7, 8, 9)
    per_query, summary = run_judged_queries(
        index, str(path), workspace, str(tmp_path / "out"), k=2, now=now
    )
    rows = {r.qid: r for r in per_query.collect()}
    assert [rows[q].precision for q in range(3)] == [0.5, 0.0, 0.5]
    assert rows[0].retrieved_ids == ["1", "2"] and rows[2].retrieved_ids == ["3", "1"]
    assert summary.first().zero_scores == 1
    assert (tmp_path / "out" / "20240506_070809" / "report_md").is_dir()
