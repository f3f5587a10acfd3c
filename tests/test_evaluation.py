import pytest

from rankloom.operators import evaluation as ev


def tables(spark, relevant, retrieved):
    runs = [(0, i + 1, d) for i, d in enumerate(retrieved)]
    return (
        spark.createDataFrame(runs, "qid long, rank int, doc_id long"),
        spark.createDataFrame([(0, d) for d in relevant], "qid long, doc_id long"),
        spark.createDataFrame([(0, "query")], "qid long, query string"),
    )


def value(df, column):
    return df.first()[column]


# What the metrics give for these lists.
@pytest.mark.parametrize(
    "metric, relevant, retrieved, k, expected",
    [
        ("precision", range(10), [1, 2, 3], 2, 1.0),
        ("recall", range(10), [10, 5, 3], 2, 0.1),
        ("precision", range(10), [], 2, 0.0),
        ("precision", [], [1, 2, 3], 5, 0.0),
        ("recall", [], [10, 5, 3], 2, 1.0),
        ("recall", range(10), [], 2, 0.0),
        ("f1", [], [1, 2, 3], 5, 0.0),
        ("f1", range(10), [], 2, 0.0),
        ("f1", range(10), [0, 1, 2], 2, 0.333),
        ("f1", range(50), range(5), 30, 0.182),
        ("f1", range(50), range(10), 30, 0.333),
        ("f1", range(50), range(30), 30, 0.75),
        ("quality", range(50), range(5), None, 0.308),
        ("quality", range(50), range(10), None, 0.5),
        ("quality", range(50), range(30), None, 0.857),
        ("quality", range(50), [-1] * 5 + list(range(5, 30)), None, 0.0),
    ],
)
def test_metrics(spark, metric, relevant, retrieved, k, expected):
    function = {
        "precision": ev.precision_at_k, "recall": ev.recall_at_k, "f1": ev.f1_at_k,
        "quality": ev.results_quality,
    }[metric]
    args = tables(spark, relevant, retrieved) + ((k,) if k else ())
    assert value(function(*args), metric) == expected


def test_average_precision_divides_by_hits_found(spark):
    args = tables(spark, [1, 2, 3, 99], [1, 7, 2, 8, 3])
    expected = round((1 / 1 + 2 / 3 + 3 / 5) / 3, 3)
    assert value(ev.average_precision(*args), "average_precision") == expected
    assert value(ev.average_precision(*args, k=2), "average_precision") == 1.0
    assert value(ev.average_precision(*tables(spark, [1], [2])), "average_precision") == 0.0


def test_fixed_precision_counts_distinct_documents(spark):
    args = tables(spark, [5, 12, 3], [5, 5, 12, 4])
    row = ev.precision_at_fixed_k(*args, k=10).first()
    assert (row.precision, row.relevant_found, row.hit_ids) == (0.2, 2, ["12", "5"])
    assert ev.precision_at_fixed_k(*args, k=1).first().precision == 1.0
    assert ev.precision_at_fixed_k(*tables(spark, [5], [])).first().precision == 0.0


def test_reciprocal_rank_and_ndcg(spark):
    args = tables(spark, [3, 4], [1, 3, 2, 4])
    assert value(ev.reciprocal_rank(*args), "reciprocal_rank") == 0.5
    from math import log2

    gain = 1 / log2(3) + 1 / log2(5)
    assert value(ev.ndcg_at_k(*args), "ndcg") == pytest.approx(gain / (1 + 1 / log2(3)))
    assert value(ev.ndcg_at_k(*tables(spark, [], [1])), "ndcg") == 0.0


@pytest.fixture(scope="module")
def three(spark):
    runs = [(0, 1, 1), (0, 2, 2), (1, 1, 5), (1, 2, 6)]
    judgments = [(0, 1), (0, 2), (1, 6), (2, 9)]
    return (
        spark.createDataFrame(runs, "qid long, rank int, doc_id long"),
        spark.createDataFrame(judgments, "qid long, doc_id long"),
        spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "d")], "qid long, query string"),
    )


def test_every_query_survives(three):
    table = ev.evaluate(*three)
    rows = {r.qid: r for r in table.collect()}
    assert set(rows) == {0, 1, 2, 3}
    assert [rows[q].p_at_5 for q in range(4)] == [1.0, 0.5, 0.0, 0.0]
    assert [rows[q].recall_at_100 for q in range(4)] == [1.0, 1.0, 0.0, 1.0]
    report = {r.qid: r for r in ev.query_report(*three).collect()}
    assert report[1].retrieved_ids == ["5", "6"] and report[1].hit_ids == ["6"]
    assert report[3].retrieved_ids == [] and report[2].total_relevant == 1


def test_all_at_once_equals_each_alone(three):
    together = {r.qid: r for r in ev.evaluate(*three).collect()}
    for column, alone, name in [
        ("p_at_5", ev.precision_at_k(*three, 5), "precision"),
        ("p_at_10", ev.precision_at_k(*three, 10), "precision"),
        ("recall_at_100", ev.recall_at_k(*three, 100), "recall"),
        ("f1_at_30", ev.f1_at_k(*three, 30), "f1"),
        ("quality", ev.results_quality(*three), "quality"),
        ("average_precision", ev.average_precision(*three), "average_precision"),
        ("reciprocal_rank", ev.reciprocal_rank(*three), "reciprocal_rank"),
        ("ndcg_at_10", ev.ndcg_at_k(*three), "ndcg"),
    ]:
        assert {r.qid: r[name] for r in alone.collect()} == {
            q: r[column] for q, r in together.items()
        }
    means = ev.mean_metrics(*three).first()
    assert means.map == pytest.approx((1.0 + 0.5 + 0 + 0) / 4)


def test_summary_and_histogram(spark, three):
    per_query = ev.precision_at_fixed_k(*three, k=2)
    summary = ev.summarize(per_query).first()
    assert summary.total_queries == 4 and summary.mean_precision == pytest.approx(0.375)
    assert summary.median_precision == 0.25
    assert (summary.perfect_scores, summary.zero_scores) == (1, 2)
    assert summary.stdev_precision == pytest.approx(0.4787135538781691)
    one = ev.summarize(per_query.filter("qid = 0")).first()
    assert one.stdev_precision == 0.0
    bars = {r.precision: r.n_queries for r in ev.precision_histogram(per_query).collect()}
    assert bars == {1.0: 1, 0.5: 1, 0.0: 2}
