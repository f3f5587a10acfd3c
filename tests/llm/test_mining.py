"""Hard negatives against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.llm import mining
from rankloom.llm.mining import Lists, Range, best_in_windows, mine_negatives

SCHEMA = "vec_id bigint, embedding array<double>, label int, rank string, score int"


def brute(rows):
    best = {}
    for i, vector, label, *_ in rows:
        if i is None or vector is None or label is None or len(vector) != 6:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        row = (label, [math.floor(256 * x) for x in vector])
        best[i] = min(best.get(i, row), row)
    out = []
    for a, (label, vector) in best.items():
        if a % 100:
            continue
        score = {i: sum(x * y for x, y in zip(vector, v)) for i, (_, v) in best.items()}
        same = sorted((-score[i], i) for i, (own, _) in best.items() if own == label and i != a)[:5]
        for s, p in same:
            inside = [
                (-score[i], i) for i, (own, _) in best.items()
                if own != label and 30 * -s <= 100 * score[i] <= 90 * -s
            ]
            out += [(a, p, r, i, -s, -n) for r, (n, i) in enumerate(sorted(inside)[:10], 1)]
    return sorted(out)


def rows_of(seed=1, n=900):
    rng = np.random.default_rng(seed)
    points = np.round(rng.normal(size=(n, 6)) / 2, 2)  # rounded: many ties
    points[200:420] = points[100]
    points[rng.integers(0, n, 60), 2] = 0
    rows = [(k, [float(x) for x in p], int(rng.integers(0, 4)), "r", 1) for k, p in enumerate(points)]
    rows += [rows[300], rows[305], (300, [0.5] * 6, 9, "r", 1), (None, [1.0] * 6, 1, "r", 1), (1000, None, 1, "r", 1)]
    rows += [(1100, [1.0] * 6, None, "r", 1), (1200, [1.0, None] * 3, 1, "r", 1), (1300, [float("nan")] * 6, 1, "r", 1)]
    rows += [(1400, [float("inf")] * 6, 1, "r", 1), (1500, [1.0] * 5, 1, None, None), (1600, [0.0] * 6, 2, "r", 1)]
    rows += [(1700, [1.0] * 6, 77, "r", 1), (1800, [-3.0, 2.0, 0.0, 0.0, 0.0, 0.1], 3, "r", 1)]
    return rows


def label():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


@pytest.mark.parametrize("shard,anchors", [(8192, 50_000), (130, 4)])
def test_mining(spark, monkeypatch, shard, anchors):
    monkeypatch.setattr(mining, "SHARD_ROWS", shard)
    monkeypatch.setattr(mining, "ANCHORS", anchors)
    rows = rows_of()
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = mine_negatives(table, F.col("vec_id") % 100 == 0, label())
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert got.columns == names
    want = brute(rows)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100
    none = mine_negatives(table.limit(0), F.col("vec_id") % 100 == 0)
    assert none.count() == 0 and none.columns == names
    assert mine_negatives(table, F.col("vec_id") < -1).count() == 0
    with pytest.raises(ValueError):
        mine_negatives(table.withColumn("embedding", F.array(F.lit(1e12))), F.lit(True))


def test_reading_stops():
    """Lists of rows far from the anchor aren't read to their end, and ties aren't cut off."""
    rng = np.random.default_rng(4)
    rows = rng.integers(-100, 100, (4000, 5))
    rows[rng.integers(0, 4000, 40)] = [250, -250, 250, 0, 0]
    anchor = np.array([9, -7, 8, 0, 0])
    lists = Lists(rng.permutation(4000), rng.integers(0, 3, 4000), rows)
    score = rows @ anchor
    windows = [Range(None, None, 5), Range(2000, 5000, 10), Range(6000, 6100, 3), Range(50, 40, 2)]
    best, _, met = best_in_windows(lists, anchor, windows[:1], None, 1)
    assert met < 400
    best, scores, met = best_in_windows(lists, anchor, windows, 17, 1)
    for w, got in zip(windows, best, strict=True):
        ok = (lists.labels != 1) & (lists.ids != 17)
        if w.low is not None:
            ok &= (score >= w.low) & (score <= w.high)
        want = sorted((-score[k], lists.ids[k], k) for k in np.flatnonzero(ok))[: w.k]
        assert got.tolist() == [k for *_, k in want] and (scores[got] == score[got]).all()
    zero, _, met = best_in_windows(lists, np.zeros(5, np.int64), [Range(0, 0, 7)], None, 9)
    assert sorted(lists.ids[zero[0]]) == list(range(7)) and met == 4000
