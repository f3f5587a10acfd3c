"""Ranked search against brute force, with many and few blocks and shards."""

import math
import re

import numpy as np
import pytest

from rankloom.llm import lexical
from rankloom.llm.lexical import Search, Shard, batch_of, ranked_search, shares, weights

DOCS = "doc_id bigint, text string, score string, term int"
ITEMS = "item_id bigint, text string, rank int"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return re.findall(TERM, (text or "").translate(LOWER))


def brute(docs, items, k=10):
    counted = []
    for d, text, *_ in docs:
        own = terms(text)
        counted.append((d, len(own), {t: own.count(t) for t in set(own)}))
    n_docs, n_terms = sum(n > 0 for _, n, _ in counted), sum(n for _, n, _ in counted)
    df = {}
    for _, _, tf in counted:
        for t in tf:
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text, *_ in items:
        scored = []
        for d, n, tf in counted:
            m = 100 - 90 + (90 * n * n_docs) // max(n_terms, 1)
            score = 0
            for t in set(terms(text)):
                if t in tf:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0))
        for r, (s, none, d) in enumerate(sorted(scored)[:k], 1):
            out.append((item, r, None if none else d, -s))
    return sorted(out, key=str)


def tables():
    rng = np.random.default_rng(11)
    words = [f"w{k}" for k in range(60)] + ["É", "x1", "Straße", "日本"]
    chance = 1 / np.arange(1, len(words) + 1)
    chance /= chance.sum()
    docs = [
        (int(k), "The " + " ".join(rng.choice(words, rng.integers(1, 60), p=chance)), "s", 1)
        for k in rng.permutation(300)
    ]
    docs += [(500, None, "s", 1), (501, "", None, 1), (502, " .,;-[]{} ", "s", None), (503, "W1,w2;THE-the", "s", 1)]
    docs += [(None, "w1 w2 w3 rare", "s", 1), (7, "w5 rare", "s", 1), (7, "w5 rare", "s", 1)]
    docs += [(600 + k, "copy of w9 É", "s", 1) for k in range(40)]
    docs += [(700, "w3 " * 100_000 + "w4", "s", 1)]
    items = [(int(k), " ".join(rng.choice(words, 8)), 1) for k in range(30)]
    items += [(40, None, 1), (41, "", 1), (42, "unknown", 1), (43, "rare RARE unknown", None), (44, "the of copy", 1)]
    items += [(None, "w9 É", 1), (45, "w9 É", 1), (45, "w9 É", 1), (46, "é ß straße Straße 日本", 1)]
    return docs, items


@pytest.mark.parametrize("block,postings,query_bytes", [(32, 2_000_000, 16 << 20), (3, 400, 300)])
def test_search(spark, monkeypatch, block, postings, query_bytes):
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(lexical, "QUERY_BYTES", query_bytes)
    docs, items = tables()
    asked = spark.createDataFrame(items, ITEMS)
    got = ranked_search(spark.createDataFrame(docs, DOCS).repartition(3), asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_empty(spark):
    docs, items = tables()
    no_docs, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert ranked_search(no_docs, spark.createDataFrame(items, ITEMS)).count() == 0
    assert ranked_search(spark.createDataFrame(docs[:9], DOCS), no_items).count() == 0


def test_blocks_are_skipped():
    """The best are found although most blocks are never read."""
    rng = np.random.default_rng(5)
    n, n_terms = 6000, 40
    topic = rng.integers(0, 8, n)
    sizes, term, tf = [], [], []
    for t in topic:
        own = np.unique(np.r_[rng.integers(0, 5, 3) + 5 * t, rng.integers(0, n_terms, 2)])
        sizes.append(len(own))
        term += own.tolist()
        tf += rng.integers(1, 6, len(own)).tolist()
    sizes, term, tf = map(np.array, (sizes, term, tf))
    length = rng.integers(5, 200, n)
    w = weights(n, int(length.sum()), np.bincount(term, minlength=n_terms))
    batch = batch_of([" ".join(f"t{k}" for k in range(5 * t, 5 * t + 4)) for t in range(8)])
    # numbers of terms stand for themselves here
    batch = lexical.Batch(batch.terms, [np.arange(5 * t, 5 * t + 4) for t in range(8)])
    shard = Shard(w, length, sizes, term, tf)
    found = Search(shard, batch, np.arange(n), 10)
    found.run()
    doc = np.repeat(np.arange(n), sizes)
    share = shares(w, length[doc], term, tf)
    for q, own in enumerate(batch.queries):
        score = np.bincount(doc, share * np.isin(term, own), n).astype(np.int64)
        best = np.lexsort((np.arange(n), -score))[:10]
        assert found.ids[found.docs[q]].tolist() == best.tolist()
        assert found.scores[q].tolist() == score[best].tolist()
    held = sum(-(-n // lexical.BLOCK) for own in batch.queries for n in np.diff(shard.lists)[own].tolist())
    assert found.read < found.blocks < held and found.read < 0.3 * held, (found.read, found.blocks, held)
