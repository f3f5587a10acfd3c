"""Importance resampling against plain Python over the features themselves, not their hashes."""

import math
import random
import re
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from rankloom.llm.common import roller
from rankloom.llm.importance import FEATURES, TEMPERATURE, counts, resample

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words + list(zip(words, words[1:]))


def noise(doc_id, text, seed):
    state = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), 42)
    if doc_id is not None:
        state = xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little", signed=True), state)
    if text is not None:
        state = xxhash.xxh64_intdigest(text.encode(), state)
    return -math.log(-math.log(((state >> 11) + 0.5) / (1 << 53)))


def plain(docs, labels, share, seed):
    quality, toxic = {}, {}
    for d, q, bad in labels:
        if d is not None:
            quality[d] = min(q, quality.get(d, q))
            toxic[d] = max(bad or 0, toxic.get(d, 0))
    good = {d for d, q in quality.items() if q == 1 and not toxic[d]}
    raw, target = Counter(), Counter()
    for d, t in docs:
        raw.update(grams(t))
        if d in good:
            target.update(grams(t))
    scale = raw.total() / target.total() if target.total() else 0.0
    ratio = {g: math.log((target[g] * scale + scale) / (n + scale)) if scale else 0.0 for g, n in raw.items()}
    weights = [sum(map(ratio.get, grams(t))) / len(grams(t)) if grams(t) else None for _, t in docs]
    keys = [
        None if w is None else w / TEMPERATURE + noise(d, t, seed) for (d, t), w in zip(docs, weights, strict=True)
    ]
    if share is None:
        share = sum(quality.values()) / len(quality) if quality else 1.0
    drawn = sorted((k for k in keys if k is not None), reverse=True)
    k = min(math.ceil(len(docs) * share), len(drawn))
    return [(d, t, w, bool(k) and key is not None and key >= drawn[k - 1])
            for (d, t), w, key in zip(docs, weights, keys, strict=True)]


def table_of():
    rng = random.Random(3)
    prose, noise_words = ["Alpha", "beta", "gamma", "delta"], ["buy", "Click", "now", "é!"]
    docs = []
    for d in range(90):
        words = prose if d % 3 else noise_words
        docs.append((d, " \n".join(rng.choice(words + ["the", "of"]) for _ in range(rng.randint(1, 40)))))
    docs += [(90, None), (91, ""), (92, " \t\n"), (None, "alpha beta"), (None, None), (5, "again the alpha")]
    docs += [docs[7], docs[7], (93, "alpha the beta " * 60_000), (94, "one")]
    labels = [(d, int(d % 3 > 0), int(d % 10 == 1)) for d in range(0, 60, 2)]
    return docs, labels + [(4, 0, 0), (8, 1, None), (None, 1, 0)]


@pytest.mark.parametrize("share, seed, labelled", [(None, 0, True), (0.3, 7, True), (0.5, 0, False)])
def test_resample_equals_plain_python(spark, share, seed, labelled):
    docs, labels = table_of()
    labels = labels if labelled else []
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    own = frame.select("*", *[F.lit(c).alias(c) for c in ("key", "target", "feature", "raw", "quality", "weight")])
    judged = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = resample(own, judged, share, seed).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    got = sorted(((r.doc_id, r.text, r.weight, r.kept) for r in got), key=order)
    want = sorted(plain(docs, labels, share, seed), key=order)
    assert [(r[0], r[1], r[3]) for r in got] == [(r[0], r[1], r[3]) for r in want]
    assert [r[2] for r in got] == [w if w is None else pytest.approx(w, abs=1e-9) for *_, w, _ in want]
    assert 0 < sum(r[3] for r in want) < len(want)


def test_memory_of_a_worker():
    """Temporary arrays take a small multiple of a slice, and small next to an executor's memory."""
    texts = ["some words of a text " * 200] * 2000  # 8 MB
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([False] * len(texts))], ["text", "target"])
    roller.cache_clear()
    tracemalloc.start()
    (out,) = counts(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(out.column("raw").to_pylist()) == 2000 * (1000 + 999)
    assert peak < 60 << 20, peak >> 20
    assert out.num_rows < FEATURES
