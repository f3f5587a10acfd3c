"""SimHash groups against brute force, on both sides of every limit."""

import re

import numpy as np
import pytest
import xxhash

from rankloom.llm import simhash
from rankloom.llm.simhash import bk_trees, cut_masks, fingerprint, simhash_groups, spanning, within

SCHEMA = "doc_id bigint, text string, fingerprint string, mask bigint"


def brute_fingerprint(text):
    lower = {c: c + 32 for c in range(65, 91)}
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows, radius=2):
    prints = [brute_fingerprint(r[1]) for r in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    out = []
    for i, r in enumerate(rows):
        known = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        out.append((r[0], f"{prints[i]:016x}", min(known, default=None)))
    return sorted(out, key=str)


def near_texts(n, n_words=400):
    rng, rows = np.random.default_rng(3), []
    base = [["w%d" % k for k in rng.integers(0, 900, n_words)] for _ in range(4)]
    for k in range(n):
        text = list(base[k % 4])
        for at in rng.integers(0, n_words, k % 7):
            text[at] = "x%d" % rng.integers(0, 50)
        rows.append((k * 3 % n, " ".join(text), "f", 1))
    return rows


ODD = [
    (900, None, "f", None), (901, "", "f", 1), (902, " \n\t\x0b ", "f", 1), (903, "Two Words", None, 1),
    (904, "two\x0cwords", "f", 1), (905, "ÀÉ é Σ", "f", 1), (906, "Àé é Σ", "f", 1), (None, "of no id", "f", 1),
    (None, None, "f", 1), (907, "w " * 60_000 + "end", "f", 1), (907, "w " * 60_000 + "end", "f", 1),
]


@pytest.mark.parametrize("shard,broadcast", [(256, 64 << 20), (16, 0)])
def test_groups(spark, monkeypatch, shard, broadcast):
    monkeypatch.setattr(simhash, "SHARD", shard)
    monkeypatch.setattr(simhash, "BROADCAST_BYTES", broadcast)
    rows = near_texts(100) + ODD
    got = simhash_groups(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == brute_groups(rows)
    assert len({r.component_id for r in got}) < len({r.fingerprint for r in got})


def test_empty(spark):
    assert simhash_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_text_in_chunks(monkeypatch):
    text = " ".join("v%d" % (k * k % 977) for k in range(3000)).encode()
    whole = fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert fingerprint(text) == whole == brute_fingerprint(text.decode())


def test_masks():
    """Of any two numbers that differ in two bits, one mask hides the difference, at every cut."""
    masks = [m & (1 << 64) - 1 for m in cut_masks(0, 2)]
    assert sum(masks) == (1 << 64) - 1 and all(20 < m.bit_count() < 23 for m in masks)
    for m in masks:
        finer = [x & (1 << 64) - 1 for x in cut_masks(m, 2)]
        assert all(x & m == m for x in finer)
        free = [b for b in range(64) if not m >> b & 1]
        assert all(any(not x >> a & 1 and not x >> b & 1 for x in finer) for a in free for b in free)


def test_trees():
    rng = np.random.default_rng(8)
    sizes = np.array([1, 40, 2, 300])
    few = rng.integers(0, 1 << 12, 4000).astype(np.uint64)
    members = [rng.choice(np.unique(few), n, replace=False) for n in sizes]
    nodes, edges = bk_trees(np.concatenate(members), sizes)
    offsets = np.r_[0, np.cumsum(sizes)]
    for k in range(len(sizes)):
        own, of = nodes[offsets[k] : offsets[k + 1]], edges[offsets[k] : offsets[k + 1]]
        assert sorted(own) == sorted(members[k]) and of[0] == -1 and (np.diff(of) > 0).all()
        assert all((int(own[e >> 7]) ^ int(x)).bit_count() == e & 127 for x, e in zip(own[1:], of[1:]))
    queries = np.array([m[0] for m in members])
    got = sorted(zip(*(x.tolist() for x in within(queries, nodes, edges, offsets, 2))))
    want = [
        (k, int(p)) for k in range(len(sizes)) for p in range(offsets[k], offsets[k + 1])
        if (int(queries[k]) ^ int(nodes[p])).bit_count() <= 2
    ]
    assert got == want and len(want) > 4


def test_spanning():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 300, 250), rng.integers(0, 300, 250)

    def parts(pairs):
        label = {x: x for p in pairs for x in p}
        for x, y in pairs:
            old, new = label[x], label[y]
            label = {k: new if v == old else v for k, v in label.items()}
        return {frozenset(k for k in label if label[k] == v) for v in label.values()} - {frozenset([x]) for x in label}

    one, two = spanning(a, b)
    assert parts(list(zip(one.tolist(), two.tolist()))) == parts(list(zip(a.tolist(), b.tolist())))
    assert len(one) < len(a)
