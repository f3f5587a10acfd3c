"""The operators on small tables with nulls, ties, repeated rows and clashing columns."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rankloom.llm import forest, substrings, tokens, trie_join
from rankloom.llm.forest import search
from rankloom.llm.importance import kth_largest, resample
from rankloom.llm.line_dedup import dedup_lines, passages
from rankloom.llm.mixing import mix_sources
from rankloom.llm.packing import pack, pack_documents, step_groups
from rankloom.llm.revisits import canonical_url, resolve_revisits
from rankloom.llm.substrings import remove_repeats
from rankloom.llm.token_files import read_token_files, write_token_files
from rankloom.llm.tokens import Encoder
from rankloom.llm.tree_dedup import exact_groups
from rankloom.llm.trie_join import JaccardJoin, near_duplicate_groups, one_per_group

SCHEMA = "doc_id bigint, text string, source string, size string"


def words(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("w%d" % k for k in rng.integers(0, 5000, n))


LONG = words(1, 400)
NEAR = LONG.replace(LONG.split()[200], "other", 1)
SHARED = "\n".join(f"line {k} of the shared part" for k in range(20))
ROWS = [
    (1, LONG, "a", "x"),
    (2, NEAR, "a", "x"),
    (3, LONG, "b", None),
    (3, LONG, "b", None),
    (4, None, None, "x"),
    (5, "", "b", "x"),
    (6, " \n\t ", None, "x"),
    (7, "Only four words here", "a", "x"),
    (8, "only FOUR words here", "é", "x"),
    (None, words(2, 60) + "\n\n" + SHARED, "a", "x"),
    (9, "é" * 300 + "\n" + SHARED + "\nend", "a", "x"),
    (10, words(3, 3000), "b", "x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def counted(rows):
    out = {}
    for r in rows:
        out[r] = out.get(r, 0) + 1
    return out


def test_exact_groups(docs, none):
    got = counted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_groups(docs).collect())
    assert got[(1, 1, 3, True)] == 1 and got[(3, 1, 3, False)] == 2
    # equal without blanks: the longest stays, then the smallest id
    assert got[(6, 6, 3, True)] == 1 and got[(4, 6, 3, False)] == 1 and got[(5, 6, 3, False)] == 1
    assert sum(got.values()) == len(ROWS) and exact_groups(none).count() == 0
    assert {r.text_sha256 for r in exact_groups(docs).filter("doc_id = 5").collect()} == {
        hashlib.sha256(b"").hexdigest()
    }


def brute_groups(rows, percent=80):
    sets, ids = [], [r[0] for r in rows]
    lower = {c: c + 32 for c in range(65, 91)}
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (r[1] or "").translate(lower))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    out = []
    for i, own in enumerate(ids):
        known = [ids[j] for j in range(len(ids)) if label[j] == label[i] and ids[j] is not None]
        out.append((own, len(sets[i]), min(known, default=None)))
    return counted(out)


def test_near_duplicates(spark, docs, none):
    got = counted(tuple(r) for r in near_duplicate_groups(docs).collect())
    assert got == brute_groups(ROWS)
    assert near_duplicate_groups(none).count() == 0
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 7, 9, 10]


def test_near_duplicates_without_id(spark):
    near = words(8, 90)
    rows = [
        (5, LONG, "a", "x"), (None, LONG, "a", "x"), (9, NEAR, "a", "x"), (12, LONG, "b", "x"),
        (None, near, "a", "x"), (7, near, "b", "x"), (None, words(9, 30), "a", "x"), (None, words(9, 30), "b", "x"),
    ]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert counted(tuple(r) for r in near_duplicate_groups(table).collect()) == brute_groups(rows)
    kept = counted((r.doc_id, r.text) for r in one_per_group(table).collect())
    assert kept == {(5, LONG): 1, (7, near): 1, (None, words(9, 30)): 1}


@pytest.mark.parametrize("block, pays, broadcast", [(2048, 4, 250_000), (4, 0, 0), (7, 1000, 250_000)])
def test_near_duplicates_of_many(spark, monkeypatch, block, pays, broadcast):
    monkeypatch.setattr(trie_join, "BLOCK", block)
    monkeypatch.setattr(trie_join, "PAYS", pays)
    monkeypatch.setattr(trie_join, "BROADCAST_CLASSES", broadcast)
    rng, rows = np.random.default_rng(5), []
    base = [words(100 + k, 60).split() for k in range(5)]
    for k in range(150):
        text = list(base[k % 5])
        for at in rng.integers(0, 60, k % 4):
            text[at] = "x%d" % rng.integers(0, 50)
        rows.append((k, " ".join(text), "s", "x"))
    got = counted(tuple(r) for r in near_duplicate_groups(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == brute_groups(rows)


def test_near_copies_of_a_long_text(spark):
    """A group of copies that differ from each other, beside texts that share half of it."""
    rng, base = np.random.default_rng(6), words(41, 120).split()
    rows = [(0, words(42, 200_000), "s", "x"), (1, words(42, 199_000), "s", "x"), (5, " ".join(base), "s", "x")]
    for k in range(300):
        text = list(base)
        text[int(rng.integers(0, 110))] = f"y{k}"
        text[int(rng.integers(0, 110))] = f"z{k}"
        rows.append((10 + k, " ".join(text if k % 3 else text[:60] + words(1000 + k, 60).split()), "s", "x"))
    got = counted(tuple(r) for r in near_duplicate_groups(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == brute_groups(rows)


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_walk_of_a_trie(percent):
    rng = np.random.default_rng(percent)
    sets = []
    for _ in range(60):
        one = np.sort(rng.choice(40, int(rng.integers(1, 30)), replace=False))
        sets += [one, np.unique(np.append(one[rng.random(len(one)) < 0.9], rng.integers(0, 40)))]
    paths = sorted(s.astype(">u8").tobytes() for s in sets)
    for probe in sets:
        walked = trie_join.TrieWalk(probe.astype(np.uint64), percent)
        for path in paths:
            other = set(np.frombuffer(path, ">u8").tolist())
            both = len(other & set(probe.tolist()))
            assert walked.links(path) == (100 * both >= percent * (len(other) + len(probe) - both))


def test_bitmaps_rule_out_long_sets_that_sketches_do_not():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (12000, 12100, 10400, 1, 7, 300)]
    sets.append(np.sort(np.concatenate([sets[0][:11200], sets[1][:240]])))  # links with the first
    sets.append(np.sort(np.concatenate([sets[5][:250], sets[4]])))
    paths = [s.astype(">u8").tobytes() for s in sets]
    bits = [trie_join.bitmap(p) for p in paths]
    rows = []
    for a, one in enumerate(sets):
        for b, two in enumerate(sets):
            most = trie_join.overlap_at_most(bits[a], len(one), bits[b], len(two))
            assert len(np.intersect1d(one, two)) <= most <= min(len(one), len(two))
            rows.append((a, b, len(one), len(two), bits[a], bits[b], trie_join.sketch(one), trie_join.sketch(two)))
    names = ["a", "b", "n_a", "n_b", "bits_a", "bits_b", "sketch_a", "sketch_b"]
    table = pa.RecordBatch.from_pydict({c: [row[k] for row in rows] for k, c in enumerate(names)})

    def stay(mapper):
        return {(r["a"], r["b"]) for batch in mapper(80)(iter([table])) for r in batch.to_pylist()}

    equal = {(k, k) for k in range(len(sets))}
    assert {(0, 1), (1, 0)} <= stay(trie_join.plausible)
    assert stay(trie_join.overlapping) == equal | {(0, 6), (6, 0), (5, 7), (7, 5)}


def test_only_pairs_left_by_bitmaps_move_paths(spark):
    texts = [words(k, 1500) for k in range(40, 44)]
    texts.append(texts[0].replace(texts[0].split()[700], "other", 1))
    join = JaccardJoin(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    join.prepare()
    of = {r["doc_id"]: r["cid"] for r in join.classes.collect()}
    pairs = join.scratch.keep(
        spark.createDataFrame([(of[a], of[b]) for a in range(5) for b in range(a)], "a bigint, b bigint")
    )
    left = join.overlapping(pairs, join.paths(pairs)).collect()
    assert [tuple(r) for r in left] == [(of[4], of[0])]
    assert [tuple(r) for r in join.verify(pairs).collect()] == [(of[4], of[0])]


@pytest.mark.parametrize("size", [1, 2, 3, 1000])
@pytest.mark.parametrize("chunk", [3, 1000])
def test_shared_keys(monkeypatch, size, chunk):
    """Rows by which two classes may link stay; of the others, those of rare keys of one class go."""
    monkeypatch.setattr(trie_join, "CHUNK", chunk)
    rng = np.random.default_rng(3)
    lengths = {c: (int(rng.integers(50, 100)), int(rng.integers(-8, 20))) for c in range(9)}
    rows = {(int(x), int(c)) for x, c in zip(rng.integers(-40, 5, 150), rng.integers(0, 9, 150), strict=True)}
    rows = sorted((x, lengths[c][0], c) for x, c in rows for _ in range(1 + c % 2))
    table = pa.table({
        "x": [r[0] for r in rows], "cid": [r[2] for r in rows],
        "n": pa.array([r[1] for r in rows], pa.int32()),
        "most": pa.array([r[1] + lengths[r[2]][1] for r in rows], pa.int32()),
    })
    got = [
        (r["x"], r["cid"]) for b in trie_join.shared_keys(80)(iter(table.to_batches(size))) for r in b.to_pylist()
    ]
    must = {(x, c) for x, _, c in rows if x >= 0}
    for x, n, c in rows:
        for y, m, d in rows:
            if (x, 1) == (y, int(c != d)) and n <= m + lengths[d][1] and m <= n + lengths[c][1]:
                if 100 * min(n, m) >= 80 * max(n, m):
                    must.add((x, c))
    assert must <= set(got) <= {(x, c) for x, _, c in rows}
    if chunk > 3:
        classes = {x: {c for y, _, c in rows if y == x} for x, _, _ in rows}
        assert len(got) == len(set(got)) and all(x >= 0 or len(classes[x]) > 1 for x, _ in got)


def brute_repeats(texts, length=200):
    seen = {}
    for b in texts:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = []
    for b in texts:
        hit = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                hit[i : i + length] = True
        out.append(np.frombuffer(b, np.uint8)[~hit].tobytes())
    return out


@pytest.mark.parametrize("group", [4096, 2])
def test_repeats(spark, docs, none, monkeypatch, group):
    monkeypatch.setattr(substrings, "GROUP", group)
    own = "tail " * 90
    rows = [*ROWS, (11, "start " + LONG[300:900] + " end", "a", "x"), (12, own, "a", "x"), (13, LONG[:199], "a", "x")]
    rows += [(20 + k, f"begin{k} " + LONG[500:760] + f" stop{k}", "a", "x") for k in range(4)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = counted((r.doc_id, bytes(r.kept)) for r in remove_repeats(table).collect())
    texts = [(r[1] or "").encode() for r in rows]
    assert got == counted(zip([r[0] for r in rows], brute_repeats(texts), strict=True))
    assert remove_repeats(none).count() == 0


def xxhash_twin(text, seed=42):
    """An ASCII text with the XXH64 of ``text``: its first lane differs, the one 32 bytes on makes up for it."""
    p1, p2, full = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, (1 << 64) - 1

    def one_round(lane):
        x = (seed + p1 + p2 + lane * p2) & full
        return (x << 31 | x >> 33) * p1 & full

    data = text.encode()
    first, second = (int.from_bytes(data[a : a + 8], "little") for a in (0, 32))
    for k in range(100_000):
        other = b"%08d" % k
        gap = one_round(first) - one_round(int.from_bytes(other, "little"))
        lane = ((second + gap * pow(p2, -1, 1 << 64)) & full).to_bytes(8, "little")
        if max(lane) < 128 and min(lane) >= 32:
            return (other + data[8:32] + lane + data[40:]).decode()


def test_repeats_of_texts_with_one_xxhash(spark):
    text = "".join(chr(97 + (k * k * 7 + k // 3) % 26) for k in range(260))
    rows = [(1, text), (2, xxhash_twin(text)), (3, "other " * 30)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert table.filter("doc_id < 3").select(F.xxhash64("text")).distinct().count() == 1
    got = counted((r.doc_id, bytes(r.kept)) for r in remove_repeats(table).collect())
    assert got == counted(zip([1, 2, 3], brute_repeats([r[1].encode() for r in rows]), strict=True))


def test_lines(docs, none):
    got = {r.doc_id: r for r in dedup_lines(docs).collect()}
    assert got[4].text is None and got[5].text == "" and got[1].text == LONG
    assert dedup_lines(docs).columns == [*docs.columns, "removed_chunks", "removed_lines"]
    # the null id comes last, so the earlier text keeps the shared lines
    assert got[9].removed_chunks == 0 and got[None].removed_chunks >= 1
    assert got[None].text.startswith(words(2, 60)) and len(got[None].text) < len(ROWS[9][1])
    assert dedup_lines(none).count() == 0


def brute_lines(rows):
    """(doc_id, text, removed_chunks, removed_lines) of rows of different ids; equal rows count as one."""
    seen, out = {}, {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0])):
        lines = re.findall(r"[^\n]*\n|[^\n]+", text or "")
        full = [k for k, x in enumerate(lines) if x.strip(" \t\n")]
        gone = set()
        for a, b in zip(full, full[1:]):
            first = seen.setdefault("".join(lines[a : b + 1]).removesuffix("\n"), (doc_id, a, b))
            if first[0] != doc_id or a > first[2]:
                gone.update(range(a, b + 1))
        kept = "".join(x for k, x in enumerate(lines) if k not in gone)
        out[doc_id] = (doc_id, text and kept, sum(k - 1 not in gone for k in gone), len(gone))
    return counted(out[r[0]] for r in rows)


def test_lines_of_many(spark):
    rng, rows = np.random.default_rng(7), []
    pool = [f"line é {k}" for k in range(12)] + ["", " \t", ""]
    for k in range(60):
        own = [f"only {k} {j}" for j in range(rng.integers(0, 4))]
        lines = list(rng.permutation(own + list(rng.choice(pool, rng.integers(0, 9)))))
        rows.append((k, "\n".join(lines) + "\n" * int(rng.integers(0, 2))))
    # runs of two lines between others, a run at the end of a text, lines repeated in a row, copies
    rows += [(100 + k, f"a{k}\nfirst shared\nsecond shared\nb{k}") for k in range(40)]
    rows += [(200 + k, f"c{k}\nshared\n\nat the end" + "\n" * k) for k in range(2)]
    rows += [(300, "same\n" * 2), (301, "same\nsame\nsame"), (302, "x\n" * 3), (303, "y\n" * 5 + "z")]
    rows += [rows[5], rows[5], (None, "own\nfirst shared\nsecond shared"), (400, None), (401, ""), (402, "\n\n")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = counted((r.doc_id, r.text, r.removed_chunks, r.removed_lines) for r in dedup_lines(table).collect())
    assert got == brute_lines(rows)
    assert got[(100, "a0\nfirst shared\nsecond shared\nb0", 0, 0)] == 1 and got[(139, "a39\nb39", 1, 2)] == 1


def test_lines_whose_digests_collide(spark):
    """Digests of one byte: passages are told apart by their bytes, in chunks and in pairs."""
    rng = np.random.default_rng(3)
    pool = [f"shared line {k}" for k in range(30)]
    rows = [(k, "\n".join([f"own {k}", *pool[(a := int(rng.integers(0, 20))) : a + int(rng.integers(1, 12))], f"end {k}"])) for k in range(40)]
    rows += [(90 + k, "\n".join(f"only {k} {j}" for j in range(9))) for k in range(40)] + [(None, rows[3][1])]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    cut = dedup_lines(table, digest_bytes=1).collect()
    assert counted((r.doc_id, r.text, r.removed_chunks, r.removed_lines) for r in cut) == brute_lines(rows)


def test_chunks_end_by_their_own_lines(spark):
    shared = [f"shared line {k}" for k in range(60)]
    texts = ["\n".join([*(f"own {d} {k}" for k in range(d)), *shared, f"end {d}"]) for d in range(1, 8)]
    table = spark.createDataFrame(list(enumerate(texts, 1)), "doc_id bigint, text string").selectExpr("doc_id", "0L as t", "text")
    schema = "doc_id bigint, t bigint, line int, last int, h bigint, v bigint, chunk int"
    chunks = table.mapInArrow(lambda batches: passages(batches, False), schema).collect()
    # apart from the first and the last one, the passage falls into the same chunks in every text
    found = [{(r.line - r.doc_id, r.last - r.doc_id, r.h, r.v) for r in chunks if r.doc_id == d and r.line - d > 12 and r.last - d < 48} for d in range(1, 8)]
    assert len(found[0]) >= 3 and all(f == found[0] for f in found)
    pairs = table.mapInArrow(lambda batches: passages(batches, True), schema).collect()
    inside = {(r.doc_id, r.chunk) for r in pairs if r.chunk is not None}
    assert inside == {(r.doc_id, r.line) for r in chunks} and any(r.chunk is None for r in pairs)


def test_paths_of_repeated_rows(spark):
    """Rows of one id and text give one path; the tables that found them are deleted."""
    rows = [(k, " ".join(f"w{k % 3}x{j}" for j in range(30))) for k in range(6)] * 2 + [(9, "a b c d e f g"), (10, None)]
    join = JaccardJoin(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    join.prepare()
    ids = [r.cid for r in join.classes.collect()]
    pairs = spark.createDataFrame([(a, b) for a in ids for b in ids if a < b], "a bigint, b bigint")
    paths = join.paths(pairs)
    assert sorted(r.cid for r in paths.collect()) == sorted(ids) and len(ids) == 4
    # all that stays is the rows, their classes and the paths
    assert sorted(t.columns for t, _ in join.scratch._kept) == sorted([join.rows.columns, join.classes.columns, paths.columns])


def test_encoder_remembers_few():
    few = Encoder(public_tokenizers.path("word_bpe_49k.json"), 2, False, cached=20)
    texts = [" ".join(f"word{k * 7 + j}" for j in range(9)) for k in range(12)]
    every = Encoder(public_tokenizers.path("word_bpe_49k.json"), 2, False)
    assert [few.document(t) for t in texts] == [every.document(t) for t in texts]
    assert len(few.known) <= 20 < len(every.known)


def test_resample(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0), (10, 1, 0), (7, 0, 0), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    rows = resample(docs, labels, keep_share=0.5).collect()
    assert len(rows) == len(ROWS) and sum(r.kept for r in rows) >= 6
    assert not any(r.kept for r in rows if r.doc_id in (4, 5, 6))
    assert rows[0].asDict().keys() >= {"doc_id", "text", "source", "size", "weight", "kept"}
    assert resample(none, labels).count() == 0 and resample(docs, labels.limit(0)).filter("kept").count() > 0


def test_kth_largest(spark):
    values = [float(x) for x in np.random.default_rng(1).normal(size=30_000)] + [0.5] * 12_000
    df = spark.createDataFrame([(v,) for v in values], "key double").cache()
    ranked = sorted(values, reverse=True)
    for k in (1, 9_000, 15_000, len(values)):
        assert kth_largest(df, k) == ranked[k - 1]


def test_mixing(docs, none):
    rows = mix_sources(docs, carry=("size",)).collect()
    assert len(rows) == len(ROWS) and mix_sources(none).count() == 0
    assert all(r.taken == r.size * r.copies and r.copies <= 3 for r in rows)
    longest = max(r.size for r in rows)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= longest / 2
    assert abs(sum({r.source: r.target for r in rows}.values()) - sum(r.size for r in rows)) < 1e-6


def test_mixing_without_ids(spark):
    """Rows of no id, and equal rows, are taken one by one, so a source comes near its target."""
    rows = [(None, f"text {k} " + "w " * 48, "a", "x") for k in range(50)]
    rows += [(None, "w " * 50, "b", "x") for _ in range(50)] + [(7, "w " * 50, "c", "x") for _ in range(50)]
    rows += [(k, "w " * 50, "d", "x") for k in range(50)] + [(7, "w " * 50, "d", "y"), (7, None, "d", "x"), (7, "", "d", "x")]
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = mix_sources(table).collect()
    assert len(got) == len(rows)
    for source in "abcd":
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 25, source


def check_pieces(rows, ids):
    pieces, sequences = {}, {}
    for r in rows:
        assert bytes(r.ids) == ids[r.doc_id][r.start : r.start + r.length].tobytes()
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.window))
    for doc, parts in pieces.items():
        assert sum(n for _, n in parts) % len(ids[doc]) == 0
    for parts in sequences.values():
        end = 0
        for offset, n, window in sorted(parts):
            assert offset == end
            end += n
        assert end == window <= 4096 and end & (end - 1) == 0
    return pieces


def test_packing(docs, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    ids = {r[0]: np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4") for r in ROWS}
    pieces = check_pieces(pack_documents(docs, path).collect(), ids)
    assert pieces.keys() == ids.keys() and pack_documents(none, path).count() == 0


def test_pack_and_steps():
    lengths = [int(x) for x in np.random.default_rng(3).integers(1, 9000, 200)]
    windows, left = pack(lengths, (512, 1024, 2048, 4096), last=True)
    assert not left and sum(p[2] for w in windows for p in w) == sum(lengths)
    sizes = [sum(p[2] for p in w) for w in windows]
    steps = np.bincount(step_groups(sizes, 1 << 17), weights=sizes)
    assert steps.max() - steps.min() <= 4096


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_encoder(name, spaced):
    path = public_tokenizers.path(name)
    ours, theirs = Encoder(path, 2, spaced), Tokenizer.from_file(path)
    rng = np.random.default_rng(4)
    parts = [" ", "  ", "\n", " \n", "\t", "word", "Don't", "é", "é", "12", "!?", " ", "\x1c", "<|endoftext|>", "日本", "Σ", ",", ". ", "\0", "'s", "é."]
    texts = ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(400)] + [None, LONG]
    for text in texts:
        want = [*theirs.encode(text or "", add_special_tokens=False).ids, 2]
        assert np.frombuffer(ours.document(text), ours.dtype).tolist() == want


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_encoder_forgets(monkeypatch, name, spaced):
    """Equal ids when pieces are forgotten, tokenized in many calls, or too long to be remembered."""
    monkeypatch.setattr(tokens, "CACHED", 20)
    monkeypatch.setattr(tokens, "CACHED_CHARS", 6)
    monkeypatch.setattr(tokens, "CALL_CHARS", 10)
    path = public_tokenizers.path(name)
    ours, theirs = Encoder(path, 2, spaced), Tokenizer.from_file(path)
    rng = np.random.default_rng(6)
    for _ in range(30):
        texts = [" ".join(f"w{k}." if k % 3 else f"long-{k}-word" for k in rng.integers(0, 40, rng.integers(0, 9))) for _ in range(6)]
        want = [[*theirs.encode(t, add_special_tokens=False).ids, 2] for t in texts]
        assert [np.frombuffer(x, ours.dtype).tolist() for x in ours.documents(texts)] == want
        assert len(ours.known) <= 20


def test_token_files(docs, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    folder, files = write_token_files(docs, path)
    rows = sorted(read_token_files(folder, files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r[0] for r in ROWS), key=lambda x: (x is not None, x))
    texts, start = {r[0]: r[1] for r in ROWS}, 0
    for r in rows:
        want = np.array([*tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2], "<u4")
        assert r.start == start and bytes(r.ids) == want.tobytes()
        start += r.n_tokens
    some = read_token_files(folder, files, wanted={1, 10}).collect()
    assert {r.doc_id for r in some} == {1, 10} and zlib.crc32(bytes(some[0].ids))
    folder, files = write_token_files(none, path)
    assert read_token_files(folder, files).count() == 0


def test_damaged_file(tmp_path):
    from pyarrow import fs

    from rankloom.llm.token_files import FrameReader, FrameWriter

    store, name = fs.LocalFileSystem(), str(tmp_path / "x")
    out = FrameWriter(store.open_output_stream(name, compression=None), 2)
    for k in range(5):
        out.add(k, bytes([k, 0]) * 100_000)
    out.close()
    assert [d for d, _, _ in FrameReader(store.open_input_file(name)).documents()] == [0, 1, 2, 3, 4]
    raw = bytearray(open(name, "rb").read())
    raw[12] ^= 0xFF
    open(name, "wb").write(bytes(raw))
    with pytest.raises(Exception):
        list(FrameReader(store.open_input_file(name)).documents({0}))


def test_revisits(spark):
    schema = "record_id bigint, kind string, url string, ts bigint, status int, headers map<string,string>"
    rows = [
        (1, "response", "http://A.org:80/x#top", 10, 200, {"ETag": '"1"', "Server": "s", "Date": "d1"}),
        (2, "response", "http://a.org/x", 20, 200, {"ETag": '"2"'}),
        (3, "response", "http://a.org/x", 25, 404, {"ETag": '"3"'}),
        (4, "revisit", "HTTP://a.org/x", 15, 304, {"etag": 'W/"1"', "DATE": "d2", "Server": "t"}),
        (5, "revisit", "http://a.org/x", 30, 304, {"etag": '"1"'}),
        (6, "revisit", "http://a.org/x", 10, 304, None),
        (7, "revisit", None, 30, 304, None),
        (8, "revisit", "http://a.org/x", None, 304, None),
        (9, "revisit", "http://a.org/x", 20, 304, {}),
        (9, "revisit", "http://a.org/x", 20, 304, {}),
    ]
    # a hot URL over many partitions
    rows += [(100 + k, "response", "http://hot.org", 10 * k, 200, {}) for k in range(200)]
    rows += [(1000 + k, "revisit", "http://hot.org/", 10 * k + 5, 304, {}) for k in range(200)]
    table = spark.createDataFrame(rows, schema).repartition(4)
    got = resolve_revisits(table).collect()
    by = {r.record_id: r for r in got}
    assert len(got) == 207 and (by[4].response_id, by[4].outcome) == (1, "resolved")
    assert by[4].headers == {"etag": 'W/"1"', "server": "s", "date": "d2"}
    assert (by[5].response_id, by[5].outcome, by[5].headers) == (2, "mismatch", None)
    assert {by[k].outcome for k in (6, 7, 8)} == {"no response"} and by[9].response_id == 1
    assert all(by[1000 + k].response_id == 100 + k for k in range(200))
    assert resolve_revisits(table.limit(0)).count() == 0


def test_canonical_url(spark):
    forms = {
        "http://User:Pw@Host:80/a/./b/../c?q=1#top": "http://User:Pw@host/a/c?q=1",
        " HTTPS://host.:443 ": "https://host/",
        "https://host:?q": "https://host/?q",
        "http://host/%7Eme/%2fx/%41": "http://host/~me/%2Fx/A",
        "http://host/../../x/": "http://host/x/",
        "FTP://Me@Host/a/../b": "ftp://Me@host/a/../b",
        "http://host/" + "y/" * 50_000: "http://host/" + "y/" * 50_000,
        "http:///x": None, "/x": None, "": None, "no address": None, None: None,
    }
    table = spark.createDataFrame([(u,) for u in forms], "url string")
    got = {r.url: r.form for r in table.select("url", canonical_url(F.col("url")).alias("form")).collect()}
    assert got == forms
    again = spark.createDataFrame([(u,) for u in forms.values() if u], "url string")
    assert all(r.url == r.form for r in again.select("url", canonical_url(F.col("url")).alias("form")).collect())


def test_revisits_of_one_address(spark):
    """Spellings of one address meet; own columns that are called like the operator's play no part."""
    schema = "record_id bigint, kind string, url string, ts bigint, status int, headers map<string,string>"
    rows = [
        (1, "response", "http://Me@a.org./x/../~y", 10, 200, None),
        (2, "revisit", "http://Me@A.org:80/%7ey#z", 20, 304, None),
        (3, "revisit", "http://me@a.org/~y", 20, 304, None),
        (4, "revisit", "http://a.org/" + "z" * 2_000_000, 20, 304, {}),
    ]
    table = spark.createDataFrame(rows, schema)
    names = ("part", "found", "handed", "several", "end", "is_response", "response_id", "outcome")
    for records in (table, table.select("*", *[F.lit(c).alias(c) for c in names])):
        got = {r.record_id: r.response_id for r in resolve_revisits(records).collect()}
        assert got == {2: 1, 3: None, 4: None}


def test_search(spark):
    rng = np.random.default_rng(6)
    points = rng.normal(size=(700, 8)).astype(float)
    points[50:350] = points[50]
    rows = [(k, [float(x) for x in p]) for k, p in enumerate(points)]
    rows += [(700, None), (800, [0.0] * 8), (900, [float("nan")] * 8), (1000, [1.0] * 7), (None, [1.0] * 8), (1100, [1.0, None] * 4)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {}
    for r in search(table, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert sorted(got) == [0, 100, 200, 300, 400, 500, 600]
    found = 0
    for q, near in got.items():
        d = np.sqrt(((points - points[q]) ** 2).sum(axis=1))
        want = sorted((d[k], k) for k in range(700) if k != q)[:10]
        assert near == sorted(near) and all(abs(d[k] - s) < 1e-12 for s, k in near)
        found += len({k for _, k in near} & {k for _, k in want})
    assert found >= 0.9 * 70
    assert search(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_best_of_a_task(monkeypatch):
    monkeypatch.setattr(forest, "GATHERED", 500)
    rng = np.random.default_rng(3)
    best, given, rows = forest.Best(5), [], []
    for _ in range(60):
        n = int(rng.integers(1, 40))
        query, row = rng.integers(0, 70, n), rng.integers(0, 90, n)
        score = (query * 7 + row * 3) % 11 / 2.0
        rows += zip(query.tolist(), score.tolist(), row.tolist())
        given.append(best.add(query, row + 1000, row, score))
    given.append(best.take())
    got = [r for b in given if b is not None for r in b.to_pylist()]
    assert len([b for b in given if b is not None]) > 1 and best.take() is None
    for q in range(70):
        want = sorted({r for r in rows if r[0] == q})[:5]
        mine = sorted({(r["query"], r["score"], r["least"]) for r in got if r["query"] == q})[:5]
        assert mine == want and all(r["cls"] == r["least"] + 1000 for r in got)


def test_pieces_are_looked_up_once():
    class Counted(dict):
        looked = 0

        def get(self, key, default=None):
            self.looked += 1
            return super().get(key, default)

        def __contains__(self, key):
            self.looked += 1
            return super().__contains__(key)

        def __getitem__(self, key):
            self.looked += 1
            return super().__getitem__(key)

    path = public_tokenizers.path("byte_bpe_50k.json")
    code, plain = Encoder(path, 2, True), Tokenizer.from_file(path)
    code.known = Counted()
    texts = ["one two, one two. three", None, "two  blanks", "é. ×. a.b.\tc*, d", "one two, one four"]
    for _ in range(2):  # all pieces new, then all known
        before = code.known.looked
        got = code.documents(texts)
        assert code.known.looked - before == sum(len(code._pieces(t or "") or ()) for t in texts)
        want = [plain.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
        assert [np.frombuffer(ids, code.dtype).tolist() for ids in got] == want
