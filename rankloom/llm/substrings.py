"""Removal of repeated byte strings by prefix doubling on sampled positions.

A byte goes if a string of ``LENGTH`` bytes that covers it starts at two places of all texts. Doubling
ranks over every byte would move a row per byte and round, so positions are sampled first: of the
``GRAM``-byte strings in a window, the one of the least hash is its anchor. Equal windows have equal
anchors at equal offsets, so a window whose anchor is nowhere else is unique. The windows that share an
anchor are one run of consecutive positions.

1. Runs whose anchor occurs once are past.
2. Runs that occur elsewhere from their first to their last byte are settled whole.
3. For the positions of the others, and of one copy of each settled run with the same anchor, the ranks
   of the first ``LENGTH / 2`` bytes and of as many bytes at that offset make a pair. Positions whose pair
   is unique are past, the others are repeated. Runs of one anchor are sorted together and paired in one
   task; where an anchor has over ``GROUP`` runs, Spark groups a row per position instead.

Ranks are hashes, so they need no global sort. Of equal texts one takes part; all are removed whole. Hashes of texts, anchors, runs and pairs have 64 bits: of
n different ones about n^2 / 2^65 pairs are expected to be confused. They are drawn anew for each run, so no rows can be made to collide.
"""

from __future__ import annotations

import secrets
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Roller, Scratch, attach, column_or_null, mix, text_slices

LENGTH = 200
GRAM = 32
#: Texts and runs (20 bytes each) up to which a table of runs is broadcast to the texts.
BROADCAST_TEXTS, BROADCAST_RUNS = 250_000, 2_000_000
#: Runs of one anchor, each under 400 bytes, that one task holds at a time.
GROUP = 4096
#: Positions of a slice that numpy works on.
SLICE = 1 << 20


@lru_cache(maxsize=1)
def drawn(seed: int) -> Roller:
    """The hashes of one run."""
    return Roller(seed)


def text_key(text: Column, seed: int) -> Column:
    """64 bits of a SHA-256 over the seed and the text; xxhash64 gives one value to texts made for it."""
    digest = F.sha2(F.concat(F.lit(f"{seed:016x}"), text), 256)
    return F.conv(F.substring(digest, 1, 16), 16, -10).cast("bigint")


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values in a row, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


def runs_of(data: np.ndarray, one: Roller) -> tuple[np.ndarray, ...]:
    """First position, number of positions, anchor hash and hash of all bytes of the runs of a text."""
    sums = one.sums(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = one.hashes(sums, at, at + GRAM)
    width = LENGTH - GRAM + 1
    least = sliding_min(grams, width)
    group = leftmost(grams, least)
    new = np.flatnonzero(np.diff(group)) + 1
    first = np.concatenate([[0], new])
    count = np.diff(np.concatenate([first, [len(least)]]))
    whole = one.hashes(sums, first, first + count + LENGTH - 1)
    return first, count, grams[group[first]], whole


def leftmost(grams: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For each window the first place at or after its start that has the window's least hash."""
    # windows in a row with one least hash look for the same value
    starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    lengths = np.diff(np.concatenate([starts, [len(least)]]))
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    low = np.searchsorted(ranked, least[starts], "left")
    high = np.searchsorted(ranked, least[starts], "right")
    out = np.repeat(order[low], lengths)
    for k in np.flatnonzero(high - low > 1).tolist():
        window = np.arange(starts[k], starts[k] + lengths[k])
        same = order[low[k] : high[k]]  # ascending, as the sort is stable
        out[window] = same[np.searchsorted(same, window)]
    return out


RUNS = "t bigint, first int, n int, anchor bigint, whole bigint"


def runs(batches, seed: int):
    """The runs of every text of at least ``LENGTH`` bytes."""
    for rows, data, offsets in text_slices(batches, limit=SLICE):
        found, which = [], []
        for k in range(len(offsets) - 1):
            text = data[offsets[k] : offsets[k + 1]]
            if len(text) >= LENGTH:
                found.append(runs_of(text, drawn(seed)))
                which.append(np.full(len(found[-1][0]), k))
        if found:
            first, n, anchor, whole = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("t").take(pa.array(np.concatenate(which))),
                    pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32)),
                    pa.array(anchor.view(np.int64)), pa.array(whole.view(np.int64)),
                ],
                ["t", "first", "n", "anchor", "whole"],
            )


def pairs_at(one, sums: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The pair of ranks at each position: the first half and the half at that offset."""
    half = LENGTH // 2
    head, tail = one.hashes(sums, at, at + half), one.hashes(sums, at + half, at + LENGTH)
    return mix(head * np.uint64(3) + mix(tail))


def rank_pairs(batches, seed: int):
    """From the bytes of runs ``(pair, t, at, open)``, a row per position."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        one, n = drawn(seed), np.array([len(x) - LENGTH + 1 for x in texts], np.int64)
        if not len(n):
            continue
        start = np.cumsum(n + LENGTH - 1) - (n + LENGTH - 1)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        data = np.frombuffer(b"".join(texts), np.uint8)
        run = pa.array(np.repeat(np.arange(len(n)), n))
        at = batch.column("first").take(run).to_numpy() + place
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(pairs_at(one, one.sums(data), place + np.repeat(start, n)).view(np.int64)),
                batch.column("t").take(run), pa.array(at.astype(np.int32)), batch.column("open").take(run),
            ],
            ["pair", "t", "at", "open"],
        )


def run_bytes(batches):
    """From ``(t, text, runs)`` the bytes of each run."""
    for rows, data, offsets in text_slices(batches):
        out = [
            (r["anchor"], k, r["first"], r["open"],
             data[offsets[k] + r["first"] : offsets[k] + r["first"] + r["n"] + LENGTH - 1].tobytes())
            for k, given in enumerate(rows.column("runs").to_pylist())
            for r in given
        ]
        for a in range(0, len(out), 10_000):
            anchor, k, first, is_open, text = zip(*out[a : a + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor, pa.int64()), rows.column("t").take(pa.array(k)),
                    pa.array(first, pa.int32()), pa.array(is_open), pa.array(text, pa.binary()),
                ],
                ["anchor", "t", "first", "open", "text"],
            )


def paired(batches, seed: int):
    """From the runs sorted by anchor and place, ``(t, first, n)`` of the repeated positions of open runs."""

    def judge(rows: pa.RecordBatch) -> pa.RecordBatch:
        place = np.stack([rows.column(c).cast(pa.int64()).to_numpy() for c in ("anchor", "t", "first")])
        again = np.concatenate([[False], (place[:, 1:] == place[:, :-1]).all(axis=0)])
        rows = rows.filter(pa.array(~again))
        texts = rows.column("text").to_pylist()
        data = np.frombuffer(b"".join(texts), np.uint8)
        n = np.array([len(x) - LENGTH + 1 for x in texts])
        start = np.cumsum(n + LENGTH - 1) - (n + LENGTH - 1)
        run, where = np.repeat(np.arange(len(n)), n), np.cumsum(n) - n
        place = np.arange(n.sum()) - np.repeat(where, n)
        one = drawn(seed)
        pair = pairs_at(one, one.sums(data), place + np.repeat(start, n))
        _, group, count = np.unique(pair, return_inverse=True, return_counts=True)
        is_open = rows.column("open").to_numpy(zero_copy_only=False)
        hit = np.concatenate([[False], (count[group] > 1) & is_open[run], [False]])
        # a span of hits ends with its run
        begins = hit[1:-1] & (~hit[:-2] | (place == 0))
        ends = hit[1:-1] & (~hit[2:] | (place == n[run] - 1))
        begins, ends = np.flatnonzero(begins), np.flatnonzero(ends)
        first = rows.column("first").to_numpy()[run[begins]] + place[begins]
        return pa.RecordBatch.from_arrays(
            [
                rows.column("t").take(pa.array(run[begins])),
                pa.array(first.astype(np.int32)), pa.array((ends - begins + 1).astype(np.int32)),
            ],
            ["t", "first", "n"],
        )

    held = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        anchor = batch.column("anchor").to_numpy()
        cut = int(np.searchsorted(anchor, anchor[-1])) if len(anchor) else 0
        if cut:
            yield judge(batch.slice(0, cut))
        held = batch.slice(cut)
    if held is not None and held.num_rows:
        yield judge(held)


def cut_out(batches):
    """``doc_id, n_bytes, n_removed, spans, kept`` from texts and the runs of repeated positions."""
    for rows, data, offsets in text_slices(batches):
        out = []
        copied = rows.column("copied").to_pylist()
        for k, given in enumerate(rows.column("runs").to_pylist()):
            text, spans = data[offsets[k] : offsets[k + 1]], []
            if copied[k] and len(text) >= LENGTH:
                spans = [(0, len(text))]
            elif given:
                for r in sorted((r["first"], r["first"] + r["n"] - 1 + LENGTH) for r in given):
                    if spans and r[0] <= spans[-1][1]:
                        spans[-1] = (spans[-1][0], max(spans[-1][1], r[1]))
                    else:
                        spans.append(r)
            edges = [0, *(e for s in spans for e in s), len(text)]
            kept = b"".join(text[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2], strict=True))
            out.append((len(text), len(text) - len(kept), [{"start": a, "end": b} for a, b in spans], kept))
        n, removed, spans, kept = zip(*out, strict=True)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(spans, span), pa.array(kept, pa.binary()),
            ],
            ["doc_id", "n_bytes", "n_removed", "spans", "kept"],
        )


def several(rows: DataFrame, key: str) -> DataFrame:
    """``(key, n_key)`` of the keys that more than one row has."""
    return rows.groupBy(key).agg(F.count("*").alias("n_key")).filter("n_key > 1")


def with_runs(texts: DataFrame, table: DataFrame, scratch: Scratch, keys: list[str], how: str) -> DataFrame:
    """Texts joined with ``table(*keys, runs)``, which is broadcast if it is small."""
    table = scratch.keep(table)
    n, total = table.agg(F.count("*"), F.coalesce(F.sum(F.size("runs")), F.lit(0))).first()
    if n <= BROADCAST_TEXTS and total <= BROADCAST_RUNS:
        table = F.broadcast(table)
    return texts.join(table, keys, how)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept``, one row per row of ``docs``.

    ``spans`` are the removed byte ranges, ``kept`` the other bytes, which may not be whole characters.
    Strings don't cross texts and are judged on the input. Null counts as empty; texts under 200 bytes
    stay whole, also when repeated. Rows are judged whatever their ids. An empty table gives an empty one.
    Columns other than doc_id and text aren't read.
    """
    scratch = Scratch(docs.sparkSession)
    seed = secrets.randbits(60)
    text = F.coalesce(column_or_null(docs, "text", "string"), F.lit(""))
    texts = docs.select(
        column_or_null(docs, "doc_id", "bigint").alias("doc_id"), text_key(text, seed).alias("t"), text.alias("text")
    )
    copied = (
        texts.groupBy("t").agg(F.count("*").alias("n"), F.min("doc_id").alias("one"))
        .filter("n > 1").select("t", "one", F.array().cast("array<int>").alias("runs"), F.lit(True).alias("copied"))
    )
    copied = scratch.keep(copied)
    # of equal texts one takes part; rows of one id and text are told apart by their places
    single = with_runs(texts, copied, scratch, ["t"], "left").filter(
        F.col("copied").isNull() | F.col("doc_id").eqNullSafe(F.col("one"))
    )
    every = scratch.keep(single.select("t", "text").mapInArrow(partial(runs, seed=seed), RUNS))
    shared = scratch.keep(several(every, "anchor"))
    alive = scratch.keep(
        attach(every, shared, ["anchor"], "n_key", every.count(), "inner").drop("n_key").distinct()
    )
    settled = scratch.keep(several(alive, "whole"))
    mine = F.broadcast(copied.select("t", "copied")) if copied.count() <= BROADCAST_TEXTS else copied.select("t", "copied")
    judged = scratch.keep(
        attach(alive, settled, ["whole"], "n_key", alive.count()).join(mine, "t", "left")
        .withColumn("open", F.col("n_key").isNull() & F.col("copied").isNull())
        .withColumn("settled", F.col("n_key").isNotNull())
        .drop("n_key", "copied")
    )
    # with the open runs go the others of their anchors, once for all that are equal
    others = judged.filter("not open").groupBy("whole").agg(F.min(F.struct("anchor", "t", "first", "n")).alias("r"))
    openly = judged.filter("open").select("anchor").distinct()
    spare = others.select("r.*").join(openly, "anchor", "left_semi").withColumn("open", F.lit(False))
    asked = scratch.keep(
        judged.filter("open").select("anchor", "t", "first", "n", "open").unionByName(spare)
    )
    sizes = scratch.keep(several(asked, "anchor"))
    asked = attach(asked, sizes, ["anchor"], "n_key", asked.count(), "inner")
    grouped = asked.groupBy("t").agg(F.collect_list(F.struct("anchor", "first", "n", "open")).alias("runs"))
    strings = scratch.keep(
        with_runs(single.drop("runs"), grouped, scratch, ["t"], "inner").select("t", "text", "runs")
        .mapInArrow(run_bytes, "anchor bigint, t bigint, first int, open boolean, text binary")
    )
    large = sizes.filter(F.col("n_key") > GROUP).select("anchor")
    in_groups = (
        strings.join(large, "anchor", "left_anti")
        .repartition("anchor").sortWithinPartitions("anchor", "t", "first")
        .mapInArrow(partial(paired, seed=seed), "t bigint, first int, n int")
    )
    pairs = scratch.keep(
        strings.join(large, "anchor", "left_semi")
        .mapInArrow(partial(rank_pairs, seed=seed), "pair bigint, t bigint, at int, open boolean").distinct()
    )
    hits = attach(
        pairs.filter("open").drop("open"), scratch.keep(several(pairs, "pair")), ["pair"], "n_key",
        pairs.count(), "inner",
    ).select("t", F.col("at").alias("first"))
    # positions in a row are one run again
    row = F.row_number().over(Window.partitionBy("t").orderBy("first"))
    by_row = (
        hits.withColumn("group", F.col("first") - row)
        .groupBy("t", "group").agg(F.min("first").alias("first"), F.count("*").cast("int").alias("n"))
        .drop("group")
    )
    # runs that touch or overlap are one span, so a text has few
    found = in_groups.unionByName(by_row).unionByName(judged.filter("settled").select("t", "first", "n"))
    before = Window.partitionBy("t").orderBy("first", "n").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("t").orderBy("first", "n").rowsBetween(Window.unboundedPreceding, 0)
    apart = F.coalesce(F.col("first") > F.max(F.col("first") + F.col("n")).over(before), F.lit(True))
    spans = (
        found.withColumn("apart", apart.cast("int")).withColumn("span", F.sum("apart").over(upto))
        .groupBy("t", "span")
        .agg(
            F.min("first").alias("first"),
            (F.max(F.col("first") + F.col("n")) - F.min("first")).alias("n"),
        )
        .groupBy("t").agg(F.collect_list(F.struct("first", "n")).alias("runs"))
    )
    removal = spans.join(copied.select("t", "copied"), "t", "full").select(
        "t",
        F.when(F.col("copied").isNull(), F.col("runs"))
        .otherwise(F.array().cast("array<struct<first:int,n:int>>")).alias("runs"),
        "copied",
    )
    return with_runs(texts, removal, scratch, ["t"], "left").select(
        "doc_id", "text", "runs", F.coalesce("copied", F.lit(False)).alias("copied")
    ).mapInArrow(
        cut_out,
        "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept binary",
    )
