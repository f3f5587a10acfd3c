"""Line dedup by content-defined chunks of lines.

Blank lines apart, a chunk ends behind a line when the rolling hash over the hashes of the last ``WINDOW`` lines
is divisible by ``DIVISOR``, so its ends depend on these lines alone. Chunks with equal digests are compared
by their bytes, and all but the first of equal ones are cut. What they leave of a repeated passage, at its edges
and in single lines between ends, is found by pairs: a line that isn't blank, the next such line and the blank
lines between them. Pairs inside a chunk that is cut stand in its first occurrence as well and take no part;
the others are compared in the same way. So every passage of two or more lines is cut wherever it is repeated.
"""

from __future__ import annotations

from functools import partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, attach, column_or_null, mix, roller, text_slices

#: Lines that decide whether a chunk ends, and one of how many such ends there is.
WINDOW = 2
DIVISOR = np.uint64(4)
#: Runs of lines (some 80 bytes each) that are joined with the texts by a broadcast.
BROADCAST_ROWS = 250_000
#: Bytes of text whose lines are hashed at a time; a longer text is a slice of its own.
SLICE_BYTES = 1 << 19
#: Bytes of a digest, at most 16; with fewer, more passages that differ are told apart by their bytes.
DIGEST_BYTES = 16

PASSAGES = "doc_id bigint, t bigint, line int, last int, h bigint, v bigint, chunk int"


def chunk_ends(hashes: np.ndarray, of_text: np.ndarray) -> np.ndarray:
    """Whether a chunk ends with each line; ``hashes`` of the lines and the texts they lie in."""
    rolled = hashes.copy()
    factor = np.uint64(0x9E3779B97F4A7C15)
    power = factor
    for back in range(1, min(WINDOW, len(hashes))):
        rolled[back:] += np.where(of_text[back:] == of_text[:-back], hashes[:-back] * power, np.uint64(0))
        power = power * factor
    ends = mix(rolled) % DIVISOR == 0
    ends[:-1] |= of_text[1:] != of_text[:-1]
    ends[-1:] = True
    return ends


def passages(batches, pairs: bool, digest_bytes: int = DIGEST_BYTES):
    """One row per chunk of two or more lines that aren't blank, or per two successive such lines.

    Lines are numbered from 0 in each text. ``chunk`` is the first line of the chunk that the passage lies in,
    null for a pair with a chunk's end between its lines.
    """
    for rows, data, offsets in text_slices(batches, limit=SLICE_BYTES):
        newline = data == 10
        breaks = np.flatnonzero(newline) + 1
        begins = np.unique(np.concatenate([offsets[:-1][offsets[:-1] < offsets[1:]], breaks[breaks < len(data)]]))
        if len(begins) < 2:
            continue
        ends = np.append(begins[1:], len(data))
        of_text = np.searchsorted(offsets, begins, "right") - 1
        numbers = np.arange(len(begins)) - np.searchsorted(begins, offsets[of_text])
        solid = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data > 32) | (data < 9), out=solid[1:])
        full = np.flatnonzero(solid[ends] > solid[begins])
        if len(full) < 2:
            continue
        begins, ends, of_text, numbers = begins[full], ends[full], of_text[full], numbers[full]
        # the newline behind a passage is left out, so a last line is like any other
        stops = ends - newline[ends - 1]
        line = roller(11)
        final = chunk_ends(line.hashes(line.sums(data), begins, stops), of_text)
        number = np.cumsum(final) - final
        opening = np.flatnonzero(np.append(True, final[:-1]))
        if pairs:
            one = np.flatnonzero(of_text[:-1] == of_text[1:])
            two = one + 1
        else:
            one, two = opening, np.flatnonzero(final)
            one, two = one[one < two], two[one < two]
        if not len(one):
            continue
        view = memoryview(data.tobytes())
        digests = b"".join(
            blake2b(view[a:b], digest_size=digest_bytes).digest().ljust(16)
            for a, b in zip(begins[one].tolist(), stops[two].tolist(), strict=True)
        )
        h, v = np.frombuffer(digests, np.int64).reshape(-1, 2).T
        pick = pa.array(of_text[one])
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id").take(pick), rows.column("t").take(pick),
                pa.array(numbers[one], pa.int32()), pa.array(numbers[two], pa.int32()),
                pa.array(np.ascontiguousarray(h)), pa.array(np.ascontiguousarray(v)),
                pa.array(numbers[opening[number[one]]], pa.int32(), mask=number[one] != number[two]),
            ],
            [c.split()[0] for c in PASSAGES.split(", ")],
        )


def _near(table: DataFrame, n_rows: int) -> DataFrame:
    return F.broadcast(table) if n_rows <= BROADCAST_ROWS else table


def _spelled(text: DataFrame, wanted: DataFrame, n_wanted: int) -> DataFrame:
    """The written passages ``wanted`` with their own text as ``passage``, which moves but for broadcast places."""
    places = wanted.groupBy("doc_id", "t").agg(F.collect_set(F.struct("line", "last", "h", "v")).alias("_places"))
    places = _near(places.withColumnsRenamed({"doc_id": "_d", "t": "_h"}), n_wanted)
    same = text["doc_id"].eqNullSafe(places["_d"]) & text["t"].eqNullSafe(places["_h"])
    found = text.join(places, same).withColumn("_lines", F.split("text", "(?<=\n)"))
    return (
        found.select("doc_id", "t", "_lines", F.explode("_places").alias("_p"))
        .select("doc_id", "t", "_p.*", F.slice("_lines", F.col("_p.line") + 1, F.col("_p.last") - F.col("_p.line") + 1).alias("_l"))
        .withColumn("passage", F.rtrim(F.array_join("_l", ""), F.lit("\n")))
        .drop("_l")
    )


def later_passages(text: DataFrame, every: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id, t, line, last`` of the passages of written ``every`` that stand at an earlier place as well.

    Equal digests only make candidates: their bytes are grouped, and digests that stand for several texts
    are taken text by text.
    """
    total = every.count()
    counts = scratch.keep(every.groupBy("h", "v").agg(F.count("*").alias("n")).filter("n > 1"))
    wanted = scratch.keep(attach(every.drop("chunk"), counts, ["h", "v"], "n", total, "inner").drop("n"))
    spelled = _spelled(text, wanted, wanted.count())
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t", "line", "last")
    texts = spelled.groupBy("h", "v", "passage").agg(
        F.min(place).alias("first"), F.max(place).alias("final"), F.count("*").alias("n")
    )
    digests = scratch.keep(
        texts.groupBy("h", "v").agg(
            F.count("*").alias("kinds"), F.min("first").alias("first"), F.max("final").alias("final"),
            F.sum("n").alias("n"),
        ).filter("first != final").drop("final")
    )
    # a passage may share a line with the first occurrence: that is no other occurrence
    apart = ~(
        F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("t") == F.col("first.t"))
        & (F.col("line") <= F.col("first.last"))
    )
    columns = ["doc_id", "t", "line", "last"]
    single = digests.filter("kinds = 1").drop("kinds")
    later = attach(wanted, single, ["h", "v"], "n", total, "inner").filter(apart).select(*columns)
    torn = digests.filter("kinds > 1").select("h", "v")
    if torn.isEmpty():
        return later
    mixed = scratch.keep(spelled.join(torn, ["h", "v"]))
    firsts = mixed.groupBy("h", "v", "passage").agg(F.min(place).alias("first"))
    return later.unionByName(mixed.join(firsts, ["h", "v", "passage"]).filter(apart).select(*columns))


def repeated_lines(docs: DataFrame, scratch: Scratch, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """``doc_id, t, runs(line, last), n_chunks, n_lines`` of the lines to cut; docs: ``_id, _t, _text``."""
    text = docs.select(F.col("_id").alias("doc_id"), F.col("_t").alias("t"), F.col("_text").alias("text"))
    found = partial(passages, digest_bytes=digest_bytes)
    chunks = scratch.keep(text.mapInArrow(partial(found, pairs=False), PASSAGES))
    cut = scratch.keep(later_passages(text, chunks, scratch).distinct())
    known = _near(
        cut.select(F.col("doc_id").alias("_d"), F.col("t").alias("_h"), F.col("line").alias("_line")), cut.count()
    )
    pairs = text.mapInArrow(partial(found, pairs=True), PASSAGES)
    inside = pairs["doc_id"].eqNullSafe(known["_d"]) & (pairs["t"] == known["_h"]) & (pairs["chunk"] == known["_line"])
    rest = scratch.keep(pairs.join(known, inside, "left_anti"))
    later = cut.unionByName(later_passages(text, rest, scratch))
    # passages of a text that touch make one run; there are at most as many as it has lines
    in_text = Window.partitionBy("doc_id", "t").orderBy("line", "last")
    before = F.max("last").over(in_text.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce(F.col("line") > before + 1, F.lit(True))
    return scratch.keep(
        later.select("doc_id", "t", "line", "last")
        .withColumn("starts", starts.cast("int"))
        .withColumn("run", F.sum("starts").over(in_text))
        .groupBy("doc_id", "t", "run")
        .agg(F.min("line").alias("line"), F.max("last").alias("last"))
        .groupBy("doc_id", "t")
        .agg(
            F.array_sort(F.collect_list(F.struct("line", "last"))).alias("runs"),
            F.count("*").cast("bigint").alias("n_chunks"),
            F.sum(F.col("last") - F.col("line") + 1).alias("n_lines"),
        )
    )


def dedup_lines(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """``docs`` with repeated runs of lines cut from ``text``, and ``removed_chunks``, ``removed_lines``.

    A run begins and ends with a line that isn't blank and has two or more of them. All its lines are cut
    wherever it occurs but in the first place: smallest doc_id (null last), then the place in the text. A
    first occurrence may share lines with a later occurrence of another run: these lines go, as they stay at an
    earlier place; so each line stays somewhere. ``removed_chunks`` counts the gaps made by the cuts.
    With a line goes the newline behind it. Rows equal in doc_id and text are treated alike. A null text
    stays null, empty texts stay empty. Other columns pass through whatever their names; an own column
    called like one of the new two is replaced.
    """
    scratch = Scratch(docs.sparkSession)
    columns = [c for c in docs.columns if c not in ("text", "removed_chunks", "removed_lines")]
    text = column_or_null(docs, "text", "string")
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row") if columns else F.lit(None).alias("_row"),
        column_or_null(docs, "doc_id", "bigint").alias("_id"),
        F.xxhash64(text).alias("_t"),
        text.alias("_text"),
    )
    cuts = repeated_lines(keyed.drop("_row"), scratch, digest_bytes)
    ends = F.concat(F.array(F.lit(0)), F.transform("runs", lambda r: r["last"] + 1))
    begins = F.concat(F.transform("runs", lambda r: r["line"]), F.array(F.size("_lines")))
    left = F.flatten(F.zip_with(ends, begins, lambda a, b: F.slice("_lines", a + 1, b - a)))
    n_runs = cuts.agg(F.coalesce(F.sum("n_chunks"), F.lit(0))).first()[0]
    table = F.broadcast(cuts) if n_runs <= BROADCAST_ROWS else cuts
    same = keyed["_id"].eqNullSafe(table["doc_id"]) & keyed["_t"].eqNullSafe(table["t"])
    split = F.when(F.col("runs").isNotNull(), F.split("_text", "(?<=\n)"))
    joined = keyed.join(table, same, "left").withColumn("_lines", split)
    order = [
        F.when(F.col("runs").isNull(), F.col("_text")).otherwise(F.array_join(left, "")).alias(c)
        if c == "text" else F.col(f"_row.`{c}`").alias(c)
        for c in docs.columns
        if c == "text" or c in columns
    ]
    return joined.select(
        *order,
        F.coalesce("n_chunks", F.lit(0)).alias("removed_chunks"),
        F.coalesce("n_lines", F.lit(0)).alias("removed_lines"),
    )
