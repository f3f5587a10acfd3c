"""Helpers shared by the operators: scratch tables, joins on hot keys, text buffers, hashes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.workspace import Workspace, delete

#: Keys that ``attach`` broadcasts at most, as only keys with more than 1 / HOT_KEYS of all rows are.
HOT_KEYS = 1000
#: Bytes of text that numpy works on at a time; a longer document makes a slice of its own.
SLICE_BYTES = 1 << 19


class Scratch(Workspace):
    """Tables of one run of an operator, in the folder that all executors share."""

    def __init__(self, spark: SparkSession):
        super().__init__(spark)
        self._n = 0
        self._kept: list[tuple[DataFrame, str]] = []

    def keep(self, df: DataFrame) -> DataFrame:
        """Write and read back: cuts the lineage, so a lost executor costs a read."""
        self._n += 1
        kept = self.save(f"t{self._n}", df)
        self._kept.append((kept, self.path(f"t{self._n}")))
        return kept

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables of :meth:`keep` that nothing reads any more; other frames are left alone."""
        gone = [path for kept, path in self._kept if any(kept is t for t in tables)]
        self._kept = [(kept, path) for kept, path in self._kept if path not in gone]
        for path in gone:
            delete(self.spark, path)


def column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    """The column as ``kind``, nulls where a table lacks it."""
    return (F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast(kind)


def attach(
    rows: DataFrame, table: DataFrame, keys: list[str], count: str, total: int, how: str = "left"
) -> DataFrame:
    """Join ``rows`` with a table of one row per key, whose ``count`` is that key's rows.

    Keys with over ``total / HOT_KEYS`` rows number fewer than ``HOT_KEYS``: they are broadcast and
    their rows don't move. The others are shuffled, and none of them is hot. Keys aren't null.
    """
    if how not in ("left", "inner"):
        raise ValueError("rows are on the left")
    is_hot = F.col(count) > F.lit(total / HOT_KEYS)
    hot = F.broadcast(table.filter(is_hot))
    near = rows.join(hot, keys)
    far = rows.join(F.broadcast(table.filter(is_hot).select(*keys)), keys, "left_anti")
    return near.unionByName(far.join(table.filter(~is_hot), keys, how))


# ---- text buffers


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """``(rows, bytes, offsets)`` of at most ``limit`` bytes unless one text is longer; null is empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column))
        if texts.null_count:
            texts = texts.fill_null("")
        wide = pa.types.is_large_string(texts.type)
        _, where, data = texts.buffers()
        offsets = np.frombuffer(where, np.int64 if wide else np.int32)
        offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        first = 0
        while first < len(texts):
            end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            end = min(max(end, first + 1), len(texts))
            yield (
                batch.slice(first, end - first),
                data[offsets[first] : offsets[end]],
                offsets[first : end + 1] - offsets[first],
            )
            first = end


def _mixed(seed: int, n: int) -> np.ndarray:
    """``n`` numbers of 64 bits by the splitmix rule."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64 (fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Roller:
    """Hashes of substrings: a polynomial modulo 2^64 over random numbers for the 256 bytes."""

    def __init__(self, seed: int):
        self.values = _mixed(seed, 256)
        self.base = (int(_mixed(seed + 1, 1)[0]) & ~7) | 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self._up = self._down = np.ones(1, np.uint64)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.ones(n, np.uint64)
        done = 1
        while done < n:
            step = np.uint64(pow(base, done, 1 << 64))
            take = min(done, n - done)
            out[done : done + take] = out[:take] * step
            done += take
        return out

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums that :meth:`hashes` takes."""
        if len(data) >= len(self._up):
            n = max(len(data) + 1, min(2 * len(self._up), SLICE_BYTES + 1))
            self._up, self._down = self._powers(self.base, n), self._powers(self.inverse, n)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self._up[: len(data)], out=out[1:])
        return out

    def hashes(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the bytes in [start, end)."""
        return mix((sums[ends] - sums[starts]) * self._down[starts])


@lru_cache(maxsize=4)
def roller(seed: int) -> Roller:
    return Roller(seed)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and for each text its first word."""
    inside = ~_SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    before[cuts] = False
    after[cuts[cuts > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` words in a row within each text, and for each text its first one.

    A text with fewer words has one hash, that of all its words; one without words has none.
    """
    n = np.diff(first)
    counts = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    where = np.zeros(len(n) + 1, np.int64)
    np.cumsum(counts, out=where[1:])
    factor = _mixed(77, width) | np.uint64(1)
    # the place of each hash's first word
    at = np.arange(where[-1]) + np.repeat(first[:-1] - where[:-1], counts)
    short = np.repeat(np.minimum(n, width), counts)
    out = short.astype(np.uint64)
    for k in range(width):
        has = short > k
        if has.all():
            out = out + words[at + k] * factor[k]
        else:
            out[has] += words[at[has] + k] * factor[k]
    return mix(out), where
