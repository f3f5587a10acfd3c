"""Files of token ids: independent zstandard frames and a trailing seek table.

A file is in the published seekable format of zstandard, so any zstandard tool can read it whole:
frames of about ``FRAME_BYTES`` of ids, a skippable frame with the documents' places, and a skippable
frame with the seek table (compressed size, content size and checksum of each frame). A reader takes
the two tables from the end and decompresses only the frames that hold the documents it wants.

Every partition of the range-sorted documents writes its own files below the folder all executors
share, under a name with the attempt's number, and moves them to their place when complete. Only files
named by finished tasks are in the table of files, so tasks that are lost or run twice do no harm.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, column_or_null, text_slices
from .tokens import encoder

FRAME_BYTES = 256 << 10
#: A partition starts another file beyond this.
FILE_BYTES = 256 << 20
#: Fixed values of the seekable format: skippable frames, seek table.
PLACES_MAGIC, TABLE_MAGIC, END_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
#: A document's id, whether it has one, frame, first byte in it, number of bytes.
PLACE = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("frame", "<u4"), ("at", "<u8"), ("size", "<u8")])


class FrameWriter:
    """One file; documents come in the order they are to have."""

    def __init__(self, stream, width: int, level: int = 3):
        self.stream, self.width = stream, width
        self.compress = zstandard.ZstdCompressor(level=level, write_checksum=True).compress
        self.frames, self.places, self.open, self.size, self.written = [], [], [], 0, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.places.append((doc_id or 0, doc_id is not None, len(self.frames), self.size, len(ids)))
        self.open.append(ids)
        self.size += len(ids)
        if self.size >= FRAME_BYTES:
            self._frame()

    def _frame(self) -> None:
        content = b"".join(self.open)
        packed = self.compress(content)
        self.stream.write(packed)
        self.frames.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.written += len(packed)
        self.open, self.size = [], 0

    def close(self) -> None:
        if self.open:
            self._frame()
        places = self.compress(bytes([self.width]) + np.array(self.places, PLACE).tobytes())
        self.stream.write(struct.pack("<II", PLACES_MAGIC, len(places)) + places)
        entries = b"".join(struct.pack("<III", *f) for f in [*self.frames, (len(places) + 8, 0, 0)])
        footer = struct.pack("<IBI", len(self.frames) + 1, 0x80, END_MAGIC)
        self.stream.write(struct.pack("<II", TABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self.stream.close()


class FrameReader:
    """Documents of one file; frames are read and checked when one of their documents is wanted."""

    def __init__(self, file):
        self.file, end = file, file.size()
        n, flags, magic = struct.unpack("<IBI", self._bytes(end - 9, 9))
        if magic != END_MAGIC or flags != 0x80:
            raise ValueError("no seek table")
        table = self._bytes(end - 9 - 12 * n, 12 * n)
        self.frames = [struct.unpack_from("<III", table, 12 * k) for k in range(n - 1)]
        self.starts = np.cumsum([0, *(f[0] for f in self.frames)])
        size = struct.unpack_from("<I", table, 12 * (n - 1))[0]
        packed = self._bytes(int(self.starts[-1]) + 8, size - 8)
        places = zstandard.ZstdDecompressor().decompress(packed)
        self.dtype = np.dtype(f"<u{places[0]}")
        self.places = np.frombuffer(places, PLACE, offset=1)

    def _bytes(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def frame(self, k: int) -> bytes:
        size, content_size, checksum = self.frames[k]
        content = zstandard.ZstdDecompressor().decompress(
            self._bytes(int(self.starts[k]), size), max_output_size=content_size
        )
        if len(content) != content_size or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} is damaged")
        return content

    def documents(self, wanted: set[int] | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """``(doc_id, start in the file, ids)`` of all documents, or of those ``wanted``."""
        sizes = self.places["size"] // self.dtype.itemsize
        starts = np.cumsum(sizes) - sizes
        chosen = np.arange(len(self.places))
        if wanted is not None:
            chosen = chosen[np.isin(self.places["doc_id"], list(wanted)) & (self.places["known"] > 0)]
        loaded, content = -1, b""
        for k in chosen:
            doc_id, known, frame, at, size = self.places[k].tolist()
            if frame != loaded:
                loaded, content = frame, self.frame(frame)
            yield doc_id if known else None, int(starts[k]), np.frombuffer(content[at : at + size], self.dtype)


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" in uri or uri.startswith("file:"):
        scheme, _, rest = uri.partition(":")
        return (fs.LocalFileSystem(), "/" + rest.lstrip("/")) if scheme == "file" else fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def writer(folder: str, path: str, end_id: int, spaced: bool):
    """Mapper from sorted documents to one row per file written."""

    def run(batches):
        code, task = encoder(path, end_id, spaced), TaskContext.get()
        store, root = open_folder(folder)
        part, out, n_docs, n_ids, done = task.partitionId(), None, 0, 0, []
        width = code.dtype.itemsize

        def finish():
            nonlocal out
            out.close()
            name = f"part-{part:07d}-{len(done):05d}-{task.taskAttemptId()}.ids.zst"
            store.move(f"{root}/_{name}", f"{root}/{name}")
            done.append((part, len(done), name, n_docs, n_ids))
            out = None

        for rows, _, _ in text_slices(batches):
            coded = code.documents(rows.column("text").to_pylist())
            for doc_id, ids in zip(rows.column("doc_id").to_pylist(), coded, strict=True):
                if out is None:
                    name = f"part-{part:07d}-{len(done):05d}-{task.taskAttemptId()}.ids.zst"
                    out, n_docs, n_ids = FrameWriter(store.open_output_stream(f"{root}/_{name}", compression=None), width), 0, 0
                out.add(doc_id, ids)
                n_docs, n_ids = n_docs + 1, n_ids + len(ids) // width
                if out.written >= FILE_BYTES:
                    finish()
        if out is not None:
            finish()
        names = ["part", "seq", "file", "n_docs", "n_ids"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        columns = zip(*done, strict=True) if done else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def reader(folder: str, wanted: set[int] | None):
    """Mapper from ``(file, first)`` to documents; ``first``: ids in all files before."""

    def run(batches):
        store, root = open_folder(folder)
        for batch in batches:
            for name, first in zip(batch.column("file").to_pylist(), batch.column("first").to_pylist(), strict=True):
                with store.open_input_file(f"{root}/{name}") as file:
                    rows, size = [], 0
                    for doc_id, start, ids in FrameReader(file).documents(wanted):
                        rows.append((doc_id, first + start, len(ids), ids.astype("<u4").tobytes()))
                        size += 4 * len(ids)
                        if size >= 4 << 20:
                            yield _batch(rows)
                            rows, size = [], 0
                    yield _batch(rows)

    return run


def _batch(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["doc_id", "start", "n_tokens", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def write_token_files(
    docs: DataFrame, path: str, end_id: int = 2, spaced: bool = True, folder: str | None = None
) -> tuple[str, DataFrame]:
    """Write all documents in ascending doc_id (null first; then by text); gives the folder and its files.

    Files: ``part, seq, file, n_docs, n_ids, first``, where ``first`` is the number of ids in all files
    before. A null or empty text is the end id alone. An empty table gives no files. The folder is one
    that pyarrow can open on every executor, by default a new one below the shared folder.
    """
    scratch = Scratch(docs.sparkSession)
    folder = folder or scratch.path("tokens")
    store, root = open_folder(folder)
    store.create_dir(root, recursive=True)
    files = scratch.keep(
        docs.select(
            column_or_null(docs, "doc_id", "bigint").alias("doc_id"),
            column_or_null(docs, "text", "string").alias("text"),
        )
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(
            writer(folder, path, end_id, spaced),
            "part bigint, seq bigint, file string, n_docs bigint, n_ids bigint",
        )
    )
    # one row per file is in a single task here
    before = Window.partitionBy().orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return folder, files.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(folder: str, files: DataFrame, wanted: set[int] | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of all documents, or of a few ``wanted``; ids as 32 bits."""
    n = max(1, files.count())
    return (
        files.select("file", "first").repartition(n, "file")
        .mapInArrow(reader(folder, wanted), "doc_id bigint, start bigint, n_tokens bigint, ids binary")
    )
