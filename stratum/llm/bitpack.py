"""Token ids in fixed-width bit-packed files, with random access.

File: header ``SBITPK01``, width and ids per block (unsigned 32-bit); blocks of ids packed with
``width`` bits each, lowest bit first; footer with the byte offset of every block, the document
ids, a null mark and the end position of every document; trailer with the counts, the footer's
offset and the header mark again. All numbers are little-endian. ``width`` is the least number
of bits that holds the largest id of the vocabulary.

Documents are range-partitioned and sorted by id (ties by text hash; null ids first), one file
per partition, so files in name order hold all documents in ascending order. Each task writes
its file under a temporary name and renames it when complete, so a task that runs again after a
lost executor leaves the same file. Null texts are empty documents (the end id alone); an empty
table gives no files and no rows. Columns beyond the id and the text are not read.
"""
from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from . import tokens
from .common import qualified, ship, slices, stored
from ..session import scratch_path

MARK = b"SBITPK01"
BLOCK_IDS = 4096
_TRAILER = struct.Struct("<QQQQ8s")
MANIFEST = "part int, file string, docs long, ids long"


def bits_for(largest_id: int) -> int:
    return max(1, int(largest_id).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """``width`` bits per id, lowest bit first, padded with zero bits to whole bytes."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, width: int, count: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{width // 8}", count=count).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(data, dtype=np.uint8), bitorder="little", count=count * width)
    return bits.reshape(count, width).astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class Writer:
    """Appends documents to one file; blocks are written as they fill."""

    def __init__(self, uri: str, width: int, block_ids: int = BLOCK_IDS):
        self.uri, self.width, self.block = uri, width, block_ids
        self.fs, self.path = open_fs(uri)
        self.temp = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.out = self.fs.open_output_stream(self.temp)
        head = MARK + struct.pack("<II", width, block_ids)
        self.out.write(head)
        self.at, self.offsets, self.ids, self.pending = len(head), [], 0, b""
        self.doc_ids: list[int] = []
        self.nulls: list[int] = []
        self.ends: list[int] = []

    def add(self, doc_ids: list[int | None], ids: list[bytes]) -> None:
        """``ids``: each document's ids as little-endian unsigned 32-bit bytes."""
        for d, b in zip(doc_ids, ids):
            self.ids += len(b) // 4
            self.doc_ids.append(0 if d is None else d)
            self.nulls.append(d is None)
            self.ends.append(self.ids)
        self.pending = b"".join([self.pending, *ids])
        self._flush(len(self.pending) // 4 // self.block * self.block)

    def _flush(self, count: int) -> None:
        if not count:
            return
        arr = np.frombuffer(self.pending, dtype="<u4", count=count)
        for i in range(0, count, self.block):
            data = pack(arr[i:i + self.block], self.width)
            self.offsets.append(self.at)
            self.out.write(data)
            self.at += len(data)
        self.pending = self.pending[count * 4:]

    def close(self) -> None:
        self._flush(len(self.pending) // 4)
        self.offsets.append(self.at)
        for values, kind in ((self.offsets, "<u8"), (self.doc_ids, "<i8"), (self.nulls, "u1"), (self.ends, "<u8")):
            self.out.write(np.array(values, dtype=kind).tobytes())
        self.out.write(_TRAILER.pack(self.ids, len(self.ends), len(self.offsets) - 1, self.at, MARK))
        self.out.close()
        self.fs.move(self.temp, self.path)


class Reader:
    """Random access to the ids and documents of one file."""

    def __init__(self, uri: str):
        fs, path = open_fs(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        self.n_ids, self.n_docs, self.n_blocks, foot, mark = _TRAILER.unpack(self._at(size - _TRAILER.size, _TRAILER.size))
        head = self._at(0, 16)
        if mark != MARK or head[:8] != MARK:
            raise ValueError(f"not a packed id file: {uri}")
        self.width, self.block = struct.unpack("<II", head[8:])
        raw = self._at(foot, size - _TRAILER.size - foot)
        cuts = np.cumsum([0, 8 * (self.n_blocks + 1), 8 * self.n_docs, self.n_docs, 8 * self.n_docs])
        self.offsets, self.doc_ids, self.nulls, self.ends = (
            np.frombuffer(raw[a:b], dtype=k) for a, b, k in zip(cuts, cuts[1:], ("<u8", "<i8", "u1", "<u8")))

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids at positions start..stop-1; only the blocks that hold them are read."""
        stop = min(stop, self.n_ids)
        if stop <= start:
            return np.zeros(0, np.uint32)
        a, b = start // self.block, (stop - 1) // self.block + 1
        base, last = int(self.offsets[a]), int(self.offsets[b])
        data = self._at(base, last - base)
        out = []
        if self.block * self.width % 8 == 0:  # blocks end on whole bytes: unpack them together
            out.append(unpack(data, self.width, min(b * self.block, self.n_ids) - a * self.block))
        else:
            for i in range(a, b):
                own = data[int(self.offsets[i]) - base:int(self.offsets[i + 1]) - base]
                out.append(unpack(own, self.width, min(self.block, self.n_ids - i * self.block)))
        return np.concatenate(out)[start - a * self.block:stop - a * self.block]

    def documents(self, step: int = 1 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(document id, start, ids) of every document, reading about ``step`` ids at a time."""
        i = 0
        while i < self.n_docs:
            lo = int(self.ends[i - 1]) if i else 0
            j = max(i + 1, int(np.searchsorted(self.ends, lo + step, side="right")))
            arr, at = self.ids(lo, int(self.ends[j - 1])), lo
            for k in range(i, j):
                end = int(self.ends[k])
                yield (None if self.nulls[k] else int(self.doc_ids[k])), at, arr[at - lo:end - lo]
                at = end
            i = j


def write_ids(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode ``text_col`` (plus ``end_id`` per document) into packed files under ``path``.

    Returns the manifest: one row per file (part, file, docs, ids), parts in document order.
    """
    spark = docs.sparkSession
    ship(spark)
    base = qualified(spark, path or scratch_path(spark, "packed-ids")).rstrip("/")
    width = bits_for(max(tokens.vocabulary_size(tokenizer) - 1, end_id))
    end = np.array([end_id], dtype="<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        uri, out, enc = f"{base}/part-{part:06d}.ids", None, tokens.encoder(tokenizer)
        for b in slices(batches, "t"):
            out = out or Writer(uri, width)
            out.add(b.column("d").to_pylist(), [x + end for x in enc.encode(b.column("t").to_pylist())])
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "file": [uri],
                                              "docs": [len(out.ends)], "ids": [out.ids]})

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("d"), F.col(f"`{text_col}`").cast("string").alias("t"))
    order = [F.col("d").asc_nulls_first(), F.xxhash64("t")]
    return stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, MANIFEST), "packed-manifest")


def read_ids(manifest: DataFrame, digest: bool = False) -> DataFrame:
    """Documents read back from the files of a manifest: doc_id, start, n_tokens and ids.

    ``start`` counts the ids of all documents before. With ``digest``, ``ids_crc32`` (over the ids as
    little-endian unsigned 32-bit integers) takes the place of ``ids``. The window below runs
    over one row per file.
    """
    ship(manifest.sparkSession)
    schema = "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<long>")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for uri, base in zip(f["file"], f["base"]):
                rows, size = [], 0
                for d, at, ids in Reader(uri).documents():
                    rows.append((d, base + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()) if digest else ids.astype(np.int64)))
                    size += 64 if digest else 64 + 8 * len(ids)
                    if size > 8 << 20:
                        yield _frame(rows, digest)
                        rows, size = [], 0
                if rows:
                    yield _frame(rows, digest)

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("part", "file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    n = max(1, manifest.count())
    return placed.repartition(n, "part").mapInPandas(read, schema)


def _frame(rows: list[tuple], digest: bool) -> pd.DataFrame:
    d, s, n, x = zip(*rows)
    return pd.DataFrame({"doc_id": pd.array(d, dtype="Int64"), "start": s, "n_tokens": n, "ids_crc32" if digest else "ids": x})
