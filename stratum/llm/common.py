"""Shared helpers: scratch tables, bounded Arrow slices, vectorised hashing of words in Arrow text."""
from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import scratch_path

#: Text bytes that one numpy pass works on; Arrow batches are cut into slices of about this size.
SLICE_BYTES = 2 << 20
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [_ROOT])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared scratch folder and read it back.

    Cuts the lineage, fixes the partitioning of what follows, and survives lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_at_once() -> None:
    """Have the C library give freed arrays back to the system, so that a reused worker does not keep a shard's memory."""
    mallopt = getattr(ctypes.CDLL(None), "mallopt", None)  # only glibc has it
    if mallopt:
        mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD


def fresh(taken, *names: str) -> list[str]:
    """Column names derived from ``names`` that are not in ``taken`` (case-insensitive)."""
    low = {c.lower() for c in taken}
    out = []
    for n in names:
        while n.lower() in low:
            n = "_" + n
        low.add(n.lower())
        out.append(n)
    return out


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each slice has about ``limit`` bytes in ``column`` (one row at least)."""
    for b in batches:
        if not b.num_rows:
            continue
        _, offsets = raw_text(b.column(column))
        i = 0
        while i < b.num_rows:
            j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
            j = min(max(j, i + 1), b.num_rows)
            yield b.slice(i, j - i)
            i = j


def add_columns(df: DataFrame, text_col: str, fields: dict[str, str], fn: Callable[[pa.Array], list]) -> DataFrame:
    """``df`` with the columns ``fields`` (name -> type) that ``fn`` computes from slices of ``text_col``.

    All other columns are passed through; columns of the same names (in any case) are replaced.
    """
    ship(df.sparkSession)
    new = {f.lower() for f in fields}
    keep = [f for f in df.schema.fields if f.name.lower() not in new]
    extra = T.StructType.fromDDL(", ".join(f"`{k}` {v}" for k, v in fields.items()))
    schema = T.StructType([*keep, *extra.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *fn(b.column(b.num_columns - 1))], names=schema.names)

    text = fresh([f.name for f in keep], "_text")[0]
    return df.select(*[f"`{f.name}`" for f in keep], F.col(f"`{text_col}`").cast("string").alias(text)).mapInArrow(run, schema)


def raw_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the row offsets into them (rows + 1). Null rows are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not wide and not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    _, offs, data = column.buffers()
    off = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


# ------------------------------------------------------------------ hashing

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_pow: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow.get("p", ())) < n:
        size = max(n, SLICE_BYTES + (1 << 17))
        for key, base in (("p", _P), ("i", _P_INV)):
            a = np.full(size, base, dtype=np.uint64)
            a[0] = 1
            _pow[key] = np.cumprod(a, dtype=np.uint64)
    return _pow["p"][:n], _pow["i"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span data[start:end]: polynomial hash by prefix sums, then mixed."""
    p, inv = _powers(len(data) + 1)
    c = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[:-1], dtype=np.uint64, out=c[1:])
    return mix((c[ends] - c[starts]) * inv[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def ascii_lower(data: np.ndarray) -> np.ndarray:
    up = (data >= 65) & (data <= 90)
    return data | (up.astype(np.uint8) << 5)


def words(data: np.ndarray, offsets: np.ndarray, on: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of the words ``[^\\x20\\x09-\\x0D]+`` of every row: starts, ends, row numbers.

    No byte of a multi-byte UTF-8 character is a separator, so byte spans are character spans.
    ``on``: which bytes belong to words, where that is another rule.
    """
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    if on is None:
        on = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[0] = False
    before[1:] = on[:-1]
    starts = np.flatnonzero(on & (~before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1] = False
    after[:-1] = on[1:]
    ends = np.flatnonzero(on & (~after | edge[1:])) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


def shingles(h: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each row and their row numbers, in order of position.

    A row with fewer than k words (and at least one) has its whole sequence as one shingle.
    """
    n = len(h)
    acc = np.zeros(n, dtype=np.uint64)
    if not n:
        return acc, rows
    same = np.zeros(n, dtype=bool)
    if n >= k:
        same[:n - k + 1] = rows[:n - k + 1] == rows[k - 1:]
        m = n - k + 1
        a = np.zeros(m, dtype=np.uint64)
        for i in range(k):
            a = (a + h[i:i + m]) * np.uint64(0xFF51AFD7ED558CCD)
            a ^= a >> np.uint64(29)
        acc[:m] = mix(a + np.uint64(k))
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    count = np.diff(np.r_[first, n])
    for i in np.flatnonzero(count < k):  # short rows only
        s, c = int(first[i]), int(count[i])
        a = np.zeros(1, dtype=np.uint64)
        for j in range(c):
            a = (a + h[s + j]) * np.uint64(0xFF51AFD7ED558CCD)
            a ^= a >> np.uint64(29)
        acc[s] = mix(a + np.uint64(c))[0]
        same[s] = True
    return acc[same], rows[same]


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its file system's scheme, so that executors need no default file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return "file://" + full[5:] if full.startswith("file:/") and not full.startswith("file://") else full
