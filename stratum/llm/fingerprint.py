"""Document fingerprints that add up: a homomorphic multiset hash of paragraphs.

A text is the multiset of its lines. Each line is hashed to a wide vector, and the
fingerprint vector of a text is the sum of its lines' vectors modulo 2**32 in every lane.
So the order of lines does not matter, and a line is inserted or deleted by adding or
subtracting its vector (``insert``, ``delete``), without the rest of the text.

A line's vector has two parts: ``LANES`` lanes drawn from SHAKE-128 of the line, which only equal
multisets share, and ``SKETCH`` lanes to which each two-word shingle of the line adds +1 or -1 (a
signed count sketch). The cosine of two sketches, cut to 0..1, estimates the likeness of
the shingle counts; equal vectors have likeness 1, and an empty sketch has likeness 0 to any other.
The fingerprint string is the SHA-256 of the vector.

Null texts are empty texts (one empty line). Equal texts have equal fingerprints wherever
they stand; very long texts are hashed in one piece, line by line. Further columns are not read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from .common import SLICE_BYTES, shingles, ship, slices, span_hashes, words

LANES, SKETCH, SHINGLE = 512, 1024, 2


def vectors(texts: list[str]) -> np.ndarray:
    """Fingerprint vectors (texts x (LANES + SKETCH), unsigned 32-bit)."""
    out = np.zeros((len(texts), LANES + SKETCH), dtype=np.uint32)
    if not texts:
        return out
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    lines = [b.split(b"\n") for b in raw]
    digests = b"".join(hashlib.shake_128(p).digest(2 * LANES) for ps in lines for p in ps)
    first = np.cumsum([0, *map(len, lines)])[:-1]
    np.add.reduceat(np.frombuffer(digests, dtype="<u2").reshape(-1, LANES), first, axis=0, dtype=np.uint32, out=out[:, :LANES])
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    if len(data):
        docs = np.cumsum([0, *map(len, raw)])
        para = np.union1d(docs, np.flatnonzero(data == 10) + 1)
        starts, ends, row = words(data, para)
        if len(starts):
            h, row = shingles(span_hashes(data, starts, ends), row, SHINGLE)
            doc = np.searchsorted(docs, para[row], side="right") - 1
            cell = doc * SKETCH + (h % np.uint64(SKETCH)).astype(np.int64)
            sign = 1.0 - 2.0 * (h >> np.uint64(63)).astype(np.float64)
            sums = np.bincount(cell, weights=sign, minlength=len(texts) * SKETCH).astype(np.int64)
            out[:, LANES:] = sums.astype(np.uint32).reshape(len(texts), SKETCH)
    return out


def insert(vector: np.ndarray, line: str) -> np.ndarray:
    return vector + vectors([line])[0]


def delete(vector: np.ndarray, line: str) -> np.ndarray:
    return vector - vectors([line])[0]


def digest(vector: np.ndarray) -> str:
    return hashlib.sha256(vector.astype("<u4").tobytes()).hexdigest()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness (0 to 1) of the vectors in the rows of ``a`` and ``b``."""
    x, y = (v[:, LANES:].view(np.int32).astype(np.float64) for v in (a, b))
    dot, xx, yy = (x * y).sum(1), (x * x).sum(1), (y * y).sum(1)
    size = np.sqrt(xx * yy)
    cos = np.divide(dot, size, out=np.zeros(len(dot)), where=size > 0)
    return np.where((a == b).all(axis=1), 1.0, np.clip(cos, 0.0, 1.0))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, vector, fingerprint) of every whole text."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            v = vectors([t or "" for t in b.column("t").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("d"), pa.array([x.astype("<u4").tobytes() for x in v], pa.binary()),
                                              pa.array([digest(x) for x in v])], names=["doc_id", "vector", "fingerprint"])

    return (docs.select(F.col(f"`{id_col}`").alias("d"), F.col(f"`{text_col}`").cast("string").alias("t"))
            .mapInArrow(run, f"doc_id {kind}, vector binary, fingerprint string"))


def edited(text: str, following: str) -> str:
    """``text`` with its last half of code points replaced by the first as many (or all) of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def in_ranges(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents dealt by ascending id over sorted ranges: columns r, sentinel, d, t.

    Each range also gets a copy (sentinel 1) of the first document of the next range, the last one that
    of the first range, so that every document meets its successor without a global order. Range limits are
    quantiles of the ids. Null ids come first; equal ids are ordered by their texts' hashes.
    """
    spark = docs.sparkSession
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    low = -(1 << 63)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("d"), F.col(f"`{text_col}`").cast("string").alias("t"))
    rows = rows.withColumn("key", F.coalesce("d", F.lit(low)))
    cuts = rows.agg(F.percentile_approx("key", [i / n for i in range(1, n)], max(10000, 20 * n)).alias("q")).first()["q"] or []
    splits = [-float("inf"), *sorted({float(c) for c in cuts if c > low}), float("inf")]
    if len(splits) == 2:
        splits.insert(1, 0.0)
    rows = Bucketizer(splits=splits, inputCol="at", outputCol="range").transform(rows.withColumn("at", F.col("key").cast("double")))
    firsts = sorted((int(r), k) for r, k in rows.groupBy("range").agg(F.min("key")).collect())  # one row per range
    if not firsts:
        return rows.select(F.col("range").cast("int").alias("r"), F.lit(0).alias("sentinel"), "d", "t")
    before = [(k, firsts[i - 1][0]) for i, (_, k) in enumerate(firsts)]
    target = F.broadcast(spark.createDataFrame(before, "key long, before int"))
    own = F.struct(F.col("range").cast("int").alias("r"), F.lit(0).alias("sentinel"))
    copy = F.struct(F.col("before").alias("r"), F.lit(1).alias("sentinel"))
    return (rows.join(target, "key", "left")
            .select(F.inline(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, copy))), "key", "d", "t")
            .repartition(n // 4, "r").sortWithinPartitions("r", "sentinel", "key", F.xxhash64("t")).select("r", "sentinel", "d", "t"))


def compare_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness to it and to the next document's.

    The edited text is the text whose second half comes from the next document in ascending id
    order (after the last, the first).
    """
    ship(docs.sparkSession)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def compare(rows: list[tuple]) -> pa.RecordBatch | None:
        pairs = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i][0] == rows[i + 1][0]]
        if not pairs:
            return None
        texts = [r[3] or "" for r in rows]
        new = [edited(texts[i], texts[i + 1]) for i in pairs]
        own, changed = vectors(texts), vectors(new)
        here, following = own[pairs], own[[i + 1 for i in pairs]]
        return pa.RecordBatch.from_arrays([
            pa.array([rows[i][2] for i in pairs], pa.int64()), pa.array([len(texts[i]) for i in pairs], pa.int64()),
            pa.array([hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in new]),
            pa.array([digest(x) for x in here]), pa.array([digest(x) for x in changed]),
            pa.array(likeness(here, changed)), pa.array(likeness(here, following))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for b in slices(batches, "t"):
            for row in zip(*(b.column(c).to_pylist() for c in ("r", "sentinel", "d", "t"))):
                held.append(row)
                size += len(row[3] or "")
                if size > SLICE_BYTES // 2 or len(held) > 2000:
                    out = compare(held)
                    if out:
                        yield out
                    held, size = held[-1:], 0
        out = compare(held)
        if out:
            yield out

    return in_ranges(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
