"""Language identification with a string kernel, Nyström landmarks and kernel ridge regression.

The kernel of two texts is the number of character n-grams (n = 1, 2, 3: a blended spectrum) that
both contain, over the root of the product of how many each contains. N-grams count by presence,
lower-cased, in ``BUCKETS`` hash buckets, so a text is a row of zeros and ones.

Fitting takes a bounded sample: per language, the ``per_language`` training documents that come first in
the order of a hash. Of these, ``landmarks`` per language span the Nyström approximation:
features of a text are its kernels with the landmarks times the inverse root of the landmarks' own
kernel matrix, and a ridge regression with one output per language (that language against the
rest) is solved on them in closed form. Scoring multiplies batches of presence rows with the
landmark matrix and the regression coefficients (both products are folded into one matrix of
n-grams by languages). The score is the softmax share of the winning language.

Whole texts are used. Null texts and texts without a letter are ``und`` with score 0, and so are all texts
where nothing could be learned. Ties go to the first language in alphabetical order.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import add_columns, fresh, ship, slices, stored

SPECTRUM = (1, 2, 3)
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
#: Bounds of the fit: training documents and landmarks per language.
PER_LANGUAGE, LANDMARKS = 400, 64
RIDGE, SHARPNESS = 1e-3, 6.0
_BATCH = 128


def presence(texts: list[str]) -> np.ndarray:
    """Zero-one rows (texts x BUCKETS) of the n-grams that each text contains."""
    out = np.zeros(len(texts) * BUCKETS, dtype=np.uint8)
    low = [t.lower() for t in texts]
    chars = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not len(chars):
        return out.reshape(len(texts), BUCKETS)
    lens = np.fromiter(map(len, low), dtype=np.int64, count=len(low))
    ends = np.cumsum(lens)
    base = np.repeat(np.arange(len(texts), dtype=np.int64) * BUCKETS, lens)
    left = np.repeat(ends, lens) - np.arange(len(chars))  # characters from here to the text's end
    acc = np.zeros(len(chars), dtype=np.uint32)
    for n in range(1, max(SPECTRUM) + 1):
        m = len(chars) - n + 1
        if m <= 0:
            break
        acc = (acc[:m] + chars[n - 1:] + np.uint32(n)) * np.uint32(0x9E3779B1)
        acc ^= acc >> np.uint32(15)
        if n in SPECTRUM:
            h = (acc * np.uint32(0x85EBCA77)) >> np.uint32(32 - BUCKET_BITS)
            at = base[:m] + h
            out[at[left[:m] >= n] if n > 1 else at] = 1
    return out.reshape(len(texts), BUCKETS)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages
    bias: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        names, scores = [], np.zeros(len(texts))
        for i in range(0, len(texts), _BATCH):
            rows = presence(texts[i:i + _BATCH]).astype(np.float32)
            size = np.sqrt(np.maximum(rows.sum(axis=1), 1.0))
            f = (rows @ self.weights) / size[:, None] + self.bias
            e = np.exp(SHARPNESS * (f - f.max(axis=1, keepdims=True)))
            best = f.argmax(axis=1)
            names += [self.languages[k] for k in best]
            scores[i:i + len(f)] = e[np.arange(len(f)), best] / e.sum(axis=1)
        return names, scores


def solve(rows: Callable[[np.ndarray], np.ndarray], labels: list[str], landmark: np.ndarray) -> Model:
    """Kernel ridge regression on Nyström features; ``rows`` gives presence rows by number, ``landmark`` marks
    those used as landmarks."""
    languages = sorted(set(labels))

    def unit(part: np.ndarray) -> np.ndarray:
        part = part.astype(np.float32)
        return part / np.sqrt(np.maximum(part.sum(axis=1, keepdims=True), 1.0))

    marks = unit(rows(np.flatnonzero(landmark)))
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    use = values > 1e-6 * values.max()
    root = vectors[:, use] / np.sqrt(values[use])  # inverse root of the landmarks' kernel matrix
    kernel = [unit(rows(np.arange(i, min(i + _BATCH, len(labels))))) @ marks.T for i in range(0, len(labels), _BATCH)]
    phi = np.concatenate(kernel).astype(np.float64) @ root
    y = np.where(np.array(labels)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    mean, shift = phi.mean(axis=0), y.mean(axis=0)
    x = phi - mean
    w = np.linalg.solve(x.T @ x + RIDGE * len(x) * np.eye(x.shape[1]), x.T @ (y - shift))
    return Model(languages, (marks.T.astype(np.float64) @ (root @ w)).astype(np.float32), shift - mean @ w)


def fit(docs: DataFrame, eligible: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS) -> Model | None:
    """Model learned from the eligible documents with a text and a language; None without any.

    Only the sample's presence rows (BUCKETS / 8 bytes each) come to the driver.
    """
    spark = docs.sparkSession
    ship(spark)
    known = F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull()
    rows = docs.where(known & eligible if eligible is not None else known)
    ids = rows.select(F.col(f"`{id_col}`").alias("k"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.lit(5), "k"), "k")
    # the row limit per language is applied before the shuffle, too
    sample = stored(ids.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language), "langid-sample")
    one = sample.groupBy("k", "lang").agg(F.min("n").alias("n"))
    text = rows.select(F.col(f"`{id_col}`").alias("k"), F.col(f"`{text_col}`").cast("string").alias("t"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    # rows that repeat an id join once each: the first text by hash stands for them
    chosen = (text.join(F.broadcast(one), ["k", "lang"]).groupBy("k", "lang", "n").agg(F.min_by("t", F.xxhash64("t")).alias("t")))

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            bits = np.packbits(presence([t or "" for t in b.column("t").to_pylist()]), axis=1)
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("n"), pa.array([r.tobytes() for r in bits], pa.binary())], names=["lang", "n", "bits"])

    got = chosen.select("lang", "n", "t").mapInArrow(rows_of, "lang string, n int, bits binary").collect()
    if not got:
        return None
    got.sort(key=lambda r: (r["lang"], r["n"], bytes(r["bits"])))
    bits = np.frombuffer(b"".join(bytes(r["bits"]) for r in got), dtype=np.uint8).reshape(len(got), -1)
    rank: dict[str, int] = {}
    marks = []
    for r in got:
        rank[r["lang"]] = rank.get(r["lang"], 0) + 1
        marks.append(rank[r["lang"]] <= landmarks)
    return solve(lambda i: np.unpackbits(bits[i], axis=1), [r["lang"] for r in got], np.array(marks))


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(column: pa.Array) -> list:
        texts = [t or "" for t in column.to_pylist()]
        letters = [any(map(str.isalpha, t)) for t in texts]
        if shared.value is None:
            names, scores = ["und"] * len(texts), np.zeros(len(texts))
        else:
            names, scores = shared.value.predict(texts)
        return [pa.array([n if ok else "und" for n, ok in zip(names, letters)], pa.string()),
                pa.array(np.where(letters, scores, 0.0).astype(np.float64))]

    return add_columns(docs, text_col, {"lang_pred": "string", "score": "double"}, run)
