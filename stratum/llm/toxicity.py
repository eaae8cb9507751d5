"""Toxicity by weak supervision: many word and pattern voters, a generative label model, a linear classifier.

Voters vote "toxic" where their unit occurs in a text and abstain elsewhere. Units are words (runs of
ASCII letters, digits and characters beyond ASCII, A-Z lower-cased) and patterns (all longer words that
begin with the same 4 to 8 bytes). The lexicon gives some voters; the others are units that a
bounded sample of labelled training rows holds clearly more often in toxic than in clean texts.

The label model treats the true label as hidden. Expectation maximisation over the sample's votes
estimates, for each voter, how often it fires on toxic and on clean texts, with the given label as one more
noisy voter (it never abstains). Voters that fire together within a class (nested patterns do) would count twice, so
each vote is divided by the sum of the voter's positive correlations within the classes. The posterior
labels, weighted to the true share of toxic rows, train a logistic regression on the votes.

Whole texts are scored. Null and empty texts get the score of a text without votes; ties do not
arise; repeated texts of the sample count once. Without toxic and clean training rows, every score is 0.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import add_columns, ascii_lower, mix, raw_text, ship, slices, span_hashes, stored, words

# English insults and slurs on ability, as a general lexicon.
LEXICON = ("stupid idiot moron loser dumb fool pathetic disgusting worthless trash scum garbage clown jerk "
           "ugly liar filthy vermin imbecile freak hate kill shut bastard bitch crap damn").split()
PREFIXES = (4, 5, 6, 7, 8)
#: Bounds of the fit: labelled rows of each class, and voters.
SAMPLE, VOTERS = 10_000, 256
#: A unit becomes a voter when its log odds exceed this many standard errors plus one.
ERRORS = 1.5


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all units of the rows' texts, and their row numbers."""
    low = ascii_lower(data)
    on = (low >= 128) | ((low >= 97) & (low <= 122)) | ((low >= 48) & (low <= 57))
    starts, ends, rows = words(low, offsets, on)
    if not len(starts):
        return np.zeros(0, np.uint64), rows
    out, where = [span_hashes(low, starts, ends)], [rows]
    for n in PREFIXES:
        long = ends - starts > n
        s = starts[long]
        out.append(mix(span_hashes(low, s, s + n) + np.uint64(n)))
        where.append(rows[long])
    return np.concatenate(out), np.concatenate(where)


def lexicon_units() -> np.ndarray:
    raw, off = raw_text(pa.array(LEXICON, pa.string()))
    starts, ends, _ = words(raw, off)
    return span_hashes(raw, starts, ends)


@dataclass
class Model:
    voters: np.ndarray  # sorted unit hashes
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.gate = np.zeros(1 << 16, dtype=bool)
        self.gate[(self.voters & np.uint64(0xFFFF)).astype(np.int64)] = True

    def votes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, voter) of every vote, without repeats."""
        h, rows = units(data, offsets)
        near = self.gate[(h & np.uint64(0xFFFF)).astype(np.int64)]
        h, rows = h[near], rows[near]
        at = np.minimum(np.searchsorted(self.voters, h), max(len(self.voters) - 1, 0))
        hit = self.voters[at] == h if len(self.voters) else np.zeros(len(h), dtype=bool)
        both = np.unique(rows[hit] * np.int64(max(len(self.voters), 1)) + at[hit])
        return both // max(len(self.voters), 1), both % max(len(self.voters), 1)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, voter = self.votes(data, offsets)
        z = np.bincount(row, weights=self.weights[voter], minlength=len(offsets) - 1) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def label_model(votes: np.ndarray, labels: np.ndarray, weight: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Posterior probability of "toxic" for each row of the vote matrix (rows x voters, zero-one)."""
    v = votes.astype(np.float32)
    q = np.clip(labels, 0.05, 0.95).astype(np.float64)
    for _ in range(rounds):
        a, b = q * weight, (1 - q) * weight
        fire1, fire0 = (a @ v + 0.1) / (a.sum() + 1), (b @ v + 0.1) / (b.sum() + 1)
        share = 1.0 / _together(v, q, fire1, fire0)
        right1, right0 = (np.clip((x @ y + 9) / (x.sum() + 10), 0.6, 0.99) for x, y in ((a, labels), (b, 1 - labels)))
        label = np.where(labels == 1, np.log(right1 / (1 - right0)), np.log((1 - right1) / right0))
        z = np.log(a.sum() / b.sum()) + v @ (np.log(fire1 / fire0) * share) + label  # abstaining says nothing
        new = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
        done = np.abs(new - q).max() < 1e-4
        q = new
        if done:
            break
    return q


def _together(v: np.ndarray, q: np.ndarray, fire1: np.ndarray, fire0: np.ndarray) -> np.ndarray:
    """For each voter, the sum of its positive correlations with all voters within the classes (itself 1)."""
    total = np.zeros((v.shape[1], v.shape[1]))
    for w, p in ((q, fire1), (1 - q, fire0)):
        both = (v * w[:, None].astype(np.float32)).T @ v
        m = w @ v
        total += both - np.outer(p, m) - np.outer(m, p) + w.sum() * np.outer(p, p)
    spread = np.diag(total).copy()
    corr = total / np.sqrt(np.outer(spread, spread) + 1e-12)
    np.fill_diagonal(corr, 1.0)
    corr[corr < 0.1] = 0.0
    return np.maximum(corr.sum(axis=1), 1.0)


def logistic(x: np.ndarray, q: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on soft labels by Newton steps; the bias is not penalised."""
    x = np.column_stack([x, np.ones(len(x), dtype=x.dtype)])
    pen = np.r_[np.full(x.shape[1] - 1, ridge), 1e-6]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - q)) + pen * w
        hess = ((x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None].astype(x.dtype)).T @ x).astype(np.float64) + np.diag(pen)
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample: int = SAMPLE, voters: int = VOTERS) -> Model:
    """Model from labelled rows (``labels`` has ids and 0/1; pass the training rows only).

    At most ``sample`` rows of each class are used, first in the order of a hash of the id.
    """
    spark = docs.sparkSession
    ship(spark)
    known = (docs.select(F.col(f"`{id_col}`").alias("k")).join(
        labels.select(F.col(f"`{id_col}`").alias("k"), F.col(f"`{label_col}`").cast("int").alias("y")).where("y in (0, 1)"), "k"))
    sizes = dict(known.groupBy("y").count().collect())
    if len(sizes) < 2:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -500.0)
    ids = [known.where(F.col("y") == y).orderBy(F.xxhash64(F.lit(3), "k"), "k").limit(sample) for y in (0, 1)]
    ids = stored(ids[0].unionByName(ids[1]).dropDuplicates(), "toxicity-sample")
    rows = docs.select(F.col(f"`{id_col}`").alias("k"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"))
    rows = stored(rows.join(F.broadcast(ids), "k").select("t", "y").dropDuplicates(), "toxicity-texts")

    def distinct_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            h, row = units(*raw_text(b.column("t")))
            order = np.lexsort((h, row))
            h, row = h[order], row[order]
            first = np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])] if len(h) else np.zeros(0, bool)
            y = np.asarray(b.column("y"))[row[first]]
            yield pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), pa.array(y, pa.int32())], names=["u", "y"])

    n = dict(rows.groupBy("y").count().collect())
    odds = F.log((F.col("t") + 0.5) / (n[1] + 1)) - F.log((F.col("c") + 0.5) / (n[0] + 1))
    error = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    counts = rows.mapInArrow(distinct_units, "u long, y int").groupBy("u").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c"))
    margin = (odds - ERRORS * error - 1).alias("margin")
    best = counts.where("t >= 3").select("u", "t", margin).where("margin > 0").orderBy(F.col("margin").desc(), F.col("t").desc(), "u").limit(voters)
    mined = np.array([r["u"] for r in best.collect()], dtype=np.int64).view(np.uint64)
    all_voters = np.unique(np.concatenate([lexicon_units(), mined]))
    blank = Model(all_voters, np.zeros(len(all_voters)), 0.0)
    shared = spark.sparkContext.broadcast(blank)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            row, voter = shared.value.votes(*raw_text(b.column("t")))
            m = np.zeros((b.num_rows, len(shared.value.voters)), dtype=np.uint8)
            m[row, voter] = 1
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.array([r.tobytes() for r in np.packbits(m, axis=1)], pa.binary())], names=["y", "bits"])

    got = sorted((r["y"], bytes(r["bits"])) for r in rows.mapInArrow(vote, "y int, bits binary").collect())
    y = np.array([r[0] for r in got], dtype=np.float64)
    bits = np.unpackbits(np.frombuffer(b"".join(r[1] for r in got), dtype=np.uint8).reshape(len(got), -1), axis=1)[:, :len(all_voters)]
    weight = np.where(y == 1, sizes[1] / n[1], sizes[0] / n[0])
    weight /= weight.mean()
    q = label_model(bits, y, weight)
    w, bias = logistic(bits.astype(np.float32), q, weight)
    return Model(all_voters, w, bias)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 where the score is at least 0.5)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(column: pa.Array) -> list:
        s = shared.value.scores(*raw_text(column))
        return [pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))]

    return add_columns(docs, text_col, {"score": "double", "predicted": "int"}, run)
