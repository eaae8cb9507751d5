"""Best-fit packing of token sequences by linear grouping over an exact length histogram.

Lengths are whole numbers from 1 to the capacity, so the histogram has at most ``capacity`` rows
however many items there are, and the packing is planned from it alone:

1. Items longer than ``small`` are sorted by length and cut into at most ``groups`` groups of equal
   cardinality; each group's lengths are rounded up to its largest.
2. Configurations (how many items of each group share a sequence) are optimised for these few
   sizes by column generation: a linear programme over the groups, priced by a knapsack.
3. Each configuration is used a whole number of times and its slots are filled with the actual items of
   the group, longest first, so the room left in a run of sequences is known exactly.
4. What is left (small items and the fractional rest) goes, longest first, into the
   fullest sequence that still has room, and into new sequences when none has.

Several limits between small and large are tried (``SMALL``, fractions of the capacity; at one half a
configuration is a single item) and the plan with the fewest sequences is used.

The plan says, for runs of equal-length items by rank, in which sequence and at which offset they
lie. Ranks come from per-partition counts, so no length is ordered in one task, and the plan is a
lookup (its size depends on the capacity and the number of groups, not on the data).

Null texts are empty documents: the end id alone. Repeated rows are packed separately. An empty table
gives no rows. Lengths that are null, below 1 or above the capacity raise ``ValueError``.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from . import tokens
from .common import fresh, ship, slices, stored

GROUPS = 64
SMALL = (8, 4, 2)


# ------------------------------------------------------------------ plan over the histogram

def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 600) -> list[tuple[np.ndarray, float]]:
    """Fractional optimum of the cutting-stock programme: (items per size, times used) pairs.

    Column generation with a revised simplex; stops when no configuration prices in or when the bound
    shows that the solution is within 2e-4 of the optimum.
    """
    k = len(sizes)
    s, b = np.array(sizes), np.array(demand, dtype=float)
    basis = np.diag(np.maximum(1, capacity // s).astype(float))
    inv = np.linalg.inv(basis)
    x = inv @ b
    for it in range(rounds):
        y = inv.sum(axis=0)
        value, column = _best_configuration(s, y, capacity)
        if value <= 1 + 2e-4:  # the sum of x over this value bounds the optimum from below
            break
        d = inv @ column
        up = d > 1e-10
        ratio = np.full(k, np.inf)
        ratio[up] = np.maximum(x[up], 0) / d[up]
        r = int(np.argmin(ratio))
        if not np.isfinite(ratio[r]):
            break
        basis[:, r] = column
        if it % 64 == 63:
            inv = np.linalg.inv(basis)
        else:
            row = inv[r] / d[r]
            inv -= np.outer(d, row)
            inv[r] = row
        x = inv @ b
    return [(basis[:, j], float(x[j])) for j in range(k) if x[j] > 1e-9]


def _best_configuration(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable configuration and its value."""
    f = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    for i in np.argsort(-worth / sizes):
        if worth[i] <= 0:
            break
        w = int(sizes[i])
        for _ in range(capacity // w):
            cand = f[:-w] + worth[i]
            better = cand > f[w:] + 1e-12
            if not better.any():
                break
            f[w:][better] = cand[better]
            pick[w:][better] = i
    column, w = np.zeros(len(sizes)), capacity
    while pick[w] >= 0:
        column[pick[w]] += 1
        w -= int(sizes[pick[w]])
    return float(column @ worth), column


class Plan:
    """Runs of placed items: columns length, rank, count, sequence, per_sequence, offset."""

    def __init__(self, counts: dict[int, int], capacity: int, small: int | None = None, groups: int = GROUPS):
        self.capacity = capacity
        self.rows: list[tuple[int, int, int, int, int, int]] = []
        self.sequences = 0
        small = capacity // 8 if small is None else small
        if counts.get(capacity):
            self._place(capacity, 0, counts[capacity], self._new(counts[capacity]), 1, 0)
        large = sorted((l for l in counts if small < l < capacity and counts[l]), reverse=True)
        rest = {l: (0, counts[l]) for l in counts if l <= small and counts[l]}
        self.rooms: dict[int, list[tuple[int, int]]] = {}
        for group, taken in self._configured(large, counts, groups):
            left = taken
            for l in group:  # ranks beyond the slots, from the longest length on
                used = min(left, counts[l])
                left -= used
                if used < counts[l]:
                    rest[l] = (used, counts[l] - used)
        for l in sorted(rest, reverse=True):
            self._best_fit(l, *rest[l])
        self.rows.sort()

    def _new(self, count: int) -> int:
        first, self.sequences = self.sequences, self.sequences + count
        return first

    def _place(self, length, rank, count, sequence, per, offset):
        self.rows.append((length, rank, count, sequence, per, offset))

    def _configured(self, large: list[int], counts: dict[int, int], groups: int):
        """Place whole uses of the optimal configurations; yields (lengths of the group, items placed)."""
        target = -(-sum(counts[l] for l in large) // groups) if large else 0
        grouped: list[list[int]] = []
        size = target
        for l in large:
            if size >= target:
                grouped.append([])
                size = 0
            grouped[-1].append(l)
            size += counts[l]
        if not grouped:
            return []
        demand = [sum(counts[l] for l in g) for g in grouped]
        taken = [0] * len(grouped)
        for column, times in configurations([g[0] for g in grouped], demand, self.capacity):
            n = int(times + 1e-7)
            for g, c in enumerate(column):
                if c:
                    n = min(n, (demand[g] - taken[g]) // int(c))
            if n <= 0:
                continue
            slots = [g for g, c in enumerate(column) for _ in range(int(c))]
            spans, cuts = [], {0, n}
            for g in slots:  # the items of one slot over the n sequences, as runs of equal length
                runs, at, lo = [], 0, 0
                begin, taken[g] = taken[g], taken[g] + n
                for l in grouped[g]:
                    a, b = max(begin, lo), min(begin + n, lo + counts[l])
                    if a < b:
                        runs.append((a - begin, b - begin, l, a - lo))
                        cuts.add(b - begin)
                    lo += counts[l]
                spans.append(runs)
            first, marks = self._new(n), sorted(cuts)
            for a, b in zip(marks, marks[1:]):
                at = 0
                for runs in spans:
                    lo, _, l, rank = next(r for r in runs if r[0] <= a < r[1])
                    self._place(l, rank + a - lo, b - a, first + a, 1, at)
                    at += l
                self._room(self.capacity - at, first + a, b - a)
        return list(zip(grouped, taken))

    def _room(self, room: int, sequence: int, count: int) -> None:
        if room > 0 and count > 0:
            self.rooms.setdefault(room, []).append((sequence, count))

    def _best_fit(self, l: int, rank: int, n: int) -> None:
        for room in sorted(r for r in self.rooms if r >= l):
            per, runs = room // l, self.rooms.pop(room)
            while runs and n:
                seq, m = runs.pop()
                full = min(m, n // per)
                if full:
                    self._place(l, rank, full * per, seq, per, self.capacity - room)
                    self._room(room - per * l, seq, full)
                    rank, n, seq, m = rank + full * per, n - full * per, seq + full, m - full
                if m and n:  # fewer than ``per`` items are left: one more sequence
                    self._place(l, rank, n, seq, n, self.capacity - room)
                    self._room(room - n * l, seq, 1)
                    n, seq, m = 0, seq + 1, m - 1
                if m:
                    runs.append((seq, m))
            if runs:
                self.rooms.setdefault(room, []).extend(runs)
            if not n:
                return
        per = self.capacity // l
        m = -(-n // per)
        self.rooms.setdefault(self.capacity, []).append((self._new(m), m))
        self._best_fit(l, rank, n)


def best_plan(counts: dict[int, int], capacity: int, groups: int = GROUPS) -> Plan:
    return min((Plan(counts, capacity, capacity // d, groups) for d in SMALL), key=lambda p: p.sequences)


# ------------------------------------------------------------------ on Spark

def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of every whole text: doc_id, piece, start, length, ids (little-endian unsigned 32-bit).

    Documents longer than ``capacity`` ids are cut into full pieces, with the shorter one first.
    """
    ship(docs.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids", T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer)
        for b in slices(batches, "t"):
            row, piece, start, length, ids = [], [], [], [], []
            for i, x in enumerate(enc.encode(b.column("t").to_pylist())):
                x += end
                n, at, p = len(x) // 4, 0, 0
                while at < n:
                    size = (n - 1) % capacity + 1 if at == 0 else capacity
                    row.append(i), piece.append(p), start.append(at), length.append(size)
                    ids.append(x[4 * at:4 * (at + size)])
                    at, p = at + size, p + 1
            yield pa.RecordBatch.from_arrays(
                [b.column("d").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col(f"`{id_col}`").alias("d"), F.col(f"`{text_col}`").cast("string").alias("t")).mapInArrow(cut, schema)


def pack(items: DataFrame, capacity: int, length_col: str = "length", groups: int = GROUPS) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``: each in one sequence of at most ``capacity``, without gaps."""
    spark = items.sparkSession
    ship(spark)
    items = items.drop(*[c for c in items.columns if c.lower() in ("sequence_id", "offset")])  # replaced
    part, row, first, at = fresh(items.columns, "_part", "_row", "_first", "_at")
    size = f"`{length_col}`"
    kept = stored(items.withColumns({part: F.spark_partition_id(), row: F.monotonically_increasing_id()}), "packing-items")
    by = kept.groupBy(F.col(size).cast("long").alias("_n"), part).agg(F.count(F.lit(1)).alias("_c"))
    by = stored(by, "packing-counts")
    counts = {r[0]: r[1] for r in by.groupBy("_n").agg(F.sum("_c")).collect()}
    if any(l is None or l < 1 or l > capacity for l in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    plan = np.array(best_plan(counts, capacity, groups).rows, dtype=np.int64).reshape(-1, 6)
    shared = spark.sparkContext.broadcast(plan)

    before = Window.partitionBy("_n").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    firsts = by.select(F.col("_n").alias(at), part, F.coalesce(F.sum("_c").over(before), F.lit(0)).alias(first))
    ranked = (kept.withColumn(at, F.col(size).cast("long")).join(firsts, [at, part])
              .withColumn(first, F.col(first) + F.row_number().over(Window.partitionBy(at, part).orderBy(row)) - 1)
              .select(*[f"`{c}`" for c in items.columns], at, first))
    schema = T.StructType([*items.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        lengths, starts = np.unique(p[:, 0], return_index=True)
        ends = np.r_[starts[1:], len(p)]
        for b in batches:
            length, rank = (np.asarray(b.column(i)) for i in (b.num_columns - 2, b.num_columns - 1))
            run = np.zeros(b.num_rows, dtype=np.int64)
            for l in np.unique(length):
                own = length == l
                k = np.searchsorted(lengths, l)
                run[own] = starts[k] + np.searchsorted(p[starts[k]:ends[k], 1], rank[own], side="right") - 1
            i = rank - p[run, 1]
            seq = p[run, 3] + i // p[run, 4]
            offset = p[run, 5] + i % p[run, 4] * length
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(seq), pa.array(offset)], names=schema.names)

    return ranked.mapInArrow(lookup, schema)
