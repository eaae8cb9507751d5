"""Prefix trie of conversations from sorted sequences: LCPs, sparse tables, and two binary searches per prefix.

``rebuild`` gives every conversation the opening of another one; ``trie`` sorts the conversations by the 128-bit hashes
of their turns and then by id (range partitions, so that copies of one conversation spread over many tasks), and
works on blocks of neighbouring rows. In a block, the lengths of the prefixes that neighbours share (LCPs) go into a
sparse table of range minima. A candidate prefix (row, depth) has as members the rows around it whose LCPs do not fall
below the depth; its left and right ends are found by one binary search each over the table, all candidates at once and
without a stack. A block yields one row of partial sums for each of its prefixes; prefixes that go on in
other blocks meet in a sum by their hash. What needs the row before or after a block (who owns a prefix, which rows end
in leaves) takes it from the neighbouring block, or at the edge of a task from a small table of the first and
last rows of tasks, one each per task.

Sums over subtrees need no walk: (members - 1) * words, summed over a subtree, is the words that its members have from
the top's depth on, less the words of its nodes counted once; both are sums over the member rows.

Turn order: null first, equal turns by role and then by hash. Null roles and texts are empty. Rows without conv_id belong to
no conversation. Repeated rows are further turns. An empty table gives no rows. Other columns are not read. Texts
are read once and never shuffled: a turn is 20 bytes. One conversation's turns are one row (a conversation is
a document, not a corpus); everything else is split.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .common import mix, ship, stored

#: Turns of a block, about (a block is at most one Arrow batch).
BLOCK_TURNS = 1 << 18
#: Nodes with more than this share of all nodes as children (at most as many nodes as its inverse) are broadcast as parents.
HOT_PARENTS = 10_000
WORDS = r"[^\x20\x09-\x0D]+"
_NODE = "k1 long, k2 long, p1 long, p2 long, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, seq): the turns of each conversation in order, each as (h1, h2, words)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(7), text, role).alias("h2"),
        F.size(F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))).alias("w"))
    seq = F.sort_array(F.collect_list(F.struct("turn", "role", "h1", "h2", "w")))
    return rows.groupBy("conv_id").agg(F.transform(seq, lambda s: F.struct(s["h1"], s["h2"], s["w"])).alias("seq"))


def rebuild(seqs: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Every conversation c with the first h turns of conversation c - c % ``group`` in place of its own first h turns.

    h is crc32 of the decimal c, modulo ``most``; a conversation that is not there gives no turns.
    """
    heads = seqs.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("seq", 1, most).alias("head"))
    own = seqs.withColumns({"base": F.col("conv_id") - F.col("conv_id") % group, "h": (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")})
    none = F.expr("slice(seq, 1, 0)")
    head = F.when(F.col("head").isNotNull(), F.expr("slice(head, 1, h)")).otherwise(none)
    rest = F.when(F.size("seq") > F.col("h"), F.expr("slice(seq, h + 1, size(seq))")).otherwise(none)
    return own.join(heads, "base", "left").select("conv_id", F.concat(head, rest).alias("seq"))


# ------------------------------------------------------------------ one block

class Rows:
    """Rows in sorted order: ids, turn hashes (two lanes), words, and where each row's turns start."""

    def __init__(self, batch: pa.RecordBatch):
        self.conv = batch.column("conv_id").to_numpy(zero_copy_only=False)
        self.len = pc.list_value_length(batch.column("w")).to_numpy(zero_copy_only=False).astype(np.int64)
        self.at = np.r_[0, np.cumsum(self.len)]
        keys = batch.column("keys").flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, 2)
        self.h1, self.h2 = keys[:, 0].copy(), keys[:, 1].copy()
        self.w = batch.column("w").flatten().to_numpy(zero_copy_only=False).astype(np.int64)

    def turns(self, i: int) -> np.ndarray:
        s = slice(self.at[i], self.at[i + 1])
        return np.stack([self.h1[s], self.h2[s]], axis=1)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    off = np.flatnonzero((a[:n] != b[:n]).any(axis=1))
    return int(off[0]) if len(off) else n


def lcps(r: Rows) -> np.ndarray:
    """LCP of each row with the row before; -1 for the first."""
    n = len(r.len)
    out = np.full(n, -1, dtype=np.int64)
    if n > 1:
        m = np.minimum(r.len[1:], r.len[:-1])
        first = np.r_[0, np.cumsum(m)]
        inner = np.arange(first[-1]) - np.repeat(first[:-1], m)
        a, b = np.repeat(r.at[:-2], m) + inner, np.repeat(r.at[1:-1], m) + inner
        differ = (r.h1[a] != r.h1[b]) | (r.h2[a] != r.h2[b])
        out[1:] = m
        pair = np.repeat(np.arange(n - 1), m)[differ]
        np.minimum.at(out, pair + 1, inner[differ])
    return out


class RangeMin:
    """Sparse table: level j holds the minima of all ranges of 2**j values."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum of each range lo..hi (inclusive)."""
        out = np.empty(len(lo), dtype=self.levels[0].dtype)
        level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        for j, v in enumerate(self.levels):
            s = level == j
            out[s] = np.minimum(v[lo[s]], v[hi[s] - (1 << j) + 1])
        return out

    def right(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Largest r >= at such that all values in at + 1 .. r are bound or more."""
        pos = at.copy()
        for j in range(len(self.levels) - 1, -1, -1):
            v = self.levels[j]
            can = pos + 1 < len(v)
            go = np.zeros(len(pos), dtype=bool)
            go[can] = v[pos[can] + 1] >= bound[can]
            pos[go] += 1 << j
        return pos

    def left(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Smallest l <= at such that all values in l + 1 .. at are bound or more."""
        pos = at.copy()
        for j in range(len(self.levels) - 1, -1, -1):
            v, lo = self.levels[j], pos - (1 << j) + 1
            can = lo >= 1
            go = np.zeros(len(pos), dtype=bool)
            go[can] = v[lo[can]] >= bound[can]
            pos[go] -= 1 << j
        return pos


def _prefix_keys(r: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each prefix; prefix d of row i is at r.at[i] + i + d."""
    depth = np.arange(len(r.w)) - np.repeat(r.at[:-1], r.len) + 1
    spot = mix(depth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = []
    slots = np.arange(len(r.w)) + np.repeat(np.arange(len(r.len)), r.len) + 1
    for lane in (r.h1, r.h2):
        total = np.r_[np.uint64(0), np.cumsum(mix(lane ^ spot), dtype=np.uint64)]
        keys = np.full(len(r.w) + len(r.len), 11, dtype=np.uint64)
        keys[slots] = mix(total[1:] - np.repeat(total[r.at[:-1]], r.len) + depth.astype(np.uint64))
        out.append(keys.view(np.int64))
    return out[0], out[1]


def block_nodes(r: Rows, before: int, after: int) -> list[np.ndarray]:
    """Partial sums of all prefixes of a block, columns as in ``_NODE``.

    ``before``, ``after``: LCPs of the first row with the row before it and of the last with the row after it (-1: none).
    """
    n = len(r.len)
    low = lcps(r)
    table, ids = RangeMin(low), RangeMin(r.conv)
    # candidates: the prefixes that a row does not share with the row before
    count = r.len - low
    first = np.r_[0, np.cumsum(count)]
    row = np.repeat(np.arange(n), count)
    depth = np.arange(first[-1]) - first[row] + low[row] + 1
    lo, hi = table.left(row, depth), table.right(row, depth)

    own = low.copy()
    own[0] = before
    words = np.r_[0, np.cumsum(r.w)]
    whole = words[r.at[1:]] - words[r.at[:-1]]
    upto = lambda i, d: words[r.at[i] + np.maximum(d, 0)] - words[r.at[i]]
    all_words = np.r_[0, np.cumsum(whole)]
    once = np.r_[0, np.cumsum(whole - upto(np.arange(n), own))]
    size = hi - lo + 1
    members = all_words[hi + 1] - all_words[lo] - size * upto(row, depth - 1)
    nodes = once[hi + 1] - once[lo + 1] + whole[lo] - upto(lo, np.maximum(depth - 1, own[lo]))
    ends = np.r_[0, np.cumsum(np.r_[own[1:], after] < r.len)]

    # the parent of a row's first candidate belongs to an earlier row, that of the others to the same row
    mine = np.arange(first[-1])
    top = depth == low[row] + 1
    parent = mine - 1
    up = top & (depth > 0)
    owner = table.left(row[up], depth[up] - 1)
    parent[up] = first[owner] + depth[up] - 1 - low[owner] - 1
    child = (depth > 0) & (depth > own[row])
    children = np.bincount(parent[child], minlength=len(mine))

    k1, k2 = _prefix_keys(r)
    slot = r.at[row] + row + depth
    over = np.where(depth > 0, slot - 1, slot)
    return [k1[slot], k2[slot], k1[over], k2[over], depth, ids.least(lo, hi), size, children, ends[hi + 1] - ends[lo], members - nodes]


def block_ends(r: Rows) -> tuple[list, list, list, list]:
    """For each run of equal rows: the key of their whole sequence, the first id, the ids joined by commas."""
    k1, k2 = _prefix_keys(r)
    last = r.at[1:] + np.arange(len(r.len))
    a, b = k1[last], k2[last]
    edge = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    ids = r.conv.tolist()
    cuts = [*edge.tolist(), len(ids)]
    return a[edge], b[edge], r.conv[edge], [",".join(map(str, ids[i:j])) for i, j in zip(cuts, cuts[1:])]


# ------------------------------------------------------------------ all rows

def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Rows]:
    for b in batches:
        at = np.r_[0, np.cumsum(pc.list_value_length(b.column("w")).to_numpy(zero_copy_only=False))]
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(at, at[i] + most, side="right")) - 1)
            yield Rows(b.slice(i, min(j, b.num_rows) - i))
            i = min(j, b.num_rows)


def _edges(ordered: DataFrame, most: int) -> dict[int, tuple]:
    """Task -> (turns of the last row of the tasks before, turns of the first row of those after)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        first = last = None
        for r in _blocks(batches, most):
            first = r.turns(0) if first is None else first
            last = r.turns(len(r.len) - 1)
        if first is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "first": pa.array([first.tobytes()]), "last": pa.array([last.tobytes()])})

    rows = sorted(ordered.mapInArrow(run, "part int, first binary, last binary").collect(), key=lambda x: x.part)
    turns = lambda x: np.frombuffer(bytes(x), dtype=np.uint64).reshape(-1, 2)
    return {x.part: (turns(rows[i - 1].last) if i else None, turns(rows[i + 1].first) if i + 1 < len(rows) else None) for i, x in enumerate(rows)}


def _walk(ordered: DataFrame, most: int) -> DataFrame:
    """Partial sums of the prefixes of all blocks, and (without depth) the ids that end at a prefix."""
    edges = ordered.sparkSession.sparkContext.broadcast(_edges(ordered, most))
    names = [c.split()[0] for c in _NODE.split(", ")] + ["ids"]

    def emit(r: Rows, before, after) -> Iterator[pa.RecordBatch]:
        cols = block_nodes(r, -1 if before is None else _shared(before, r.turns(0)), -1 if after is None else _shared(r.turns(len(r.len) - 1), after))
        yield pa.RecordBatch.from_arrays([*[pa.array(c.astype(np.int64, copy=False)) for c in cols], pa.nulls(len(cols[0]), pa.string())], names=names)
        a, b, conv, ids = block_ends(r)
        none = pa.nulls(len(a), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), none, none, none, pa.array(conv), none, none, none, none, pa.array(ids, pa.string())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        before, after = edges.value.get(TaskContext.get().partitionId(), (None, None))
        held = None
        for r in _blocks(batches, most):
            if held is not None:
                yield from emit(held, before, r.turns(0))
                before = held.turns(len(held.len) - 1)
            held = r
        if held is not None:
            yield from emit(held, before, after)

    return ordered.mapInArrow(run, _NODE + ", ids string")


def _digests(ends: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256): hash of all ids that end at a prefix, joined by commas in ascending order; read as a stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for b in batches:
            done = []
            for k1, k2, ids in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
                if (k1, k2) == key:
                    sha.update(b",")
                else:
                    if key is not None:
                        done.append((*key, sha.hexdigest()))
                    key, sha = (k1, k2), hashlib.sha256()
                sha.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["k1", "k2", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*key, sha.hexdigest())], names=["k1", "k2", "ends_sha256"])

    return ends.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "conv_id").select("k1", "k2", "ids").mapInArrow(run, "k1 long, k2 long, ends_sha256 string")


def trie(seqs: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per distinct prefix of the sequences (conv_id, seq): conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    ship(seqs.sparkSession)
    keys = F.flatten(F.transform("seq", lambda s: F.array(s["h1"], s["h2"])))
    flat = seqs.select("conv_id", keys.alias("keys"), F.transform("seq", lambda s: s["w"]).alias("w"))
    ordered = cut_lineage(flat.repartitionByRange("keys", "conv_id").sortWithinPartitions("keys", "conv_id"))
    walked = stored(_walk(ordered, block_turns), "trie-blocks")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    nodes = walked.where("depth is not null").groupBy("k1", "k2", "p1", "p2", "depth").agg(F.min("conv_id").alias("conv_id"), *sums)
    ends = _digests(walked.where("depth is null"))
    nodes = stored(nodes.join(ends, ["k1", "k2"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256))), "trie-nodes")
    return _parents(nodes)


def _parents(nodes: DataFrame) -> DataFrame:
    """Adds the parents' smallest members. Parents of a large share of all nodes are few, and broadcast."""
    total = nodes.count()
    hot: Column = F.col("n_children") * HOT_PARENTS > total
    over = nodes.where("n_children > 0").select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), hot.alias("hot"))
    named = nodes.join(F.broadcast(over.where("hot").drop("hot")), ["p1", "p2"], "left")
    rest = named.where("depth > 0 and parent_conv_id is null").drop("parent_conv_id").join(over.where("not hot").drop("hot"), ["p1", "p2"])
    known = named.where("depth = 0 or parent_conv_id is not null").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("parent_conv_id")))
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return known.select(*cols).unionByName(rest.select(*cols))
