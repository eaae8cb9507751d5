"""Exact Jaccard join of documents on word shingles, by partitioning the shingle universe.

A document is the set of its distinct k-word shingles (64-bit hashes). Equal sets form a class (by a 64-bit
digest), and only classes are joined. A set of n elements differs from any set that it links with in
at most D(n) = n (1 - t) / t elements. Shingles are hashed into segments, more of them in bands of larger
sets; by the pigeonhole principle two linked sets agree, or nearly agree, in some of them:

* ``eq`` segments are indexed by their content. ``near`` segments are indexed by their content and by
  each of its one-deletion neighbours, which also finds contents that differ by one element, and so count
  twice. Linked sets agree in at least eq + 2 near - D of that budget.
* So a set may leave out all but D + 1 of it, as long as all sets prefer the same signatures: of those that
  two linked sets share, the last in a common order is then left out by neither. First go the
  signatures with the fewest elements (by size, then hash), before anything is written; ``RARE`` parts in
  all are written on top, and the most frequent ones of these go once frequencies are known. As the two orders
  differ, the second number is one for the whole band (or all that a set has to spare). This keeps empty
  and common segments (boilerplate, the unchanged parts of widely copied texts) out of the candidate search.
* How many segments and how many near ones a band gets is chosen by cost: signatures to write against weak
  ones (at most one element) that stay.

A set is indexed in its own band and, if sets of the next band can link with it, in that, too. All candidates
are verified exactly on the whole sets. They are not expanded into all pairs: in each signature's
bucket, every member is compared with one pivot; buckets whose members are then in one component are done; in
the others, the members outside the pivot's component are compared in blocks with the members of other
components (all buckets of a pivot together), inside tasks that return only links.

Results: ``component_id`` is the smallest id reachable by links. Texts that are null or have no word have an
empty set and link with nothing; fewer than k words count as one shingle; repeated rows are one class.
Ids may repeat or be null. Other columns are not read.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import ascii_lower, free_at_once, mix, raw_text, shingles, ship, slices, span_hashes, stored, words

#: Members of a block in the comparison of buckets with several components.
BLOCK = 512
#: Cost of one weak signature, in signatures.
WEAK_COST = 20.0
#: Signatures written beyond the D + 1 needed, as a share of these; the most frequent ones are left out again.
RARE = 0.25
#: A band's sizes span this power of 1 / t.
SPAN = 3
_LOW = -(1 << 63)


class Bands:
    """Size bands for sets of up to ``largest`` elements and how each is cut into segments (similarity num/den)."""

    def __init__(self, num: int, den: int, largest: int):
        self.num, self.den = num, den
        low = [1]
        while len(low) < 2 or low[-2] <= largest:
            low.append(low[-1] * den ** SPAN // num ** SPAN + 1)
        self.low = np.array(low, dtype=np.int64)
        top = self.low[1:] - 1
        cuts = [_allocate(int(d), int(n)) for d, n in zip(self.gap(top), top)]
        self.eq, self.near = (np.array(x, dtype=np.int64) for x in zip(*cuts))
        self.late = np.ceil(RARE * (self.gap(top) + 1)).astype(np.int64)

    def gap(self, sizes: np.ndarray) -> np.ndarray:
        """D: in how many elements a set can differ from a set that it links with."""
        return sizes * (self.den - self.num) // self.num

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, sizes, side="right") - 1

    def meets_next(self, sizes: np.ndarray, band: np.ndarray) -> np.ndarray:
        """Whether sets of the next band can be similar enough."""
        return self.den * sizes >= self.num * self.low[band + 1]

    def budget(self, sizes: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """eq signatures that a set leaves out before writing, and of those written, once frequencies are known."""
        gap = self.gap(sizes)
        spare = np.clip(self.eq[band] + 2 * self.near[band] - 1 - gap, 0, self.eq[band])
        late = np.minimum(spare, self.late[band])
        return spare - late, late


def _allocate(gap: int, size: int) -> tuple[int, int]:
    """(eq, near) segments of least cost for sets of ``size`` elements that differ in up to ``gap``."""
    best = None
    written = math.ceil((1 + RARE) * (gap + 1))
    for total in sorted({math.ceil(written * x) for x in (1.0, 1.25, 1.5, 2.0)}):
        for near in sorted({0, 1, 2, (gap + 1) // 4, (gap + 1) // 2}):
            eq = total - 2 * near
            if eq < 0 or eq + near == 0:
                continue
            mean = size / (eq + near)
            weak = math.exp(-mean) * (1 + mean)  # share of segments with at most one element (Poisson)
            dropped = min(eq, total - 1 - gap)
            left = max(0.0, eq * weak - dropped) + near * math.exp(-mean) * (1 + mean + mean * mean / 2)
            cost = max(0, min(eq, written - 2 * near)) + near * (1 + mean) + WEAK_COST * left + 0.1 * total
            if best is None or cost < best[0]:
                best = (cost, eq, near)
    return best[1:]


# ------------------------------------------------------------------ sets and signatures

def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every row, sorted within rows, and their row numbers."""
    data, offsets = raw_text(column)
    low = ascii_lower(data)
    starts, ends, rows = words(low, offsets)
    h, rows = shingles(span_hashes(low, starts, ends), rows, k) if len(starts) else (np.zeros(0, np.uint64), rows)
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    if len(h):
        keep = np.r_[True, (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])]
        h, rows = h[keep], rows[keep]
    return h, rows


def _sums(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of 64-bit values per index, modulo 2**64 (two exact half sums; below 2**21 values each)."""
    lo = np.bincount(index, weights=(values & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=size)
    hi = np.bincount(index, weights=(values >> np.uint64(32)).astype(np.float64), minlength=size)
    return lo.astype(np.uint64) + (hi.astype(np.uint64) << np.uint64(32))


def digests(h: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """64-bit digest of each row's set (0 for empty sets)."""
    return mix(_sums(rows, mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), n))


def signatures(h: np.ndarray, rows: np.ndarray, sizes: np.ndarray, band: np.ndarray, bands: Bands) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Signatures (eq lists, near lists) of every row's set in the given band of each row (below 0: none), and
    how many of the eq ones may be left out later."""
    n = len(sizes)
    live = band >= 0
    band = np.maximum(band, 0)
    eq, near = np.where(live, bands.eq[band], 0), np.where(live, bands.near[band], 0)
    early, late = bands.budget(sizes, band)
    parts = eq + near
    use = parts[rows] > 0
    h, rows = h[use], rows[use]
    salt = (band.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    inner = mix(h + salt[rows])
    first = np.r_[0, np.cumsum(parts)]
    part = (mix(inner) >> np.uint64(11)).astype(np.int64) % np.maximum(parts, 1)[rows]
    spot = first[rows] + part
    content, count = _sums(spot, inner, int(first[-1])), np.bincount(spot, minlength=int(first[-1]))
    owner = np.repeat(np.arange(n), parts)
    number = np.arange(first[-1]) - first[owner]
    place = mix(salt[owner] + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    key = mix(content ^ place)
    is_eq = number < eq[owner]
    # eq: the contents with the fewest elements go first, equal ones by their key
    who, values = owner[is_eq], key[is_eq]
    order = np.lexsort((values, count[is_eq], who))
    who, values = who[order], values[order]
    start = np.r_[0, np.cumsum(eq)]
    keep = np.arange(len(who)) - start[who] >= early[who]
    eq_lists = _lists(who[keep], values[keep], n)
    # near: the content, and the content without each one of its elements
    own = part >= eq[rows]
    at = spot[own]
    values = np.concatenate([key[~is_eq], mix((content[at] - inner[own]) ^ place[at])])
    who = np.concatenate([owner[~is_eq], rows[own]])
    order = np.argsort(who, kind="stable")
    return eq_lists, _lists(who[order], values[order], n), late


def _lists(who: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    """Lists of the values of each of n rows (``who`` ascending)."""
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.bincount(who, minlength=n))].astype(np.int32)), pa.array(values.view(np.int64)))


def _indexed(docs: DataFrame, k: int) -> DataFrame:
    """Every document: id, set size, node (digest of the set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_at_once()
        for b in slices(batches, "t"):
            h, rows = shingle_sets(b.column("t"), k)
            yield pa.RecordBatch.from_arrays([b.column("d"), pa.array(np.bincount(rows, minlength=b.num_rows)), pa.array(digests(h, rows, b.num_rows).view(np.int64))],
                                             names=["doc_id", "n", "node"])

    return docs.mapInArrow(run, "doc_id long, n long, node long")


def _signed(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(rid, sig, own, late): the signatures of every set (node) in its own band and in the next; ``late`` is how many of
    the set's eq signatures there may be left out later, and -1 for a near signature, which never is.

    Signatures are many times the digests, so they are made where they are exchanged and never stored. A task writes
    those of equal sets once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_at_once()
        bands, seen = Bands(num, den, 1 << 16), set()
        for b in slices(batches, "t"):
            h, rows = shingle_sets(b.column("t"), k)
            n = np.bincount(rows, minlength=b.num_rows)
            if n.max(initial=0) >= bands.low[-2]:
                bands = Bands(num, den, int(n.max()))
            node = digests(h, rows, b.num_rows)
            new = np.zeros(b.num_rows, dtype=bool)
            for i, x in enumerate(node.tolist()):
                if n[i] and x not in seen:
                    seen.add(x)
                    new[i] = True
            size = np.maximum(n, 1)
            band = bands.of(size)
            new &= bands.gap(size) > 0  # smaller sets cannot link with different ones
            up = np.where(new & bands.meets_next(size, band), band + 1, -1)
            for own, of in ((True, np.where(new, band, -1)), (False, up)):
                eq, near, late = signatures(h, rows, size, of, bands)
                for lists, spare in ((eq, late), (near, np.full(b.num_rows, -1))):
                    who = lists.value_parent_indices().to_numpy()
                    if len(who):
                        yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)[who]), lists.flatten(), pa.array(np.full(len(who), own)), pa.array(spare[who].astype(np.int32))],
                                                         names=["rid", "sig", "own", "late"])

    return docs.select("t").mapInArrow(run, "rid long, sig long, own boolean, late int")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """(node, items) of documents: the digest and the sorted elements of each set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_at_once()
        for b in slices(batches, "t"):
            h, rows = shingle_sets(b.column("t"), k)
            yield pa.RecordBatch.from_arrays([pa.array(digests(h, rows, b.num_rows).view(np.int64)), _lists(rows, h, b.num_rows)], names=["node", "items"])

    return docs.select("t").mapInArrow(run, "node long, items array<long>")


# ------------------------------------------------------------------ components

def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable over ``edges`` (a, b), for every node of an edge.

    Each round takes the smallest label among neighbours and then the label of that label.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "jaccard-edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "jaccard-labels")
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("v")).agg(F.min("root").alias("r")))
        step = labels.join(near, labels.node == near.v).select("node", "root", F.least("root", "r").alias("low"))
        hop = labels.select(F.col("node").alias("n2"), F.col("root").alias("r2"))
        new = stored(step.join(hop, step.low == hop.n2, "left").select("node", "root", F.least("low", F.coalesce("r2", "low")).alias("next")), "jaccard-labels")
        labels = new.select("node", F.col("next").alias("root"))
        if new.where("next <> root").isEmpty():
            return labels


# ------------------------------------------------------------------ join

def join(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document; links need similarity num/den or more."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("d"), F.col(f"`{text_col}`").cast("string").alias("t"))
    index = stored(_indexed(texts, k), "jaccard-index")
    classes = stored(index.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least")), "jaccard-classes")
    roots = components(_links(texts, classes, k, num, den))
    named = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("node", "component_id")
    keyed = index.select("doc_id", F.col("n").alias("n_shingles"), "node")
    full = keyed.where("n_shingles > 0").join(named, "node").select("doc_id", "n_shingles", "component_id")
    return full.unionByName(keyed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def _links(texts: DataFrame, classes: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Edges (a, b) between nodes (sets) that connect exactly the nodes connected by links."""
    rows = _signed(texts, k, num, den)
    # one exchange by signature: rows are counted where they are kept, and those of one set alone go
    of_sig = Window.partitionBy("sig")
    told = rows.withColumns({"c": F.count(F.lit(1)).over(of_sig), "r1": F.min("rid").over(of_sig), "r2": F.max("rid").over(of_sig), "o": F.max("own").over(of_sig)})
    shared = stored(told.where("r1 <> r2 and o").drop("r1", "r2", "o").dropDuplicates(["sig", "rid", "own"]), "jaccard-shared")
    # each set leaves out its most frequent eq signatures, as many as it may
    by = Window.partitionBy("rid", "own").orderBy(F.desc("c"), "sig")
    eqs = shared.where("late >= 0").withColumn("n", F.row_number().over(by)).where(F.col("n") > F.col("late")).drop("n")
    left = eqs.unionByName(shared.where("late < 0"))
    size = Window.partitionBy("rid")
    members = stored(left.withColumn("p", F.sum("c").over(size)).select("sig", "rid", "own", "p"), "jaccard-members")
    # the pivot of a bucket: the member of the own band whose signatures are the most frequent
    pivots = (members.groupBy("sig").agg(F.max(F.when(F.col("own"), F.struct("p", (-F.col("rid")).alias("r")))).alias("v"),
                                         F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("rid")).alias("x"))
              .where("c > 1 and v is not null").select("sig", (-F.col("v.r")).alias("pivot"), "c", "x"))
    # buckets with the same members and pivot do the same work once
    pivots = pivots.groupBy("pivot", "c", "x").agg(F.min("sig").alias("sig")).select("sig", "pivot")
    buckets = stored(members.join(pivots, "sig").select("sig", "rid", "pivot").distinct(), "jaccard-buckets")
    pairs = stored(buckets.where("rid <> pivot").select("rid", "pivot").distinct(), "jaccard-pairs")

    used = stored(pairs.select("rid").union(pairs.select("pivot")).distinct(), "jaccard-used")
    found = stored(classes.join(used, classes.node == used.rid, "left_semi"), "jaccard-found")
    wanted = found.select(F.coalesce("least", F.lit(_LOW)).alias("d")).distinct()
    whole = texts.withColumn("d", F.coalesce("d", F.lit(_LOW))).join(wanted, "d", "left_semi")
    sets = stored(_sets(whole, k).join(found.select("node"), "node", "left_semi").groupBy("node").agg(F.first("items").alias("items")), "jaccard-sets")

    a, b = (sets.select(F.col("node").alias(n), F.col("items").alias(f"i{n}")) for n in ("rid", "pivot"))
    same = F.size(F.array_intersect("irid", "ipivot"))
    linked = den * same >= num * (F.size("irid") + F.size("ipivot") - same)
    # sizes first: most unlinked pairs differ too much, and need no elements moved
    sizes = stored(sets.select("node", F.size("items").alias("n")), "jaccard-sizes")
    sa, sb = (sizes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}")) for x in ("rid", "pivot"))
    close = pairs.join(sa, "rid").join(sb, "pivot").where(num * F.greatest("nrid", "npivot") <= den * F.least("nrid", "npivot")).select("rid", "pivot")
    stars = stored(close.join(a, "rid").join(b, "pivot").where(linked).select(F.col("rid").alias("a"), F.col("pivot").alias("b")), "jaccard-stars")
    return stars.unionByName(_rest(pairs, sets, components(stars), num, den))


def _rest(pairs: DataFrame, sets: DataFrame, roots: DataFrame, num: int, den: int) -> DataFrame:
    """Links between members of one bucket that the comparisons with pivots left in different components.

    All buckets of a pivot are taken together, so that the elements of a member move once per pivot.
    """
    named = (pairs.join(roots, pairs.rid == roots.node, "left").withColumn("root", F.coalesce("root", "rid")).drop("node")
             .join(roots.select(F.col("node").alias("pivot"), F.col("root").alias("main")), "pivot", "left")
             .withColumn("main", F.coalesce("main", "pivot")).withColumnRenamed("pivot", "sig"))
    many = (named.groupBy("sig").agg(F.min("root").alias("r1"), F.max("root").alias("r2"), F.count_if(F.col("root") != F.col("main")).alias("out"))
            .where("r1 <> r2").select("sig", F.ceil(F.col("out") / BLOCK).cast("int").alias("blocks")))
    named = stored(named.join(many, "sig"), "jaccard-open")
    items = sets.select(F.col("node").alias("rid"), "items")
    key = F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")
    outside = named.where(F.col("root") != F.col("main")).withColumn("block", key).withColumn("part", F.lit(-1))
    # the other members come in parts, too, so that no task holds a whole bucket
    total = named.groupBy("sig").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    named, outside = named.join(total, "sig"), outside.join(total, "sig")
    others = (named.withColumn("part", F.pmod(F.xxhash64(F.lit(1), "rid"), F.col("parts")).cast("int"))
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    outside = outside.drop("part").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cols = ["sig", "block", "part", "rid", "root", "items"]
    left, right = (f.join(items, "rid").select(*cols).toDF(*cols) for f in (outside, others))

    def compare(key, x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(y):
            return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
        inter = intersections(x["items"].tolist(), y["items"].tolist())
        nx, ny = x["items"].map(len).to_numpy(), y["items"].map(len).to_numpy()
        link = den * inter >= num * (nx[:, None] + ny[None, :] - inter)
        link &= x["root"].to_numpy()[:, None] != y["root"].to_numpy()[None, :]
        i, j = np.nonzero(link)
        # one link from each member to each component is enough
        one = pd.DataFrame({"a": x["rid"].to_numpy()[i], "b": y["rid"].to_numpy()[j], "r": y["root"].to_numpy()[j]})
        return one.drop_duplicates(["a", "r"])[["a", "b"]]

    keys = ["sig", "block", "part"]
    new = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, "a long, b long").distinct()
    return stored(new, "jaccard-rest")


def intersections(xs: list[np.ndarray], ys: list[np.ndarray], cells: int = 4_000_000) -> np.ndarray:
    """Sizes of the intersections of all xs with all ys, by products of zero-one matrices over common elements."""
    out = np.zeros((len(xs), len(ys)), dtype=np.int64)
    ax, ay = np.concatenate(xs), np.concatenate(ys)
    common = np.intersect1d(ax, ay)
    if not len(common):
        return out
    spots = []
    for arrays, flat in ((xs, ax), (ys, ay)):
        rows = np.repeat(np.arange(len(arrays)), [len(v) for v in arrays])
        at = np.minimum(np.searchsorted(common, flat), len(common) - 1)
        hit = common[at] == flat
        order = np.argsort(at[hit], kind="stable")
        spots.append((rows[hit][order], at[hit][order]))
    step = max(1, cells // (len(xs) + len(ys)))
    for lo in range(0, len(common), step):
        mats = []
        for (rows, at), n in zip(spots, (len(xs), len(ys))):
            s = slice(*np.searchsorted(at, [lo, lo + step]))
            m = np.zeros((n, min(step, len(common) - lo)), dtype=np.float32)
            m[rows[s], at[s] - lo] = 1
            mats.append(m)
        out += (mats[0] @ mats[1].T).astype(np.int64)
    return out
