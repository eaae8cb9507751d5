"""Exact k-nearest-neighbour imputation as a search over pivot cells (no all-pairs join).

Distance between a receiver (row missing column c) and a donor (row with c observed) is
the NaN-aware Euclidean distance over the feature columns both rows have:
``sqrt(p / |S| * sum_{j in S} (a_j - b_j)^2)``; pairs with no common column never match.
The imputed value is the mean of c over the k nearest donors (ties: smaller donor key);
a receiver without any donor sharing a column gets the donors' mean of c. No scaling.

Donors of one null pattern, seen through one set S of common columns, form a group, which is a point set of a
true metric space. Each group is cut into Voronoi cells around pivots (a hash sample of its points, about one
per ``cell_rows`` donors); a cell knows its size, radius and bounding box. The search has two steps:

1. Every receiver is compared with the donors of its nearest cell of each group that it can use,
   which gives an upper bound of its k-th distance for each missing column.
2. It is sent to just those further cells that the triangle inequality (distance to the pivot less radius) and the
   box do not rule out at this bound.

Cells adapt to the data in any number of columns, so that a receiver meets a few cells of constant size. Equal
receivers are searched once. Equal donors are one row with their k smallest keys, and at one point of a group only the k
of these rows with the smallest first keys are kept, so that common values
(a median that filled a quarter of a column) are neither a large cell nor a large join key. Cells
and their receivers meet in cogroups of bounded size. Only the cells' summaries (``MAX_PIVOTS`` at most) and the
distinct null patterns are on the driver. The input is read once, into a checkpoint.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.scalar import qcol
from ..session import cut_lineage, ship

#: Pivots in all; beyond, cells grow.
MAX_PIVOTS = 1 << 15
#: Receivers that meet a cell in one block, and rows of a cogroup, about.
BLOCK_ROWS, GROUP_ROWS = 4096, 50_000
_Q = ["q1", "q2"]
#: Stands for a donor without a key.
_NO_KEY = -(1 << 63)


class Cells:
    """The cells of every group: pivots, radii, sizes and boxes as arrays; knows which groups a null pattern can use."""

    def __init__(self, p: int, groups: dict[tuple[str, str], int], receivers: list[str]):
        self.p = p
        self.common = {g: np.array([b == "1" for b in s]) for (s, _), g in groups.items()}
        self.targets = {g: [j for j in range(p) if pd_[j] == "1" and s[j] == "0"] for (s, pd_), g in groups.items()}
        self.of = {r: [g for (s, pd_), g in groups.items() if s == _meet(r, pd_)] for r in receivers}
        self.pivots: dict[int, np.ndarray] = {}
        self.first: dict[int, int] = {}  # number of a group's first cell
        self.radius = self.size = self.rows = self.low = self.high = None

    def set_pivots(self, pivots: dict[int, np.ndarray]) -> None:
        self.pivots, at = pivots, 0
        for g, x in pivots.items():
            self.first[g], at = at, at + len(x)
        self.radius, self.size = np.full(at, -np.inf), np.zeros(at, np.int64)
        self.rows = np.zeros(at, np.int64)
        self.low, self.high = np.full((at, self.p), np.inf), np.full((at, self.p), -np.inf)

    def span(self, g: int) -> slice:
        return slice(self.first[g], self.first[g] + len(self.pivots[g]))

    def scale(self, g: int) -> float:
        return math.sqrt(self.p / self.common[g].sum())

    def centre_distances(self, g: int, x: np.ndarray) -> np.ndarray:
        """Distances to the group's pivots, never above the true ones by rounding."""
        c = self.pivots[g]
        shift = c.mean(axis=0)
        a, b = x - shift, c - shift
        na, nb = (a * a).sum(axis=1)[:, None], (b * b).sum(axis=1)[None, :]
        return np.sqrt(np.maximum(na + nb - 2 * (a @ b.T) - 1e-12 * (na + nb), 0.0))

    def nearest(self, g: int, x: np.ndarray, k: int) -> np.ndarray:
        """Mask of the cells of the first step: the nearest one, and more where that holds less than k donors."""
        d, size = self.centre_distances(g, x), self.size[self.span(g)]
        d[:, size == 0] = np.inf
        take = np.zeros(d.shape, dtype=bool)
        best = d.argmin(axis=1)
        take[np.arange(len(x)), best] = True
        few = np.flatnonzero(size[best] < k)
        if len(few):
            order = np.argsort(d[few], axis=1, kind="stable")
            need = np.cumsum(size[order], axis=1) - size[order] < k
            take[few[:, None], order] = need
        return take & (size > 0)

    def possible(self, g: int, x: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Mask of the cells that can hold a donor at the bound or nearer."""
        s = self.span(g)
        reach = bound / self.scale(g) * (1 + 1e-9) + 1e-12
        ok = (self.centre_distances(g, x) - self.radius[s] * (1 + 1e-9) <= reach[:, None]) & (self.size[s] > 0)
        i, j = np.nonzero(ok)
        for lo in range(0, len(i), 1 << 18):
            a, b = i[lo:lo + (1 << 18)], j[lo:lo + (1 << 18)]
            off = np.maximum(np.maximum(self.low[s][b] - x[a], x[a] - self.high[s][b]), 0.0)
            ok[a, b] = np.sqrt((off * off).sum(axis=1)) <= reach[a]
        return ok


def _meet(a: str, b: str) -> str:
    return "".join("1" if x == y == "1" else "0" for x, y in zip(a, b))


def _matrix(column: pa.Array, p: int) -> np.ndarray:
    return np.nan_to_num(column.flatten().to_numpy(zero_copy_only=False).astype(float), nan=np.nan).reshape(-1, p)


def _chunks(n: int, width: int):
    step = max(1, 2_000_000 // max(width, 1))
    return ((lo, min(lo + step, n)) for lo in range(0, n, step))


def _assign(don: DataFrame, cells) -> DataFrame:
    """Donors with their cell and the distance to its pivot."""
    p = cells.value.p

    def run(batches):
        c = cells.value
        for b in batches:
            gid, x = b.column("gid").to_numpy(), _matrix(b.column("coords"), p)
            cell, dist = np.zeros(len(gid), np.int32), np.zeros(len(gid))
            for g in np.unique(gid):
                rows = np.flatnonzero(gid == g)
                for lo, hi in _chunks(len(rows), len(c.pivots[g])):
                    r = rows[lo:hi]
                    best = c.centre_distances(g, x[r]).argmin(axis=1)
                    cell[r] = c.first[g] + best
                    dist[r] = np.sqrt(((x[r] - c.pivots[g][best]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(dist)], names=[*b.schema.names, "cell", "off"])

    return don.mapInArrow(run, don._jdf.schema().toDDL() + ", cell int, off double")


def _probes(queries: DataFrame, cells, k: int, second: bool) -> DataFrame:
    """(q1, q2, tag, cell, coords): the cells that each receiver is compared with in the first or the second step."""
    p = cells.value.p
    names = ["q1", "q2", "tag", "cell", "coords"]

    def run(batches):
        c = cells.value
        for b in batches:
            pats = b.column("pat").dictionary_encode()
            codes = pats.indices.to_numpy(zero_copy_only=False)
            vals = _matrix(b.column("vals"), p)
            dk = _matrix(b.column("dk"), p) if second else None
            for code, pat in enumerate(pats.dictionary.to_pylist()):
                rows = np.flatnonzero(codes == code)
                for g in c.of.get(pat, ()):
                    for lo, hi in _chunks(len(rows), len(c.pivots[g])):
                        r = rows[lo:hi]
                        x = np.where(c.common[g], vals[r], 0.0)
                        take = c.nearest(g, x, k)
                        if second:
                            take = c.possible(g, x, dk[r][:, c.targets[g]].max(axis=1)) & ~take
                        i, j = np.nonzero(take)
                        for a in range(0, len(i), 1 << 15):
                            s = slice(a, a + (1 << 15))
                            at = pa.array(r[i[s]])
                            coords = pa.ListArray.from_arrays(pa.array(np.arange(len(i[s]) + 1) * p, pa.int32()), pa.array(x[i[s]].ravel()))
                            yield pa.RecordBatch.from_arrays([b.column("q1").take(at), b.column("q2").take(at), b.column("tag").take(at),
                                                              pa.array((c.first[g] + j[s]).astype(np.int32)), coords], names=names)

    return queries.mapInArrow(run, "q1 long, q2 long, tag int, cell int, coords array<double>")


def nearest_in_block(x: np.ndarray, y: np.ndarray, ids: np.ndarray, k: int, scale2: float, barred: np.ndarray | None = None):
    """For each row of x its k nearest rows of y (equal distances: smaller id): (row, position, distance), by row and rank."""
    order = np.argsort(ids, kind="stable")
    d = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        d += (x[:, j, None] - y[order, j][None, :]) ** 2
    d = np.sqrt(scale2 * d)
    if barred is not None:
        d[barred[:, order]] = np.inf
    kth = np.partition(d, k - 1, axis=1)[:, k - 1] if len(y) > k else np.full(len(x), np.inf)
    i, j = np.nonzero((d <= kth[:, None]) & np.isfinite(d))
    v = d[i, j]
    o = np.lexsort((v, i))
    i, j, v = i[o], j[o], v[o]
    rank = np.arange(len(i)) - np.searchsorted(i, i)
    keep = rank < k
    return i[keep], order[j[keep]], v[keep]


def nearest_donors(i: np.ndarray, j: np.ndarray, v: np.ndarray, ids: list[np.ndarray], k: int):
    """Donors of the found rows (each holds several equal donors): the k nearest for each i, as (i, row, donor, distance)."""
    held = np.array([len(a) for a in ids])[j]
    before = np.cumsum(held) - held
    start = np.searchsorted(i, i)
    step = np.flatnonzero(np.r_[True, (i[1:] != i[:-1]) | (v[1:] != v[:-1])]) if len(i) else np.zeros(0, int)
    level = np.repeat(step, np.diff(np.r_[step, len(i)]))
    keep = before[level] - before[start] < k  # fewer than k donors are nearer
    i, j, v, held = i[keep], j[keep], v[keep], held[keep]
    donor = np.concatenate([ids[r] for r in j]) if len(j) else np.zeros(0, np.int64)
    i, j, v = np.repeat(i, held), np.repeat(j, held), np.repeat(v, held)
    o = np.lexsort((donor, v, i))
    i, j, v, donor = i[o], j[o], v[o], donor[o]
    keep = np.arange(len(i)) - np.searchsorted(i, i) < k
    return i[keep], j[keep], donor[keep], v[keep]


def _compare(probes: DataFrame, don: DataFrame, cells, k: int, tags: bool) -> DataFrame:
    """(q1, q2, gid, donor, dist, vals): the k nearest donors of each probed cell."""
    spark, p = don.sparkSession, cells.value.p
    counts = {r.cell: r.n for r in probes.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return spark.createDataFrame([], "q1 long, q2 long, gid int, donor long, dist double, vals array<double>")
    size = cells.value.rows
    blocks = {c: -(-n // BLOCK_ROWS) for c, n in counts.items()}
    packs = max(1, (sum(counts.values()) + sum(int(size[c]) * b for c, b in blocks.items())) // GROUP_ROWS)
    table = F.broadcast(spark.createDataFrame([(int(c), int(b)) for c, b in blocks.items()], "cell int, blocks int"))
    pack = F.pmod(F.xxhash64("cell", "block"), F.lit(packs)).cast("int")
    left = probes.join(table, "cell").withColumn("block", F.pmod(F.xxhash64(*_Q), F.col("blocks")).cast("int")).withColumn("pack", pack)
    left = left.select("pack", "block", "cell", "tag", "coords", *_Q)
    right = don.join(table, "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("pack", pack)
    right = right.select("pack", "block", "cell", "gid", "donor", "ids", "tag", "coords", "vals")
    names = ["q1", "q2", "gid", "donor", "dist", "vals"]

    def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        ours = dict(list(a.groupby(["block", "cell"])))
        for unit, donors in b.groupby(["block", "cell"]):
            if unit not in ours:
                continue
            mine, g = ours[unit], int(donors["gid"].iloc[0])
            common = cells.value.common[g]
            y, ids, values = np.stack(donors["coords"].to_numpy())[:, common], donors["donor"].to_numpy(), donors["vals"].to_numpy()
            held = donors["ids"].to_list()
            x = np.stack(mine["coords"].to_numpy())[:, common]
            for lo, hi in _chunks(len(x), len(y)):
                barred = mine["tag"].to_numpy()[lo:hi, None] == donors["tag"].to_numpy()[None, :] if tags else None
                i, j, donor, v = nearest_donors(*nearest_in_block(x[lo:hi], y, ids, k, p / common.sum(), barred), held, k)
                q = mine.iloc[lo:hi]
                out.append(pd.DataFrame({"q1": q["q1"].to_numpy()[i], "q2": q["q2"].to_numpy()[i], "gid": np.full(len(i), g, np.int32),
                                         "donor": donor, "dist": v, "vals": values[j]}))
        return pd.concat(out) if out else pd.DataFrame({n: pd.Series(dtype="object" if n == "vals" else "float64" if n == "dist" else "int64") for n in names})

    return left.groupBy("pack").cogroup(right.groupBy("pack")).applyInPandas(run, "q1 long, q2 long, gid int, donor long, dist double, vals array<double>")


def knn_neighbours(df: DataFrame, cols: list[str], k: int = 5, key: str = "row_id",
                   cell_rows: int = 256, donor: str | None = None,
                   receiver: str | None = None, exclude: str | None = None) -> DataFrame:
    """Exact k nearest donors per (receiver key, missing column).

    ``donor`` / ``receiver``: optional boolean columns restricting which rows may give or
    receive values (e.g. training fold vs held-out fold); by default every row may do both.
    ``exclude``: optional integer column; rows of equal numbers there never match (e.g. folds, all searched at once).
    Returns ``(key, column, donor, dist, value, rank)`` with the donor's value of ``column``.
    Receivers sharing no column with any donor are absent (callers use the column mean). NaN counts as missing."""
    found = _search(df, cols, k, key, cell_rows, donor, receiver, exclude)
    if found is None:
        return df.sparkSession.createDataFrame([], f"{key} long, column string, donor long, dist double, value double, rank int")
    keys, out = found
    name = F.create_map(*[v for j, c in enumerate(cols) for v in (F.lit(j), F.lit(c))])
    return keys.join(out, _Q).select(F.col("_id").alias(key), name[F.col("c")].alias("column"), "donor", "dist", "value", "rank")


def _search(df: DataFrame, cols: list[str], k: int, key: str, cell_rows: int = 256, donor: str | None = None,
            receiver: str | None = None, exclude: str | None = None) -> tuple[DataFrame, DataFrame] | None:
    """(receivers with the two numbers of their distinct query, neighbours of the distinct queries); None without any donor."""
    spark = df.sparkSession
    ship(spark)
    p = len(cols)
    x = [F.when(~F.isnan(qcol(c).cast("double")), qcol(c).cast("double") + F.lit(0.0)) for c in cols]
    base = df.select(qcol(key).cast("long").alias("_id"), F.array(*x).alias("vals"), (qcol(donor) if donor else F.lit(True)).alias("_isd"),
                     (qcol(receiver) if receiver else F.lit(True)).alias("_isr"), (qcol(exclude).cast("int") if exclude else F.lit(-1)).alias("tag"))
    pat = F.array_join(F.transform("vals", lambda v: F.when(v.isNull(), "0").otherwise("1")), "")
    filled = F.transform("vals", lambda v: F.coalesce(v, F.lit(0.0)))
    base = base.where("_isd or _isr").withColumn("pat", pat)
    base = cut_lineage(base.withColumns({"q1": F.xxhash64("pat", filled, "tag"), "q2": F.xxhash64(F.lit(1), "tag", filled, "pat")}))
    stats = base.groupBy("pat").agg(F.count_if("_isd").alias("nd"), F.count_if("_isr").alias("nr")).collect()
    receivers = sorted(r.pat for r in stats if r.nr and "0" in r.pat)
    groups: dict[tuple[str, str], int] = {}
    for d in sorted(r.pat for r in stats if r.nd):
        for r in receivers:
            s = _meet(r, d)
            if "1" in s and s != d:
                groups.setdefault((s, d), len(groups))
    if not groups:
        return None
    cells = Cells(p, groups, receivers)

    uses = spark.createDataFrame([(d, s, g) for (s, d), g in groups.items()], "pat string, s string, gid int")
    seen = F.expr("transform(vals, (v, i) -> if(substr(s, i + 1, 1) = '1', v, 0D))")
    same = Window.partitionBy(*_Q).orderBy("_id")
    equal = (base.where("_isd").select(*_Q, "_id", "pat", "tag", "vals").withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k)
             .groupBy(*_Q).agg(F.array_sort(F.collect_list(F.coalesce("_id", F.lit(_NO_KEY)))).alias("ids"), *[F.first(c).alias(c) for c in ("pat", "tag", "vals")]))
    don = equal.join(F.broadcast(uses), "pat").select("gid", F.col("ids")[0].alias("donor"), "ids", "tag", seen.alias("coords"), "vals")
    don = don.withColumns({"p1": F.xxhash64("gid", "tag", "coords"), "p2": F.xxhash64("coords", "tag", "gid")})  # numbers sort faster than arrays
    point = Window.partitionBy("p1", "p2").orderBy("donor")
    don = cut_lineage(don.withColumn("_n", F.row_number().over(point)).where(F.col("_n") <= k).drop("_n", "p1", "p2"))

    # pivots: a hash sample of each group's donors
    n = {r.gid: r.n for r in don.groupBy("gid").agg(F.count(F.lit(1)).alias("n")).collect()}
    shrink = min(1.0, MAX_PIVOTS / max(1.0, sum(math.ceil(v / cell_rows) for v in n.values())))
    rates = spark.createDataFrame([(g, min(1.0, shrink / cell_rows)) for g in n], "gid int, rate double")
    drawn = don.join(F.broadcast(rates), "gid").where(F.pmod(F.xxhash64("donor", "gid"), F.lit(1 << 30)) < F.col("rate") * (1 << 30))
    pivots: dict[int, list] = {g: [] for g in n}
    for r in drawn.select("gid", "coords").distinct().collect():
        pivots[r.gid].append(r.coords)
    cells.set_pivots({g: np.array(sorted(v) or [[0.0] * p]) for g, v in pivots.items()})
    cells.of = {r: [g for g in gs if g in n] for r, gs in cells.of.items()}
    sc = spark.sparkContext
    don = cut_lineage(_assign(don, sc.broadcast(cells)))
    extent = [f(F.col("coords")[j]).alias(f"{a}{j}") for j in range(p) for a, f in (("l", F.min), ("h", F.max))]
    for r in don.groupBy("cell").agg(F.sum(F.size("ids")).alias("n"), F.count(F.lit(1)).alias("rows"), F.max("off").alias("r"), *extent).collect():
        cells.size[r.cell], cells.rows[r.cell], cells.radius[r.cell] = r.n, r.rows, r.r
        cells.low[r.cell], cells.high[r.cell] = [r[f"l{j}"] for j in range(p)], [r[f"h{j}"] for j in range(p)]
    shared = sc.broadcast(cells)

    queries = cut_lineage(base.where("_isr").where(F.col("pat").isin([r for r, gs in cells.of.items() if gs]))
                          .select("q1", "q2", "tag", "pat", "vals").dropDuplicates(_Q))
    wants = F.broadcast(spark.createDataFrame([(g, j) for g, t in cells.targets.items() for j in t], "gid int, c int"))
    best = Window.partitionBy(*_Q, "c").orderBy("dist", "donor")

    def told(found: DataFrame) -> DataFrame:
        return found.join(wants, "gid").select(*_Q, "c", F.nullif("donor", F.lit(_NO_KEY)).alias("donor"), "dist", F.expr("element_at(vals, c + 1)").alias("value"))

    def top(rows: DataFrame) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    first = cut_lineage(top(told(_compare(cut_lineage(_probes(queries, shared, k, False)), don, shared, k, exclude is not None))))
    kth = first.groupBy(*_Q, "c").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("d")).where(F.col("n") == k)
    kth = kth.groupBy(*_Q).agg(F.map_from_entries(F.collect_list(F.struct("c", "d"))).alias("m"))
    far = F.lit(float("inf"))
    bounds = F.transform(F.sequence(F.lit(0), F.lit(p - 1)), lambda c: F.coalesce(F.element_at("m", c), far))
    bounded = queries.join(kth, _Q, "left").withColumn("dk", F.when(F.col("m").isNull(), F.array_repeat(far, p)).otherwise(bounds)).drop("m")
    second = _compare(cut_lineage(_probes(bounded, shared, k, True)), don, shared, k, exclude is not None)
    out = top(first.drop("rank").unionByName(told(second)))
    return base.where("_isr").select("_id", *_Q), out


def knn_fill(df: DataFrame, cols: list[str], k: int = 5, key: str = "row_id", **kw) -> DataFrame:
    """(key, one column per ``cols``): the mean over the k nearest donors, for receivers that have any. The means are taken
    per distinct query, before they meet the keys (one row a receiver instead of k a missing cell)."""
    found = _search(df, cols, k, key, **kw)
    if found is None:
        return df.sparkSession.createDataFrame([], ", ".join([f"`{key}` long", *[f"`{c}` double" for c in cols]]))
    keys, out = found
    here = [F.when(F.col("c") == j, F.col("value")) for j in range(len(cols))]
    per = out.groupBy(*_Q).agg(*[f(v).alias(f"_{a}{j}") for j, v in enumerate(here) for a, f in (("s", F.sum), ("n", F.count))])
    mean = [(F.sum(f"_s{j}") / F.nullif(F.sum(f"_n{j}"), F.lit(0))).alias(c) for j, c in enumerate(cols)]
    return keys.join(per, _Q).groupBy(F.col("_id").alias(key)).agg(*mean)


def impute_knn(df: DataFrame, cols: list[str], k: int = 5, key: str = "row_id", **kw) -> DataFrame:
    """Fill the missing cells of ``cols`` with the mean over the k nearest donors."""
    fill = cut_lineage(knn_fill(df, cols, k, key, **kw))
    means = df.agg(*[F.avg(qcol(c)).alias(c) for c in cols]).first()
    fill = fill.select(key, *[F.col(c).alias(f"_f_{c}") for c in cols])
    j = df.join(fill, key, "left")
    return j.select(*[F.coalesce(qcol(c), F.col(f"_f_{c}"), F.lit(means[c])).alias(c) if c in cols else qcol(c)
                      for c in df.columns])


def tune_knn_k(df: DataFrame, cols: list[str], k_values=range(3, 20, 2), folds: int = 5,
               hide: float = 0.2, metric: str = "rmse", key: str = "row_id", seed: int = 42) -> DataFrame:
    """Choose k for KNN imputation by hiding cells of held-out complete rows.

    Complete rows get a hash fold; in each held-out fold ``hide`` of the cells (hash per
    row and column) are hidden and imputed from the other folds' rows. The neighbour lists of all
    folds come from one search for ``max(k)`` and every k is scored from its prefix. Returns
    ``(k, mean, std, best)`` with the population std over folds; folds without hidden cells
    are skipped; the smallest mean wins (ties: smaller k)."""
    from ..functions.hashing import portable_hash
    k_values = sorted(k_values)
    kmax = k_values[-1]
    comp = df.dropna(subset=cols).select(qcol(key).alias(key), *[qcol(c) for c in cols])
    comp = cut_lineage(comp.withColumn("_fold", F.pmod(portable_hash(key, seed), F.lit(folds)).cast("int")))
    u = lambda c: portable_hash(F.concat(F.col(key).cast("string"), F.lit("|" + c)), seed) / F.lit(4294967296.0)
    # all folds in one search: whole rows give, masked rows receive, and rows of one fold never match
    masked = comp.select(key, "_fold", *[F.when(u(c) >= hide, F.col(c)).alias(c) for c in cols], F.lit(False).alias("_isd"), F.lit(True).alias("_isr"))
    both = comp.withColumns({"_isd": F.lit(True), "_isr": F.lit(False)}).unionByName(masked)
    found = _search(both, cols, kmax, key, donor="_isd", receiver="_isr", exclude="_fold")
    at = range(len(k_values))
    if found is None:
        est = df.sparkSession.createDataFrame([], ", ".join([f"`{key}` long", "column string", *[f"_e{i} double" for i in at]]))
    else:  # the means of all k per distinct query, then per receiver
        keys, out = found
        near = [F.when(F.col("rank") <= kv, F.col("value")) for kv in k_values]
        per = out.groupBy("q1", "q2", "c").agg(*[f(v).alias(f"_{a}{i}") for i, v in enumerate(near) for a, f in (("s", F.sum), ("n", F.count))])
        name = F.create_map(*[v for j, c in enumerate(cols) for v in (F.lit(j), F.lit(c))])
        est = (keys.join(per, ["q1", "q2"]).groupBy(F.col("_id").alias(key), name[F.col("c")].alias("column"))
               .agg(*[(F.sum(f"_s{i}") / F.nullif(F.sum(f"_n{i}"), F.lit(0))).alias(f"_e{i}") for i in at]))
    # hidden cells; those without any neighbour get the mean of the other folds' rows
    hidden = comp.select(key, "_fold", F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("truth"),
                                                                   (u(c) < hide).alias("gone")) for c in cols]))).where("gone").drop("gone")
    sums = comp.groupBy("_fold").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(F.col(c).cast("double")).alias(c) for c in cols]).collect()
    total = {c: sum(r[c] or 0.0 for r in sums) for c in cols}
    rows = sum(r["_n"] for r in sums)
    means = [(r["_fold"], c, (total[c] - (r[c] or 0.0)) / (rows - r["_n"]) if rows > r["_n"] else None) for r in sums for c in cols]
    other = df.sparkSession.createDataFrame(means, "_fold int, column string, _mean double")
    off = [F.struct(F.lit(kv).alias("k"), (F.coalesce(f"_e{i}", "_mean") - F.col("truth")).alias("e")) for i, kv in enumerate(k_values)]
    err = (hidden.join(est, [key, "column"], "left").join(F.broadcast(other), ["_fold", "column"])
           .select(F.col("_fold").alias("fold"), F.inline(F.array(*off))))
    allf = err.groupBy("k", "fold").agg(F.avg(F.col("e") ** 2).alias("mse"), F.avg(F.abs("e")).alias("mae"), F.count(F.lit(1)).alias("n_cells"))
    allf = allf.withColumn("rmse", F.sqrt("mse")).where(F.col("n_cells") > 0)
    res = allf.groupBy("k").agg(F.avg(metric).alias("mean"), F.stddev_pop(metric).alias("std"))
    best = res.orderBy("mean", "k").limit(1).select(F.col("k").alias("_best"))
    return res.join(best, F.col("k") == F.col("_best"), "left").select(
        "k", "mean", "std", F.col("_best").isNotNull().alias("best"))
