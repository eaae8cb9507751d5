"""Exact quantiles that stay bounded at any scale, by one method at every size.

For all columns together, the values at the needed ranks are found by selection:

1. one pass counts the values of every column and brackets its ranks by ``percentile_approx``;
2. one pass counts the values below, at and between a bracket's ends, which narrows the interval (each round by about
   ``APPROX_ACCURACY / 8``); neighbouring ranks share a bracket;
3. while an interval holds more than ``window`` values: one more pass brackets its ranks inside it, followed by 2;
4. one pass sorts the few values of each remaining interval inside the aggregate.

Up to some 80 million values of a column that is three passes.

No step holds more than ``window`` values per rank, on executors or the driver. Results are linear
interpolations between order statistics.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import qcol

WINDOW = 50_000
APPROX_ACCURACY = 10_000
#: Columns or intervals in one aggregate (keeps it under the code generation limits).
CHUNK = 50


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], window: int = WINDOW) -> dict[str, list[float | None]]:
    """Return {col: [q(p) for p in probs]} over non-null values (None when empty)."""
    n, first = {}, {}
    for part in _chunks(cols):
        row = df.agg(*[x for i, c in enumerate(part) for x in (F.count(qcol(c)).alias(f"n{i}"), _bracket(qcol(c), probs, probs).alias(f"b{i}"))]).first()
        n.update({c: row[f"n{i}"] for i, c in enumerate(part)})
        first.update({c: row[f"b{i}"] for i, c in enumerate(part)})
    place = {c: [(n[c] - 1) * p for p in probs] for c in cols if n[c]}
    ranks = {c: sorted({int(f(x)) for x in xs for f in (math.floor, math.ceil)}) for c, xs in place.items()}
    brackets = {(c, r): first[c][2 * i:2 * i + 2] for c, xs in place.items() for i, x in enumerate(xs) for r in {math.floor(x), math.ceil(x)}}
    at = values_at_ranks(df, ranks, n, window, brackets)
    out: dict[str, list] = {c: [None] * len(probs) for c in cols}
    for c, xs in place.items():
        pairs = [(x, at[c, int(math.floor(x))], at[c, int(math.ceil(x))]) for x in xs]
        out[c] = [a + (x - math.floor(x)) * (b - a) if a != b else a for x, a, b in pairs]
    return out


def _chunks(items: list) -> list[list]:
    return [items[i:i + CHUNK] for i in range(0, len(items), CHUNK)]


def _bracket(x: Column, low: list[float], high: list[float]) -> Column:
    """Pairs of values around the ranks between the given shares, as far as the approximation goes."""
    eps = 2.0 / APPROX_ACCURACY
    return F.percentile_approx(x, [e for a, b in zip(low, high) for e in (max(a - eps, 0.0), min(b + eps, 1.0))], APPROX_ACCURACY)


def _inside(col: str, lo: float | None, hi: float | None) -> Column:
    """The column's values strictly between lo and hi (None: no limit), else NULL."""
    x = qcol(col)
    keep = F.lit(True)
    if lo is not None:
        keep = keep & (x > F.lit(lo))
    if hi is not None:
        keep = keep & (x < F.lit(hi))
    return F.when(keep, x)


def values_at_ranks(df: DataFrame, ranks: dict[str, list[int]], n: dict[str, int], window: int = WINDOW, known: dict | None = None) -> dict[tuple[str, int], float]:
    """Order statistics {(col, rank): value}, 0-based, of columns with ``n`` non-null values. ``known``: a first bracket of each."""
    found: dict[tuple[str, int], float] = {}
    known = dict(known or {})
    # (column, rank) -> (lo, hi, rank inside the interval, values inside)
    todo = {(c, r): (None, None, r, n[c]) for c, rs in ranks.items() for r in rs}
    while wide := [k for k, s in todo.items() if s[3] > window]:
        groups: dict[tuple, list] = {}  # neighbouring ranks of one interval share a bracket
        for c, r in sorted(k for k in wide if k not in known):
            lo, hi, at, m = todo[c, r]
            mates = groups.setdefault((c, lo, hi, m, at if (c, r - 1) not in wide or todo[c, r - 1][:2] != (lo, hi) else at - 1), [])
            mates.append((c, r))
        for part in _chunks(list(groups.items())):
            row = df.agg(*[_bracket(_inside(c, lo, hi), [todo[ks[0]][2] / (m - 1)], [todo[ks[-1]][2] / (m - 1)]).alias(f"b{i}")
                           for i, ((c, lo, hi, m, _), ks) in enumerate(part)]).first()
            known.update({k: row[f"b{i}"] for i, (_, ks) in enumerate(part) for k in ks})
        shared: dict[tuple, list] = {}
        for k in wide:
            shared.setdefault((k[0], *todo[k][:2], *known.pop(k)), []).append(k)
        for part in _chunks(list(shared.items())):
            aggs = []
            for i, ((c, lo, hi, a, b), _) in enumerate(part):
                x = _inside(c, lo, hi)
                aggs += [F.count_if(x < F.lit(a)).alias(f"u{i}"), F.count_if(x == F.lit(a)).alias(f"a{i}"),
                         F.count_if((x > F.lit(a)) & (x < F.lit(b))).alias(f"m{i}"), F.count_if((x == F.lit(b)) & F.lit(a != b)).alias(f"b{i}")]
            row = df.agg(*aggs).first()
            for i, ((_, _, _, a, b), ks) in enumerate(part):
                under, at_a, mid, at_b = (row[f"{x}{i}"] for x in "uamb")
                for k in ks:
                    lo, hi, r, m = todo.pop(k)
                    if r < under:
                        todo[k] = (lo, a, r, under)
                    elif r < under + at_a:
                        found[k] = float(a)
                    elif r < under + at_a + mid:
                        todo[k] = (a, b, r - under - at_a, mid)
                    elif r < under + at_a + mid + at_b:
                        found[k] = float(b)
                    else:
                        rest = under + at_a + mid + at_b
                        todo[k] = (b, hi, r - rest, m - rest)
    spans = sorted({(c, s[0], s[1]) for (c, _), s in todo.items()}, key=str)
    for part in _chunks(spans):
        row = df.agg(*[F.sort_array(F.collect_list(_inside(c, lo, hi))).alias(f"v{i}") for i, (c, lo, hi) in enumerate(part)]).first()
        values = {span: row[f"v{i}"] for i, span in enumerate(part)}
        for k, (lo, hi, r, _) in todo.items():
            if (k[0], lo, hi) in values:
                found[k] = float(values[k[0], lo, hi][r])
    return found
