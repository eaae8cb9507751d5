"""Personal data by patterns and a skip-chain conditional random field.

Base spans are those of four patterns (``base_spans``); they always stay. A CRF over the tokens that hold a digit
or ``@`` adds mentions that a pattern misses but whose like the document has elsewhere: neighbouring tokens of a line
share a chain potential, and tokens that repeat or resemble each other (same core, same local part of an
address, same last seven digits) share a skip potential, from each one to the next of its kind, however far apart. Loopy
sum-product messages over both kinds of edges make the labels of a document consistent; tokens of base spans are
held at their label. A run of tokens is added where the belief in one kind reaches ``BELIEF`` and skip edges connect one
of the run with a base span of that kind: what resembles nothing that the patterns found is never added.

Training (``fit``) is distantly supervised by the base spans of all documents. Features are few and discrete, so that
tasks count equal training cases and the driver gets one weighted row per distinct case. Besides the tokens as they
are, each labelled token gives damaged cases, without the features that make the pattern match: next to a
labelled neighbour or a labelled repeat it keeps its label, alone it is no personal data. The weights maximise
the pseudo-likelihood.

Null texts are empty and have no spans; repeated rows and repeated or null ids are rows of their own; an empty table
gives no rows (and a model that adds nothing); columns named like the results are replaced. Scans are linear in a
text's length, also for very long words and digit runs.
"""
from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import add_columns, ship, slices

KINDS = ["email", "ip", "card", "phone"]
LABELS = len(KINDS) + 1
#: Least belief in a kind for a token to be added.
BELIEF = 0.9
ROUNDS = 25

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A match that starts inside a run of digits would also start at the run's first digit, hence the look-behind.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[0-9@][^\x20\x09-\x0D]*+")
_SPACES = " \t\n\x0b\x0c\r"
_EDGE = "()[]{}<>\"'.,;:!?"


# ------------------------------------------------------------------ patterns

def _emails(text: str) -> Iterator[tuple[int, int]]:
    low, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at + 1)
        if m:
            start = at
            while start > low and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, m.end()
                low = m.end()
        at = text.find("@", max(at + 1, low))


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(2 * d - 9 * (d > 4) for d in map(int, even))) % 10 == 0


def _octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))


def _is_card(s: str) -> bool:
    d = s.replace(" ", "").replace("-", "")
    return 12 <= len(d) <= 19 and luhn(d)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the patterns' matches, leftmost and non-overlapping per kind, by start, then kind."""
    if not text:
        return []
    found = [(0, s, e) for s, e in _emails(text)]
    found += [(1, m.start(), m.end()) for m in _IP.finditer(text) if _octets(m[0])]
    found += [(2, m.start(), m.end()) for m in _CARD.finditer(text) if m.end() - m.start() > 11 and _is_card(m[0])]
    found += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_DIGITS.findall(m[0])) <= 15]
    return sorted(found, key=lambda x: (x[1], x[0]))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


# ------------------------------------------------------------------ tokens, features, edges

#: Bits of the unary features; FORM are those that make a pattern match.
_DOMAIN_OK, _AT, _QUAD, _LUHN, _PLUS, _PAREN, _LETTER, _HYPHEN, _DOT1, _DOT2, _DOT3 = (1 << i for i in range(11))
FORM = _DOMAIN_OK | _QUAD | _LUHN | _PLUS
_COUNTS = [1, 4, 7, 9, 12, 20]  # bounds of the digit-count features, one of bits 11 to 17
FEATURES = 11 + len(_COUNTS) + 1


def tokens(text: str) -> list[tuple[int, int]]:
    """(start, end) of the tokens with a digit or ``@``, without brackets, quotes and stops at their ends."""
    out, low = [], 0
    for m in _TOKEN.finditer(text):
        s = max(low, max(text.rfind(c, low, m.start()) for c in _SPACES) + 1)
        low = e = m.end()
        word = text[s:e]
        s += len(word) - len(word.lstrip(_EDGE))
        e -= len(word) - len(word.rstrip(_EDGE))
        if s < e:
            out.append((s, e))
    return out


def features(text: str, s: int, e: int) -> tuple[int, str]:
    """Feature bits of a token and its digits."""
    core = text[s:e]
    digits = "".join(_DIGITS.findall(core))
    f = 0
    if "@" in core:
        m = _DOMAIN.match(core, core.index("@") + 1)
        f |= _AT | (_DOMAIN_OK if m else 0)
    if _IP.fullmatch(core) and _octets(core):
        f |= _QUAD
    if 12 <= len(digits) <= 19 and luhn(digits):
        f |= _LUHN
    if core[0] == "+":
        f |= _PLUS
    if s and text[s - 1] == "(":
        f |= _PAREN
    if any(c.isalpha() for c in core[:64]):
        f |= _LETTER
    if "-" in core:
        f |= _HYPHEN
    dots = core.count(".")
    f |= {0: 0, 1: _DOT1, 2: _DOT2}.get(dots, _DOT3)
    return f | 1 << (11 + int(np.searchsorted(_COUNTS, len(digits), side="right"))), digits


def keys(core: str, digits: str) -> list[str]:
    """What makes tokens alike: the lower-cased core, an address's local part, the last seven digits."""
    low = core.lower()
    out = [low] if len(low) >= 5 else []
    if "@" in low and low.index("@") >= 5:
        out.append(low[:low.index("@")])
    if len(digits) >= 7:
        out.append("#" + digits[-7:])
    return out


class Graph:
    """Tokens of one text: spans, feature bits, base labels (0: none), chain edges (i, i + 1), skip edges (i, j)."""

    def __init__(self, text: str, base: list[tuple[int, int, int]]):
        self.spans = tokens(text)
        self.bits, self.label, self.chain, self.skip = [], [], [], []
        seen: dict[str, int] = {}
        by_start, open_, nxt = base, [], 0
        for i, (s, e) in enumerate(self.spans):
            f, digits = features(text, s, e)
            self.bits.append(f)
            while nxt < len(by_start) and by_start[nxt][1] < e:
                open_.append(by_start[nxt])
                nxt += 1
            open_ = [x for x in open_ if x[2] > s]
            self.label.append(min((k + 1 for k, _, _ in open_), default=0))
            if i:
                gap = text[self.spans[i - 1][1]:s] if s - self.spans[i - 1][1] <= 8 else "x"
                if not any(c.isalnum() or c in "\n\r\x0b\x0c" for c in gap):
                    self.chain.append((i - 1, i))
            linked = set()
            for key in keys(text[s:e], digits):
                j = seen.get(key)
                if j is not None and j not in linked:
                    linked.add(j)
                    self.skip.append((j, i))
                seen[key] = i

    def found_kinds(self) -> list[set[int]]:
        """For each token, the base labels among the tokens that skip edges connect it with."""
        root = list(range(len(self.spans)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for i, j in self.skip:
            root[find(j)] = find(i)
        kinds: dict[int, set[int]] = {}
        for i, y in enumerate(self.label):
            kinds.setdefault(find(i), set()).update({y} - {0})
        return [kinds[find(i)] for i in range(len(root))]


# ------------------------------------------------------------------ training

def _cases(text: str) -> Counter:
    """Training cases (bits, left label, right label, skip labels, label) of a text; -1: no neighbour."""
    base = base_spans(text)
    g = Graph(text, base)
    left, right, skip = [-1] * len(g.spans), [-1] * len(g.spans), [[0] * LABELS for _ in g.spans]
    for i, j in g.chain:
        left[j], right[i] = g.label[i], g.label[j]
    for i, j in g.skip:
        skip[i][g.label[j]] += 1
        skip[j][g.label[i]] += 1
    out: Counter = Counter()
    for i, y in enumerate(g.label):
        out[(g.bits[i], left[i], right[i], *(min(c, 2) for c in skip[i]), y)] += 1
        if y:
            like = [int(k == y) for k in range(LABELS)]
            for bare in {g.bits[i] & ~FORM, g.bits[i] & ~FORM & ~_AT}:
                out[(bare, -1, -1, *like, y)] += 1
                out[(bare, -1, -1, *[0] * LABELS, 0)] += 1
            bare = g.bits[i] & ~FORM
            if y in (left[i], right[i]):
                out[(bare, left[i] if left[i] == y else -1, right[i] if right[i] == y else -1, *[0] * LABELS, y)] += 1
    return out


_CASE = ["bits", "lefts", "rights", *[f"s{k}" for k in range(LABELS)], "label"]


def fit(docs: DataFrame, text_col: str = "text", steps: int = 1000, penalty: float = 1e-4) -> dict[str, np.ndarray]:
    """Weights: ``unary`` (features + 1, labels), ``chain`` (left, right), ``skip`` (symmetric)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in slices(batches, "t"):
            for text in b.column("t").to_pylist():
                if text:
                    total.update(_cases(text))
        cols = [*zip(*[(*k, n) for k, n in sorted(total.items())])] or [()] * (len(_CASE) + 1)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=[*_CASE, "n"])

    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("t")).where(F.col("t").rlike("[0-9@]"))
    rows = texts.mapInArrow(run, ", ".join(f"{c} long" for c in [*_CASE, "n"])).groupBy(*_CASE).agg(F.sum("n").alias("n")).toPandas()
    rows = rows.sort_values(_CASE)
    return train(rows[_CASE].to_numpy(np.int64), rows["n"].to_numpy(np.float64), steps, penalty)


def _unary(bits: np.ndarray) -> np.ndarray:
    return np.concatenate([np.ones((len(bits), 1)), (bits[:, None] >> np.arange(FEATURES)) & 1], axis=1).astype(np.float64)


def train(cases: np.ndarray, weight: np.ndarray, steps: int, penalty: float) -> dict[str, np.ndarray]:
    """Weighted maximum pseudo-likelihood by Adam. Frequent cases weigh as the root of their number, so that plain
    tokens do not drown the labelled ones."""
    w = {"unary": np.zeros((FEATURES + 1, LABELS)), "chain": np.zeros((LABELS, LABELS)), "skip": np.zeros((LABELS, LABELS))}
    if not len(cases):
        return w
    weight = np.sqrt(weight)
    weight /= weight.sum()
    f, y = _unary(cases[:, 0]), np.eye(LABELS)[cases[:, -1]]
    wide = np.vstack([np.eye(LABELS), np.zeros((1, LABELS))])  # the last row: no neighbour
    left, right, skip = wide[cases[:, 1]], wide[cases[:, 2]], cases[:, 3:3 + LABELS].astype(np.float64)
    m, v = ({k: np.zeros_like(a) for k, a in w.items()} for _ in range(2))
    for t in range(1, steps + 1):
        z = f @ w["unary"] + left @ w["chain"] + right @ w["chain"].T + skip @ (w["skip"] + w["skip"].T)
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        g = (p / p.sum(axis=1, keepdims=True) - y) * weight[:, None]
        s = skip.T @ g
        grad = {"unary": f.T @ g, "chain": left.T @ g + (right.T @ g).T, "skip": s + s.T}
        for k, a in w.items():
            d = grad[k] + penalty * a
            m[k] = 0.9 * m[k] + 0.1 * d
            v[k] = 0.999 * v[k] + 0.001 * d * d
            a -= 0.05 * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-9)
    w["skip"] = w["skip"] + w["skip"].T
    return w


# ------------------------------------------------------------------ inference

def _logsum(z: np.ndarray) -> np.ndarray:
    top = z.max(axis=1)
    return top + np.log(np.exp(z - top[:, None]).sum(axis=1))


def beliefs(unary: np.ndarray, chain: np.ndarray, skip: np.ndarray, w: dict[str, np.ndarray]) -> np.ndarray:
    """Label distribution of each node by damped loopy sum-product messages along chain and skip edges."""
    edges = np.concatenate([chain, skip]).reshape(-1, 2)
    pots = np.concatenate([np.broadcast_to(w["chain"], (len(chain), LABELS, LABELS)), np.broadcast_to(w["skip"], (len(skip), LABELS, LABELS))])
    src, dst = np.r_[edges[:, 0], edges[:, 1]], np.r_[edges[:, 1], edges[:, 0]]
    pots = np.concatenate([pots, pots.transpose(0, 2, 1)])
    n = len(edges)
    back = np.r_[np.arange(n, 2 * n), np.arange(n)]
    msg = np.zeros((2 * n, LABELS))
    total = unary
    for _ in range(ROUNDS if n else 0):
        out = total[src] - msg[back]
        new = np.stack([_logsum(out + pots[:, :, b]) for b in range(LABELS)], axis=1)
        new -= _logsum(new)[:, None]
        change = np.abs(new - msg).max()
        msg = 0.5 * msg + 0.5 * new
        total = unary.copy()
        np.add.at(total, dst, msg)
        if change < 1e-3:
            break
    return np.exp(total - _logsum(total)[:, None])


def added_spans(texts: list[str], bases: list[list], w: dict[str, np.ndarray], belief: float = BELIEF) -> list[list[tuple[int, int, int]]]:
    """Spans that the CRF adds to the base spans of each text."""
    out: list[list] = [[] for _ in texts]
    graphs, at = [], 0
    chain, skip = [], []
    for i, (text, base) in enumerate(zip(texts, bases)):
        g = Graph(text, base)
        if not g.skip or not any(g.label):
            continue  # nothing resembles anything found
        graphs.append((i, g, at))
        chain += [(a + at, b + at) for a, b in g.chain]
        skip += [(a + at, b + at) for a, b in g.skip]
        at += len(g.spans)
    if not graphs:
        return out
    label = np.array([y for _, g, _ in graphs for y in g.label])
    unary = _unary(np.array([b for _, g, _ in graphs for b in g.bits], dtype=np.int64)) @ w["unary"]
    unary[label > 0] = -30.0
    unary[label > 0, label[label > 0]] = 0.0
    p = beliefs(unary, np.array(chain, dtype=np.int64).reshape(-1, 2), np.array(skip, dtype=np.int64).reshape(-1, 2), w)
    best = p.argmax(axis=1)
    best[(p.max(axis=1) < belief) | (label > 0)] = 0
    for i, g, first in graphs:
        pairs, kinds = {b for _, b in g.chain}, g.found_kinds()
        run: list[int] = []
        for t in [*range(len(g.spans)), None]:
            if run and (t is None or t not in pairs or best[first + t] != best[first + run[-1]]):
                if any(best[first + run[0]] in kinds[r] for r in run):
                    s, e = g.spans[run[0]][0], g.spans[run[-1]][1]
                    s -= texts[i][s - 1:s] == "(" and ")" in texts[i][s:e]
                    out[i].append((int(best[first + run[0]]) - 1, s, e))
                run = []
            if t is not None and best[first + t]:
                run.append(t)
    return out


def find(docs: DataFrame, weights: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """``docs`` with n_email, n_ip, n_card, n_phone and base_sha256 of the base spans, and ``spans``, those that the CRF
    adds included: kind:start:end by start, then kind, joined by commas; code points, end exclusive."""
    w = docs.sparkSession.sparkContext.broadcast(weights)

    def run(column: pa.Array) -> list:
        texts = [t or "" for t in column.to_pylist()]
        bases = [base_spans(t) for t in texts]
        more = added_spans(texts, bases, w.value)
        counts = [pa.array([sum(k == kind for k, _, _ in b) for b in bases], pa.int64()) for kind in range(len(KINDS))]
        sha = pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in bases], pa.string())
        every = [joined(sorted(b + m, key=lambda x: (x[1], x[0]))) for b, m in zip(bases, more)]
        return [*counts, sha, pa.array(every, pa.string())]

    return add_columns(docs, text_col, {f"n_{k}": "long" for k in KINDS} | {"base_sha256": "string", "spans": "string"}, run)
