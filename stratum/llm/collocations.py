"""Phrase collocations by SON partitioning: local mining, union of the locally frequent, exact global counts.

Texts are cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and pieces into words ``[^\\x20\\x09]+`` (A-Z lower-cased); a
phrase is 1 to ``max_words`` words in a row within a piece, counted per language with overlaps.

A shard is a run of texts of one task, of about ``SHARD_WORDS`` words; ``share`` is its part of the language's text
bytes. A phrase that occurs ``min_count`` times in all occurs at least ``min_count * share`` times in some shard. Each
shard is mined completely at half that support (``mine``) and tells its task how far each phrase found passes it. A
task adds its shards up and, where there are few enough tasks for that to matter, keeps ``SLACK`` of its own
proportional support back in the same way: it reports by how much the sum passes it. Of a phrase, what shards and tasks
do not report is less than ``min_count * (1 / 2 + SLACK)`` in all, so that only phrases whose reports sum to more than
the rest stay in the union. The union is kept as one bit per hash in a table of
fixed size (``BITS``; a false hit costs work, never a result), and a second pass counts its phrases in all
shards exactly (``count``). Where the whole support is reached (in one shard at least), the count carries the text.
This is done for single words, then pairs, then the rest; each stage looks only where all shorter phrases are
frequent, so that little is left even where shards are so many that the local support is one.

Nothing but the bit tables (16 MB each, at any size) goes through the driver. Counts are summed within a task
before they are shuffled, so that a very common phrase is one row per task.

Null texts are empty, null languages are ``und``; repeated rows count as often as they occur; an empty table gives no
rows. Other columns are not read.
"""
from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import ascii_lower, free_at_once, raw_text, ship, slices, span_hashes, stored, words

#: Words of a shard, about; a task holds one shard at a time.
SHARD_WORDS = 3 << 20
#: Text bytes of a task, about; a task works on several shards in turn and adds their rows up before they are shuffled.
TASK_BYTES = 64 << 20
#: Rows that a task adds up before it passes them on.
HELD_ROWS = 1 << 20
#: Part of a task's proportional support that it need not report, besides the half that its shards need not.
SLACK = 3 / 8
#: Bits of the table that holds the union of locally frequent phrases.
BITS = 1 << 27
_LOCAL = 1 << 24
_BREAKS = np.zeros(256, dtype=bool)
_BREAKS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True


# ------------------------------------------------------------------ one shard

class Shard:
    """The words of a run of texts of one language: bytes, word spans, word hashes, piece numbers. Takes the parts over."""

    def __init__(self, lang: str, parts: list[tuple]):
        at = np.cumsum([0] + [len(p[0]) for p in parts])
        pieces = np.cumsum([0] + [int(p[4][-1]) + 1 if len(p[4]) else 0 for p in parts])
        self.lang, self.bytes = lang, int(at[-1])
        cols = [list(c) for c in zip(*parts)]
        parts.clear()
        self.data = np.concatenate(cols[0])
        self.starts, self.ends, self.piece = (np.concatenate([p + o.astype(p.dtype) for p, o in zip(c, off)]) for c, off in ((cols[1], at), (cols[2], at), (cols[4], pieces)))
        self.h = np.concatenate(cols[3])

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-word phrase at each position, and the positions that have one."""
        m = max(0, len(self.h) - n + 1)
        g = self.h[:m] ^ np.uint64(zlib.crc32(self.lang.encode()) << 16)
        for i in range(1, n):
            g *= np.uint64(0x9E3779B97F4A7C15)
            g += self.h[i:i + m]
            _mix(g)
        return g, self.piece[:m] == self.piece[n - 1:n - 1 + m]

    def known(self, table: np.ndarray, k: int, n: int) -> np.ndarray:
        """Positions of n words in a row of which all k neighbours are in the table."""
        g, ok = self.grams(k)
        ok &= hit(table, g)
        m = max(0, len(self.h) - n + 1)
        out = np.ones(m, dtype=bool)
        for i in range(n - k + 1):
            out &= ok[i:i + m]
        return out

    def texts(self, first: np.ndarray, n: int) -> pa.Array:
        """The phrases of n words at the given positions, joined by single spaces."""
        at = (first[:, None] + np.arange(n)).ravel()
        start = self.starts[at].astype(np.int64)
        size = self.ends[at] - start + 1
        size[n - 1::n] -= 1  # no space after the last word
        out = np.r_[0, np.cumsum(size)]
        spot = np.repeat(start - out[:-1], size) + np.arange(out[-1])
        chars = self.data[np.minimum(spot, len(self.data) - 1)]
        inner = np.ones(len(at), dtype=bool)
        inner[n - 1::n] = False
        chars[out[1:][inner] - 1] = 32
        return pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(np.ascontiguousarray(out[::n])), pa.py_buffer(chars)).cast(pa.string())


def _mix(g: np.ndarray) -> None:
    """``common.mix`` in place."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        g ^= g >> np.uint64(shift)
        g *= np.uint64(factor)


def _shards(batches: Iterator[pa.RecordBatch], shard_words: int) -> Iterator[Shard]:
    """Shards of the rows (lang, t) of a task; all languages' texts close their shards when there are enough words."""
    free_at_once()
    held: dict[str, list] = {}
    size = 0
    for b in slices(batches, "t"):
        langs = b.column("lang").dictionary_encode()
        codes = langs.indices.to_numpy(zero_copy_only=False)
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            data, offsets = raw_text(b.column("t").filter(pa.array(codes == code)))
            low = ascii_lower(data)
            broken = _BREAKS[low]
            starts, ends, rows = words(low, offsets, ~(broken | (low == 32) | (low == 9)))
            piece = (np.cumsum(broken)[starts] + rows) if len(starts) else starts
            held.setdefault(lang, []).append((low, starts.astype(np.int32), ends.astype(np.int32), span_hashes(low, starts, ends), piece.astype(np.int32)))
            size += len(starts)
        if size >= shard_words:
            yield from (Shard(k, held.pop(k)) for k in list(held))
            size = 0
    yield from (Shard(k, held.pop(k)) for k in list(held))


def _counts(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and how often each occurs. Sorts ``h`` in place."""
    h.sort()
    edge = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    return h[edge], np.diff(np.r_[edge, len(h)])


class Sums:
    """Sums of values by hash, and a (words, phrase) for some of the hashes, over the shards of a task."""

    def __init__(self):
        self.rows, self.named, self.size = [], [], 0

    def add(self, h: np.ndarray, values: np.ndarray, named: np.ndarray | None = None, words: int = 0, phrases: pa.Array | None = None) -> None:
        self.rows.append((h, values))
        self.size += len(h)
        if named is not None and len(named):
            self.named.append((named, np.full(len(named), words, np.int32), phrases))
        if self.size > 2 * HELD_ROWS:
            self.merge()

    def merge(self) -> None:
        h, values = (np.concatenate(c) for c in zip(*self.rows))
        self.rows = []
        order = np.argsort(h)
        h, values = h[order], values[order]
        edge = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
        self.rows, self.size = [(h[edge], np.add.reduceat(values, edge) if len(h) else values)], len(edge)
        if self.named:
            named, first = np.unique(np.concatenate([x[0] for x in self.named]), return_index=True)
            self.named = [(named, np.concatenate([x[1] for x in self.named])[first], pa.concat_arrays([x[2] for x in self.named]).take(pa.array(first)))]

    def take(self) -> tuple:
        """(h, sum, words, phrase) of all rows; words and phrase are null for hashes without a name."""
        if not self.rows:
            self.rows = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        self.merge()
        h, total = self.rows[0]
        at = pa.nulls(len(h), pa.int64())
        words, phrases = pa.array([], pa.int32()), pa.array([], pa.string())
        if self.named:
            named, n, phrases = self.named[0]
            spot = np.searchsorted(named, h)
            spot[spot == len(named)] = 0
            at, words = pa.array(spot, mask=named[spot] != h), pa.array(n)
        self.__init__()
        return h, total, words.take(at), phrases.take(at)


def hit(table: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Whether each hash's bit is set."""
    slot = (g >> np.uint64(8)) & np.uint64(64 * len(table) - 1)
    return (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


# ------------------------------------------------------------------ the two passes

def _mine(texts: DataFrame, lengths: list[int], min_count: int, totals: dict[str, int], known, shard_words: int, size: int, slack: float) -> np.ndarray:
    """Bit table of the phrases that can be frequent, from what is reported beyond half the proportional support and the slack."""
    reports = _reports(texts, lengths, min_count, totals, known, shard_words, slack).groupBy("h").agg(F.sum("over").alias("over"))
    return _table(reports.where(F.col("over") > min_count * (0.5 - slack)), size)


def _reports(texts: DataFrame, lengths: list[int], min_count: int, totals: dict[str, int], known, shard_words: int, slack: float) -> DataFrame:
    """(h, over): by how much a phrase passes what the shards of a task, and the task, need not report."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.uint64(_LOCAL - 1)
        held: dict[str, Sums] = {}
        read: dict[str, int] = {}  # text bytes behind the sums
        for s in _shards(batches, shard_words):
            sums = held.setdefault(s.lang, Sums())
            read[s.lang] = read.get(s.lang, 0) + s.bytes
            half = max(1, math.ceil(min_count * s.bytes / max(totals[s.lang], 1) / 2 - 1e-9))
            ok = None
            for n in lengths:
                g, whole = s.grams(n)
                if known is not None and n == lengths[0]:
                    whole &= s.known(known.value, n - 1, n)
                if ok is not None:  # both parts of n - 1 words reach the support
                    whole &= ok[:len(g)] & ok[1:len(g) + 1]
                h, c = _counts(g[whole])
                h, c = h[c >= half], c[c >= half]
                flags = np.zeros(_LOCAL, dtype=bool)
                flags[(h & mask).astype(np.int64)] = True
                ok = whole & flags[(g & mask).astype(np.int64)]
                sums.add(h, c - half + 1)
            if sum(x.size for x in held.values()) > HELD_ROWS:
                for lang in list(held):
                    yield told(lang, held.pop(lang), read.pop(lang))
        for lang in list(held):
            yield told(lang, held.pop(lang), read.pop(lang))

    def told(lang: str, sums: Sums, size: int) -> pa.RecordBatch:
        h, over, _, _ = sums.take()
        over = over - max(0, math.ceil(min_count * size / max(totals[lang], 1) * slack - 1e-9) - 1)
        return pa.RecordBatch.from_arrays([pa.array(h[over > 0].view(np.int64)), pa.array(over[over > 0])], names=["h", "over"])

    return texts.mapInArrow(run, "h long, over long")


def _table(hashes: DataFrame, size: int) -> np.ndarray:
    """Bit table of hashes (h); at most ``size`` / 64 rows come to the driver."""
    slot = F.shiftrightunsigned(F.col("h"), 8).bitwiseAND(F.lit(size - 1))
    bit = hashes.select(F.shiftright(slot, 6).cast("int").alias("word"), slot.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    rows = bit.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    table = np.zeros(size // 64, dtype=np.uint64)
    table[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return table


def _count(texts: DataFrame, lengths: list[int], min_count: int, totals: dict[str, int], union, known, shard_words: int) -> DataFrame:
    """(lang, words, phrase, h, a) of all phrases of the union that occur ``min_count`` times or more.

    Of lengths from 1 up, one row of zero words tells each language's number of words. A phrase's language, number of words and
    text come from the shards that hold its proportional share; one at least does.
    """
    names = ["h", "a", "lang", "words", "phrase"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Sums] = {}
        for s in _shards(batches, shard_words):
            share = min_count * s.bytes / max(totals[s.lang], 1) - 1e-9
            sums = held.setdefault(s.lang, Sums())
            if lengths[0] == 1 and len(s.h):
                key = np.array([zlib.crc32(s.lang.encode())], np.uint64)  # phrases' hashes are mixed
                sums.add(key, np.array([len(s.h)]), key, 0, pa.array([""]))
            for n in lengths:
                g, at = s.grams(n)
                if known is not None:
                    at &= s.known(known.value, lengths[0] - 1, n)
                at = np.flatnonzero(at)
                at = at[hit(union.value, g[at])]
                h, c = _counts(g[at])
                first = np.zeros(len(h), dtype=np.int64)
                for lo in range(0, len(at), 1 << 18):
                    some = at[lo:lo + (1 << 18)]
                    first[np.searchsorted(h, g[some])] = some
                named = c >= share
                sums.add(h, c, h[named], n, s.texts(first[named], n))
            if sum(x.size for x in held.values()) > HELD_ROWS:
                for lang in list(held):
                    yield from told(lang, held.pop(lang))
        for lang in list(held):
            yield from told(lang, held.pop(lang))

    def told(lang: str, sums: Sums) -> Iterator[pa.RecordBatch]:
        h, a, words, phrases = sums.take()
        langs = pa.array([lang]).take(pa.array(np.zeros(len(h), np.int64)))
        batch = pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(a), langs, words, phrases], names=names)
        for lo in range(0, len(h), 1 << 16):
            yield batch.slice(lo, 1 << 16)

    rows = texts.mapInArrow(run, "h long, a long, lang string, words int, phrase string")
    told = F.when(F.col("words").isNotNull(), F.struct("lang", "words", "phrase"))
    found = rows.groupBy("h").agg(F.sum("a").alias("a"), F.first(told, ignorenulls=True).alias("p"))
    return found.where((F.col("a") >= min_count) | (F.col("p.words") == 0)).select("p.lang", "p.words", "p.phrase", "h", "a")


#: Lengths that are mined and counted together; each stage starts from the frequent phrases of one word less.
STAGES = ((1,), (2,), (3, 4, 5, 6, 7, 8))


def frequent_phrases(docs: DataFrame, min_count: int = 100, max_words: int = 5, lang_col: str = "lang", text_col: str = "text",
                     shard_words: int = SHARD_WORDS, bits: int = BITS) -> DataFrame:
    """(lang, words, phrase, a) of all phrases of 1 to ``max_words`` (at most 8) words with a >= ``min_count`` occurrences.

    The empty phrase (words = 0) holds each language's number of words.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"))
    totals = {r.lang: int(r.b) for r in texts.groupBy("lang").agg(F.sum(F.octet_length("t").cast("long")).alias("b")).collect()}
    tasks = max(math.ceil(sum(totals.values()) / TASK_BYTES), spark.sparkContext.defaultParallelism)
    texts = texts.coalesce(tasks)
    slack = SLACK if min_count * SLACK > tasks else 0.0  # else a task's part would be less than one
    out, known = None, None
    for stage in STAGES:
        lengths = [n for n in stage if n <= max_words]
        if not lengths:
            break
        if out is not None:
            known = spark.sparkContext.broadcast(_table(out.where(F.col("words") == lengths[0] - 1).select("h"), bits))
        union = spark.sparkContext.broadcast(_mine(texts, lengths, min_count, totals, known, shard_words, bits, slack))
        new = stored(_count(texts, lengths, min_count, totals, union, known, shard_words), "phrases")
        out = new if out is None else out.unionByName(new)
    return out.select("lang", "words", "phrase", "a")


def collocations(phrases: DataFrame, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of two words or more.

    ``phrases``: the result of ``frequent_phrases``. A phrase cut after its first k words has score
    floor(1000 a n / (l r)), l and r being the counts of its parts; the lowest score counts, of equal ones that of the
    smallest k. Phrases that occur in a longer one as often as at all are left out. All parts of a frequent
    phrase are frequent, so their counts are in the same table. Decimal arithmetic, exact to 37 digits.
    """
    n = phrases.where("words = 0").select("lang", F.col("a").alias("n"))
    some = phrases.where("words > 1")
    # a longer phrase that occurs as often makes all phrases between occur as often: one more word is enough
    longer = some.where("words > 2").select("lang", "a", F.explode(F.array(F.expr("substring_index(phrase, ' ', words - 1)"), F.expr("substring_index(phrase, ' ', 1 - words)"))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = some.join(longer, ["lang", "phrase"], "left").where("most is null or most < a").drop("most")
    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.expr("substring_index(phrase, ' ', k)"), "right": F.expr("substring_index(phrase, ' ', k - words)")})
    for side, name in (("left", "l"), ("right", "r")):
        part = phrases.where("words > 0").select("lang", F.col("phrase").alias(side), F.col("a").alias(name))
        cuts = cuts.join(part, ["lang", side])
    score = F.expr("(cast(a as decimal(16,0)) * 1000 * cast(n as decimal(16,0))) div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))")
    scored = cuts.join(n, "lang").withColumn("score", score)
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("b")).select("lang", "phrase", "b.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
