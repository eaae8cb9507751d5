"""Delimited-file ingestion with the source project's rules.

* separator sniffing on the first 100 lines: the candidate giving the most header columns wins
  (strict '>', first tie wins), it must give more than one column and the mean length of the
  first field of the lines that are not over-long must stay under 100;
* header cleaning (strip, quotes/whitespace collapsed to one space) and duplicate headers
  ``name.k`` dropped when ``name`` exists (first copy kept);
* NA tokens -> NULL, over-long lines dropped, short lines padded with NULL;
* a file that parses into a single column is split on tab, comma, semicolon or space.

Parsing is ``from_csv`` over ``spark.read.text`` lines. Over-long lines are those with more
fields than the header when quoted sections are taken as text. The first non-blank line
of every part file is skipped if it is the header; equal lines further down are data.

With ``quoted_line_ends`` a quoted field may hold line ends (they become ``\n``). Files are still read in splits: a
line starts inside quotes if an odd number of lines before it in the file have an odd number of quote marks.
"""
from __future__ import annotations

import csv
import io
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.scalar import qcol
from ..session import cut_lineage, ship

# Fixed values of the source format.
SEPARATORS = [",", ";", "\t", "|"]
NA_TOKENS = ["", "NULL", "null", "NA", "N/A", "NaN", "nan", "#N/A"]
QUOTED = '"[^"]*"'
SPLIT_SEPARATORS = ["\t", ",", ";", " "]
#: Most files whose header places (about 100 bytes each) are broadcast.
BROADCAST_FILES = 100_000
#: Most file splits whose counts (about 100 bytes each) are broadcast.
BROADCAST_SPLITS = 100_000
#: Characters of joined records in an Arrow batch, about.
JOINED_CHARS = 1 << 23


def sample_lines(spark: SparkSession, path: str, n: int = 100) -> list[str]:
    return [r[0] for r in spark.read.text(path).limit(n).collect()]


def _fields(line: str, sep: str) -> list[str]:
    return next(csv.reader(io.StringIO(line), delimiter=sep), [])


def _joined(lines: list[str]) -> list[str]:
    """Sampled lines as records: lines are joined while a quoted field is open (an unfinished last record is left out)."""
    out, held = [], []
    for l in lines:
        held.append(l)
        if sum(h.count('"') for h in held) % 2 == 0:
            out.append("\n".join(held))
            held = []
    return out or lines


def sniff_separator(lines: list[str], seps=SEPARATORS) -> str | None:
    best, best_n = None, 1
    lines = [l for l in lines if l.strip()]
    for sep in seps:
        rows = [_fields(l, sep) for l in lines]
        if not rows:
            continue
        n = len(rows[0])
        data = [r for r in rows[1:] if len(r) <= n]
        first_len = sum(len(r[0]) if r else 0 for r in data) / max(len(data), 1)
        if n > best_n and first_len < 100:
            best, best_n = sep, n
    return best


def clean_column_names(names: list[str]) -> list[str]:
    out = []
    for n in names:
        s = n.strip()
        s = re.sub(r"[\"'\s]+", " ", s).strip()
        out.append(s)
    return out


def drop_duplicate_columns(names: list[str]) -> list[int]:
    """Indexes of the columns to keep: ``name.k`` is dropped when ``name`` exists."""
    seen = set(names)
    keep = []
    for i, n in enumerate(names):
        m = re.fullmatch(r"(.*)\.(\d+)", n)
        if m and m.group(1) in seen:
            continue
        keep.append(i)
    return keep


def _dedupe(names: list[str]) -> list[str]:
    """pandas-style renaming of repeated header names: a, a.1, a.2 ..."""
    count: dict[str, int] = {}
    out = []
    for n in names:
        if n in count:
            count[n] += 1
            out.append(f"{n}.{count[n]}")
        else:
            count[n] = 0
            out.append(n)
    return out


def read_delimited(spark: SparkSession, path: str, sep: str | None = None, header: bool = True,
                   na_tokens=NA_TOKENS, quoted_line_ends: bool = False, max_lines: int = 10_000) -> DataFrame:
    """All-string DataFrame with cleaned, de-duplicated names (coerce types afterwards).

    ``quoted_line_ends``: see ``_records``; the files are read three times, their lines are not shuffled."""
    lines = sample_lines(spark, path)
    if quoted_line_ends:
        lines = _joined(lines)
    sep = sep or sniff_separator(lines) or ","
    first = next((l for l in lines if l.strip()), "")
    raw_names = _fields(first, sep) if header else [f"X{i + 1}" for i in range(len(_fields(first, sep)))]
    names = _dedupe(clean_column_names(raw_names))
    keep = drop_duplicate_columns(names)
    n = len(names)
    source = spark.read.text(path)
    if quoted_line_ends:
        text = _records(source, max_lines, first if header else None).where(F.trim(F.col("value")) != "")
    else:
        text = _placed(source).where(F.trim(F.col("value")) != "")
        if header:
            text = _without_headers(text, first, len(source.inputFiles()) <= BROADCAST_FILES)
    # doubled marks go first: one pattern for both recurses in long fields
    unquoted = F.regexp_replace(F.replace("value", F.lit('""'), F.lit("")), QUOTED, "q")
    n_fields = F.size(F.split(unquoted, re.escape(sep)))
    schema = ", ".join(f"c{i} string" for i in range(n))
    parsed = (text.where(n_fields <= n)
                  .select(F.from_csv(F.col("value"), schema, {"sep": sep, "escape": "\""}).alias("r")))
    cols = []
    for i in keep:
        v = F.col(f"r.c{i}")
        cols.append(F.when(v.isNull() | F.trim(v).isin(na_tokens), F.lit(None).cast("string"))
                     .otherwise(v).alias(names[i]))
    return parsed.select(*cols)


def _placed(text: DataFrame) -> DataFrame:
    """Lines with their file (``_f``), the start of their split (``_b``) and a number that rises within it (``_m``)."""
    return text.select("value", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"),
                       F.monotonically_increasing_id().alias("_m"))


def _records(text: DataFrame, max_lines: int, header: str | None) -> DataFrame:
    """Records of all files: lines joined where a quoted field goes on, without each file's first non-blank record if that is ``header``.

    Every quote mark counts, as in RFC 4180. The number of odd lines (an odd number of marks) before a line is
    the number in earlier splits, from one row per split, and the number earlier in its own split; an odd line after 2k odd
    lines opens a record, and all lines after 2k + 1 odd lines belong to it. Lines of a file whose marks do not pair up
    stay single, as do those of a "record" of more than ``max_lines`` lines (two stray marks), so that no group is unbounded.

    The files are read once for the splits' counts and then in place: a task joins the lines of its splits as they come. Only
    pieces of records that go beyond a split (or beyond ``max_lines``) are shuffled.
    """
    spark = text.sparkSession
    ship(spark)
    odd = F.length(F.regexp_replace("value", '[^"]', "")) % 2
    lines = text.select("value", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"))
    splits = lines.groupBy("_f", "_b").agg(F.sum(odd).alias("_n"), F.max(F.trim("value") != "").alias("_any"))
    file = Window.partitionBy("_f")
    earlier = file.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    head = F.col("_any") & ~F.coalesce(F.max("_any").over(earlier), F.lit(False))
    splits = cut_lineage(splits.select("_f", "_b", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
                                       (F.sum("_n").over(file) % 2 == 1).alias("_stray"), head.alias("_head")))
    if splits.count() <= BROADCAST_SPLITS:
        placed = lines.join(F.broadcast(splits), ["_f", "_b"])
    else:  # lines are put back in the order of their split
        at = F.monotonically_increasing_id().alias("_at")
        placed = lines.select("*", at).join(splits, ["_f", "_b"]).repartition("_f", "_b").sortWithinPartitions("_f", "_b", "_at")
    whole = pa.schema([("value", pa.string()), ("_first", pa.bool_()), ("_f", pa.string()), ("_b", pa.int64()),
                       ("_i", pa.int64()), ("_record", pa.int64()), ("_lines", pa.list_(pa.string()))])

    def run(batches):
        joiner = _Joiner(max_lines)
        for b in batches:
            joiner.take(b)
            if joiner.chars > JOINED_CHARS:
                yield joiner.batch(whole)
        joiner.close()
        yield joiner.batch(whole)

    rows = (placed.select("value", "_f", "_b", "_n0", "_stray", "_head")
            .mapInArrow(run, "value string, _first boolean, _f string, _b long, _i long, _record long, _lines array<string>"))
    torn = cut_lineage(rows.where("_record is not null").drop("value"))  # read several times below
    group = ["_f", "_record"]
    long = torn.groupBy(*group).agg(F.sum(F.size("_lines")).alias("_c")).where(F.col("_c") > max_lines).select(*group)
    held = F.sort_array(F.collect_list(F.struct("_b", "_i", "_lines")))
    joined = (torn.join(long, group, "left_anti").groupBy(*group).agg(held.alias("_l"), F.max("_first").alias("_first"))
              .select(F.array_join(F.flatten(F.col("_l._lines")), "\n").alias("value"), "_first"))
    single = (torn.join(long, group, "left_semi").select("_first", F.posexplode("_lines").alias("_p", "value"))
              .select("value", (F.col("_first") & (F.col("_p") == 0)).alias("_first")))
    out = rows.where("_record is null").select("value", "_first").unionByName(joined).unionByName(single)
    return out.where(~(F.col("_first") & (F.col("value") == F.lit(header)))).select("value") if header is not None else out.select("value")


class _Joiner:
    """Joins the lines of a task's splits, which come in order, to records; holds the lines of one open record."""

    def __init__(self, max_lines: int):
        self.max_lines, self.split, self.chars, self.rows = max_lines, None, 0, []
        self.held: list[str] = []

    def take(self, b: pa.RecordBatch) -> None:
        if not b.num_rows:
            return
        values, starts = b.column("value").to_pylist(), b.column("_b").to_numpy()
        files = b.column("_f").dictionary_encode()
        codes = files.indices.to_numpy(zero_copy_only=False)
        odd = pc.count_substring(b.column("value"), '"').to_numpy(zero_copy_only=False) % 2
        edges = np.flatnonzero((np.diff(codes) != 0) | (np.diff(starts) != 0)) + 1
        for lo, hi in zip([0, *edges], [*edges, len(values)]):
            split = (files.dictionary[int(codes[lo])].as_py(), int(starts[lo]))
            if split != self.split:
                self.close()
                self.split, self.index, self.before = split, 0, b.column("_n0")[lo].as_py()
                self.stray, self.head = b.column("_stray")[lo].as_py(), b.column("_head")[lo].as_py()
            self._lines(values[lo:hi], odd[lo:hi])

    def _lines(self, values: list[str], odd: np.ndarray) -> None:
        after = self.before + np.cumsum(odd)
        inside = ((after - odd) % 2 == 1) | (odd == 1)
        if self.stray:
            inside[:] = False
        opens = (odd == 1) & ((after - odd) % 2 == 0)
        for i, (value, inner) in enumerate(zip(values, inside.tolist())):
            if not inner:
                self._emit(value, self._is_first(value))
                continue
            if not self.held:
                self.at, self.record, self.opened = self.index + i, int(after[i] - odd[i]) // 2, bool(opens[i])
                self.first = self.opened and self._is_first(value)
            self.held.append(value)
            if after[i] % 2 == 0:
                self._close_record()
            elif len(self.held) >= self.max_lines:
                self._tear()
        self.index += len(values)
        self.before = int(after[-1])

    def _is_first(self, value: str) -> bool:
        if not self.head or not value.strip(" "):
            return False
        self.head = False
        return True

    def _close_record(self) -> None:
        if self.opened:
            self._emit("\n".join(self.held), self.first)
            self.held = []
        else:
            self._tear()

    def _tear(self) -> None:
        """The held lines are a piece of a record that has more of them."""
        if self.held:
            self.chars += sum(map(len, self.held))
            self.rows.append((None, self.first, *self.split, self.at, self.record, self.held))
            self.at, self.opened, self.first, self.held = self.at + len(self.held), False, False, []

    def _emit(self, value: str, first: bool) -> None:
        self.chars += len(value) + 40
        self.rows.append((value, first, None, None, None, None, None))

    def close(self) -> None:
        self._tear()

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(schema)
        self.rows, self.chars = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _without_headers(lines: DataFrame, header: str, few: bool) -> DataFrame:
    """Drop the first non-blank record of every file where it is ``header`` (one row per file, broadcast where they are few).

    Places are plain numbers, so that they are found by hash aggregation: a task holds a row per split, and sorts no lines."""
    heads = lines.groupBy("_f", "_b").agg(F.min("_m").alias("_m")).groupBy("_f").agg(F.min_by("_m", "_b").alias("_h")).select("_h")
    return (lines.join(F.broadcast(heads) if few else heads, (F.col("_m") == F.col("_h")) & (F.col("value") == F.lit(header)), "left_anti")
            .select("value"))


def split_single_column(df: DataFrame, seps=SPLIT_SEPARATORS, prefix: str = "X") -> DataFrame:
    """If the frame has one column, split it on the first separator found in its values."""
    if len(df.columns) != 1:
        return df
    c = qcol(df.columns[0])
    sample = [r[0] for r in df.limit(100).collect() if r[0]]
    sep = next((s for s in seps if any(s in v for v in sample)), None)
    if sep is None:
        return df.select(c.alias(f"{prefix}1"))
    parts = F.split(c, re.escape(sep))
    n = df.agg(F.max(F.size(parts))).first()[0] or 1
    return df.select(*[parts.getItem(i).alias(f"{prefix}{i + 1}") for i in range(n)])


def peek_structure(spark: SparkSession, path: str, target: str | None = None, n: int = 5) -> dict:
    lines = sample_lines(spark, path, n + 1)
    sep = sniff_separator(lines) or ","
    names = clean_column_names(_fields(lines[0], sep)) if lines else []
    return {"separator": sep, "columns": names, "n_columns": len(names),
            "has_target": (target in names) if target else None}


def clean_column_names_df(df: DataFrame) -> DataFrame:
    """DataFrame form: rename every column to its cleaned name."""
    return df.toDF(*clean_column_names(df.columns))


def drop_duplicate_columns_df(df: DataFrame) -> DataFrame:
    """DataFrame form: keep the first copy of ``name`` when ``name.k`` also exists."""
    keep = drop_duplicate_columns(df.columns)
    return df.select(*[qcol(df.columns[i]) for i in keep])
