"""Exact histogram of encoded lengths, and what it answers for every context limit.

Documents are counted by encoded length, so everything after the encoding works on one row per
distinct length. Suffix sums over the histogram give, for any limit, how many documents are
longer, how many tokens a truncation keeps or loses, and the quantile that the limit is.

Null texts count as length 0, like empty ones; repeated rows count each time; an empty table
gives an empty histogram. Further columns are not read.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import tokens
from .common import ship, slices, stored

#: Lengths of one block of the running sums: no task orders more distinct lengths than this.
BLOCK = 4096


def length_histogram(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """(length, docs): number of documents with each encoded length."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer)
        for b in slices(batches, "t"):
            yield pa.RecordBatch.from_pydict({"length": pa.array([len(x) // 4 for x in enc.encode(b.column("t").to_pylist())], pa.int64())})

    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("t")).mapInArrow(count, "length long")
    return stored(rows.groupBy("length").agg(F.count(F.lit(1)).alias("docs")), "length-histogram")


def limits(histogram: DataFrame) -> DataFrame:
    """One row per distinct length taken as context limit:

    docs of that length, docs_longer and tokens_longer (suffix sums), tokens_kept and tokens_lost when
    longer documents are truncated to the limit, and quantile, the share of documents not longer.
    Between two rows, tokens_kept grows by docs_longer per token of the limit.
    """
    block = F.floor(F.col("length") / BLOCK)
    rows = histogram.withColumn("_b", block).withColumn("_t", F.col("length") * F.col("docs"))
    after = Window.orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    sums = rows.groupBy("_b").agg(F.sum("docs").alias("_d"), F.sum("_t").alias("_s"))
    total = rows.agg(F.sum("docs").alias("_all"), F.sum("_t").alias("_tokens"))  # one row
    sums = sums.select("_b", F.coalesce(F.sum("_d").over(after), F.lit(0)).alias("_da"), F.coalesce(F.sum("_s").over(after), F.lit(0)).alias("_sa"))
    own = Window.partitionBy("_b").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    longer = (F.coalesce(F.sum("docs").over(own), F.lit(0)) + F.col("_da")).alias("docs_longer")
    heavier = (F.coalesce(F.sum("_t").over(own), F.lit(0)) + F.col("_sa")).alias("tokens_longer")
    out = rows.join(sums, "_b").select(F.col("length").alias("context_limit"), "docs", longer, heavier).join(F.broadcast(total))
    kept = F.col("_tokens") - F.col("tokens_longer") + F.col("context_limit") * F.col("docs_longer")
    return out.select("context_limit", "docs", "docs_longer", "tokens_longer", kept.alias("tokens_kept"),
                      (F.col("_tokens") - kept).alias("tokens_lost"),
                      (1 - F.col("docs_longer") / F.col("_all")).alias("quantile"))


def truncated_totals(histogram: DataFrame, context_limits: list[int]) -> DataFrame:
    """(context_limit, tokens_kept, docs_longer) for the given limits, in one aggregate over the histogram."""
    pairs = F.array(*[F.struct(F.lit(int(c)).cast("long").alias("context_limit"),
                               F.sum(F.least("length", F.lit(int(c))) * F.col("docs")).alias("tokens_kept"),
                               F.sum(F.when(F.col("length") > c, F.col("docs")).otherwise(0)).alias("docs_longer")) for c in context_limits])
    return histogram.agg(pairs.alias("p")).select(F.inline("p"))


def quantile_lengths(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the least length that at least that share of the documents does not exceed."""
    at = F.array(*[F.struct(F.lit(float(s)).alias("share")) for s in shares])
    return (limits(histogram).select("context_limit", "quantile", F.inline(at)).where(F.col("quantile") >= F.col("share"))
            .groupBy("share").agg(F.min("context_limit").alias("length")))
