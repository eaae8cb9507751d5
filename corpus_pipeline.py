"""A corpus pipeline over ``documents``: toxicity, language, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage's result as
Parquet in the shared scratch folder and reads it back as the next stage's input. All but the last
return the columns of ``documents``.

1. toxicity: drops documents that the classifier, learned from the labels of the documents at hand, calls
   toxic; documents labelled toxic go, too, so that of those the classifier's misses do not show.
2. language: drops documents without a letter and those whose language is not clear (score below
   ``MIN_LANGUAGE_SCORE``).
3. near_duplicates: of each group linked by similarity 0.8 or more of 5-word shingles, the row with the
   smallest id stays (of several with that id, one; one without an id only where the whole group has
   none). Documents without words all stay.
4. mixing: chooses documents to the target weights of domain, language and source, in epochs; a document chosen
   for two epochs is there twice.
5. packing: the pieces of all chosen documents in sequences of at most 1024 tokens. ``copy`` numbers the
   copies of a document.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stratum.llm import jaccard, langid, mixing, packing, toxicity
from stratum.llm.common import stored, table
from stratum.llm.queries import MIX_WEIGHTS, mix_levels, tokenizer, word_count

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Share that the softmax must give the winning language.
MIN_LANGUAGE_SCORE = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    scored = toxicity.score(docs.select(*COLUMNS), toxicity.fit(docs, labels))
    marked = labels.where("toxic = 1").select("doc_id").distinct()
    return scored.where("predicted = 0").join(marked, "doc_id", "left_anti").select(*COLUMNS)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named = langid.predict(docs.select(*COLUMNS), langid.fit(docs))
    return named.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # rows, not ids, are joined and decided on, as ids may repeat or be null; equal rows are one
    rows = docs.select(*COLUMNS).withColumn("_row", F.xxhash64(*COLUMNS))
    groups = jaccard.join(rows, k=5, num=4, den=5, id_col="_row").where("n_shingles > 0").select(F.col("doc_id").alias("_row"), "component_id").distinct()
    named = stored(rows.select("doc_id", "_row").join(groups, "_row"), "pipeline-groups")
    # without an id only where nothing of the group has one
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("s")).select("component_id", F.col("s._row").alias("stays"))
    gone = named.join(first, "component_id").where("_row <> stays").select("_row").distinct()
    kept = rows.join(gone, "_row", "left_anti")
    many = stored(named.groupBy("_row").count().where("count > 1").select("_row"), "pipeline-repeated")
    if many.isEmpty():
        return kept.select(*COLUMNS)
    again = kept.join(many, "_row", "left_semi").dropDuplicates(["_row"])
    return kept.join(many, "_row", "left_anti").unionByName(again).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs.select(*COLUMNS), mix_levels(), word_count(), MIX_WEIGHTS).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pieces(docs, tokenizer("byte_bpe_50k.json"), end_id=2, capacity=1024)
    packed = packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), capacity=1024)
    copies = Window.partitionBy("doc_id", "piece").orderBy("sequence_id", "offset")
    return packed.withColumn("copy", F.row_number().over(copies) - 1)


STAGES = [("toxicity", drop_toxic), ("language_id", keep_languages), ("near_duplicates", drop_near_duplicates),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: SQL cannot express the classifiers, tokenizer and packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
