"""Mixing, nearest neighbours, oracles of the queries, and the pipeline."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import edge
from edge import ROWS
from oracle_harness import compare, duck
from stratum.llm import ann, mixing, queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, sf_dir, name):
    r = compare(spark, duck(sf_dir), name, queries.QUERIES[name], queries.ORACLES[name], sf_dir)
    assert r["ok"], r


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", 10), ("a", "y", 100), ("b", "z", 1000)], "d string, s string, tokens long")
    got = {r.s: r.budget for r in mixing.leaf_budgets(leaves, ["d", "s"], {"d": {"a": 1, "b": 1}}, 160, 1).collect()}
    assert got == {"x": 10, "y": 70, "z": 80}
    got = {r.s: r.budget for r in mixing.leaf_budgets(leaves, ["d", "s"], {"d": {"a": 1, "b": 1}}, 600, 1).collect()}
    assert got == {"x": 10, "y": 100, "z": 490}
    got = {r.s: r.budget for r in mixing.leaf_budgets(leaves, ["d", "s"], {}, 10 ** 6, 2).collect()}
    assert got == {"x": 20, "y": 200, "z": 2000}


def test_mixing_edges(spark, docs):
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    out = mixing.mix(docs, levels, F.length("text"), {"lang": {"de": 9}}, budget=1000, max_epochs=3)
    rows = out.collect()
    assert set(docs.columns) | {"epoch"} == set(out.columns)
    assert sum(len(r.text or "") for r in rows) <= 1000 and {r.doc_id for r in rows} <= {r[0] for r in ROWS}
    assert max(r.epoch for r in rows) <= 2
    assert mixing.mix(docs.limit(0), levels, F.length("text"), {}).count() == 0
    every = mixing.mix(docs, levels, F.length("text"), {}, budget=10 ** 9, max_epochs=1)
    assert every.where("length(text) > 0").count() == sum(bool(r[1]) for r in ROWS)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(0)).withColumn("cell", F.lit(1))


def brute(rows, k):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    return {q: sorted((-float((v * x).sum()), i) for i, v in ok if i != q)[:k] for q, x in ok if q % 20 == 0}


def test_neighbours_with_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(2)
    same = rng.standard_normal(8).tolist()
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(100)] + [(i, same) for i in range(100, 180)]
    rows += [(200, None), (220, [0.0] * 8), (240, [float("nan")] * 8), (260, [None] + [1.0] * 7), (280, [float("inf")] * 8), (None, same)]
    got = {}
    for r in sorted(ann.search(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=20).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    want = brute(rows, 20)
    assert set(got) == set(want)
    assert np.mean([len({i for _, i in got[q]} & {i for _, i in want[q]}) / 20 for q in want]) >= 0.97
    assert [i for _, i in got[120]] == [i for _, i in want[120]]  # ties go to smaller ids
    assert all(v == sorted(v) and len(v) == 20 for v in got.values())


def test_few_or_no_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])]
    got = ann.search(vectors(spark, rows), F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 0.5), (2, 0.0)]
    assert ann.search(vectors(spark, rows).limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_neighbour_recall(spark, sf_dir):
    got = {}
    for r in queries.op7_nearest_neighbours(spark, sf_dir.replace("0.001", "0.1")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    rows = [(r.vec_id, r.embedding) for r in queries.table(spark, sf_dir.replace("0.001", "0.1"), "embeddings").collect()]
    want = brute(rows, 20)
    assert np.mean([len(got[q] & {i for _, i in want[q]}) / 20 for q in want]) >= 0.95


def test_pipeline_stages(spark, sf_dir):
    docs = corpus_pipeline.table(spark, sf_dir, "documents")
    toxic = {r.doc_id for r in corpus_pipeline.table(spark, sf_dir, "labels").where("toxic = 1").collect()}
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), f"test-{name}")
        seen.append(docs)
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS and docs.count()
    ids = [{r[0] for r in d.select("doc_id").distinct().collect()} for d in seen]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and not ids[1] & toxic
    assert len(ids[0] - toxic - ids[1]) <= 0.02 * len(ids[0])
    sets = {r.doc_id: edge.shingle_set(r.text, 5) for r in seen[2].collect()}
    assert ids[3] == set(edge.components(sets, 4, 5).values())
    assert ids[5] == ids[4]


def test_near_duplicates_keep_one_row_of_each_group(spark, sf_dir):
    a, b, c = ("".join(w + x for w in (" alpha", " beta", " gamma", " delta", " eps", " zeta")) for x in "abc")
    rows = [(6, a), (9, a), (2, b), (6, b), (None, c), (20, c), (None, c), (None, "lone text of some words here"), (None, ""), (None, None), (7, a), (7, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "1L AS n_chars")
    got = sorted((r.doc_id or 0, r.text or "") for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect())
    assert got == sorted([(6, a), (2, b), (20, c), (0, "lone text of some words here"), (0, ""), (0, "")])


def test_pipeline_edges(spark, plain, sf_dir):
    docs = plain
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), f"test-{name}")
    assert docs.count()
    empty = plain.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        empty = corpus_pipeline.stored(stage(spark, empty, sf_dir), f"test-{name}")
    assert empty.count() == 0
