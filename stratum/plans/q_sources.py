"""Catalog entries: sources/sinks round trips and projections (§2.1, §2.2), and
publishing (§2.11 tail). Round trips write Spark-derived data to the shared scratch
folder and read it back, so their work grows with the tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import project as pj, clean as cl, evaluate as ev
from ..session import scratch_path
from ..sources import delimited as dl, coerce as co, sinks as sk
from . import tables as tb, ensembles as en, publish as pb
from .catalog import query, R, WITH_STUDY, WITH_PREDS, K, KEYS, CONTINUOUS, BINARY, FEATURES


def _labelled(spark, d):
    return pj.decode_label(tb.study(spark, d), "y", "outcome")


@query("read_delimited", R(WITH_STUDY + """SELECT row_id, X1, X2,
  CASE WHEN y = 1 THEN 'ad.' WHEN y = 0 THEN 'noad.' END AS outcome FROM study""", ["X1", "X2"]))
def q_read_delimited(spark, d):
    """study -> ';'-separated files with 'NA' for NULL -> sniffed, cleaned, coerced."""
    path = scratch_path(spark, "delimited")
    src = _labelled(spark, d).select("row_id", "X1", "X2", "outcome")
    src.write.mode("overwrite").option("header", True).option("sep", ";").option("nullValue", "NA").csv(path)
    raw = dl.read_delimited(spark, path)
    out = co.coerce_numeric(raw, keep=("row_id", "outcome"))
    return out.select(F.col("row_id").cast("bigint").alias("row_id"), "X1", "X2", "outcome")


@query("read_delimited_line_ends", f"""SELECT doc_id, CASE WHEN trim(t) NOT IN ({', '.join("'" + x + "'" for x in dl.NA_TOKENS)}) THEN t END AS text, lang
  FROM (SELECT doc_id, replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS t, lang FROM documents)""")
def q_read_delimited_line_ends(spark, d):
    """documents -> ','-separated files with line ends inside quoted texts -> records."""
    path = scratch_path(spark, "line-ends")
    text = F.regexp_replace("text", "\r\n?", "\n").alias("text")
    (tb.read(spark, d, "documents").select("doc_id", text, "lang").write.option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    out = dl.read_delimited(spark, path, sep=",", quoted_line_ends=True, max_lines=1_000_000)
    return out.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")


@query("split_single_column", R(WITH_STUDY + "SELECT row_id AS X1, X2, y AS X3 FROM study",
                                ["X2"]))
def q_split_single_column(spark, d):
    """Tab-joined single-column text ('NA' for NULL) -> split -> X1..Xn -> numbers."""
    path = scratch_path(spark, "single")
    s = tb.study(spark, d)
    s.select(F.concat_ws("\t", F.col("row_id").cast("string"), F.coalesce(F.col("X2").cast("string"), F.lit("NA")),
                         F.col("y").cast("string"))).write.mode("overwrite").text(path)
    single = spark.read.text(path)
    parts = dl.split_single_column(single)
    c = co.coerce_numeric(parts, keep=("X1",))
    return c.select(F.col("X1").cast("bigint").alias("X1"), "X2", F.col("X3").cast("int").alias("X3"))


@query("coerce_numeric", R("""SELECT event_id, TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value,
  TRY_CAST(event_type AS DOUBLE) AS event_type, TRY_CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS props
  FROM events""", ["value", "event_type", "props"]))
def q_coerce_numeric(spark, d):
    ev_ = tb.read(spark, d, "events").select(
        "event_id", F.col("value").cast("string").alias("value"), "event_type",
        F.regexp_extract("props", "[0-9]+", 0).alias("props"))
    return co.coerce_numeric(ev_, keep=("event_id",))


@query("coercion_report", R("""SELECT * FROM (
  SELECT 'props' AS "column", count_if(TRY_CAST(CASE WHEN event_id % 3 = 0 THEN 'x' ELSE regexp_extract(props, '[0-9]+') END AS DOUBLE) IS NULL) AS n_null,
         CAST(count_if(TRY_CAST(CASE WHEN event_id % 3 = 0 THEN 'x' ELSE regexp_extract(props, '[0-9]+') END AS DOUBLE) IS NULL) AS DOUBLE) / count(*) AS share_null FROM events
  UNION ALL
  SELECT 'event_type', count(*), 1.0 FROM events) WHERE n_null > 0 AND share_null < 0.9""", ["share_null"]))
def q_coercion_report(spark, d):
    ev_ = tb.read(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 3 == 0, "x").otherwise(F.regexp_extract("props", "[0-9]+", 0)).alias("props"),
        "event_type")
    return co.coercion_report(co.coerce_numeric(ev_, keep=("event_id",)), keep=("event_id",))


@query("source_report", R(WITH_STUDY + f"""SELECT count(*) AS n_rows,
  CAST({' + '.join(f'count_if({c} IS NULL)' for c in ['row_id'] + FEATURES + ['y'])} AS BIGINT) AS n_missing,
  count(y) AS target_nonnull, count_if(y IS NULL) AS target_null, count(DISTINCT y) AS target_distinct,
  12 AS n_columns, 12 AS n_numeric, 0 AS n_string, 0 AS n_other, count_if(y IS NULL) * 100.0 / count(*) AS target_null_pct
  FROM study""", ["target_null_pct"]))
def q_source_report(spark, d):
    return co.source_report(tb.study(spark, d), "y")


@query("write_table", R(WITH_STUDY + "SELECT row_id, X1, X2, X3, y FROM study", ["X1", "X2", "X3"]))
def q_write_table(spark, d):
    path = scratch_path(spark, "table") + "/study.parquet"
    sk.write_table(tb.study(spark, d).select("row_id", *CONTINUOUS, "y"), path)
    return sk.read_table(spark, path)


@query("save_params", R(WITH_STUDY + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT 'median' AS step, '{c}' AS \"column\", 'median' AS param, quantile_cont({c}, 0.5) AS value FROM study"
    for c in CONTINUOUS) + ")", ["value"]))
def q_save_params(spark, d):
    path = scratch_path(spark, "params")
    sk.save_params(cl.fit_median(tb.study(spark, d), CONTINUOUS), path)
    return sk.load_params(spark, path).select("step", "column", "param", "value")


@query("rename_target", WITH_STUDY + "SELECT row_id, y AS outcome FROM study")
def q_rename_target(spark, d):
    return pj.rename_target(tb.study(spark, d).select("row_id", "y"), "y", "outcome")


@query("encode_label", WITH_STUDY + """SELECT row_id, CASE WHEN y = 1 THEN 'ad.' WHEN y = 0 THEN 'noad.' END AS outcome,
  y AS code FROM study""")
def q_encode_label(spark, d):
    dec = _labelled(spark, d).select("row_id", "outcome")
    return pj.encode_label(dec, "outcome", "code")


@query("select_features", R(WITH_STUDY + "SELECT X3, X1, y FROM study", ["X3", "X1"]))
def q_select_features(spark, d):
    return pj.select_features(tb.study(spark, d), ["X3", "X1", "X99", "y"])


@query("drop_listed", R(WITH_STUDY + "SELECT row_id, X1, X2, X3, X4, y FROM study", ["X1", "X2", "X3", "X4"]))
def q_drop_listed(spark, d):
    return pj.drop_listed(tb.study(spark, d), BINARY[1:] + ["X99"])[0]


@query("attach_row_id", "SELECT row_number() OVER () - 1 AS row_id, o_orderkey FROM orders")
def q_attach_row_id(spark, d):
    return pj.attach_row_id(tb.read(spark, d, "orders").select("o_orderkey"), id_col="id")


@query("infer_column_kinds", WITH_STUDY + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CASE WHEN count(DISTINCT {c}) > 2 THEN 'continuous' ELSE 'binary' END AS kind FROM study"
    for c in ["row_id"] + FEATURES + ["y"]) + ")")
def q_infer_column_kinds(spark, d):
    return pj.infer_column_kinds(tb.study(spark, d))


@query("assert_shape", WITH_STUDY + """SELECT count(*) AS n_rows, 12 AS n_columns, count(*) AS expected_rows,
  12 AS expected_columns, true AS ok FROM study""")
def q_assert_shape(spark, d):
    s = tb.study(spark, d)
    n = tb.read(spark, d, "lineitem").count()
    return pj.assert_shape(s, n, 12)


# ---------------------------------------------------------------- publishing
GROUP = ("XGBoost", "KNN", "FULL")
GROUP_SQL = "split = 'test' AND model = 'XGBoost' AND imputation = 'KNN' AND version = 'FULL'"


def _group_test(spark, d):
    p = tb.preds(spark, d)
    return p.where((F.col("split") == "test") & (F.col("model") == GROUP[0]) &
                   (F.col("imputation") == GROUP[1]) & (F.col("version") == GROUP[2]))


@query("write_label_lines", WITH_PREDS + f"""SELECT count(*) AS n_lines, count(*) AS n_expected, CAST(0 AS BIGINT) AS n_bad,
  CAST(NULL AS BIGINT) AS first_bad_line, CAST(NULL AS VARCHAR) AS first_bad_value, true AS valid
  FROM preds WHERE {GROUP_SQL}""")
def q_write_label_lines(spark, d):
    """Labels written header-less in row order, then checked by ``validate_submission``."""
    t = ev.with_prediction(_group_test(spark, d), 0.5)
    lab = pj.decode_label(t, "pred", "outcome")
    path = scratch_path(spark, "labels")
    sk.write_label_lines(lab, path, "outcome", "row_id")
    return pb.validate_submission(spark, path, t.count())


@query("validate_submission", WITH_PREDS + f"""SELECT count(*) AS n_lines, count(*) + 1 AS n_expected,
  count(*) AS n_bad, CAST(1 AS BIGINT) AS first_bad_line, '0' AS first_bad_value, false AS valid
  FROM preds WHERE {GROUP_SQL} AND score >= 0.5""")
def q_validate_submission(spark, d):
    """A wrong file: raw 0/1 codes instead of labels and a wrong expected count."""
    t = ev.with_prediction(_group_test(spark, d), 0.5).where(F.col("pred") == 1)
    path = scratch_path(spark, "badlabels")
    t.orderBy("row_id").select(F.lit("0")).write.mode("overwrite").text(path)
    return pb.validate_submission(spark, path, t.count() + 1)


@query("reconcile_length", WITH_PREDS + f""", t AS (SELECT row_id, CAST(score >= 0.5 AS INTEGER) AS pred,
  row_number() OVER (ORDER BY row_id) - 1 AS pos FROM preds WHERE {GROUP_SQL}),
m AS (SELECT count(*) AS m FROM t)
SELECT r.i AS position, t.row_id, t.pred FROM m, range(m.m * 3 // 2) AS r(i) JOIN t ON t.pos = r.i % m.m""")
def q_reconcile_length(spark, d):
    t = ev.with_prediction(_group_test(spark, d), 0.5).select("row_id", "pred")
    m = t.count()
    return pb.reconcile_length(t, int(m * 3 // 2), "cyclic").select("position", "row_id", "pred")
