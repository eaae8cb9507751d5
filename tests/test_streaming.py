"""Fitted stateless steps give the same rows on a stream as in batch."""
from pyspark.sql import functions as F

from stratum.operators import clean, transform as tf
from stratum.operators.params import union_params
from stratum.plans import tables as tb
from stratum.session import scratch_path
from stratum.streaming import apply_params, stream_prepare


def test_stream_equals_batch(spark, sf_dir):
    s = tb.study(spark, sf_dir).select("row_id", "X1", "X2", "X3", "X4")
    params = union_params(clean.fit_median(s, ["X4"], step="median"),
                          tf.fit_power(s, ["X1", "X2"], "yeo-johnson"),
                          clean.fit_caps(s, ["X3"]))
    src = scratch_path(spark, "stream-src")
    s.write.mode("overwrite").parquet(src)
    q = stream_prepare(spark, src, s.schema, params, name="prep_test",
                       checkpoint=scratch_path(spark, "stream-ckpt"))
    q.processAllAvailable()
    q.stop()
    got = sorted(tuple(r) for r in spark.sql("SELECT * FROM prep_test").collect())
    exp = sorted(tuple(r) for r in apply_params(s, params).collect())
    assert got == exp
