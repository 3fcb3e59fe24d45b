"""A key holding a third of all rows: results stay whole and exact."""

import datetime as dt

from pyspark.sql import functions as F

from sluice.operators.aggregate import ordered_concat, ordered_concat_chunks
from sluice.operators.dedup import latest_per_key
from sluice.operators import quality as Q

D = dt.datetime(2024, 1, 1)


def _skewed(spark, n=30000):
    # key 0 holds a third of the rows, the rest are spread
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("seq"),
        (F.lit(D) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id"))).alias("u"))


def test_latest_per_key_hot_key(spark):
    df = _skewed(spark).repartition(16)
    out = {r["k"]: r["seq"] for r in latest_per_key(df, ["k"], ["u"]).collect()}
    assert out[0] == 29997 and len(out) == 1 + 20000


def test_uniqueness_rule_hot_key(spark):
    df = _skewed(spark)
    ev = Q.evaluate_rules(df, [Q.Rule("u", "UNIQUENESS", "k")])
    assert ev.where(~F.col("_dq_pass__u")).count() == 10000
    assert ev.count() == 30000


def test_chunked_concat_equals_plain(spark):
    df = _skewed(spark, 6000).withColumn("v", F.col("seq").cast("string"))
    plain = {r["k"]: r["v_list"] for r in
             ordered_concat(df, ["k"], "v", ["seq"]).collect()}
    chunks = ordered_concat_chunks(df, ["k"], "v", ["seq"], partitions=8).collect()
    by_key = {}
    for r in sorted(chunks, key=lambda r: (r["k"], r["chunk"])):
        by_key.setdefault(r["k"], []).append(r["v_list"])
    assert {k: ",".join(v) for k, v in by_key.items()} == plain
    # the hot key was split over several tasks
    assert len(by_key[0]) > 1
