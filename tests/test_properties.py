"""Properties: merge twice = once; two batches in time order = one batch."""

import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sluice.operators.merge import merge_upsert
from sluice.spec import TableSpec, _cols

SPEC = TableSpec("T", ("id",), _cols("id bigint, v int, created_at timestamp_ntz, "
                                     "updated_at timestamp_ntz"))
RAW = ("id bigint, v int, created_at timestamp_ntz, updated_at timestamp_ntz, "
       "_pipeline_name string, _batch_id string, _run_id string, _is_deleted boolean, "
       "_ingestion_timestamp timestamp_ntz")
BASE = dt.datetime(2024, 1, 1)

rows = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 9), st.integers(0, 5)),
                min_size=1, max_size=12)


def _raw(spark, rs, batch):
    data = [(k, v, BASE, BASE + dt.timedelta(days=d), "p", batch, "r", False,
             BASE + dt.timedelta(seconds=i)) for i, (k, v, d) in enumerate(rs)]
    return spark.createDataFrame(data, RAW)


def _proj(df):
    return sorted((r["id"], r["v"], r["updated_at"]) for r in df.collect())


@settings(max_examples=8, deadline=None)
@given(rows, rows)
def test_split_batches_equal_one_batch(spark, a, b):
    from sluice.operators.merge import empty_staging
    # give the second batch strictly later times, so no stale flips occur
    b = [(k, v, d + 10) for k, v, d in b]
    empty = empty_staging(spark, SPEC)
    now = dt.datetime(2025, 1, 1)
    two = merge_upsert(merge_upsert(empty, _raw(spark, a, "B1"), SPEC, now),
                       _raw(spark, b, "B2"), SPEC, now)
    one = merge_upsert(empty, _raw(spark, a + b, "B"), SPEC, now)
    assert _proj(two) == _proj(one)
    again = merge_upsert(one, _raw(spark, a + b, "B"), SPEC, now)
    assert _proj(again) == _proj(one)
