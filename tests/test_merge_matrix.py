"""MERGE semantics, one fixture row per case (FIXTURES.md §4), and W1 edge cases."""

import datetime as dt

from pyspark.sql import functions as F

from sluice.operators.dedup import latest_per_key
from sluice.operators.merge import current_rows, merge_counts, merge_message, merge_upsert
from sluice.spec import TableSpec, _cols

SPEC = TableSpec("T", ("id",), _cols("id bigint, v string, created_at timestamp_ntz, "
                                     "updated_at timestamp_ntz"))
D1, D2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
T0, NOW = dt.datetime(2024, 6, 1), dt.datetime(2025, 1, 1)
STG = ("id bigint, v string, created_at timestamp_ntz, updated_at timestamp_ntz, "
       "_cdc_operation string, _cdc_timestamp timestamp_ntz, _is_deleted boolean, "
       "_is_current boolean, _pipeline_name string, _batch_id string, _run_id string, "
       "_created_at timestamp_ntz, _updated_at timestamp_ntz")
RAW = ("id bigint, v string, created_at timestamp_ntz, updated_at timestamp_ntz, "
       "_pipeline_name string, _batch_id string, _run_id string, _is_deleted boolean, "
       "_ingestion_timestamp timestamp_ntz")


def tgt_row(i, upd, deleted):
    return (i, f"t{i}", D1, upd, "INSERT", T0, deleted, True, "p", "B0", "r0", T0, T0)


def src_row(i, upd, deleted, v=None, ing=NOW):
    return (i, v or f"s{i}", D2, upd, "p", "B1", "r1", deleted, ing)


def run_matrix(spark):
    target = spark.createDataFrame([
        tgt_row(1, D1, False), tgt_row(4, D1, False), tgt_row(5, D2, False),
        tgt_row(6, D2, False), tgt_row(7, D2, False), tgt_row(8, D1, True),
        tgt_row(9, None, False), tgt_row(10, D1, False), tgt_row(11, D1, None),
        tgt_row(12, D1, None)], STG)
    raw = spark.createDataFrame([
        src_row(2, D1, False), src_row(3, D1, True), src_row(4, D2, False),
        src_row(5, D1, False), src_row(6, D2, False), src_row(7, D1, True),
        src_row(8, D2, False), src_row(9, D1, False), src_row(10, None, False),
        src_row(11, D1, True), src_row(12, D2, True), src_row(None, D1, False)], RAW)
    return merge_upsert(target, raw, SPEC, NOW, batch_id="B1"), raw


def test_merge_matrix(spark):
    out, _ = run_matrix(spark)
    rows = {r["id"]: r for r in out.collect()}
    assert len(rows) == 13
    unchanged = [1, 5, 6, 9, 10, 11]
    for i in unchanged:
        assert rows[i]["v"] == f"t{i}" and rows[i]["_cdc_operation"] == "INSERT"
        assert rows[i]["_batch_id"] == "B0", i
    # inserts, including a tombstone and a NULL key
    for i in (2, 3, None):
        r = rows[i]
        assert r["_cdc_operation"] == "INSERT" and r["_created_at"] == NOW
        assert r["_updated_at"] == NOW and r["_is_current"] is True and r["_batch_id"] == "B1"
        assert r["created_at"] == D2
    assert rows[3]["_is_deleted"] is True
    # updates
    for i in (4, 7, 8, 12):
        r = rows[i]
        assert r["_cdc_operation"] == "UPDATE" and r["v"] == f"s{i}"
        assert r["created_at"] == D1 and r["_created_at"] == T0 and r["_updated_at"] == NOW
    assert rows[7]["updated_at"] == D1 and rows[7]["_is_deleted"] is True   # moves back
    assert rows[8]["_is_deleted"] is False                                    # un-deleted


def test_null_key_inserted_again(spark):
    out, raw = run_matrix(spark)
    again = merge_upsert(out, raw, SPEC, NOW + dt.timedelta(days=1), batch_id="B1")
    assert again.where(F.col("id").isNull()).count() == 2
    assert again.where(F.col("id").isNotNull()).count() == 12


def test_merge_is_idempotent_for_keys(spark):
    out, raw = run_matrix(spark)
    again = merge_upsert(out, raw, SPEC, NOW + dt.timedelta(days=1), batch_id="B1")
    a = out.where(F.col("id").isNotNull()).collect()
    b = again.where(F.col("id").isNotNull()).collect()
    assert sorted(a) == sorted(b)


def test_counts_and_message(spark):
    out, _ = run_matrix(spark)
    m = merge_message("t", merge_counts(out, "B1")).first()
    assert (m["rows_inserted"], m["rows_updated"]) == (3, 4)
    assert m["result_msg"] == "MERGE_T COMPLETE | INSERTED: 3 | UPDATED: 4"


def test_current_rows(spark):
    out, _ = run_matrix(spark)
    ids = {r["id"] for r in current_rows(out).collect()}
    assert 3 not in ids and 7 not in ids and 11 not in ids and 1 in ids


def test_latest_per_key_edges(spark):
    df = spark.createDataFrame([
        ("a", D1, NOW, 1), ("a", D2, NOW, 2),                     # later date wins
        ("b", D1, NOW, 3), ("b", D1, NOW + dt.timedelta(1), 4),   # later ingestion wins
        ("c", None, NOW, 5), ("c", D1, NOW, 6),                   # NULL date first
        (None, D1, NOW, 7), (None, D2, NOW, 8),                   # NULL keys: one group
        ("e", D1, NOW, 9), ("e", D1, NOW, 9),                     # full tie: one row
    ], "k string, upd timestamp_ntz, ing timestamp_ntz, n int")
    got = {r["k"]: r["n"] for r in latest_per_key(df, ["k"], ["upd", "ing"]).collect()}
    assert got == {"a": 2, "b": 4, "c": 5, None: 8, "e": 9}


def test_tiebreak_is_deterministic(spark):
    df = spark.range(0, 2000).select((F.col("id") % 7).alias("k"), F.lit(D1).alias("u"),
                                     F.col("id").alias("payload"))
    a = sorted(latest_per_key(df.repartition(5), ["k"], ["u"]).collect())
    b = sorted(latest_per_key(df.repartition(3), ["k"], ["u"]).collect())
    assert a == b
