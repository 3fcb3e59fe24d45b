"""RAW holds one batch, and inputs that must be refused or counted exactly."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from sluice.operators.dedup import latest_per_key
from sluice.operators.drift import row_count_check
from sluice.operators.runlog import error_row
from sluice.sinks.write import land, load_raw, read_raw, read_rejects
from sluice.sources.extract import read_landing

NOW = dt.datetime(2026, 1, 2, 3, 4, 5)
TARGET = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType())])


def _load(spark, path, batch, rows):
    return load_raw(spark.createDataFrame(rows, "id string, v string"), TARGET, path, pipeline_name="p",
                    batch_id=batch, run_id=f"r{batch}", load_type="FULL", now=NOW)


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_raw_holds_the_last_batch_only(spark, work, mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        for batch, rows in (("1", [("1", "a"), ("x", "b")]), ("2", [("2", "c")]), ("3", [("y", "d")]), ("4", [])):
            got = _load(spark, work + "/raw", batch, rows)
            good, bad = (f(spark, work + "/raw", got.schema).collect() for f in (read_raw, read_rejects))
            assert [r.v for r in good] == [v for i, v in rows if i.isdigit()]
            assert [r._batch_id for r in good + bad] == [batch] * len(rows)
            assert len(bad) == sum(not i.isdigit() for i, _ in rows)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_all_bad_first_batch_can_be_read(spark, work):
    got = _load(spark, work + "/raw", "1", [("x", "b")])
    assert (got.rows_loaded, got.rows_rejected) == (0, 1)
    assert read_raw(spark, work + "/raw").count() == 0


def test_landing_keeps_a_source_column_named_batch_id(spark, work):
    land(spark.createDataFrame([(1, "own")], "id int, batch_id string"), work + "/l", "B1")
    assert read_landing(spark, work + "/l").select("id", "batch_id").collect() == [(1, "own")]


def test_order_columns_are_found_as_spark_finds_them(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 2, "b")], "k int, updated_at int, v string")
    assert latest_per_key(df, ["k"], ["UPDATED_AT"]).first().v == "a"
    with pytest.raises(ValueError, match="unknown order column"):
        latest_per_key(df, ["k"], ["no_such_column"])
    assert latest_per_key(df, ["k"], ["updated_at", "_ingestion_timestamp"]).first().v == "a"


def test_row_count_check_of_numbers(spark):
    assert [r.matches for r in row_count_check(landed=5, loaded=5, merged=4).collect()] == [True, True, False]


def test_error_text_is_kept_whole():
    assert len(error_row("r", "p", "t", "UNKNOWN", "x" * 9000, NOW)["error_message"]) == 9000
