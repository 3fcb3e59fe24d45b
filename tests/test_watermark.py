"""Extract and watermark semantics."""

import datetime as dt

from pyspark.sql import functions as F

from sluice.operators.watermark import next_watermark, watermark_current, watermark_lookup
from sluice.sources.extract import default_watermark, extract
from sluice.spec import WATERMARK_LOG_SCHEMA


def test_defaults():
    assert default_watermark(None) == "1900-01-01 00:00:00"
    assert default_watermark("BIGINT") == str(-(2 ** 63))


def test_extract_ge_and_lookback(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 5)),
                                (3, dt.datetime(2024, 1, 10))], "id bigint, ts timestamp_ntz")
    assert extract(df, "FULL").count() == 3
    assert [r.id for r in extract(df, "CDC", "ts", "2024-01-05 00:00:00").collect()] == [2, 3]
    assert extract(df, "INCREMENTAL", "ts", "2024-01-05 00:00:00",
                   lookback=dt.timedelta(days=4)).count() == 3
    assert extract(df, "CDC", "ts", None).count() == 3          # first run
    assert extract(df, "CDC", "id", 2, cdc_column_type="BIGINT").count() == 2


def test_next_watermark_keeps_previous_on_empty(spark):
    df = spark.createDataFrame([], "id bigint, ts timestamp_ntz")
    r = next_watermark(df, "ts", "2024-01-01 00:00:00").first()
    assert r["rows_extracted"] == 0 and r["new_watermark"] == "2024-01-01 00:00:00"


def test_watermark_state_and_lookup(spark):
    t = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([
        ("p", "a", "c", "v1", "TIMESTAMP", 10, t, 1),
        ("p", "a", "c", "v2", "TIMESTAMP", None, t + dt.timedelta(1), 2),
        ("p", "b", "c", "w1", "TIMESTAMP", 5, t, 3)], WATERMARK_LOG_SCHEMA)
    st = {(r["pipeline_name"], r["source_table"]): r for r in watermark_current(log).collect()}
    assert st[("p", "a")]["last_watermark_value"] == "v2"
    assert st[("p", "a")]["total_rows_loaded"] == 10
    assert st[("p", "a")]["last_rows_loaded"] is None
    assert watermark_lookup(watermark_current(log), "p", "b").first()["watermark"] == "w1"
    miss = watermark_lookup(watermark_current(log), "p", "zzz").first()
    assert miss["watermark"] == "1900-01-01 00:00:00" and miss["initial_load_done"] is False


def test_api_source_reads_landed_json(spark, work):
    from sluice.sources.extract import read_source
    cust = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    cust.write.json(work + "/api/customer")
    df = read_source(spark, {"source_type": "API", "source_server": work + "/api",
                             "source_table": "customer"}, csv_schema=cust.schema)
    assert sorted(df.collect()) == sorted(cust.collect())
