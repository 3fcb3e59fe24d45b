"""Typed load, bad-row split, conversion, audit stamp."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from sluice.operators.projection import (BAD_COLUMNS, convert, split_bad_rows, stamp_audit,
                                         typed_projection)
from sluice.spec import schema_of

TARGET = schema_of("ID int, AMOUNT decimal(5,2), DAY date, NAME string, MISSING string")


def test_bad_row_rules(spark):
    df = spark.createDataFrame([
        ("1", "2.345", "2024-01-02", "a"),      # good, amount rounds half up
        ("x", "1.00", "2024-01-02", "b"),       # bad int
        (None, "1.00", "2024-01-02", "c"),      # NULL int is fine
        ("3", "1e20", "2024-01-02", "d"),       # overflow -> bad
        ("4", "1.00", "2024-13-01", "e"),       # bad date
    ], "id string, amount string, day string, name string")
    good, bad = split_bad_rows(df, TARGET)
    g = {r["NAME"]: r for r in good.collect()}
    assert set(g) == {"a", "c"}
    assert g["a"]["AMOUNT"] == Decimal("2.35") and g["a"]["MISSING"] is None
    assert g["c"]["ID"] is None
    b = {r["NAME"]: list(r[BAD_COLUMNS]) for r in bad.collect()}
    assert b == {"b": ["ID"], "d": ["AMOUNT"], "e": ["DAY"]}
    assert good.count() + bad.count() == df.count()


def test_case_insensitive_and_ordinal(spark):
    df = spark.createDataFrame([("n", 5)], "name string, id int").select("id", "name")
    out = typed_projection(df, TARGET)
    assert out.columns == ["ID", "AMOUNT", "DAY", "NAME", "MISSING"]


def test_uncastable_pair_goes_through_string(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "ts timestamp_ntz")
    out = typed_projection(df, schema_of("ts int"), keep_bad_columns=True).first()
    assert out["ts"] is None and list(out[BAD_COLUMNS]) == ["ts"]


def test_convert_truncates_and_keeps_booleans(spark):
    df = spark.createDataFrame([("abcdefgh", True)], "s string, b boolean")
    out = convert(df, schema_of("s string, b int"), max_lengths={"s": 3}).first()
    assert out["s"] == "abc" and out["b"] is None
    strict = typed_projection(df, schema_of("s string"), max_lengths={"s": 3},
                              allow_truncation=False, keep_bad_columns=True).first()
    assert strict["s"] is None and list(strict[BAD_COLUMNS]) == ["s"]


def test_stamp_audit(spark):
    df = spark.createDataFrame([(1, None), (2, True)], "id int, _is_deleted boolean")
    now = dt.datetime(2025, 1, 1)
    out = stamp_audit(df, "p", "B", "r", "CDC", now, source_file="f.parquet")
    assert out.columns == ["id", "_pipeline_name", "_batch_id", "_run_id", "_load_type",
                           "_source_file", "_is_deleted", "_ingestion_timestamp"]
    rows = {r["id"]: r for r in out.collect()}
    assert rows[1]["_is_deleted"] is False and rows[2]["_is_deleted"] is True
    assert rows[1]["_ingestion_timestamp"] == now and rows[1]["_source_file"] == "f.parquet"


def test_raw_load_single_pass_and_empty_rejects(spark, work):
    from sluice.sinks.write import load_raw, read_raw, read_rejects
    df = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, name string")
    res = load_raw(df, schema_of("id int, name string"), work + "/raw", pipeline_name="p",
                   batch_id="B", run_id="r", load_type="FULL", now=dt.datetime(2025, 1, 1))
    assert (res.rows_loaded, res.rows_rejected) == (2, 0)
    assert read_raw(spark, work + "/raw").count() == 2
    rej = read_rejects(spark, work + "/raw")
    assert rej.count() == 0 and BAD_COLUMNS in rej.columns


def test_nested_values_become_json(spark):
    df = spark.createDataFrame([(1, [1, 2], {"k": "v"})], "id int, a array<int>, m map<string,string>")
    out = typed_projection(df, schema_of("id int, a string, m string"), keep_bad_columns=True).first()
    assert out["a"] == "[1,2]" and out["m"] == '{"k":"v"}' and list(out[BAD_COLUMNS]) == []
