"""Scalar helpers (F3, F5, F10, T6) and the column list."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F, types as T

from sluice.functions.scalar import (batch_id, dated_path, seconds_between, warehouse_type,
                                     safe_cast)
from sluice.operators.aggregate import column_list


def test_formats():
    now = dt.datetime(2025, 3, 4, 5, 6, 7)
    assert batch_id(now) == "BATCH-20250304-050607"
    assert dated_path(now) == "2025/03/04"


def test_warehouse_types():
    assert warehouse_type("NUMBER(18,2)") == T.DecimalType(18, 2)
    assert warehouse_type("NUMBER", 10, 3) == T.DecimalType(10, 3)
    assert warehouse_type("TEXT") == T.StringType()
    assert warehouse_type("TIMESTAMP_LTZ") == T.TimestampNTZType()
    assert warehouse_type("BOOLEAN") == T.BooleanType()
    assert warehouse_type("VARIANT") == T.StringType()       # anything else: text


def test_seconds_between_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0, 900000),
                                 dt.datetime(2024, 1, 1, 0, 0, 2, 100000))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(seconds_between(F.col("a"), F.col("b")).alias("s")).first()["s"] == 2


def test_safe_cast_rounds_half_up(spark):
    df = spark.createDataFrame([("2.345",), ("2.344",)], "x string")
    got = [r[0] for r in df.select(safe_cast(F.col("x"), T.StringType(),
                                             T.DecimalType(5, 2))).collect()]
    assert got == [Decimal("2.35"), Decimal("2.34")]


def test_column_list(spark):
    df = spark.createDataFrame([(1, "a", "p")], "id int, name string, _pipeline_name string")
    assert column_list(df, exclude=["_PIPELINE_NAME"]) == "ID,NAME"
