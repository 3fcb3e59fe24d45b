"""Scalar helpers built only from Spark's built-in expressions.

Driver-side helpers (``batch_id``, ``dated_path``) format the one ``now``
of a run; the Column forms do the same inside a query.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, functions as F, types as T

# The reference's timestamp formats.
BATCH_PREFIX = "BATCH-"
BATCH_FORMAT = "yyyyMMdd-HHmmss"
DAY_PATH_FORMAT = "yyyy/MM/dd"
FILE_DAY_FORMAT = "yyyyMMdd"
WATERMARK_FORMAT = "yyyy-MM-dd HH:mm:ss"

_PY = {"yyyy": "%Y", "MM": "%m", "dd": "%d", "HH": "%H", "mm": "%M", "ss": "%S"}


def fmt_ts(ts: dt.datetime, pattern: str) -> str:
    """Format a Python datetime with a Spark/Java style pattern."""
    out = pattern
    for k, v in _PY.items():
        out = out.replace(k, v)
    return ts.strftime(out)


def batch_id(now: dt.datetime) -> str:
    """``BATCH-yyyyMMdd-HHmmss`` for one run's instant."""
    return BATCH_PREFIX + fmt_ts(now, BATCH_FORMAT)


def batch_id_col(ts: Column) -> Column:
    return F.concat(F.lit(BATCH_PREFIX), F.date_format(ts, BATCH_FORMAT))


def dated_path(now: dt.datetime) -> str:
    return fmt_ts(now, DAY_PATH_FORMAT)


def dated_path_col(ts: Column) -> Column:
    return F.date_format(ts, DAY_PATH_FORMAT)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole-second boundaries crossed from ``start`` to ``end``.

    Truncating both ends to the second before subtracting counts boundaries
    (0.9 s -> 2.1 s gives 2), unlike ``timestampdiff`` which floors the
    elapsed time.
    """
    return (F.unix_timestamp(end) - F.unix_timestamp(start)).cast("bigint")


def hours_before(now: Column | dt.datetime, hours: int) -> Column:
    base = F.lit(now) if not isinstance(now, Column) else now
    return base - F.make_dt_interval(F.lit(0), F.lit(hours))


# The reference's mapping of warehouse column types to load
# types; any other type becomes a string.
_WAREHOUSE_TYPES = {
    "TEXT": "string", "VARCHAR": "string", "BOOLEAN": "boolean", "FLOAT": "double",
    "DATE": "date", "TIMESTAMP_NTZ": "timestamp_ntz", "TIMESTAMP_LTZ": "timestamp_ntz",
    "TIMESTAMP_TZ": "timestamp_ntz", "TIMESTAMP": "timestamp_ntz",
}


def warehouse_type(name: str, precision: int | None = None, scale: int | None = None) -> T.DataType:
    """Spark type for a warehouse catalogue type.

    NUMBER keeps the column's own precision and scale (the reference's
    unqualified NUMBER would round amounts to whole numbers).
    """
    n = name.upper().strip()
    m = re.match(r"(NUMBER|NUMERIC|DECIMAL)\s*(?:\((\d+)\s*(?:,\s*(\d+))?\))?", n)
    if m:
        p = int(m.group(2) or precision or 38)
        s = int(m.group(3) or scale or 0)
        return T.DecimalType(p, s)
    from sluice.spec import parse_type
    return parse_type(_WAREHOUSE_TYPES.get(n, "string"))


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)
_DATETIME = (T.DateType, T.TimestampType, T.TimestampNTZType)


def castable(src: T.DataType, dst: T.DataType) -> bool:
    """Whether ``try_cast(src AS dst)`` is legal under ANSI mode.

    Pairs Spark refuses at analysis (timestamp -> int, int -> date, ...) go
    through a string instead.
    """
    if isinstance(src, T.StringType) or type(src) is type(dst):
        return True
    if isinstance(dst, T.StringType):
        return True
    if isinstance(src, _NUMERIC) and isinstance(dst, _NUMERIC):
        return True
    if isinstance(src, _DATETIME) and isinstance(dst, _DATETIME):
        return True
    if isinstance(src, T.BooleanType) and isinstance(dst, _NUMERIC):
        return True
    if isinstance(src, _NUMERIC) and isinstance(dst, T.BooleanType):
        return True
    return False


def safe_cast(col: Column, src: T.DataType, dst: T.DataType,
              booleans_as_numbers: bool = False) -> Column:
    """``try_cast`` that never fails analysis: NULL where the value does not fit.

    With ``booleans_as_numbers`` false a boolean never becomes 1/0: it is
    an incompatible value (NULL, hence a bad row when the input was set).
    """
    if src == dst:
        return col
    if isinstance(src, (T.ArrayType, T.MapType, T.StructType)):
        # nested values fall to the text branch of the type map: as JSON
        return F.to_json(col) if isinstance(dst, T.StringType) else F.lit(None).cast(dst)
    if isinstance(src, T.BooleanType) and isinstance(dst, _NUMERIC) and not booleans_as_numbers:
        return F.lit(None).cast(dst)
    if castable(src, dst):
        return col.try_cast(dst)
    return col.cast("string").try_cast(dst)


def set_names(names: list[Column]) -> Column:
    """The given names that are not NULL (no two are equal), as an array.  Spark compiles
    this; ``array_compact`` is a lambda that it interprets, with all columns beside it."""
    return F.array_except(F.array(*names), F.array(F.lit(None).cast("string")))
