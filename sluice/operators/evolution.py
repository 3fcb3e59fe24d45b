"""Q14: a column's type over many loads, by least common supertypes.

The lattice is lossless: every value of a type can be had back from the supertype.
``tinyint < smallint < int < bigint < decimal``, ``float < double``, integers up to 32
bits below ``double``, ``date < timestamp_ntz``, and ``string`` above everything; two
decimals meet in the smallest that holds both, or in ``string`` beyond 38 digits.
"""

from __future__ import annotations

from pyspark.sql import types as T

_INTEGERS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def least_common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The smallest type of the lattice that holds every value of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, _NESTED) or isinstance(b, _NESTED):
        return T.StringType()                     # as JSON text: no common structure is guessed
    kinds = {type(a), type(b)}
    if kinds <= set(_INTEGERS):
        return max((a, b), key=lambda t: _INTEGERS.index(type(t)))
    if kinds == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if T.DoubleType in kinds and kinds & {T.ByteType, T.ShortType, T.IntegerType}:
        return T.DoubleType()
    if T.FloatType in kinds and kinds & {T.ByteType, T.ShortType}:
        return T.FloatType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    exact = [T.DecimalType(_DIGITS[type(t)], 0) if type(t) in _DIGITS else t for t in (a, b)]
    if all(isinstance(t, T.DecimalType) for t in exact):
        scale = max(t.scale for t in exact)
        whole = max(t.precision - t.scale for t in exact)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    return T.StringType()


def widen_schema(current: T.StructType, incoming: T.StructType) -> tuple[T.StructType, list[dict]]:
    """(schema that takes both, changes): the current columns in their order, widened
    where needed, then new ones.  Names match without regard to case.  Each change is
    {column_name, change (ADDED, WIDENED, ABSENT), from_type, to_type}; ABSENT columns
    stay and read NULL."""
    come = {f.name.lower(): f for f in incoming.fields}
    fields, changes = [], []

    def note(name, change, old, new):
        changes.append({"column_name": name, "change": change, "from_type": old and old.simpleString(),
                        "to_type": new and new.simpleString()})
    for f in current.fields:
        new = come.pop(f.name.lower(), None)
        if new is None:
            note(f.name, "ABSENT", f.dataType, None)
            fields.append(f)
            continue
        kind = least_common_type(f.dataType, new.dataType)
        if kind != f.dataType:
            note(f.name, "WIDENED", f.dataType, kind)
        fields.append(T.StructField(f.name, kind))
    for f in come.values():
        kind = T.StringType() if isinstance(f.dataType, T.NullType) else f.dataType
        note(f.name, "ADDED", None, kind)
        fields.append(T.StructField(f.name, kind))
    return T.StructType(fields), changes
