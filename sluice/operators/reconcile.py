"""Q12 beyond counts: which keys differ between two stages of the same data.

Both stages are summed over key ranges by order-free hashes of their rows.  Only ranges
whose sums differ are cut further, and each level reads only those ranges (the range
filter reaches the scans).  At the last level the rows of the ranges that are left are
compared by key.  Equal tables cost one aggregate each; what reaches the driver is one
row per differing range, at most ``fanout`` times those of the level before, and beyond
``most`` ranges their hulls go on as one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sluice.operators.evolution import least_common_type

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


def _position(df: DataFrame, key: str) -> Column:
    """The key as a whole number that follows its order."""
    kind = df.schema[key].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(key).cast("long")
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return F.unix_micros(F.col(key).cast("timestamp"))
    if isinstance(kind, _WHOLE):
        return F.col(key).cast("long")
    raise TypeError(f"{key}: ranges need an integer, date or timestamp column, not {kind.simpleString()}")


def _bound(df: DataFrame, key: str, position: int) -> Column:
    kind = df.schema[key].dataType
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(F.lit(position))
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return F.timestamp_micros(F.lit(position)).cast(kind)
    return F.lit(position).cast(kind)


def _within(df: DataFrame, key: str, ranges: Sequence[tuple[int, int]]) -> DataFrame:
    """Rows in the ranges; plain comparisons with literals, so the scan can skip files."""
    cond = F.lit(False)
    for lo, hi in ranges:
        cond = cond | F.col(key).between(_bound(df, key, lo), _bound(df, key, hi))
    return df.where(cond)


def _row_hash(columns: Sequence[str]) -> Column:
    """A hash in which NULL differs from every value and columns cannot slide into each other."""
    parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(*parts)


def _sums(df: DataFrame, group: Column, columns: Sequence[str]) -> DataFrame:
    h = _row_hash(columns)
    return df.groupBy(group.alias("g")).agg(F.count("*").alias("n"), F.sum(h.cast("decimal(20,0)")).alias("s"),
                                            F.bit_xor(F.xxhash64(h, F.lit(1))).alias("x"))


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    a, b = (d.select(F.col("g").alias(f"{p}g"), F.struct("n", "s", "x").alias(p)) for d, p in ((a, "a"), (b, "b")))
    return (a.join(b, F.col("ag").eqNullSafe(F.col("bg")), "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
            .select(F.coalesce("ag", "bg").alias("g")))


def differing_ranges(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], fanout: int = 64,
                     levels: int = 2, most: int = 512) -> tuple[list[tuple[int, int]], bool]:
    """(ranges of ``key`` whose rows differ, whether the rows without a key differ)."""
    pos = {id(d): _position(d, key) for d in (left, right)}
    ends = [d.agg(F.min(pos[id(d)]), F.max(pos[id(d)])).first() for d in (left, right)]
    known = [e for e in ends if e[0] is not None]
    ranges, nulls = ([(min(e[0] for e in known), max(e[1] for e in known))] if known else []), False
    for level in range(levels):
        if not ranges:
            break
        steps = [(lo, hi, -(-(hi - lo + 1) // fanout)) for lo, hi in ranges]
        sums = []
        for d in (left, right):
            p = pos[id(d)]
            part = d if level == 0 else _within(d, key, ranges)
            lows = F.array(*[F.lit(lo) for lo, _, _ in steps])
            r = F.size(F.filter(lows, lambda lo: lo <= p)) - 1
            at = lambda k: F.get(F.array(*[F.lit(s[k]) for s in steps]), r)  # noqa: B023,E731
            # exact whole-number division: positions may pass 2^53
            step_of = p - at(0) - F.pmod(p - at(0), at(2))
            sums.append(_sums(part, (r * fanout + F.round(step_of / at(2))).cast("long"), columns))
        found = [r["g"] for r in _differing(*sums).collect()]
        if level == 0:
            nulls = None in found
        new = []
        for g in sorted(x for x in found if x is not None):
            lo, hi, step = steps[g // fanout]
            new.append((lo + g % fanout * step, min(hi, lo + (g % fanout + 1) * step - 1)))
        ranges = []
        for lo, hi in new:                                # neighbours go on as one range
            if ranges and (ranges[-1][1] + 1 == lo or len(ranges) >= most):
                ranges[-1] = (ranges[-1][0], hi)
            else:
                ranges.append((lo, hi))
    else:
        return ranges, nulls
    if not known:
        nulls = bool(_differing(*(_sums(d, F.lit(None).cast("long"), columns) for d in (left, right))).limit(1).count())
    return ranges, nulls


def reconcile_ranges(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
                     fanout: int = 64, levels: int = 2) -> DataFrame:
    """One row per key whose rows differ: the keys, left_rows, right_rows, difference
    (LEFT_ONLY, RIGHT_ONLY, CHANGED).

    Rows are compared as a multiset per key, so keys may repeat; NULL keys are compared
    too.  The first key column is the one that ranges are made of."""
    columns = list(columns or [c for c in left.columns if c in right.columns])
    first = keys[0]
    # a value hashes by its type, so both sides are read in the common one
    kinds = {c: least_common_type(left.schema[c].dataType, right.schema[c].dataType) for c in dict.fromkeys([*keys, *columns])}
    left, right = (d.select(*[F.col(c).cast(t).alias(c) for c, t in kinds.items()]) for d in (left, right))
    ranges, nulls = differing_ranges(left, right, first, columns, fanout, levels)
    sides = []
    for d, p in ((left, "left"), (right, "right")):
        part = _within(d, first, ranges)
        if nulls:
            part = part.unionByName(d.where(F.col(first).isNull()))
        h = _row_hash(columns)
        sides.append(part.groupBy(*[F.col(k).alias(f"{p}_{k}") for k in keys])
                     .agg(F.count("*").alias(f"{p}_rows"), F.sum(h.cast("decimal(20,0)")).alias(f"{p}_sum"),
                          F.bit_xor(F.xxhash64(h, F.lit(1))).alias(f"{p}_xor")))
    a, b = sides
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"left_{k}").eqNullSafe(F.col(f"right_{k}"))
    same = F.lit(True)
    for c in ("rows", "sum", "xor"):
        same = same & F.col(f"left_{c}").eqNullSafe(F.col(f"right_{c}"))
    kind = (F.when(F.col("right_rows").isNull(), "LEFT_ONLY").when(F.col("left_rows").isNull(), "RIGHT_ONLY").otherwise("CHANGED"))
    return (a.join(b, on, "full_outer").where(~same)
            .select(*[F.coalesce(f"left_{k}", f"right_{k}").alias(k) for k in keys],
                    F.coalesce("left_rows", F.lit(0)).alias("left_rows"), F.coalesce("right_rows", F.lit(0)).alias("right_rows"),
                    kind.alias("difference")))
