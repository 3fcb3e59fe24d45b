"""Q13 without the old data: profiles of loads as mergeable rows, and renamed columns.

A load leaves one row per column: counts, bounds, a HyperLogLog sketch of its distinct
values and a KLL sketch of its quantiles.  Rows of any two windows of loads are merged
and compared; no load is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

PROFILE = ("load_id string, column_name string, data_type string, row_count bigint, null_count bigint, "
           "min_number double, max_number double, min_text string, max_text string, distinct_sketch binary, "
           "quantile_sketch binary")
_NESTED = (T.ArrayType, T.MapType, T.StructType)
QUANTILES = (0.25, 0.5, 0.75)


def _number(col: Column, kind: T.DataType) -> Column | None:
    """The column on a number line, for columns that have one."""
    if isinstance(kind, T.NumericType):
        return col.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    return None


def profile_sketches(df: DataFrame, load_id: str, lg_k: int = 14) -> DataFrame:
    """One row per column of a load (``PROFILE``), from one aggregate over one scan.

    Complex-typed columns are left out.  Dates count as days, timestamps as
    microseconds on the number line.  An empty load has rows with zero counts."""
    fields = [f for f in df.schema.fields if not isinstance(f.dataType, _NESTED)]
    aggs, rows = [F.count(F.lit(1)).alias("rows")], []
    for i, f in enumerate(fields):
        col = F.col(f"`{f.name}`")
        num = _number(col, f.dataType)
        text = col.cast("string")
        aggs += [F.count_if(col.isNull()).alias(f"n{i}"), F.hll_sketch_agg(text, F.lit(lg_k)).alias(f"d{i}")]
        if num is not None:
            aggs += [F.min(num).alias(f"lo{i}"), F.max(num).alias(f"hi{i}"), F.kll_sketch_agg_double(num).alias(f"q{i}")]
        else:
            aggs += [F.min(text).alias(f"lo{i}"), F.max(text).alias(f"hi{i}")]
        none = F.lit(None)
        lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
        is_num = num is not None
        rows.append(F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                             F.col(f"n{i}").alias("null_count"), (lo if is_num else none.cast("double")).alias("min_number"),
                             (hi if is_num else none.cast("double")).alias("max_number"),
                             (none.cast("string") if is_num else lo).alias("min_text"),
                             (none.cast("string") if is_num else hi).alias("max_text"), F.col(f"d{i}").alias("distinct_sketch"),
                             (F.col(f"q{i}") if is_num else none.cast("binary")).alias("quantile_sketch")))
    return (df.agg(*aggs).select(F.lit(load_id).alias("load_id"), F.col("rows").alias("row_count"), F.explode(F.array(*rows)).alias("p"))
            .select("load_id", "p.column_name", "p.data_type", "row_count", "p.null_count", "p.min_number", "p.max_number",
                    "p.min_text", "p.max_text", "p.distinct_sketch", "p.quantile_sketch"))


def merge_profiles(sketches: DataFrame) -> DataFrame:
    """One row per column over all the loads given: sums, bounds, distinct_count, quantiles.

    ``data_type`` is the type of the last load by id."""
    n = F.sum(F.col("row_count") - F.col("null_count"))
    merged = sketches.groupBy("column_name").agg(
        F.max_by("data_type", "load_id").alias("data_type"), F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"), F.min("min_number").alias("min_number"), F.max("max_number").alias("max_number"),
        F.min("min_text").alias("min_text"), F.max("max_text").alias("max_text"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_count"),
        F.kll_merge_agg_double("quantile_sketch").alias("q"), n.alias("n"))
    at = F.when((F.col("n") > 0) & F.col("min_number").isNotNull(),
                F.kll_sketch_get_quantile_double("q", F.array(*[F.lit(x) for x in QUANTILES])))
    return merged.withColumn("quantiles", at).drop("q", "n")


def drift_from_sketches(sketches: DataFrame, before: Sequence[str], after: Sequence[str], ratio: float = 1.5) -> DataFrame:
    """Q13 between two windows of loads, from their profile rows alone.

    distinct_shift is UP or DOWN where the distinct counts differ by more than ``ratio``
    (the sketch's error is about 1 %); quantile_shift where the median left the middle
    half of the earlier window.  NULL where a side has no such column or no values."""
    a, b = (merge_profiles(sketches.where(F.col("load_id").isin(list(w)))) for w in (before, after))
    a, b = (d.select(*[F.col(c).alias(p + c) for c in d.columns]) for d, p in ((a, "prev_"), (b, "curr_")))
    change = (F.when(F.col("prev_column_name").isNull(), "ADDED").when(F.col("curr_column_name").isNull(), "REMOVED")
              .when(F.col("prev_data_type") != F.col("curr_data_type"), "RETYPED").otherwise("SAME"))
    both = (F.col("prev_distinct_count") > 0) & (F.col("curr_distinct_count") > 0)
    distinct = (F.when(~both | both.isNull(), None).when(F.col("curr_distinct_count") > ratio * F.col("prev_distinct_count"), "UP")
                .when(F.col("prev_distinct_count") > ratio * F.col("curr_distinct_count"), "DOWN").otherwise("SAME"))
    lo, mid, hi = F.col("prev_quantiles")[0], F.col("curr_quantiles")[1], F.col("prev_quantiles")[2]
    quantile = F.when(lo.isNull() | mid.isNull(), None).when(mid > hi, "UP").when(mid < lo, "DOWN").otherwise("SAME")
    return (a.join(b, F.col("prev_column_name") == F.col("curr_column_name"), "full_outer")
            .select(F.coalesce("curr_column_name", "prev_column_name").alias("column_name"), change.alias("change"),
                    *[f"{p}{c}" for c in ("row_count", "null_count", "min_number", "max_number", "min_text", "max_text",
                                          "distinct_count", "quantiles") for p in ("prev_", "curr_")],
                    distinct.alias("distinct_shift"), quantile.alias("quantile_shift")))


# -- renamed columns ------------------------------------------------------------

BUCKETS = 256


def value_signatures(df: DataFrame, columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(column_name, bucket, low): the smallest value hash per bucket, over each column's
    distinct values as text.  Equal values combine before the shuffle, so it carries at
    most ``buckets`` rows per column and task."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.xxhash64(F.col(f"`{c}`").cast("string")).alias("h"),
                                         F.col(f"`{c}`").isNotNull().alias("some")) for c in columns]))
    return (df.select(pairs.alias("p")).where("p.some")
            .groupBy(F.col("p.column_name").alias("column_name"), F.pmod("p.h", F.lit(buckets)).alias("bucket"))
            .agg(F.min("p.h").alias("low")))


def drift_renames(previous: DataFrame, current: DataFrame, least: float = 0.8) -> DataFrame:
    """Removed and added columns whose values agree: (removed_column, added_column, similarity).

    ``similarity`` estimates the Jaccard similarity of the two columns' distinct values,
    from one signature each.  A pair is kept when each column is the other's best match
    and it reaches ``least``; ties go to the first name.  Columns without values match nothing."""
    have, come = {c.lower() for c in previous.columns}, {c.lower() for c in current.columns}
    gone = [c for c in previous.columns if c.lower() not in come]
    new = [c for c in current.columns if c.lower() not in have]
    if not gone or not new:
        return previous.sparkSession.createDataFrame([], "removed_column string, added_column string, similarity double")
    a = value_signatures(previous, gone).withColumnsRenamed({"column_name": "removed_column", "low": "a"})
    b = value_signatures(current, new).withColumnsRenamed({"column_name": "added_column", "low": "b"})
    size_a, size_b = (d.groupBy(c).agg(F.count("*").alias(f"n_{c}")) for d, c in ((a, "removed_column"), (b, "added_column")))
    # the smaller of two lows is the union's; it is common when both are equal
    met = (a.join(b, "bucket").groupBy("removed_column", "added_column")
           .agg(F.count("*").alias("both"), F.count_if(F.col("a") == F.col("b")).alias("same")))
    scored = (met.join(size_a, "removed_column").join(size_b, "added_column")
              .withColumn("similarity", F.col("same") / (F.col("n_removed_column") + F.col("n_added_column") - F.col("both"))))
    # columns only: a handful of rows
    best = scored.where(F.col("similarity") >= least).groupBy
    by_old = best("removed_column").agg(F.max_by("added_column", F.struct("similarity", _reversed("added_column"))).alias("best_added"))
    by_new = best("added_column").agg(F.max_by("removed_column", F.struct("similarity", _reversed("removed_column"))).alias("best_removed"))
    return (scored.join(by_old, "removed_column").join(by_new, "added_column")
            .where((F.col("best_added") == F.col("added_column")) & (F.col("best_removed") == F.col("removed_column")))
            .select("removed_column", "added_column", "similarity"))


def _reversed(column: str) -> Column:
    """Sorts texts downwards inside an ascending struct (by code point)."""
    return F.transform(F.split(column, ""), lambda c: -F.ascii(c))
