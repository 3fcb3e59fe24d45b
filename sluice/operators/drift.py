"""Q12-Q14: row-count checks, drift between two loads, schema evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def row_count_check(**counts: DataFrame | int) -> DataFrame:
    """Q12: compare row counts of the same data at several stages.

    Each argument is a DataFrame (counted in one aggregate each) or a number
    already observed during a write.  Returns one row per stage with the
    count and whether it equals the first stage's.
    """
    parts = []
    for i, (stage, v) in enumerate(counts.items()):
        if isinstance(v, DataFrame):
            parts.append(v.agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
                          .select(F.lit(i).alias("ordinal"), F.lit(stage).alias("stage"),
                                  "row_count"))
        else:
            parts.append((i, stage, int(v)))
    dfs = [p for p in parts if isinstance(p, DataFrame)]
    lits = [p for p in parts if not isinstance(p, DataFrame)]
    if lits:
        dfs.append(SparkSession.active().createDataFrame(lits, "ordinal int, stage string, row_count bigint"))
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    expected = out.where(F.col("ordinal") == 0).select("row_count").scalar()
    return out.select("stage", "row_count", expected.alias("expected"),
                      (F.col("row_count") == expected).alias("matches"))


def profile(df: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """One row per column: column_name, data_type, row_count, null_count,
    min_value, max_value (as text), distinct_count.  Complex-typed columns are
    left out.

    Counts and bounds are one aggregate over all columns.  Exact distinct
    counts are one aggregate per column, each reading that column alone and
    combining equal values map-side, so no row is expanded; with
    ``exact_distinct=False`` HyperLogLog++ (1 % error) joins the first aggregate.
    """
    simple = [f for f in df.schema.fields
              if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for f in simple:
        col = F.col(f"`{f.name}`")
        aggs += [F.count_if(col.isNull()).alias(f"{f.name}__nulls"),
                 F.min(col).cast("string").alias(f"{f.name}__min"),
                 F.max(col).cast("string").alias(f"{f.name}__max")]
        if not exact_distinct:
            aggs.append(F.approx_count_distinct(col, 0.01).alias(f"{f.name}__distinct"))
    structs = [F.struct(F.lit(f.name).alias("column_name"),
                        F.lit(f.dataType.simpleString()).alias("data_type"),
                        F.col(f"`{f.name}__nulls`").cast("bigint").alias("null_count"),
                        F.col(f"`{f.name}__min`").alias("min_value"),
                        F.col(f"`{f.name}__max`").alias("max_value"),
                        *([] if exact_distinct else
                          [F.col(f"`{f.name}__distinct`").cast("bigint").alias("distinct_count")]))
               for f in simple]
    out = (df.agg(*aggs).select(F.col("__rows").cast("bigint").alias("row_count"),
                                F.explode(F.array(*structs)).alias("p"))
             .select("p.column_name", "p.data_type", "row_count", "p.null_count", "p.min_value",
                     "p.max_value", *([] if exact_distinct else ["p.distinct_count"])))
    if not exact_distinct or not simple:
        return out
    each = [df.agg(F.count_distinct(F.col(f"`{f.name}`")).cast("bigint").alias("distinct_count"))
              .select(F.lit(f.name).alias("column_name"), "distinct_count") for f in simple]
    distinct = each[0]
    for d in each[1:]:
        distinct = distinct.unionByName(d)
    return out.join(distinct, "column_name").select(*out.columns, "distinct_count")


def load_drift(previous: DataFrame, current: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """Q13: per column, ADDED / REMOVED / RETYPED / SAME, with profile shifts.

    Each load is profiled in one aggregate; the two profiles (one row per
    column) are joined on the column name.
    """
    a = profile(previous, exact_distinct).select(*[F.col(c).alias("prev_" + c) for c in
                                   ("column_name", "data_type", "row_count", "null_count",
                                    "min_value", "max_value", "distinct_count")])
    b = profile(current, exact_distinct).select(*[F.col(c).alias("curr_" + c) for c in
                                  ("column_name", "data_type", "row_count", "null_count",
                                   "min_value", "max_value", "distinct_count")])
    j = a.join(b, F.col("prev_column_name") == F.col("curr_column_name"), "full_outer")
    change = (F.when(F.col("prev_column_name").isNull(), F.lit("ADDED"))
               .when(F.col("curr_column_name").isNull(), F.lit("REMOVED"))
               .when(F.col("prev_data_type") != F.col("curr_data_type"), F.lit("RETYPED"))
               .otherwise(F.lit("SAME")))

    def rate(prefix):
        return F.when(F.col(prefix + "row_count") > 0,
                      F.round(F.col(prefix + "null_count") * F.lit(100.0)
                              / F.col(prefix + "row_count"), 4))

    return j.select(
        F.coalesce("curr_column_name", "prev_column_name").alias("column_name"),
        change.alias("change"), "prev_data_type", "curr_data_type",
        rate("prev_").alias("prev_null_pct"), rate("curr_").alias("curr_null_pct"),
        (F.coalesce(rate("curr_"), F.lit(0.0)) - F.coalesce(rate("prev_"), F.lit(0.0)))
        .alias("null_pct_shift"),
        "prev_min_value", "curr_min_value", "prev_max_value", "curr_max_value",
        "prev_distinct_count", "curr_distinct_count")


def evolve_schema(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Q14: append rows that bring new columns; missing ones become NULL.

    Columns are matched by name; a column new in ``incoming`` is added to
    the result (NULL for the target's old rows).
    """
    return target.unionByName(incoming, allowMissingColumns=True)


def schema_changes(target: T.StructType, incoming: T.StructType) -> list[tuple[str, str]]:
    """Columns of ``incoming`` that the target lacks, for an opt-in ALTER."""
    have = {f.name.lower() for f in target.fields}
    return [(f.name, f.dataType.simpleString()) for f in incoming.fields
            if f.name.lower() not in have]
