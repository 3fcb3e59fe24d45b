"""Watermark state from an append-only log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sluice.sources.extract import default_watermark


def watermark_current(log: DataFrame) -> DataFrame:
    """One row per (pipeline, table) from its watermark updates.

    Each update row carries the new value, the rows it loaded and when it
    ran; the current state keeps the last value (by time, then sequence),
    the running total of rows (``total + rows``, NULL counted as 0) and
    marks the initial load done.  A grouped aggregate with map-side partial
    aggregation: a pipeline with a third of all updates is combined per map
    task before the shuffle.
    """
    order = F.struct(F.col("updated_at"), F.col("seq"))
    return (log.groupBy("pipeline_name", "source_table")
               .agg(F.max_by("watermark_value", order).alias("last_watermark_value"),
                    F.max("updated_at").alias("last_watermark_datetime"),
                    F.lit(True).alias("initial_load_done"),
                    F.max("updated_at").alias("last_successful_run"),
                    F.max_by("rows_loaded", order).alias("last_rows_loaded"),
                    F.sum(F.coalesce(F.col("rows_loaded"), F.lit(0))).cast("bigint")
                     .alias("total_rows_loaded"),
                    F.count(F.lit(1)).alias("updates")))


def watermark_lookup(state: DataFrame, pipeline_name: str, source_table: str,
                     cdc_column_type: str | None = None) -> DataFrame:
    """The stored value for one (pipeline, table), default when none.

    Keyed by both names (the reference looks up by pipeline only).  Returns
    one row; a missing entry yields the type's default watermark.
    """
    hit = state.where((F.col("pipeline_name") == pipeline_name)
                      & (F.col("source_table") == source_table))
    dflt = default_watermark(cdc_column_type)
    return hit.agg(F.coalesce(F.max("last_watermark_value"), F.lit(dflt)).alias("watermark"),
                   F.coalesce(F.max("initial_load_done"), F.lit(False))
                    .alias("initial_load_done"))


def next_watermark(df: DataFrame, cdc_column: str, previous: Column | str | None = None) -> DataFrame:
    """G6 + G3: rows extracted and the largest CDC value, in one aggregate.

    An empty extract keeps the previous watermark.
    """
    prev = previous if isinstance(previous, Column) else F.lit(previous)
    return df.agg(F.count(F.lit(1)).alias("rows_extracted"),
                  F.coalesce(F.max(cdc_column).cast("string"), prev.cast("string"))
                   .alias("new_watermark"))
