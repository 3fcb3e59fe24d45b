"""Run-log state and monitoring queries over run events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from sluice.functions.scalar import hours_before, seconds_between
from sluice.operators.dedup import latest_per_key

HISTORY_COLUMNS = ("pipeline_name", "source_table", "status", "start_time", "end_time",
                   "duration_seconds", "rows_extracted", "rows_loaded")


def run_log_current(events: DataFrame) -> DataFrame:
    """One row per run from its START and END events.

    A START row opens the run as RUNNING; the latest END event of the same
    (run_id, pipeline_name) sets end time, duration (second boundaries
    crossed), status, counts and message.  An END without a START gives no
    row.  The join is an equi-join on the run key, partitioned by it.
    """
    starts = (events.where(F.col("event") == "START")
                    .select("run_id", "pipeline_name", "source_table",
                            F.col("event_time").alias("start_time"),
                            "adf_pipeline_name", "adf_trigger_name", "watermark_start"))
    starts = latest_per_key(starts, ["run_id", "pipeline_name"], ["start_time"],
                            nulls_first=False)
    ends = latest_per_key(events.where(F.col("event") == "END"), ["run_id", "pipeline_name"],
                          ["event_time"], nulls_first=False)
    ends = ends.select("run_id", "pipeline_name", F.col("event_time").alias("end_time"),
                       F.col("status").alias("end_status"), "rows_extracted",
                       "rows_passed_dq", "rows_failed_dq", "rows_loaded", "watermark_end",
                       "error_message")
    j = starts.join(ends, ["run_id", "pipeline_name"], "left")
    return j.select(
        "run_id", "pipeline_name", "source_table",
        F.to_date("start_time").alias("run_date"), "start_time", "end_time",
        seconds_between(F.col("start_time"), F.col("end_time")).alias("duration_seconds"),
        F.coalesce(F.col("end_status"), F.lit("RUNNING")).alias("status"),
        F.coalesce(F.col("rows_extracted"), F.lit(0)).cast("bigint").alias("rows_extracted"),
        F.coalesce(F.col("rows_passed_dq"), F.lit(0)).cast("bigint").alias("rows_passed_dq"),
        F.coalesce(F.col("rows_failed_dq"), F.lit(0)).cast("bigint").alias("rows_failed_dq"),
        F.coalesce(F.col("rows_loaded"), F.lit(0)).cast("bigint").alias("rows_loaded"),
        "watermark_start", "watermark_end", "adf_pipeline_name", "adf_trigger_name",
        "error_message")


def run_history(runs: DataFrame) -> DataFrame:
    """The eight history columns, newest first."""
    return runs.select(*HISTORY_COLUMNS).orderBy(F.col("start_time").desc())


def failed_since(runs: DataFrame, now: dt.datetime | Column, hours: int = 24) -> DataFrame:
    """Failed runs that started in the last ``hours``, newest first."""
    return (runs.where((F.col("status") == "FAILED")
                       & (F.col("start_time") >= hours_before(now, hours)))
                .orderBy(F.col("start_time").desc()))


def run_trend(runs: DataFrame) -> DataFrame:
    """Runs, rows and duration per pipeline, day and status."""
    return (runs.groupBy("pipeline_name", "run_date", "status")
                .agg(F.count(F.lit(1)).alias("runs"),
                     F.sum("rows_loaded").cast("bigint").alias("rows_loaded"),
                     F.avg("duration_seconds").alias("avg_duration_seconds"),
                     F.max("duration_seconds").alias("max_duration_seconds")))


def errors_current(errors: DataFrame) -> DataFrame:
    """K10/K11 current state: the latest row of each error id (a resolution is
    appended as its own row, later than the error it closes)."""
    stamp = F.coalesce(F.col("resolved_date"), F.col("created_date"))
    return latest_per_key(errors.withColumn("__stamp", stamp), ["error_id"],
                          ["__stamp", F.col("is_resolved").cast("int")],
                          nulls_first=False).drop("__stamp")


def open_errors(errors: DataFrame, runs: DataFrame) -> DataFrame:
    """Unresolved errors with their run's status, newest first."""
    r = runs.select("run_id", "pipeline_name", F.col("status").alias("run_status"),
                    "start_time")
    return (errors.where(~F.coalesce(F.col("is_resolved"), F.lit(False)))
                  .join(r, ["run_id", "pipeline_name"], "left")
                  .orderBy(F.col("created_date").desc()))


def resolution_row(error: dict, resolved_by: str, when: dt.datetime, notes: str | None = None) -> dict:
    """The row that closes an error (same id, resolved)."""
    return dict(error, is_resolved=True, resolved_by=resolved_by, resolved_date=when,
                resolution_notes=notes)


def error_row(run_id: str, pipeline_name: str, source_table: str | None, error_type: str,
              message: str, created: dt.datetime, activity: str | None = None) -> dict:
    """One error-log row (resolution appended later as its own row)."""
    return {"error_id": f"{run_id}:{error_type}", "run_id": run_id,
            "pipeline_name": pipeline_name, "source_table": source_table,
            "error_type": error_type, "error_message": message,
            "error_details": message, "adf_activity_name": activity,
            "created_date": created, "is_resolved": False}
