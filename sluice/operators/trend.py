"""Runs that leave their pipeline's trend, as alert rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

SCALE = 1.4826          # fixed value: MAD to standard deviation for normal data


def _median(xs: Column) -> Column:
    """Median of a short array (mean of the middle two)."""
    s, n = F.sort_array(xs), F.size(xs)
    return (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2


def trend_anomalies(runs: DataFrame, group: str, day: str, value: str, weeks: int = 8, least_history: int = 3,
                    limit: float = 3.5) -> DataFrame:
    """Days whose value is far from earlier same-weekday days: one row per alert with the
    day's value, the median and the median absolute deviation of its history, and the score.

    ``runs`` has one row per group and day.  The history of a day are the same weekday's
    values in the ``weeks`` weeks before it, a RANGE frame, so missing days shorten it and
    a frame never holds more than ``weeks`` values.  With no deviation at all, any other
    value is an alert (score NULL).  NULL values are no history and no alert."""
    days = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    w = (Window.partitionBy(group, F.dayofweek(day)).orderBy(days).rangeBetween(-7 * weeks, -1))
    x = F.col(value).cast("double")
    out = (runs.select(group, day, x.alias("value"), F.collect_list(x).over(w).alias("past"))
           .where(F.col("value").isNotNull() & (F.size("past") >= least_history))
           .withColumn("median", _median(F.col("past")))
           .withColumn("mad", _median(F.transform("past", lambda v: F.abs(v - F.col("median")))))
           .withColumn("score", F.when(F.col("mad") > 0, F.abs(F.col("value") - F.col("median")) / (SCALE * F.col("mad")))))
    odd = F.when(F.col("mad") > 0, F.col("score") > limit).otherwise(F.col("value") != F.col("median"))
    return out.where(odd).select(group, day, "value", "median", "mad", "score", F.size("past").cast("long").alias("n_history"),
                                 F.when(F.col("value") > F.col("median"), "HIGH").otherwise("LOW").alias("direction"))
