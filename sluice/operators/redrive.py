"""Rejected rows driven again under a new schema, with each row's attempts.

Rejects are driven from their landed form, in which the value that failed is still
there.  A row is known by the content of its landed columns; its attempts are kept as an
append-only log, so a re-drive takes only rows that have not yet passed and were not
already tried under the same version of the schema or rules: a second run moves nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from sluice.operators.projection import BAD_COLUMNS, flag_bad_rows

KEY = "_content_key"
ATTEMPTS = f"{KEY} string, attempt bigint, version string, outcome string, bad_columns string, n_rows bigint"


def with_content_key(landed: DataFrame) -> DataFrame:
    """Landed rows with the SHA-256 of their columns, in name order; equal rows share it."""
    cols = sorted(c for c in landed.columns if not c.startswith("_"))
    return landed.withColumn(KEY, F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols]), {"ignoreNullFields": "false"}), 256))


def pending_rows(landed: DataFrame, attempts: DataFrame, version: str) -> DataFrame:
    """Keyed rows that never passed and were not tried under ``version``, with their last attempt."""
    state = attempts.groupBy(KEY).agg(F.max("attempt").alias("last_attempt"),
                                      F.max((F.col("outcome") == "PASSED") | (F.col("version") == version)).alias("done"))
    return (with_content_key(landed).join(state, KEY, "left").where(~F.coalesce("done", F.lit(False)))
            .withColumn("last_attempt", F.coalesce("last_attempt", F.lit(0))).drop("done"))


def redrive(landed: DataFrame, attempts: DataFrame, target: T.StructType, version: str) -> tuple[DataFrame, DataFrame]:
    """(passed, log): the pending rows that convert to ``target`` now, typed, with their
    content key and attempt number; and one log row per content key tried.

    Append the log once the passed rows are loaded.  The first drive of a batch is a
    re-drive with an empty log (``ATTEMPTS``)."""
    pending = pending_rows(landed, attempts, version)
    fields = [*target.fields, T.StructField(KEY, T.StringType()), T.StructField("last_attempt", T.LongType())]
    tried = flag_bad_rows(pending, T.StructType(fields)).withColumn("attempt", F.col("last_attempt") + 1).drop("last_attempt")
    ok = F.size(BAD_COLUMNS) == 0
    log = (tried.groupBy(KEY).agg(F.first("attempt").alias("attempt"), F.first(F.array_join(BAD_COLUMNS, ",")).alias("bad_columns"),
                                  F.count("*").alias("n_rows"))
           .select(KEY, "attempt", F.lit(version).alias("version"),
                   F.when(F.col("bad_columns") == "", "PASSED").otherwise("FAILED").alias("outcome"), "bad_columns", "n_rows"))
    return tried.where(ok).drop(BAD_COLUMNS), log
