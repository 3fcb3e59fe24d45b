"""M1: upsert MERGE of a change batch into a current-state table.

Semantics (per key, source = latest row of the batch):

* key only in target            -> row unchanged
* key only in source            -> INSERT (also a tombstone when deleted)
* both, tgt.updated < src.updated OR tgt._is_deleted != src._is_deleted
                                -> UPDATE (every column but keys and created_at)
* both, guard false or NULL     -> unchanged
* NULL key                      -> never matches, so inserted on every run

Expressed as one full outer join on the key plus a per-column
``when``; rows whose key holds a NULL cannot match and bypass the join
(they would otherwise all hash to one reducer).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sluice.operators.dedup import latest_per_key
from sluice.spec import STAGING_META_COLUMNS, STAGING_META_TYPES, TableSpec


def batch_rows(raw: DataFrame, batch_id: str | None) -> DataFrame:
    """Rows of one batch (all rows when ``batch_id`` is None)."""
    if batch_id is None:
        return raw
    return raw.where(F.col("_batch_id") == F.lit(batch_id))


def _any_null(cols: Sequence[str], prefix: str = "") -> Column:
    cond = F.lit(False)
    for k in cols:
        cond = cond | F.col(prefix + k).isNull()
    return cond


def empty_staging(spark, spec: TableSpec) -> DataFrame:
    return spark.createDataFrame([], spec.staging_schema())


def source_latest(raw: DataFrame, spec: TableSpec, batch_id: str | None = None) -> DataFrame:
    """W1 over the batch rows with the spec's order (NULLs first)."""
    rows = batch_rows(raw, batch_id)
    return latest_per_key(rows, spec.keys, list(spec.order_columns), nulls_first=True)


def update_guard(spec: TableSpec) -> Column:
    """M1's condition on a matched pair: newer, or the delete flag differs (NULL: no)."""
    return F.coalesce(
        (F.col("t__" + spec.updated_column) < F.col("s__" + spec.updated_column))
        | (F.col("t___is_deleted") != F.col("s___is_deleted")), F.lit(False))


def _merged_columns(spec: TableSpec, t_in: Column, s_in: Column, now_c: Column) -> list[Column]:
    """Per-column MERGE result over a joined row (``t__*`` / ``s__*`` columns), then
    whether the merge changed the row (``_changed``)."""
    keys = list(spec.keys)
    is_update = t_in & s_in & update_guard(spec)
    is_insert = ~t_in
    changed = is_insert | is_update

    def pick(name: str, when_changed: Column, otherwise: Column) -> Column:
        return F.when(changed, when_changed).otherwise(otherwise).alias(name)

    out = []
    for c in spec.column_names:
        if c in keys:
            out.append(F.when(t_in, F.col("t__" + c)).otherwise(F.col("s__" + c)).alias(c))
        elif c == spec.created_column:
            out.append(F.when(is_insert, F.col("s__" + c)).otherwise(F.col("t__" + c)).alias(c))
        else:
            out.append(pick(c, F.col("s__" + c), F.col("t__" + c)))
    op = (F.when(is_insert, F.lit("INSERT")).when(is_update, F.lit("UPDATE"))
           .otherwise(F.col("t___cdc_operation")))
    out += [
        op.alias("_cdc_operation"),
        pick("_cdc_timestamp", now_c, F.col("t___cdc_timestamp")),
        pick("_is_deleted", F.col("s___is_deleted"), F.col("t___is_deleted")),
        pick("_is_current", F.lit(True), F.col("t___is_current")),
        pick("_pipeline_name", F.col("s___pipeline_name"), F.col("t___pipeline_name")),
        pick("_batch_id", F.col("s___batch_id"), F.col("t___batch_id")),
        pick("_run_id", F.col("s___run_id"), F.col("t___run_id")),
        F.when(is_insert, now_c).otherwise(F.col("t___created_at")).alias("_created_at"),
        pick("_updated_at", now_c, F.col("t___updated_at")),
        changed.alias(CHANGED),
    ]
    return out


def _insert_columns(spec: TableSpec, now_c: Column) -> list[Column]:
    return [*[F.col("s__" + c).alias(c) for c in spec.column_names],
            F.lit("INSERT").alias("_cdc_operation"), now_c.alias("_cdc_timestamp"),
            F.col("s___is_deleted").alias("_is_deleted"), F.lit(True).alias("_is_current"),
            F.col("s___pipeline_name").alias("_pipeline_name"),
            F.col("s___batch_id").alias("_batch_id"), F.col("s___run_id").alias("_run_id"),
            now_c.alias("_created_at"), now_c.alias("_updated_at"), F.lit(True).alias(CHANGED)]


CHANGED = "_changed"
SOURCE_META = ("_pipeline_name", "_batch_id", "_run_id", "_is_deleted")


def _source_side(src: DataFrame, spec: TableSpec) -> DataFrame:
    return src.select(*[F.col(c).alias("s__" + c) for c in [*spec.column_names, *SOURCE_META]])


def _target_side(target: DataFrame, spec: TableSpec) -> DataFrame:
    return target.select(*[F.col(c).alias("t__" + c)
                           for c in [*spec.column_names, *STAGING_META_COLUMNS]])


def _instant(now: dt.datetime | Column) -> Column:
    return now if isinstance(now, Column) else F.lit(now).cast(T.TimestampNTZType())


def _staging_columns(spec: TableSpec) -> list[Column]:
    return [*[F.col(c).cast(t).alias(c) for c, t in spec.columns],
            *[F.col(c).cast(STAGING_META_TYPES[c]).alias(c) for c in STAGING_META_COLUMNS]]


def _same_key(spec: TableSpec) -> list[Column]:
    return [F.col("t__" + k) == F.col("s__" + k) for k in spec.keys]


def merge_upsert(target: DataFrame, raw: DataFrame, spec: TableSpec, now: dt.datetime | Column,
                 batch_id: str | None = None, dedupe: bool = True, mark: bool = False) -> DataFrame:
    """Return the table after merging ``raw`` (RAW rows) into ``target``; with ``mark``
    also whether the merge changed the row (``_changed``).

    ``target`` has the STAGING layout (business columns + metadata); the
    result has the same columns in the same order.  ``now`` is the one
    instant of the merge.  One full outer join on the key: the W1 exchange
    of the source is reused by the join, the target is shuffled once.
    """
    now_c = _instant(now)
    src = source_latest(raw, spec, batch_id) if dedupe else batch_rows(raw, batch_id)
    keys = list(spec.keys)
    src, tgt = _source_side(src, spec), _target_side(target, spec)
    # NULL keys never compare equal: keep them out of the shuffle join.
    src_keyed = src.where(~_any_null(keys, "s__")).withColumn("s__present", F.lit(True))
    tgt_keyed = tgt.where(~_any_null(keys, "t__")).withColumn("t__present", F.lit(True))
    joined = tgt_keyed.join(src_keyed, _same_key(spec), "full_outer")
    merged = joined.select(*_merged_columns(
        spec, F.coalesce(F.col("t__present"), F.lit(False)),
        F.coalesce(F.col("s__present"), F.lit(False)), now_c))
    # Rows that cannot match: target rows kept as they are, source rows inserted.
    kept = (tgt.where(_any_null(keys, "t__"))
               .select(*[F.col("t__" + c).alias(c)
                         for c in [*spec.column_names, *STAGING_META_COLUMNS]], F.lit(False).alias(CHANGED)))
    inserted = src.where(_any_null(keys, "s__")).select(*_insert_columns(spec, now_c))
    return (merged.unionByName(kept).unionByName(inserted)
            .select(*_staging_columns(spec), *([CHANGED] if mark else [])))


def changed_rows(target: DataFrame, src: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys (``s__*``) of the latest rows ``src`` that a merge would insert or update,
    from the key and guard columns alone."""
    guard = [spec.updated_column, "_is_deleted"]
    cols = [*spec.keys, *[c for c in guard if c not in spec.keys]]
    s = src.select(*[F.col(c).alias("s__" + c) for c in cols])
    t = target.select(*[F.col(c).alias("t__" + c) for c in cols], F.lit(True).alias("t__present"))
    return (s.join(t, _same_key(spec), "left").where(F.col("t__present").isNull() | update_guard(spec))
             .select(*["s__" + k for k in spec.keys]))


def merge_counts(staging: DataFrame, batch_id: str | Column | None = None) -> DataFrame:
    """G1: rows of this batch labelled INSERT / UPDATE, one pass, plus M9 text."""
    rows = staging if batch_id is None else staging.where(F.col("_batch_id") == batch_id)
    agg = rows.agg(F.count_if(F.col("_cdc_operation") == "INSERT").alias("rows_inserted"),
                   F.count_if(F.col("_cdc_operation") == "UPDATE").alias("rows_updated"))
    return agg


def merge_message(table: str, counts: DataFrame) -> DataFrame:
    """M9: ``MERGE_<TABLE> COMPLETE | INSERTED: n | UPDATED: m`` (fixed text)."""
    return counts.withColumn(
        "result_msg",
        F.concat(F.lit(f"MERGE_{table.upper()} COMPLETE | INSERTED: "),
                 F.col("rows_inserted").cast("string"), F.lit(" | UPDATED: "),
                 F.col("rows_updated").cast("string")))


def current_rows(staging: DataFrame) -> DataFrame:
    """Active rows: current and not soft-deleted."""
    return staging.where(F.col("_is_current") & ~F.col("_is_deleted"))
