"""Typed select list, audit stamp, bad-row split, conversion."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sluice.functions.scalar import safe_cast, set_names
from sluice.spec import AUDIT_COLUMNS

BAD_COLUMNS = "_bad_columns"


def _field_map(df: DataFrame) -> dict[str, T.StructField]:
    return {f.name.lower(): f for f in df.schema.fields}


def typed_projection(df: DataFrame, target: T.StructType, *, keep_bad_columns: bool = False,
                     max_lengths: dict[str, int] | None = None,
                     allow_truncation: bool = True,
                     booleans_as_numbers: bool = False) -> DataFrame:
    """Select every target column, in ordinal order, from the same-named field.

    Field names match without regard to case (landed files hold lower-case
    names).  Each value is cast with ``try_cast`` to the target type; a
    field missing from the input gives NULL.  With ``keep_bad_columns`` an
    array column lists the fields whose non-NULL value did not convert;
    that is the bad-row test of P4, computed in the same projection.

    ``max_lengths`` limits string columns: cut to length when
    ``allow_truncation`` holds, else an over-long value is a bad value (P5).
    """
    fields = _field_map(df)
    max_lengths = {k.lower(): v for k, v in (max_lengths or {}).items()}
    cols, bad = [], []
    for f in target.fields:
        src = fields.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        raw = F.col(f"`{src.name}`")
        conv = safe_cast(raw, src.dataType, f.dataType, booleans_as_numbers)
        limit = max_lengths.get(f.name.lower())
        if limit is not None and isinstance(f.dataType, T.StringType):
            if allow_truncation:
                conv = F.substring(conv, 1, limit)
            else:
                conv = F.when(F.length(conv) <= limit, conv)
        cols.append(conv.alias(f.name))
        if conv is not raw:     # a value that keeps its type always fits
            bad.append(F.when(raw.isNotNull() & conv.isNull(), F.lit(f.name)))
    if keep_bad_columns:
        arr = set_names(bad) if bad else F.array().cast("array<string>")
        cols.append(arr.alias(BAD_COLUMNS))
    return df.select(*cols)


def flag_bad_rows(df: DataFrame, target: T.StructType, **kw) -> DataFrame:
    """Typed projection plus ``_bad_columns`` (empty array = good row)."""
    return typed_projection(df, target, keep_bad_columns=True, **kw)


def split_bad_rows(df: DataFrame, target: T.StructType, **kw) -> tuple[DataFrame, DataFrame]:
    """(good, bad) over one projection.

    A row is bad when some field is set but does not convert to its target
    type.  Good rows carry the typed target columns; bad rows also keep the
    list of failing columns.  For a single pass at scale, write
    ``flag_bad_rows`` once partitioned by ``size(_bad_columns) > 0`` (see
    ``sinks.load_raw``) instead of evaluating both filters.
    """
    flagged = flag_bad_rows(df, target, **kw)
    good = flagged.where(F.size(BAD_COLUMNS) == 0).drop(BAD_COLUMNS)
    bad = flagged.where(F.size(BAD_COLUMNS) > 0)
    return good, bad


def convert(df: DataFrame, target: T.StructType, allow_truncation: bool = True,
            max_lengths: dict[str, int] | None = None) -> DataFrame:
    """P5: copy-time conversion: truncation allowed, booleans stay booleans."""
    return typed_projection(df, target, max_lengths=max_lengths,
                            allow_truncation=allow_truncation, booleans_as_numbers=False)


def stamp_audit(df: DataFrame, pipeline_name: str, batch_id: str, run_id: str, load_type: str,
                now: dt.datetime | Column, source_file: Column | str | None = None) -> DataFrame:
    """The five lineage columns plus the two the merge reads.

    ``_source_file`` comes from ``_metadata.file_path`` captured at read
    time (a ``_source_file`` column already on ``df``), or the given value.
    ``_ingestion_timestamp`` is the run's ``now``; ``_is_deleted`` keeps a
    source flag and is FALSE where there is none.
    """
    now_c = now if isinstance(now, Column) else F.lit(now).cast(T.TimestampNTZType())
    if isinstance(source_file, Column):
        sf = source_file
    elif isinstance(source_file, str):
        sf = F.lit(source_file)
    elif "_source_file" in df.columns:
        sf = F.col("_source_file")
    else:
        sf = F.lit(None).cast("string")
    deleted = (F.coalesce(F.col("_is_deleted").cast("boolean"), F.lit(False))
               if "_is_deleted" in df.columns else F.lit(False))
    base = [c for c in df.columns if c not in AUDIT_COLUMNS
            and c not in ("_is_deleted", "_ingestion_timestamp")]
    return df.select(*[F.col(f"`{c}`") for c in base],
                     F.lit(pipeline_name).alias("_pipeline_name"),
                     F.lit(batch_id).alias("_batch_id"),
                     F.lit(run_id).alias("_run_id"),
                     F.lit(load_type).alias("_load_type"),
                     sf.alias("_source_file"),
                     deleted.alias("_is_deleted"),
                     now_c.alias("_ingestion_timestamp"))


def lineage(df: DataFrame, keys: list[str]) -> DataFrame:
    """Which pipeline / batch / run / file a record came from."""
    cols = [c for c in ("_pipeline_name", "_batch_id", "_run_id", "_load_type", "_source_file")
            if c in df.columns]
    return df.select(*keys, *cols)
