"""K1, K3, K8, K9: landing, RAW load with bad-row split, logs.

Counts come from ``Observation`` on the write itself: one scan gives the
rows written and the largest CDC value, with no second pass.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from sluice.operators.projection import BAD_COLUMNS, flag_bad_rows, stamp_audit


@dataclass
class LandResult:
    path: str
    rows: int
    max_cdc: object = None


def land(df: DataFrame, path: str, batch_id: str, cdc_column: str | None = None) -> LandResult:
    """K1: write the extract as snappy Parquet under ``path/_landing_batch=<id>``.

    A rerun of the same batch replaces its folder; other batches of the day
    stay (raw history is kept).  Rows copied and, when given, ``max(cdc)``
    (the data-driven next watermark, G6) are observed during the write.
    """
    metrics = [F.count(F.lit(1)).alias("rows")]
    if cdc_column:
        metrics.append(F.max(cdc_column).alias("max_cdc"))
    obs = Observation(f"land_{batch_id}_{abs(hash(path)) % 10**8}")
    (df.observe(obs, *metrics).write.mode("overwrite").option("compression", "snappy")
       .parquet(f"{path}/_landing_batch={batch_id}"))
    got = obs.get
    return LandResult(path, int(got.get("rows", 0) or 0), got.get("max_cdc"))


@dataclass
class RawLoadResult:
    path: str
    rows_loaded: int
    rows_rejected: int
    schema: T.StructType | None = None


def load_raw(landed: DataFrame, target: T.StructType, path: str, *, pipeline_name: str,
             batch_id: str, run_id: str, load_type: str, now: dt.datetime,
             max_lengths=None, allow_truncation: bool = True) -> RawLoadResult:
    """K2+K3+K8: truncate and reload RAW from the landing, bad rows aside.

    One projection casts to the target types and lists failing columns;
    one write, partitioned by ``_rejected``, puts good rows and rejects in
    place in a single scan.  The whole folder is overwritten, partitions
    without rows in this batch included (RAW holds the current batch only).
    """
    keep = [f.name for f in target.fields]
    extra = [c for c in ("_source_file", "_is_deleted") if c in landed.columns
             and c.lower() not in [k.lower() for k in keep]]
    fields = list(target.fields) + [T.StructField(c, landed.schema[c].dataType) for c in extra]
    typed = flag_bad_rows(landed, T.StructType(fields), max_lengths=max_lengths,
                          allow_truncation=allow_truncation)
    stamped = stamp_audit(typed, pipeline_name, batch_id, run_id, load_type, now)
    stamped = stamped.withColumn("_rejected", F.size(BAD_COLUMNS) > 0)
    obs = Observation(f"raw_{batch_id}_{abs(hash(path)) % 10**8}")
    (stamped.observe(obs, F.count_if(~F.col("_rejected")).alias("good"),
                     F.count_if(F.col("_rejected")).alias("bad"))
            .write.mode("overwrite").option("partitionOverwriteMode", "static")
            .partitionBy("_rejected").parquet(path))
    got = obs.get
    return RawLoadResult(path, int(got.get("good", 0) or 0), int(got.get("bad", 0) or 0),
                         stamped.schema)


def _raw_part(spark: SparkSession, path: str, rejected: bool,
              schema: T.StructType | None) -> DataFrame:
    """Rows of one ``_rejected`` partition; none where the batch has none."""
    from sluice.session import has_data
    folder = f"{path}/_rejected={str(rejected).lower()}"
    if has_data(spark, folder):
        return spark.read.option("basePath", path).parquet(folder).drop("_rejected")
    if schema is not None:
        return spark.createDataFrame([], schema).drop("_rejected")
    return spark.read.parquet(path).where(F.lit(False)).drop("_rejected")


def read_raw(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """RAW rows that converted cleanly (partition ``_rejected=false`` only).

    ``schema`` (of the load) is needed only where the batch may be empty.
    """
    return _raw_part(spark, path, False, schema).drop(BAD_COLUMNS)


def read_rejects(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """K8: skipped incompatible rows with the list of failing columns."""
    return _raw_part(spark, path, True, schema)


def write_rejects(bad: DataFrame, path: str) -> None:
    """K8 for callers holding a rejects DataFrame (e.g. from ``split_bad_rows``)."""
    bad.write.mode("append").parquet(path)


def append_log(spark: SparkSession, rows: list[dict], schema: T.StructType, path: str,
               date_column: str | None = None) -> None:
    """Append control rows (run events, watermark updates, errors).

    Control state is append-only; current state is derived by aggregation,
    so parallel table loads never update the same row.  Every append goes
    to its own ``writer=<id>`` folder: concurrent appends from parallel
    table loads never share a job's temporary folder.  With ``date_column``
    the rows land under ``event_date=<day>/`` so time-bounded monitoring
    reads prune to the days they need.
    """
    df = spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows],
                               schema)
    target = path
    if date_column:
        days = {r.get(date_column).date() for r in rows if r.get(date_column) is not None}
        if len(days) == 1:
            target = f"{path}/event_date={days.pop().isoformat()}"
    df.coalesce(1).write.mode("append").parquet(f"{target}/writer={uuid.uuid4().hex}")


def read_log(spark: SparkSession, path: str, schema: T.StructType,
             since: dt.date | None = None) -> DataFrame:
    """Appended control rows (folder columns dropped).

    ``since`` keeps the ``event_date=`` folders from that day on: a
    partition filter, so older days are not listed into the scan.
    """
    from sluice.session import has_data
    if not has_data(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.parquet(path)
    if since is not None and "event_date" in df.columns:
        df = df.where(F.col("event_date") >= F.lit(since))
    # exact duplicates can exist for a moment while a compaction swaps folders
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]).dropDuplicates()


def compact_log(spark: SparkSession, path: str) -> int:
    """Rewrite a control log's many one-row ``writer=`` folders as one folder
    per day (or one in all), then delete exactly the folders that were read.

    Appends that arrive meanwhile land in new folders and are kept; readers
    drop the exact duplicates visible between the write and the delete.
    Returns the number of folders folded in.
    """
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return 0
    groups: dict[str, list[str]] = {}
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if name.startswith("event_date=") and st.isDirectory():
            groups[name] = [c.getPath().toString() for c in fs.listStatus(st.getPath())
                            if c.getPath().getName().startswith("writer=")]
        elif name.startswith("writer="):
            groups.setdefault("", []).append(st.getPath().toString())
    folded = 0
    for day, folders in groups.items():
        if len(folders) < 2:
            continue
        rows = spark.read.parquet(*folders).dropDuplicates()
        dest = f"{path}/{day + '/' if day else ''}writer=compact-{uuid.uuid4().hex}"
        rows.coalesce(1).write.parquet(dest)
        for f in folders:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f), True)
        folded += len(folders)
    return folded


def write_dq_results(results: DataFrame, path: str) -> None:
    """K9: append DQ result rows."""
    results.write.mode("append").parquet(path)
