"""Whole-table ingestion driven by configuration rows.

``ingest_table`` runs one config row:
log START -> watermark lookup -> extract -> land -> typed RAW load (bad
rows aside) -> optional rules -> MERGE into STAGING -> advance watermark
-> log END.  Only control rows touch the driver; the data steps are Spark
jobs (scan + filter + write; scan + project + write; window + join +
write).  Crash order: STAGING is committed before the watermark moves and
the watermark before the END event, so a crash only repeats work, which
the idempotent merge absorbs.

``ingest_all`` runs every active row, a few tables at a time (the
reference's table-level parallelism is 3), each table in its own driver
thread submitting its own Spark jobs; a failing table does not stop the
others.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from sluice.functions.scalar import batch_id as make_batch_id
from sluice.operators import quality as Q
from sluice.operators.evolution import widen_schema
from sluice.operators.runlog import (error_row, errors_current, failed_since, open_errors,
                                     resolution_row, run_log_current)
from sluice.operators.watermark import watermark_current, watermark_lookup
from sluice.session import delete, exists
from sluice.sinks.staging import StagingTable
from sluice.sinks.write import (append_log, compact_log, land, load_raw, read_log, read_raw,
                                read_rejects)
from sluice.sources.extract import extract, landing_path, read_landing, read_source
from sluice.spec import (AUDIT_COLUMNS, CONFIG_DEFAULTS, ERROR_LOG_SCHEMA, RUN_EVENT_SCHEMA,
                         SCHEMA_LOG_SCHEMA, STAGING_META_COLUMNS, WATERMARK_LOG_SCHEMA, DQ_RESULTS_SCHEMA,
                         TableSpec, UnknownTableError, spec_for, spec_from_schema)


class BatchRejected(RuntimeError):
    """A REJECT rule failed: the batch is refused and nothing is merged."""


class RowCountMismatch(RuntimeError):
    """Landed rows are not all accounted for by RAW (loaded + rejected)."""


@dataclass
class Control:
    """Append-only control logs under one folder (shared storage)."""

    spark: SparkSession
    root: str

    @property
    def run_events_path(self):
        return f"{self.root}/run_events"

    @property
    def watermark_path(self):
        return f"{self.root}/watermark_log"

    @property
    def error_path(self):
        return f"{self.root}/error_log"

    @property
    def dq_results_path(self):
        return f"{self.root}/dq_results"

    @property
    def schema_path(self):
        return f"{self.root}/schema_log"

    def _read(self, path, schema) -> DataFrame:
        return read_log(self.spark, path, schema)

    def run_events(self, since: dt.date | None = None) -> DataFrame:
        return read_log(self.spark, self.run_events_path, RUN_EVENT_SCHEMA, since)

    def runs(self, since: dt.date | None = None) -> DataFrame:
        """G4 over the run events; ``since`` limits the read to runs started
        on or after that day (partition pruning on ``event_date``)."""
        return run_log_current(self.run_events(since))

    def failed_recently(self, now: dt.datetime, hours: int = 24) -> DataFrame:
        """N2/N8 reading only the event days the window can touch."""
        since = (now - dt.timedelta(hours=hours)).date()
        return failed_since(self.runs(since), now, hours)

    def watermark_log(self) -> DataFrame:
        return self._read(self.watermark_path, WATERMARK_LOG_SCHEMA)

    def watermarks(self) -> DataFrame:
        return watermark_current(self.watermark_log())

    def errors(self) -> DataFrame:
        """Current state of each error (its resolution row, once appended)."""
        return errors_current(self._read(self.error_path, ERROR_LOG_SCHEMA))

    def schema_changes(self) -> DataFrame:
        """Q14: columns that loads brought, lacked or widened, or that were left out."""
        return self._read(self.schema_path, SCHEMA_LOG_SCHEMA)

    def dq_report(self) -> DataFrame:
        """N5 + J4: DQ results with their runs' status, per pipeline, day, severity."""
        return Q.dq_report(self.dq_results(), self.runs())

    def open_errors(self) -> DataFrame:
        """Unresolved errors with their run's status, newest first."""
        return open_errors(self.errors(), self.runs())

    def resolve_error(self, error_id: str, resolved_by: str, when: dt.datetime,
                      notes: str | None = None) -> None:
        """Append the resolution of one error (control rows only)."""
        row = self.errors().where(F.col("error_id") == error_id).first()
        if row is None:
            raise KeyError(f"no error {error_id!r}")
        self.error(resolution_row(row.asDict(), resolved_by, when, notes))

    def dq_results(self) -> DataFrame:
        return self._read(self.dq_results_path, DQ_RESULTS_SCHEMA)

    def compact(self) -> int:
        """Fold each log's one-row appends into one folder per day."""
        return sum(compact_log(self.spark, p) for p in (
            self.run_events_path, self.watermark_path, self.error_path, self.dq_results_path))

    def event(self, **row):
        append_log(self.spark, [row], RUN_EVENT_SCHEMA, self.run_events_path,
                   date_column="event_time")

    def advance_watermark(self, **row):
        append_log(self.spark, [row], WATERMARK_LOG_SCHEMA, self.watermark_path)

    def error(self, row: dict):
        append_log(self.spark, [row], ERROR_LOG_SCHEMA, self.error_path)


@dataclass
class RunResult:
    pipeline_name: str
    source_table: str
    run_id: str
    status: str
    rows_extracted: int = 0
    rows_loaded: int = 0
    rows_rejected: int = 0
    rows_quarantined: int = 0
    rows_inserted: int = 0
    rows_updated: int = 0
    watermark_start: str | None = None
    watermark_end: str | None = None
    error: str | None = None
    staging_path: str | None = None
    extra: dict = field(default_factory=dict)


def _cfg(cfg: Mapping) -> dict:
    out = dict(CONFIG_DEFAULTS)
    out.update({k: v for k, v in dict(cfg).items() if v is not None})
    return out


def _error_type(exc: Exception, step: str) -> str:
    """The error log's type of a failure: its own kind, else the step it fell in."""
    if isinstance(exc, BatchRejected):
        return "DQ"
    if isinstance(exc, RowCountMismatch):
        return "LOAD"
    if isinstance(exc, KeyError):
        return "TRANSFORMATION"
    text = str(exc)
    if "java.sql.SQL" in text or "java.net." in text or isinstance(exc, ConnectionError):
        return "CONNECTION"
    return step


def _target_spec(spark: SparkSession, c: Mapping, specs, targets) -> TableSpec:
    """The target's spec: a known one, else (P2) the column list of the target as it
    is now (``targets`` by sink table, or a catalogue table of that name) with the
    row's ``primary_key_columns`` and CDC column."""
    try:
        return spec_for(c["sink_table"], specs)
    except UnknownTableError:
        keys = [k.strip() for k in (c.get("primary_key_columns") or "").split(",") if k.strip()]
        schema = (targets or {}).get(c["sink_table"])
        if schema is None and keys and spark.catalog.tableExists(c["sink_table"]):
            schema = spark.table(c["sink_table"]).schema
        if schema is None or not keys or not c.get("cdc_column"):
            raise
        names = {f.name.lower(): f.name for f in schema.fields}
        unknown = [k for k in [*keys, c["cdc_column"]] if k.lower() not in names]
        if unknown:
            raise ValueError(f"{c['pipeline_name']}: {unknown} not in {c['sink_table']}")
        business = T.StructType([f for f in schema.fields if not f.name.startswith("_")])
        return spec_from_schema(c["sink_table"], business, [names[k.lower()] for k in keys],
                                names[c["cdc_column"].lower()])


def ingest_table(spark: SparkSession, cfg: Mapping, *, control: Control, lake_root: str,
                 now: dt.datetime, batch_id: str | None = None, run_id: str | None = None,
                 specs: dict[str, TableSpec] | None = None,
                 rules: list[Q.Rule] | None = None,
                 refs: dict[str, DataFrame] | None = None,
                 clock: Callable[[], dt.datetime] | None = None,
                 watermark_mode: str = "data", cluster_by: tuple[str, ...] = (),
                 lookback: dt.timedelta | None = None,
                 targets: Mapping[str, T.StructType] | None = None, evolve: bool = False,
                 source_options: Mapping | None = None,
                 source_reader: Callable[[SparkSession, dict], DataFrame] | None = None
                 ) -> RunResult:
    """Ingest one configured table.  See the module docstring for the steps.

    ``now`` is the run's one instant (batch id, landing path, audit and
    merge timestamps); ``clock`` stamps the run-log events (defaults to
    ``now``).  ``watermark_mode='data'`` stores ``max(cdc_column)`` of the
    extract; ``'clock'`` stores ``now`` as the reference does.  ``lookback``
    (X4) reads that much before the watermark again, for late rows.  A sink
    table without a built-in spec needs its schema (in ``targets`` or the
    catalogue) and the row's key columns.  ``source_options`` go to ``read_source``.
    With ``evolve`` (Q14) new source columns join the table and a column whose type
    changed takes the least common supertype; without it the column list is the
    target's.  Either way every difference is a row of the schema log.
    """
    step = "UNKNOWN"
    rules_tmp = None
    c = _cfg(cfg)
    clock = clock or (lambda: now)
    batch_id = batch_id or make_batch_id(now)
    run_id = run_id or str(uuid.uuid4())
    pname, stable = c["pipeline_name"], c["source_table"]
    load_type = (c.get("load_type") or "FULL").upper()
    res = RunResult(pname, stable, run_id, "RUNNING")
    control.event(event="START", run_id=run_id, pipeline_name=pname, source_table=stable,
                  event_time=clock(), status="RUNNING",
                  adf_pipeline_name=c.get("adf_pipeline_name", "ingest_table"),
                  adf_trigger_name=c.get("adf_trigger_name"))
    try:
        spec = _target_spec(spark, c, specs, targets)                 # M10: clear error
        if load_type != "FULL" and not c.get("cdc_column"):
            raise ValueError(f"{pname}: load_type {load_type} needs cdc_column")
        # Stored watermark of (pipeline, table), default when none.
        wm, step = None, "WATERMARK"
        if load_type != "FULL":
            wm_row = watermark_lookup(control.watermarks(), pname, stable,
                                      c.get("cdc_column_type")).first()
            wm = wm_row["watermark"]
        res.watermark_start = wm
        # Extract; K1: land with observed count and max(cdc).
        step = "EXTRACTION"
        reader = source_reader or (lambda s, conf: read_source(s, conf, **(source_options or {})))
        src = extract(reader(spark, c), load_type, c.get("cdc_column"), wm,
                      lookback=lookback, cdc_column_type=c.get("cdc_column_type"))
        lpath = landing_path(f"{lake_root}/landing", c.get("adls_container"),
                             c.get("adls_folder_path") or pname, stable, now)
        landed = land(src, lpath, batch_id, c.get("cdc_column") if load_type != "FULL" else None)
        res.rows_extracted = landed.rows
        if landed.rows == 0:
            res.status = "SKIPPED"                                    # E8
            res.watermark_end = wm
        else:
            step = "LOAD"
            # P1/P3/P4 + K2/K3: typed RAW load, target-driven, bad rows aside.
            raw_path = f"{lake_root}/raw/{c.get('sink_schema') or 'RAW'}/{spec.name}"
            stg_path = f"{lake_root}/staging/{c.get('sink_schema') or 'STAGING'}/{spec.name}"
            landing = read_landing(spark, lpath, batch_id)
            spec = _evolved(spark, control, spec, landing.schema, stg_path, evolve, res, batch_id, clock())
            raw_res = load_raw(landing, spec.business_schema(),
                               raw_path, pipeline_name=pname, batch_id=batch_id, run_id=run_id,
                               load_type=load_type, now=now)
            res.rows_rejected = raw_res.rows_rejected
            # Q12: every landed row is either loaded or rejected (counts observed
            # during the two writes); anything else is lost data, so stop here
            if raw_res.rows_loaded + raw_res.rows_rejected != landed.rows:
                raise RowCountMismatch(
                    f"{pname}: landed {landed.rows} rows, RAW holds {raw_res.rows_loaded} "
                    f"loaded + {raw_res.rows_rejected} rejected")
            raw = read_raw(spark, raw_path, raw_res.schema)
            if rules and c.get("dq_enabled", True):
                step = "DQ"
                rules_tmp = f"{lake_root}/work/rules-{run_id}"
                raw, spec = _apply_rules(spark, control, raw, rules, refs or {}, res, lake_root,
                                         now, spec, rules_tmp)
            res.rows_loaded = raw_res.rows_loaded - res.rows_quarantined
            step = "LOAD"
            # M1 + K4: rewrite the files that hold a changed row, append inserts.
            table = StagingTable(spark, stg_path, spec, cluster_by)
            table.evolve(spec)
            counts = table.merge(raw, now, batch_id)
            res.rows_inserted, res.rows_updated = counts["rows_inserted"], counts["rows_updated"]
            res.staging_path = stg_path
            # K7: advance the watermark only after the merge committed.
            if load_type != "FULL":
                step = "WATERMARK"
                new_wm = (str(landed.max_cdc) if watermark_mode == "data" and
                          landed.max_cdc is not None else now.strftime("%Y-%m-%d %H:%M:%S"))
                res.watermark_end = new_wm
                control.advance_watermark(pipeline_name=pname, source_table=stable,
                                          cdc_column=c.get("cdc_column"), watermark_value=new_wm,
                                          watermark_type=c.get("cdc_column_type") or "TIMESTAMP",
                                          rows_loaded=res.rows_loaded, updated_at=clock(),
                                          seq=int(now.timestamp() * 1e6))
            res.status = "PARTIAL" if (res.rows_rejected or res.rows_quarantined) else "SUCCESS"
    except Exception as exc:  # noqa: BLE001  E6: any failure -> FAILED, watermark kept
        res.status, res.error = "FAILED", f"{type(exc).__name__}: {exc}"
        res.rows_extracted = res.rows_loaded = 0
        control.error(error_row(run_id, pname, stable, _error_type(exc, step), res.error, clock(),
                                "ingest_table"))
    finally:
        if rules_tmp:
            delete(spark, rules_tmp)
    control.event(event="END", run_id=run_id, pipeline_name=pname, source_table=stable,
                  event_time=clock(), status=res.status, rows_extracted=res.rows_extracted,
                  rows_passed_dq=res.extra.get("rows_passed_dq"),
                  rows_failed_dq=res.extra.get("rows_failed_dq"), rows_loaded=res.rows_loaded,
                  watermark_start=res.watermark_start, watermark_end=res.watermark_end,
                  error_message=res.error)
    return res


def _evolved(spark, control, spec, landed, stg_path, evolve, res, batch_id, when) -> TableSpec:
    """Q14: the spec for this load; each difference from the landed columns is logged."""
    table = StagingTable(spark, stg_path, spec)
    current = spec.business_schema()
    if table.exists():        # columns and types that earlier loads brought
        have = T.StructType([f for f in table.schema().fields
                             if f.name not in STAGING_META_COLUMNS and f.name != Q.FLAGS])
        current = widen_schema(current, have)[0] if evolve else current
    source = T.StructType([f for f in landed.fields if f.name not in AUDIT_COLUMNS
                           and f.name.lower() not in ("_is_deleted", "_ingestion_timestamp", "_source_file", "_landing_batch")])
    wide, changes = widen_schema(current, source)
    if not evolve:            # the typed load casts to the target; only unknown columns are left out
        changes = [c | {"change": "IGNORED"} for c in changes if c["change"] == "ADDED"]
    if changes:
        res.extra["schema_changes"] = changes
        append_log(spark, [c | {"run_id": res.run_id, "pipeline_name": res.pipeline_name, "batch_id": batch_id,
                                "logged_at": when} for c in changes], SCHEMA_LOG_SCHEMA, control.schema_path)
    return replace(spec, columns=tuple((f.name, f.dataType) for f in wide.fields)) if evolve else spec


def _apply_rules(spark, control, raw, rules, refs, res, lake_root, now, spec, tmp):
    """Q9: evaluate once; REJECT refuses the batch; QUARANTINE diverts rows; FLAG
    lists the failed rules in the column ``_dq_flags``, which the table then has.

    The evaluated batch feeds the summary, the quarantine write and the merge;
    it is written once as Parquet (the caller deletes it after the merge), so
    the rule joins run once, also when an executor is lost.
    """
    Q.evaluate_rules(raw, rules, refs, f"{tmp}/sets").write.parquet(f"{tmp}/rows")
    evaluated = spark.read.parquet(f"{tmp}/rows")
    qpath = f"{lake_root}/quarantine/{spec.name}/run_id={res.run_id}"
    summary = Q.dq_summary(evaluated, rules)
    rows = summary.collect()  # one row per rule: bounded by the rule count
    # K9 result rows from the collected summary: no second pass over the batch
    small = spark.createDataFrame(rows, summary.schema)
    results = Q.dq_results(small, res.run_id, res.pipeline_name, res.source_table, now, qpath)
    results.coalesce(1).write.mode("append").parquet(
        f"{control.dq_results_path}/writer={uuid.uuid4().hex}")
    if rows:
        res.extra["rows_passed_dq"] = rows[0]["rows_passed_dq"]
        res.extra["rows_failed_dq"] = rows[0]["rows_failed_dq"]
    if any(r["action_taken"] == "REJECT" for r in rows):
        raise BatchRejected(f"{res.pipeline_name}: batch refused by a REJECT rule")
    breached = [r["rule_name"] for r in rows
                if r["rule_type"] == "THRESHOLD" and r["action_taken"] != "NONE"]
    obs = Observation(f"quarantine_{res.run_id}")
    Q.quarantined(evaluated, rules, breached).observe(obs, F.count(F.lit(1)).alias("n")) \
        .write.mode("overwrite").parquet(qpath)
    res.rows_quarantined = int(obs.get.get("n") or 0)
    keep = Q.loadable(evaluated, rules, breached)
    if any((r.action_on_failure or "").upper() == "FLAG" for r in rules):
        flags = ((Q.FLAGS, T.ArrayType(T.StringType())),)
        return keep.select(*raw.columns, Q.FLAGS), replace(spec, columns=spec.columns + flags)
    return keep.select(*raw.columns), spec


def config_violations(config: DataFrame) -> DataFrame:
    """V1-V3 on the config table: allowed load and source types, required
    names, one row per pipeline_name.  One row per (pipeline_name, check)."""
    from sluice.spec import LOAD_TYPES, SOURCE_TYPES
    name = F.col("pipeline_name")
    checks = [
        Q.domain_violations(config, "load_type", LOAD_TYPES)
         .select(name, F.lit("load_type").alias("check_name")),
        Q.domain_violations(config, "source_type", SOURCE_TYPES)
         .select(name, F.lit("source_type").alias("check_name")),
        config.where(F.col("source_table").isNull() | F.col("sink_table").isNull())
              .select(name, F.lit("not_null").alias("check_name")),
        Q.unique_violations(config, ["pipeline_name"])
         .select(name, F.lit("unique_pipeline_name").alias("check_name")),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def active_configs(config: DataFrame) -> list[dict]:
    """S1 + V2: active config rows with defaults filled, in pipeline_id order
    (control rows only reach the driver)."""
    from sluice.spec import CONFIG_DEFAULTS
    rows = (Q.with_defaults(config, CONFIG_DEFAULTS)
              .where(F.coalesce(F.col("is_active"), F.lit(True)))
              .orderBy("pipeline_id").collect())
    return [r.asDict() for r in rows]


def ingest_all(spark: SparkSession, config: DataFrame | list[dict], *, control: Control,
               lake_root: str, now: dt.datetime, parallelism: int = 3,
               run_ids: Mapping[str, str] | None = None, **kw) -> list[RunResult]:
    """Every active table, ``parallelism`` at a time; failures stay per table.

    A config table is validated first (``config_violations``); rows that break
    a check are not run and are logged as FAILED runs with the reason.
    """
    bad: dict[str, str] = {}
    if isinstance(config, DataFrame):
        for r in config_violations(config).collect():   # control rows only
            bad.setdefault(r["pipeline_name"], r["check_name"])
        rows = active_configs(config)
    else:
        rows = [r for r in config if r.get("is_active", True)]
    rows = sorted(rows, key=lambda r: r.get("pipeline_id") or 0)
    batch = make_batch_id(now)
    run_ids = run_ids or {}

    def one(cfg):
        if cfg["pipeline_name"] in bad:
            return _refused(control, cfg, now, run_ids.get(cfg["pipeline_name"]),
                            f"config check failed: {bad[cfg['pipeline_name']]}")
        return ingest_table(spark, cfg, control=control, lake_root=lake_root, now=now,
                            batch_id=batch, run_id=run_ids.get(cfg["pipeline_name"]), **kw)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(one, rows))


def _refused(control: Control, cfg: Mapping, now: dt.datetime, run_id: str | None,
             reason: str) -> RunResult:
    run_id = run_id or str(uuid.uuid4())
    res = RunResult(cfg["pipeline_name"], cfg.get("source_table"), run_id, "FAILED", error=reason)
    for ev, st in (("START", "RUNNING"), ("END", "FAILED")):
        control.event(event=ev, run_id=run_id, pipeline_name=res.pipeline_name,
                      source_table=res.source_table, event_time=now, status=st,
                      rows_extracted=0, rows_loaded=0,
                      error_message=reason if ev == "END" else None)
    control.error(error_row(run_id, res.pipeline_name, res.source_table, "TRANSFORMATION",
                            reason, now, "config_check"))
    return res


def reprocess_batch(spark: SparkSession, landing: str, batch_id: str, spec: TableSpec,
                    staging: StagingTable, now: dt.datetime, raw_path: str, *,
                    pipeline_name: str, run_id: str, load_type: str = "REPLAY") -> dict:
    """Merge one landed batch again, without extracting."""
    load_raw(read_landing(spark, landing, batch_id), spec.business_schema(), raw_path,
             pipeline_name=pipeline_name, batch_id=batch_id, run_id=run_id,
             load_type=load_type, now=now)
    return staging.merge(read_raw(spark, raw_path), now, batch_id)


__all__ = ["Control", "RunResult", "BatchRejected", "RowCountMismatch", "ingest_table", "ingest_all", "list_tables",
           "active_configs", "config_violations", "reprocess_batch", "exists", "read_rejects"]


def list_tables(spark: SparkSession, lake_root: str, layer: str = "staging") -> DataFrame:
    """The tables of a layer (``raw`` or ``staging``) as (schema, table) rows,
    from the lake's folder listing (metadata only, no data read)."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{lake_root}/{layer}")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    rows = []
    if fs.exists(root):
        for sch in fs.listStatus(root):
            if sch.isDirectory():
                rows += [(sch.getPath().getName(), t.getPath().getName())
                         for t in fs.listStatus(sch.getPath()) if t.isDirectory()]
    return spark.createDataFrame(sorted(rows), "table_schema string, table_name string")
