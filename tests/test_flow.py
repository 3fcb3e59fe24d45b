"""Lifecycle: initial then incremental run, failure path, skipped run, replay."""

import datetime as dt

from pyspark.sql import functions as F

from sluice.plans.flow import Control, ingest_all, ingest_table, reprocess_batch
from sluice.sinks.staging import StagingTable, read_staging
from sluice.spec import BUSINESS_SPECS
from sluice.sources.extract import landing_path

from conftest import SF_SMALL

NOW1, NOW2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)


def _src(spark, path):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    o.select(F.col("o_orderkey").alias("po_id"),
             F.concat(F.lit("PO-"), F.col("o_orderkey").cast("string")).alias("po_number"),
             F.col("o_totalprice").alias("total_amount"), F.lit("USD").alias("currency"),
             F.col("o_orderdate").alias("created_at"), F.col("o_orderdate").alias("updated_at")) \
     .write.mode("overwrite").parquet(path)


def _cfg(path, **kw):
    c = {"pipeline_id": 1, "pipeline_name": "pl_po", "source_type": "PARQUET",
         "source_server": path.rsplit("/", 1)[0], "source_table": path.rsplit("/", 1)[1],
         "load_type": "CDC", "cdc_column": "updated_at", "sink_table": "STG_PURCHASE_ORDERS",
         "adls_container": "raw", "adls_folder_path": "po"}
    c.update(kw)
    return c


def test_initial_then_incremental(spark, work):
    src = work + "/src/po"
    _src(spark, src)
    ctl = Control(spark, work + "/control")
    r1 = ingest_table(spark, _cfg(src), control=ctl, lake_root=work, now=NOW1, run_id="r1")
    n = spark.read.parquet(src).count()
    assert r1.status == "SUCCESS" and r1.rows_extracted == n and r1.rows_inserted == n
    assert r1.watermark_start == "1900-01-01 00:00:00"
    r2 = ingest_table(spark, _cfg(src), control=ctl, lake_root=work, now=NOW2, run_id="r2")
    # '>=' re-reads rows at the watermark; the merge leaves them unchanged
    assert r2.status == "SUCCESS" and 0 < r2.rows_extracted < n
    assert r2.rows_inserted == 0 and r2.rows_updated == 0
    stg = read_staging(spark, r1.staging_path)
    assert stg.count() == n and stg.where("_batch_id <> 'BATCH-20250101-000000'").count() == 0
    runs = {r["run_id"]: r for r in ctl.runs().collect()}
    assert runs["r1"]["status"] == "SUCCESS" and runs["r2"]["rows_extracted"] == r2.rows_extracted
    wm = ctl.watermarks().first()
    assert wm["updates"] == 2 and wm["total_rows_loaded"] == n + r2.rows_loaded


def test_failure_keeps_watermark_and_others_run(spark, work):
    src = work + "/src/po"
    _src(spark, src)
    ctl = Control(spark, work + "/control")
    bad = _cfg(src, pipeline_id=2, pipeline_name="pl_bad", sink_table="STG_ORDERS")
    res = ingest_all(spark, [_cfg(src), bad], control=ctl, lake_root=work, now=NOW1)
    st = {r.pipeline_name: r.status for r in res}
    assert st == {"pl_po": "SUCCESS", "pl_bad": "FAILED"}
    assert ctl.watermarks().where("pipeline_name = 'pl_bad'").count() == 0
    errs = ctl.errors().collect()
    assert len(errs) == 1 and "STG_ORDERS" in errs[0]["error_message"]


def test_skipped_when_nothing_new(spark, work):
    src = work + "/src/po"
    _src(spark, src)
    ctl = Control(spark, work + "/control")
    ctl.advance_watermark(pipeline_name="pl_po", source_table="po", cdc_column="updated_at",
                          watermark_value="2100-01-01 00:00:00", watermark_type="TIMESTAMP",
                          rows_loaded=0, updated_at=NOW1, seq=1)
    r = ingest_table(spark, _cfg(src), control=ctl, lake_root=work, now=NOW2)
    assert r.status == "SKIPPED" and r.rows_extracted == 0


def test_replay_is_idempotent(spark, work):
    src = work + "/src/po"
    _src(spark, src)
    ctl = Control(spark, work + "/control")
    r1 = ingest_table(spark, _cfg(src), control=ctl, lake_root=work, now=NOW1, run_id="r1")
    spec = BUSINESS_SPECS["PURCHASE_ORDERS"]
    table = StagingTable(spark, r1.staging_path, spec)
    before = sorted(table.read().collect())
    landing = landing_path(f"{work}/landing", "raw", "po", "po", NOW1)
    counts = reprocess_batch(spark, landing, "BATCH-20250101-000000", spec, table, NOW2,
                             work + "/replay_raw", pipeline_name="pl_po", run_id="r1")
    assert sorted(table.read().collect()) == before
    assert counts["rows_inserted"] == len(before)   # labels of the batch, as the reference counts


def test_rules_quarantine_partial_and_reject_fails(spark, work):
    from sluice.operators.quality import Rule
    src = work + "/src/po"
    _src(spark, src)
    ctl = Control(spark, work + "/control")
    n = spark.read.parquet(src).count()
    quarantine = [Rule("price_range", "RANGE", "total_amount", max_value="100000")]
    r = ingest_table(spark, _cfg(src), control=ctl, lake_root=work, now=NOW1, run_id="q1",
                     rules=quarantine)
    over = spark.read.parquet(src).where("total_amount > 100000").count()
    assert 0 < over < n
    assert r.status == "PARTIAL" and r.rows_quarantined == over
    assert r.rows_loaded == n - over
    assert read_staging(spark, r.staging_path).count() == n - over
    assert ctl.dq_results().count() == 1
    rep = ctl.dq_report().first()
    assert (rep["run_status"], rep["rules"], rep["rules_not_passed"]) == ("PARTIAL", 1, 1)
    assert rep["failed_records"] == over
    # a REJECT rule that fails refuses the whole batch and keeps the watermark
    reject = [Rule("price_cap", "RANGE", "total_amount", max_value="1000",
                   action_on_failure="REJECT")]
    ctl2 = Control(spark, work + "/control2")
    r2 = ingest_table(spark, _cfg(src), control=ctl2, lake_root=work + "/lake2", now=NOW1,
                      run_id="q2", rules=reject)
    assert r2.status == "FAILED" and "REJECT" in r2.error
    assert ctl2.watermarks().count() == 0
    assert ctl2.errors().first()["error_type"] == "DQ"
    assert r2.staging_path is None


def test_run_events_partitioned_by_day(spark, work):
    ctl = Control(spark, work + "/control")
    for day, status in ((1, "FAILED"), (10, "FAILED"), (10, "SUCCESS")):
        t = dt.datetime(2025, 1, day, 12)
        rid = f"r{day}{status}"
        ctl.event(event="START", run_id=rid, pipeline_name="p", source_table="t", event_time=t,
                  status="RUNNING")
        ctl.event(event="END", run_id=rid, pipeline_name="p", source_table="t",
                  event_time=t + dt.timedelta(minutes=5), status=status)
    recent = ctl.failed_recently(dt.datetime(2025, 1, 10, 20), 24)
    assert [r.run_id for r in recent.collect()] == ["r10FAILED"]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert ctl.runs().count() == 3


def test_stream_rerun_without_new_files_changes_nothing(spark, work):
    from sluice.operators.projection import stamp_audit
    from sluice.plans.standins import EVENTS_SPEC
    from sluice.streaming.incremental import stream_landing, stream_merge
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    landing, ckpt = work + "/landing", work + "/ckpt"
    table = StagingTable(spark, work + "/stg", EVENTS_SPEC)
    epochs = []

    def on_batch(df, epoch_id):
        epochs.append(epoch_id)
        rows = df.select("user_id", "event_id", "event_type", "value",
                         F.col("ts").alias("created_at"), F.col("ts").alias("updated_at"))
        table.merge(stamp_audit(rows, "p", f"E{epoch_id}", "s", "STREAM", NOW1), NOW1,
                    f"E{epoch_id}")
    ev.write.mode("append").parquet(landing)
    stream_merge(stream_landing(spark, landing, ev.schema), on_batch, ckpt)
    first = sorted(table.read().collect())
    stream_merge(stream_landing(spark, landing, ev.schema), on_batch, ckpt)
    assert epochs == [0]                      # nothing new: no micro-batch
    assert sorted(table.read().collect()) == first
    assert len(first) == ev.select("user_id").distinct().count()


def test_compact_control_logs(spark, work):
    import os
    from sluice.session import local_path
    ctl = Control(spark, work + "/control")
    for i in range(6):
        t = dt.datetime(2025, 1, 1 + i % 2, 12)
        ctl.event(event="START", run_id=f"r{i}", pipeline_name="p", source_table="t",
                  event_time=t, status="RUNNING")
        ctl.advance_watermark(pipeline_name="p", source_table="t", cdc_column="c",
                              watermark_value=str(i), watermark_type="BIGINT", rows_loaded=1,
                              updated_at=t, seq=i)
    before_runs = sorted(ctl.runs().collect())
    before_wm = ctl.watermarks().collect()
    assert ctl.compact() == 12
    assert sorted(ctl.runs().collect()) == before_runs
    assert ctl.watermarks().collect() == before_wm
    days = os.listdir(local_path(ctl.run_events_path))
    assert sorted(days) == ["event_date=2025-01-01", "event_date=2025-01-02"]
    for d in days:
        assert len(os.listdir(os.path.join(local_path(ctl.run_events_path), d))) == 1


def test_clock_watermark_mode(spark, work):
    src = work + "/src/po"
    _src(spark, src)
    ctl = Control(spark, work + "/control")
    r = ingest_table(spark, _cfg(src), control=ctl, lake_root=work, now=NOW1,
                     watermark_mode="clock")
    assert r.watermark_end == "2025-01-01 00:00:00"
    assert ctl.watermarks().first()["last_watermark_value"] == "2025-01-01 00:00:00"


def test_config_table_validation(spark, work):
    from sluice.plans.flow import config_violations
    from sluice.spec import PIPELINE_CONFIG_SCHEMA
    src = work + "/src/po"
    _src(spark, src)
    good = _cfg(src)
    rows = [good, dict(good, pipeline_id=2, pipeline_name="pl_bad", load_type="DELTA"),
            dict(good, pipeline_id=3)]        # duplicate pipeline_name
    df = spark.createDataFrame([tuple(r.get(f.name) for f in PIPELINE_CONFIG_SCHEMA.fields)
                                for r in rows], PIPELINE_CONFIG_SCHEMA)
    v = {(r["pipeline_name"], r["check_name"]) for r in config_violations(df).collect()}
    assert v == {("pl_bad", "load_type"), ("pl_po", "unique_pipeline_name")}
    ctl = Control(spark, work + "/control")
    res = ingest_all(spark, df, control=ctl, lake_root=work, now=NOW1)
    assert {r.status for r in res} == {"FAILED"}
    assert ctl.runs().where("status = 'FAILED'").count() == 3


def test_error_resolution_closes_it(spark, work):
    src = work + "/src/po"
    _src(spark, src)
    ctl = Control(spark, work + "/control")
    bad = _cfg(src, pipeline_name="pl_bad", sink_table="STG_ORDERS")
    ingest_table(spark, bad, control=ctl, lake_root=work, now=NOW1, run_id="rb")
    opened = ctl.open_errors().collect()
    assert len(opened) == 1 and opened[0]["run_status"] == "FAILED"
    ctl.resolve_error(opened[0]["error_id"], "ops", NOW2, "spec added")
    assert ctl.open_errors().count() == 0
    e = ctl.errors().first()
    assert e["is_resolved"] is True and e["resolved_by"] == "ops"


def test_row_count_mismatch_fails_the_run(spark, work, monkeypatch):
    import sluice.plans.flow as flow
    src = work + "/src/po"
    _src(spark, src)
    real = flow.load_raw

    def lossy(*a, **k):
        r = real(*a, **k)
        r.rows_loaded -= 1          # as if a row went missing between landing and RAW
        return r
    monkeypatch.setattr(flow, "load_raw", lossy)
    ctl = Control(spark, work + "/control")
    r = ingest_table(spark, _cfg(src), control=ctl, lake_root=work, now=NOW1)
    assert r.status == "FAILED" and "RowCountMismatch" in r.error
    assert ctl.errors().first()["error_type"] == "LOAD"
    assert ctl.watermarks().count() == 0 and r.staging_path is None


def test_list_tables(spark, work):
    from sluice.plans.flow import list_tables
    src = work + "/src/po"
    _src(spark, src)
    ingest_table(spark, _cfg(src), control=Control(spark, work + "/control"), lake_root=work,
                 now=NOW1)
    assert [tuple(r) for r in list_tables(spark, work).collect()] == \
        [("STAGING", "PURCHASE_ORDERS")]
    assert list_tables(spark, work, "raw").count() == 1


def test_breached_threshold_acts_as_its_report_says(spark, work):
    from sluice.operators.quality import Rule
    src = work + "/src/po"
    _src(spark, src)
    n = spark.read.parquet(src).count()
    over = spark.read.parquet(src).where("total_amount > 100000").count()
    ctl = Control(spark, work + "/control")
    rules = [Rule("mostly_small", "THRESHOLD", rule_expression="total_amount <= 100000",
                  threshold_pct=100)]
    r = ingest_table(spark, _cfg(src), control=ctl, lake_root=work, now=NOW1, rules=rules)
    assert ctl.dq_results().first()["action_taken"] == "QUARANTINE"
    assert (r.status, r.rows_quarantined) == ("PARTIAL", over)
    # a threshold that the batch meets diverts nothing
    rules[0].threshold_pct = 0
    r = ingest_table(spark, _cfg(src), control=Control(spark, work + "/c2"), lake_root=work + "/2",
                     now=NOW1, rules=rules)
    assert (r.status, r.rows_quarantined, r.rows_loaded) == ("SUCCESS", 0, n)


def test_flag_list_reaches_staging_and_rule_files_are_gone(spark, work):
    from sluice.operators.quality import Rule
    src = work + "/src/po"
    _src(spark, src)
    r = ingest_table(spark, _cfg(src), control=Control(spark, work + "/control"), lake_root=work,
                     now=NOW1, rules=[Rule("dear", "RANGE", "total_amount", max_value="100000",
                                           action_on_failure="FLAG")])
    got = {tuple(x["_dq_flags"]): x["n"] for x in read_staging(spark, r.staging_path)
           .groupBy("_dq_flags").agg(F.count("*").alias("n")).collect()}
    over = spark.read.parquet(src).where("total_amount > 100000").count()
    assert r.status == "SUCCESS" and got[("dear",)] == over and set(got) == {(), ("dear",)}
    import os
    from sluice.session import local_path
    assert os.listdir(local_path(work + "/work")) == []


def test_invalid_rule_rows_are_refused(spark):
    import pytest
    from sluice.operators.quality import rules_from_table
    from sluice.spec import DQ_RULES_SCHEMA

    def table(*rows):
        return spark.createDataFrame([tuple(r.get(f.name) for f in DQ_RULES_SCHEMA.fields)
                                      for r in rows], DQ_RULES_SCHEMA)
    row = {"pipeline_name": "p", "rule_name": "r", "rule_type": "NOT_NULL", "column_name": "c"}
    assert len(rules_from_table(table(row), "p")) == 1
    for bad in ({"action_on_failure": "DROP"}, {"rule_type": "NEAT"}, {"severity": "DIRE"}):
        with pytest.raises(ValueError, match="is not one of"):
            rules_from_table(table(row | bad), "p")
    with pytest.raises(ValueError, match="share a name"):
        rules_from_table(table(row, row), "p")


def test_errors_are_typed_by_the_step_they_fell_in(spark, work):
    src = work + "/src/po"
    _src(spark, src)
    ctl = Control(spark, work + "/control")

    def fails(s, conf):
        raise RuntimeError("source is gone")

    def refused(s, conf):
        raise ConnectionError("no route")
    for reader in (fails, refused):
        assert ingest_table(spark, _cfg(src), control=ctl, lake_root=work, now=NOW1,
                            source_reader=reader).status == "FAILED"
    assert {e["error_type"] for e in ctl.errors().collect()} == {"EXTRACTION", "CONNECTION"}


def test_lookback_reads_late_rows_again(spark, work):
    src = work + "/src/po"
    _src(spark, src)
    ctl = Control(spark, work + "/control")
    top = spark.read.parquet(src).agg(F.max("updated_at")).first()[0]
    ctl.advance_watermark(pipeline_name="pl_po", source_table="po", cdc_column="updated_at",
                          watermark_value=str(top), watermark_type="TIMESTAMP", rows_loaded=0,
                          updated_at=NOW1, seq=1)
    days = dt.timedelta(days=30)
    r = ingest_table(spark, _cfg(src), control=ctl, lake_root=work, now=NOW2, lookback=days)
    assert r.rows_extracted == spark.read.parquet(src).where(F.col("updated_at") >= top - days).count()
    assert r.status == "SUCCESS"
