"""Query catalogue for the driver contract: Spark query + oracle SQL per name.

Each Spark query is built from the library's operators over the given
tables (or data Spark derives from them); each oracle is the same
semantics restated as DuckDB SQL over the pre-registered views.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.functions.scalar import batch_id_col, dated_path_col, hours_before
from sluice.operators import quality as Q
from sluice.operators.aggregate import ordered_concat, ordered_concat_chunks
from sluice.operators.dedup import latest_per_key
from sluice.operators.drift import evolve_schema, load_drift, row_count_check
from sluice.operators.merge import current_rows, merge_counts, merge_message, merge_upsert
from sluice.operators.projection import (BAD_COLUMNS, lineage, split_bad_rows, stamp_audit,
                                         typed_projection)
from sluice.operators.runlog import (failed_since, open_errors, run_history, run_log_current,
                                     run_trend)
from sluice.operators.watermark import next_watermark, watermark_current
from sluice.plans.dialect import Dialect, SparkDialect
from sluice.plans.flow import Control, ingest_all, ingest_table, reprocess_batch
from sluice.plans.standins import (BATCH1, EVENTS_SPEC, LINEITEM_SPEC, NOW, STANDINS,
                                   SpecOnly, change_source_sql, initial_raw_sql,
                                   merge_oracle_sql, raw_rows_sql, raw_sql, staging_sql,
                                   target_sql)
from sluice.session import scratch_dir
from sluice.sinks.staging import StagingTable, read_staging
from sluice.sinks.write import land, load_raw, read_raw, read_rejects
from sluice.sources.extract import (extract, landing_path, read_landing, read_source,
                                    replay, with_source_file)
from sluice.spec import DQ_RULES_SCHEMA, schema_of
from sluice.streaming.incremental import late_rows, stream_landing, stream_merge

NOW_DT = dt.datetime(2025, 1, 1)
DUCK = Dialect()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _sql(spark: SparkSession, sf_dir: str, build) -> DataFrame:
    return spark.sql(build(SparkDialect(sf_dir)))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# Change-apply: M1-M8, J1, J2, P7, P9, G1, M11, M12
# ---------------------------------------------------------------------------

def _merged(spark, sf_dir, key: str) -> DataFrame:
    si = STANDINS[key]
    tgt = _sql(spark, sf_dir, lambda d: target_sql(si, d))
    raw = _sql(spark, sf_dir, lambda d: raw_sql(si, d))
    return merge_upsert(tgt, raw, si.spec, NOW_DT, batch_id=BATCH1)


def _register_merge(qname: str, key: str):
    register(qname, merge_oracle_sql(STANDINS[key], DUCK))(
        lambda spark, sf_dir: _merged(spark, sf_dir, key))


_register_merge("merge_orders", "orders")
_register_merge("merge_composite_key", "lineitem")
for _k in ("suppliers", "purchase_orders", "inventory", "shipments", "sales_orders"):
    _register_merge(f"merge_{_k}", _k)


@register("merge_counts", f"""
SELECT CAST(count(*) FILTER (WHERE _cdc_operation = 'INSERT') AS BIGINT) AS rows_inserted,
       CAST(count(*) FILTER (WHERE _cdc_operation = 'UPDATE') AS BIGINT) AS rows_updated,
       'MERGE_ORDERS COMPLETE | INSERTED: ' || CAST(count(*) FILTER (WHERE _cdc_operation = 'INSERT') AS VARCHAR)
         || ' | UPDATED: ' || CAST(count(*) FILTER (WHERE _cdc_operation = 'UPDATE') AS VARCHAR) AS result_msg
FROM ({merge_oracle_sql(STANDINS['orders'], DUCK)}) m WHERE _batch_id = '{BATCH1}'""")
def q_merge_counts(spark, sf_dir):
    return merge_message("ORDERS", merge_counts(_merged(spark, sf_dir, "orders"), BATCH1))


@register("merge_idempotent", merge_oracle_sql(STANDINS["orders"], DUCK))
def q_merge_idempotent(spark, sf_dir):
    si = STANDINS["orders"]
    raw = _sql(spark, sf_dir, lambda d: raw_sql(si, d))
    once = _merged(spark, sf_dir, "orders")
    return merge_upsert(once, raw, si.spec, NOW_DT + dt.timedelta(days=1), batch_id=BATCH1)


@register("current_rows", f"""
SELECT * FROM ({merge_oracle_sql(STANDINS['orders'], DUCK)}) m
WHERE _is_current AND NOT _is_deleted""")
def q_current_rows(spark, sf_dir):
    return current_rows(_merged(spark, sf_dir, "orders"))


# ---------------------------------------------------------------------------
# Sources: S2, S3, X4, S6, S9, T8
# ---------------------------------------------------------------------------


@register("extract_full", "SELECT * FROM customer")
def q_extract_full(spark, sf_dir):
    return extract(_table(spark, sf_dir, "customer"), "FULL")


@register("extract_incremental",
          "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1999-12-29 00:00:00'")
def q_extract_incremental(spark, sf_dir):
    # stored watermark 2000-01-01, re-read with a 3-day lookback
    return extract(_table(spark, sf_dir, "orders"), "CDC", "o_orderdate",
                   "2000-01-01 00:00:00", lookback=dt.timedelta(days=3))


@register("extract_integer_watermark", """
SELECT * FROM events WHERE event_id >=
  (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00')""")
def q_extract_integer_watermark(spark, sf_dir):
    ev = _table(spark, sf_dir, "events")
    # the watermark a first run stored: max(event_id) of what it extracted
    stored = ev.where(F.col("ts") < F.lit(dt.datetime(2024, 1, 15))).agg(
        F.max("event_id")).scalar()
    return extract(ev, "INCREMENTAL", "event_id", stored, cdc_column_type="BIGINT")


def _custom_query(d: Dialect) -> str:
    return (f"SELECT o.o_orderkey, o.o_orderdate, o.o_totalprice, c.c_name, c.c_mktsegment "
            f"FROM {d.t('orders')} o JOIN {d.t('customer')} c ON o.o_custkey = c.c_custkey "
            f"WHERE o.o_orderstatus = 'O'")


@register("extract_custom_query",
          f"SELECT * FROM ({_custom_query(DUCK)}) q "
          f"WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'")
def q_extract_custom_query(spark, sf_dir):
    cfg = {"source_type": "PARQUET", "source_table": "orders",
           "source_query": _custom_query(SparkDialect(sf_dir))}
    return extract(read_source(spark, cfg), "INCREMENTAL", "o_orderdate", "1998-01-01 00:00:00")


@register("extract_csv", "SELECT *, CAST(NULL AS VARCHAR) AS _corrupt FROM customer")
def q_extract_csv(spark, sf_dir):
    src = _table(spark, sf_dir, "customer")
    path = scratch_dir(spark, "csv") + "/customer"
    src.write.mode("overwrite").option("header", "true").csv(path)
    cfg = {"source_type": "CSV", "source_server": path.rsplit("/", 1)[0],
           "source_table": "customer"}
    return read_source(spark, cfg, csv_schema=src.schema)


# ---------------------------------------------------------------------------
# Load: K1, S7, S8, S14, K3, P1, P3, P4, P5, S10, N7
# ---------------------------------------------------------------------------

SUPPLIER_TARGET = schema_of("S_SUPPKEY bigint, S_NAME string, S_NATIONKEY int, "
                            "S_ACCTBAL decimal(12,2), S_RATING decimal(3,2)")


@register("land_and_reload", f"""
SELECT CAST(s_suppkey AS BIGINT) AS S_SUPPKEY, s_name AS S_NAME, s_nationkey AS S_NATIONKEY,
       CAST(s_acctbal AS DECIMAL(12,2)) AS S_ACCTBAL, CAST(NULL AS DECIMAL(3,2)) AS S_RATING,
       'pl_supplier' AS _pipeline_name, '{BATCH1}' AS _batch_id, 'run-1' AS _run_id,
       'FULL' AS _load_type, 'supplier_20250101.parquet' AS _source_file,
       false AS _is_deleted, TIMESTAMP '{NOW}' AS _ingestion_timestamp
FROM supplier""")
def q_land_and_reload(spark, sf_dir):
    root = scratch_dir(spark, "landing")
    path = landing_path(root, "raw", "supply_chain/supplier", "supplier", NOW_DT)
    land(extract(_table(spark, sf_dir, "supplier"), "FULL"), path, BATCH1)
    landed = read_landing(spark, path, BATCH1)
    raw_path = root + "/RAW/RAW_SUPPLIER"
    load_raw(landed, SUPPLIER_TARGET, raw_path, pipeline_name="pl_supplier", batch_id=BATCH1,
             run_id="run-1", load_type="FULL", now=NOW_DT)
    raw = read_raw(spark, raw_path)
    return raw.withColumn("_source_file",
                          F.regexp_extract("_source_file", r"([^/]+\.parquet)/_landing_batch=", 1))


PART_TARGET = schema_of("P_PARTKEY bigint, P_NAME string, P_SIZE int, "
                        "P_RETAILPRICE decimal(12,2), P_TYPE string, P_AVAILABLE_FROM date")


@register("typed_projection", """
SELECT CAST(CAST(p_partkey AS VARCHAR) AS BIGINT) AS P_PARTKEY, p_name AS P_NAME,
       CAST(CAST(p_size AS VARCHAR) AS INTEGER) AS P_SIZE,
       CAST(CAST(p_retailprice AS VARCHAR) AS DECIMAL(12,2)) AS P_RETAILPRICE,
       p_type AS P_TYPE, CAST(NULL AS DATE) AS P_AVAILABLE_FROM
FROM part""")
def q_typed_projection(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    # the landed file holds text only, lower-case names
    text = part.select(*[F.col(c).cast("string").alias(c.lower()) for c in part.columns])
    return typed_projection(text, PART_TARGET)


def _junk_part(df: DataFrame) -> DataFrame:
    return df.select(
        "p_partkey", "p_name",
        F.when(F.col("p_partkey") % 10 == 0, F.concat(F.lit("x"), F.col("p_size").cast("string")))
         .otherwise(F.col("p_size").cast("string")).alias("p_size"),
        F.col("p_retailprice"))


BAD_TARGET = schema_of("p_partkey bigint, p_name string, p_size int, p_retailprice decimal(6,2)")
_BAD_SQL = """
WITH t AS (
  SELECT p_partkey, substr(p_name, 1, 20) AS p_name,
         TRY_CAST(CASE WHEN p_partkey % 10 = 0 THEN 'x' || CAST(p_size AS VARCHAR)
                       ELSE CAST(p_size AS VARCHAR) END AS INTEGER) AS p_size,
         TRY_CAST(p_retailprice AS DECIMAL(6,2)) AS p_retailprice,
         concat_ws(',', CASE WHEN p_partkey % 10 = 0 THEN 'p_size' END,
                   CASE WHEN TRY_CAST(p_retailprice AS DECIMAL(6,2)) IS NULL THEN 'p_retailprice' END)
           AS bad_columns
  FROM part)
"""


@register("bad_rows", _BAD_SQL + "SELECT * FROM t WHERE bad_columns <> ''")
def q_bad_rows(spark, sf_dir):
    src = _junk_part(_table(spark, sf_dir, "part"))
    _, bad = split_bad_rows(src, BAD_TARGET, max_lengths={"p_name": 20})
    return bad.withColumn("bad_columns", F.array_join(BAD_COLUMNS, ",")).drop(BAD_COLUMNS)


@register("good_rows", _BAD_SQL + "SELECT * EXCLUDE (bad_columns) FROM t WHERE bad_columns = ''")
def q_good_rows(spark, sf_dir):
    src = _junk_part(_table(spark, sf_dir, "part"))
    good, _ = split_bad_rows(src, BAD_TARGET, max_lengths={"p_name": 20})
    return good


@register("audit_stamp", f"""
SELECT o_orderkey, 'pl_orders' AS _pipeline_name, '{BATCH1}' AS _batch_id, 'run-1' AS _run_id,
       'FULL' AS _load_type, 'orders.parquet' AS _source_file, false AS _is_deleted,
       TIMESTAMP '{NOW}' AS _ingestion_timestamp
FROM orders""")
def q_audit_stamp(spark, sf_dir):
    src = with_source_file(_table(spark, sf_dir, "orders"))
    stamped = stamp_audit(src, "pl_orders", BATCH1, "run-1", "FULL", NOW_DT)
    cols = lineage(stamped, ["o_orderkey"]).columns + ["_is_deleted", "_ingestion_timestamp"]
    # the lineage lookup (N7), with the file name reduced to its last part
    return (stamped.select(*cols)
                   .withColumn("_source_file", F.regexp_extract("_source_file", r"[^/]+$", 0)))


# ---------------------------------------------------------------------------
# Scalar functions F1-F4, F6-F9, F12
# ---------------------------------------------------------------------------


@register("scalar_functions", f"""
SELECT o_orderkey,
       'BATCH-' || strftime(o_orderdate, '%Y%m%d-%H%M%S') AS batch_id,
       strftime(o_orderdate, '%Y/%m/%d') AS day_path,
       'orders_' || strftime(o_orderdate, '%Y%m%d') || '.parquet' AS file_name,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS watermark_text,
       upper(o_orderpriority) AS priority_upper, lower(o_orderstatus) AS status_lower,
       CASE WHEN o_totalprice > 200000 THEN 'LARGE' WHEN o_totalprice > 50000 THEN 'MEDIUM'
            ELSE 'SMALL' END AS size_class,
       regexp_matches(o_orderpriority, '^[12]-') AS is_priority,
       COALESCE(NULLIF(o_orderpriority, '5-LOW'), 'NONE') AS priority_or_none,
       CAST(o_orderdate AS DATE) AS order_day,
       o_orderdate >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR AS in_last_24h
FROM orders""")
def q_scalar_functions(spark, sf_dir):
    o = _table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    return o.select(
        "o_orderkey", batch_id_col(d).alias("batch_id"), dated_path_col(d).alias("day_path"),
        F.concat(F.lit("orders_"), F.date_format(d, "yyyyMMdd"), F.lit(".parquet"))
         .alias("file_name"),
        F.date_format(d, "yyyy-MM-dd HH:mm:ss").alias("watermark_text"),
        F.upper("o_orderpriority").alias("priority_upper"),
        F.lower("o_orderstatus").alias("status_lower"),
        F.when(F.col("o_totalprice") > 200000, "LARGE").when(F.col("o_totalprice") > 50000, "MEDIUM")
         .otherwise("SMALL").alias("size_class"),
        F.col("o_orderpriority").rlike("^[12]-").alias("is_priority"),
        F.coalesce(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")), F.lit("NONE"))
         .alias("priority_or_none"),
        F.to_date(d).alias("order_day"),
        (d >= hours_before(NOW_DT, 24)).alias("in_last_24h"))


# ---------------------------------------------------------------------------
# G2 ordered concat, W1 latest per key
# ---------------------------------------------------------------------------


@register("ordered_concat", """
SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey)
         AS part_list
FROM lineitem GROUP BY l_orderkey""")
def q_ordered_concat(spark, sf_dir):
    return ordered_concat(_table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_partkey",
                          ["l_linenumber", "l_partkey"], alias="part_list")


_HOT_ORDER = "CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END"


@register("ordered_concat_chunks", f"""
SELECT {_HOT_ORDER} AS order_group,
       string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_orderkey, l_linenumber, l_partkey)
         AS parts
FROM lineitem GROUP BY 1""")
def q_ordered_concat_chunks(spark, sf_dir):
    """A third of all rows under one key, concatenated in chunks; the chunks re-joined."""
    rows = _table(spark, sf_dir, "lineitem").withColumn("order_group", F.expr(_HOT_ORDER))
    chunks = ordered_concat_chunks(rows, ["order_group"], "l_partkey",
                                   ["l_orderkey", "l_linenumber", "l_partkey"], alias="part")
    return ordered_concat(chunks, ["order_group"], "part", ["chunk"], alias="parts")


@register("latest_per_key", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn
  FROM lineitem) WHERE rn = 1""")
def q_latest_per_key(spark, sf_dir):
    return latest_per_key(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"],
                          ["l_shipdate", "l_partkey", "l_suppkey"])


@register("latest_per_key_nulls", """
SELECT o_custkey, o_orderkey, updated_at FROM (
  SELECT o_custkey, o_orderkey,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate END AS updated_at,
         row_number() OVER (PARTITION BY o_custkey ORDER BY
           CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate END DESC NULLS FIRST,
           o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1""")
def q_latest_per_key_nulls(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
         .otherwise(F.col("o_orderdate")).alias("updated_at"))
    return latest_per_key(o, ["o_custkey"], ["updated_at", "o_orderkey"], nulls_first=True)


# ---------------------------------------------------------------------------
# Watermarks: G5, G6, G3, F8, F11
# ---------------------------------------------------------------------------


def _wm_log_sql(d: Dialect) -> str:
    return (f"SELECT 'pl_' || event_type AS pipeline_name, "
            f"'t' || CAST(user_id % 10 AS {d.str_type}) AS source_table, 'ts' AS cdc_column, "
            f"{d.fmt('ts', 'yyyy-MM-dd HH:mm:ss')} AS watermark_value, "
            f"'TIMESTAMP' AS watermark_type, "
            f"CASE WHEN event_type = 'error' THEN NULL ELSE CAST(floor(value) AS BIGINT) END "
            f"AS rows_loaded, ts AS updated_at, event_id AS seq FROM {d.t('events')}")


@register("watermark_state", f"""
WITH log AS ({_wm_log_sql(DUCK)}),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_name, source_table
                        ORDER BY updated_at DESC, seq DESC) AS rn FROM log) WHERE rn = 1),
agg AS (SELECT pipeline_name, source_table, max(updated_at) AS mx,
               CAST(sum(COALESCE(rows_loaded, 0)) AS BIGINT) AS total_rows_loaded,
               count(*) AS updates
        FROM log GROUP BY pipeline_name, source_table)
SELECT a.pipeline_name, a.source_table, l.watermark_value AS last_watermark_value,
       a.mx AS last_watermark_datetime, true AS initial_load_done, a.mx AS last_successful_run,
       l.rows_loaded AS last_rows_loaded, a.total_rows_loaded, a.updates
FROM agg a JOIN last l USING (pipeline_name, source_table)""")
def q_watermark_state(spark, sf_dir):
    return watermark_current(_sql(spark, sf_dir, _wm_log_sql))


@register("next_watermark", """
SELECT count(*) AS rows_extracted, CAST(max(ts) AS VARCHAR) AS new_watermark
FROM events WHERE ts >= TIMESTAMP '1900-01-01 00:00:00'""")
def q_next_watermark(spark, sf_dir):
    ev = extract(_table(spark, sf_dir, "events"), "CDC", "ts", None)  # first run: default 1900
    return next_watermark(ev, "ts", "1900-01-01 00:00:00")


# ---------------------------------------------------------------------------
# Run log and monitoring: G4, G8, N1, N2, N4, N6, N8, O2, P12, F5, F6, F7, J4
# Events recast as a run-event log: even event_id = START, odd = END of run
# event_id DIV 2; END status from the event type.
# ---------------------------------------------------------------------------

MONITOR_NOW = "2024-01-30 12:00:00"


def _run_events_sql(d: Dialect) -> str:
    run = d.int_div("event_id", "2")
    return (
        f"SELECT CASE WHEN event_id % 2 = 0 THEN 'START' ELSE 'END' END AS event, "
        f"'run-' || CAST({run} AS {d.str_type}) AS run_id, "
        f"'pl_' || CAST({run} % 7 AS {d.str_type}) AS pipeline_name, "
        f"'t' || CAST({run} % 7 AS {d.str_type}) AS source_table, ts AS event_time, "
        f"CASE WHEN event_id % 2 = 0 THEN 'RUNNING' WHEN event_type = 'error' THEN 'FAILED' "
        f"WHEN event_type = 'signup' THEN 'SKIPPED' ELSE 'SUCCESS' END AS status, "
        f"CAST(floor(value * 10) AS BIGINT) AS rows_extracted, "
        f"CAST(NULL AS BIGINT) AS rows_passed_dq, CAST(NULL AS BIGINT) AS rows_failed_dq, "
        f"CASE WHEN event_type = 'error' THEN CAST(0 AS BIGINT) "
        f"ELSE CAST(floor(value * 10) AS BIGINT) END AS rows_loaded, "
        f"CAST(NULL AS {d.str_type}) AS watermark_start, CAST(NULL AS {d.str_type}) AS watermark_end, "
        f"'ingest_all' AS adf_pipeline_name, 'daily' AS adf_trigger_name, "
        f"CASE WHEN event_type = 'error' THEN props END AS error_message "
        f"FROM {d.t('events')}")


_RUNS_SQL = f"""
WITH ev AS ({_run_events_sql(DUCK)}),
s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id, pipeline_name
                     ORDER BY event_time DESC) AS rn FROM ev WHERE event = 'START') WHERE rn = 1),
e AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id, pipeline_name
                     ORDER BY event_time DESC) AS rn FROM ev WHERE event = 'END') WHERE rn = 1),
runs AS (
SELECT s.run_id, s.pipeline_name, s.source_table, CAST(s.event_time AS DATE) AS run_date,
       s.event_time AS start_time, e.event_time AS end_time,
       date_diff('second', s.event_time, e.event_time) AS duration_seconds,
       COALESCE(e.status, 'RUNNING') AS status,
       COALESCE(e.rows_extracted, 0) AS rows_extracted,
       COALESCE(e.rows_passed_dq, 0) AS rows_passed_dq,
       COALESCE(e.rows_failed_dq, 0) AS rows_failed_dq,
       COALESCE(e.rows_loaded, 0) AS rows_loaded,
       s.watermark_start, e.watermark_end, s.adf_pipeline_name, s.adf_trigger_name,
       e.error_message
FROM s LEFT JOIN e ON s.run_id = e.run_id AND s.pipeline_name = e.pipeline_name)
"""


def _runs(spark, sf_dir):
    return run_log_current(_sql(spark, sf_dir, _run_events_sql))


@register("run_log_current", _RUNS_SQL + "SELECT * FROM runs")
def q_run_log_current(spark, sf_dir):
    return _runs(spark, sf_dir)


@register("run_history", _RUNS_SQL + """
SELECT pipeline_name, source_table, status, start_time, end_time, duration_seconds,
       rows_extracted, rows_loaded FROM runs ORDER BY start_time DESC""")
def q_run_history(spark, sf_dir):
    return run_history(_runs(spark, sf_dir))


@register("failed_24h", _RUNS_SQL + f"""
SELECT * FROM runs WHERE status = 'FAILED'
  AND start_time >= TIMESTAMP '{MONITOR_NOW}' - INTERVAL 24 HOUR ORDER BY start_time DESC""")
def q_failed_24h(spark, sf_dir):
    return failed_since(_runs(spark, sf_dir), dt.datetime(2024, 1, 30, 12), 24)


@register("run_trend", _RUNS_SQL + """
SELECT pipeline_name, run_date, status, count(*) AS runs,
       CAST(sum(rows_loaded) AS BIGINT) AS rows_loaded,
       avg(duration_seconds) AS avg_duration_seconds,
       max(duration_seconds) AS max_duration_seconds
FROM runs GROUP BY pipeline_name, run_date, status""")
def q_run_trend(spark, sf_dir):
    return run_trend(_runs(spark, sf_dir))


def _errors_sql(d: Dialect) -> str:
    run = d.int_div("event_id", "2")
    return (
        f"SELECT 'err-' || CAST(event_id AS {d.str_type}) AS error_id, "
        f"'run-' || CAST({run} AS {d.str_type}) AS run_id, "
        f"'pl_' || CAST({run} % 7 AS {d.str_type}) AS pipeline_name, "
        f"'t' || CAST({run} % 7 AS {d.str_type}) AS source_table, "
        f"CASE WHEN value > 50 THEN 'LOAD' ELSE 'EXTRACTION' END AS error_type, "
        f"props AS error_message, ts AS created_date, (event_id % 4 = 0) AS is_resolved "
        f"FROM {d.t('events')} WHERE event_type = 'error'")


@register("open_errors", _RUNS_SQL + f"""
SELECT er.*, r.status AS run_status, r.start_time
FROM ({_errors_sql(DUCK)}) er LEFT JOIN runs r
  ON er.run_id = r.run_id AND er.pipeline_name = r.pipeline_name
WHERE NOT COALESCE(er.is_resolved, false) ORDER BY er.created_date DESC""")
def q_open_errors(spark, sf_dir):
    return open_errors(_sql(spark, sf_dir, _errors_sql), _runs(spark, sf_dir))


# ---------------------------------------------------------------------------
# Constraint checks V1-V4 and the rule engine Q1-Q11, G7, W2, J3, N5, K9
# ---------------------------------------------------------------------------


@register("constraint_violations", """
SELECT 'status_domain' AS check_name, CAST(o_orderkey AS VARCHAR) AS row_key FROM orders
  WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')
UNION ALL
SELECT 'priority_not_null', CAST(o_orderkey AS VARCHAR) FROM orders
  WHERE NULLIF(o_orderpriority, '5-LOW') IS NULL
UNION ALL
SELECT 'line_unique', CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)
  FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL
SELECT 'customer_fk', CAST(o_orderkey AS VARCHAR) FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey + 100)""")
def q_constraint_violations(spark, sf_dir):
    o = _table(spark, sf_dir, "orders")
    li = _table(spark, sf_dir, "lineitem")
    c = _table(spark, sf_dir, "customer")
    key = F.col("o_orderkey").cast("string").alias("row_key")
    v1 = Q.domain_violations(o, "o_orderstatus", ["F", "O"]).select(
        F.lit("status_domain").alias("check_name"), key)
    o2 = o.withColumn("o_orderpriority", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
    v2 = Q.not_null_violations(o2, "o_orderpriority").select(
        F.lit("priority_not_null").alias("check_name"), key)
    v3 = Q.unique_violations(li, ["l_orderkey", "l_linenumber"]).select(
        F.lit("line_unique").alias("check_name"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("row_key"))
    o4 = o.withColumn("o_custkey", F.col("o_custkey") + 100)
    v4 = Q.fk_violations(o4, "o_custkey", c, "c_custkey").select(
        F.lit("customer_fk").alias("check_name"), key)
    return v1.unionByName(v2).unionByName(v3).unionByName(v4)


def _dq_input_sql(d: Dialect) -> str:
    return (f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, "
            f"l_tax, NULLIF(l_returnflag, 'A') AS l_returnflag, "
            f"CASE WHEN l_partkey % 97 = 0 THEN lower(l_linestatus) ELSE l_linestatus END "
            f"AS l_linestatus, "
            f"l_suppkey + CASE WHEN l_partkey % 50 = 0 THEN 1000000 ELSE 0 END AS l_suppkey_x "
            f"FROM {d.t('lineitem')}")


DQ_RULES = [
    Q.Rule("rq_returnflag_nn", "NOT_NULL", "l_returnflag", action_on_failure="QUARANTINE",
           severity="HIGH", rule_order=1, rule_id=1),
    Q.Rule("rq_line_unique", "UNIQUENESS", "l_orderkey,l_linenumber", action_on_failure="FLAG",
           severity="MEDIUM", rule_order=2, rule_id=2),
    Q.Rule("rq_qty_range", "RANGE", "l_quantity", min_value="1", max_value="45",
           action_on_failure="WARN", severity="LOW", rule_order=3, rule_id=3),
    Q.Rule("rq_status_regex", "REGEX", "l_linestatus", regex_pattern="^[OF]$",
           action_on_failure="QUARANTINE", severity="HIGH", rule_order=4, rule_id=4),
    Q.Rule("rq_supp_ref", "REFERENTIAL", "l_suppkey_x", ref_table="supplier",
           ref_column="s_suppkey", action_on_failure="REJECT", severity="HIGH", rule_order=5,
           rule_id=5),
    Q.Rule("rq_discount_threshold", "THRESHOLD", rule_expression="l_discount <= 0.08",
           threshold_pct=80, action_on_failure="WARN", severity="MEDIUM", rule_order=6,
           rule_id=6),
    Q.Rule("rq_tax_custom", "CUSTOM", rule_expression="l_tax <= l_discount + 0.06",
           action_on_failure="FLAG", severity="LOW", rule_order=7, rule_id=7),
]

# DuckDB restatement of each rule's row-level pass condition.
_DQ_PASS = {
    "rq_returnflag_nn": "l_returnflag IS NOT NULL",
    "rq_line_unique": "NOT COALESCE(d.__dup, false)",
    "rq_qty_range": "(l_quantity IS NULL OR (l_quantity >= 1 AND l_quantity <= 45))",
    "rq_status_regex": "(l_linestatus IS NULL OR regexp_matches(l_linestatus, '^[OF]$'))",
    "rq_supp_ref": "(l_suppkey_x IS NULL OR r.__hit IS NOT NULL)",
    "rq_discount_threshold": "COALESCE(l_discount <= 0.08, false)",
    "rq_tax_custom": "COALESCE(l_tax <= l_discount + 0.06, true)",
}
_DQ_EVAL = f"""
WITH src AS ({_dq_input_sql(DUCK)}),
dups AS (SELECT l_orderkey, l_linenumber, true AS __dup FROM src
         WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
         GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1),
refs AS (SELECT DISTINCT s_suppkey AS __ref, true AS __hit FROM supplier WHERE s_suppkey IS NOT NULL),
ev AS (
  SELECT src.*, {", ".join(f"{v} AS {r}" for r, v in _DQ_PASS.items())}
  FROM src LEFT JOIN dups d ON src.l_orderkey = d.l_orderkey AND src.l_linenumber = d.l_linenumber
           LEFT JOIN refs r ON src.l_suppkey_x = r.__ref)
"""


def _dq_eval(spark, sf_dir, rules=None):
    df = _sql(spark, sf_dir, _dq_input_sql)
    refs = {"supplier": _table(spark, sf_dir, "supplier")}
    return Q.evaluate_rules(df, rules or DQ_RULES, refs, scratch_dir(spark, "rules"))


_DQ_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
for _r in DQ_RULES:
    if _r.rule_type == "THRESHOLD":
        continue
    _qn = "dq_" + _r.rule_type.lower()

    def _mk(rule):
        def q(spark, sf_dir):
            ev = _dq_eval(spark, sf_dir, [rule])
            return ev.where(~F.col(rule.pass_column)).select(
                *_DQ_KEYS, F.lit(rule.rule_name).alias("rule_name"))
        return q
    register(_qn, _DQ_EVAL + f"SELECT {', '.join(_DQ_KEYS)}, '{_r.rule_name}' AS rule_name "
                             f"FROM ev WHERE NOT {_r.rule_name}")(_mk(_r))


def _summary_sql_rows() -> str:
    parts = []
    for r in DQ_RULES:
        thr = "NULL" if r.threshold_pct is None else f"CAST({r.threshold_pct} AS DECIMAL(5,2))"
        col = "NULL" if r.column_name is None else f"'{r.column_name}'"
        parts.append(
            f"SELECT {r.rule_id} AS rule_id, '{r.rule_name}' AS rule_name, '{r.rule_type}' AS rule_type, "
            f"{col} AS column_name, '{r.severity}' AS severity, '{r.action_on_failure}' AS act, "
            f"{thr} AS thr, count(*) AS total, count(*) FILTER (WHERE NOT {r.rule_name}) AS failed, "
            f"count(*) FILTER (WHERE NOT ({' AND '.join(x.rule_name for x in DQ_RULES if x.rule_type != 'THRESHOLD')})) AS rows_failed "
            f"FROM ev")
    return " UNION ALL ".join(parts)


_DQ_SUMMARY = _DQ_EVAL + f""",
s AS ({_summary_sql_rows()}),
s2 AS (SELECT *, CAST(ROUND((total - failed) * 100 / total, 2) AS DECIMAL(5,2)) AS rate FROM s),
s3 AS (SELECT *, CASE WHEN rule_type = 'THRESHOLD' THEN COALESCE(rate < thr, true) AND total > 0
                      ELSE failed > 0 END AS breached FROM s2),
summary AS (
SELECT rule_id, rule_name, rule_type, column_name, severity, CAST(total AS BIGINT) AS total_records,
       CAST(total - failed AS BIGINT) AS passed_records, CAST(failed AS BIGINT) AS failed_records,
       rate AS pass_rate_pct,
       CASE WHEN NOT breached THEN 'PASS' WHEN act = 'WARN' THEN 'WARN' ELSE 'FAIL' END AS status,
       CASE WHEN breached THEN act ELSE 'NONE' END AS action_taken,
       CAST(total - rows_failed AS BIGINT) AS rows_passed_dq, CAST(rows_failed AS BIGINT) AS rows_failed_dq
FROM s3)
"""


def _summary(spark, sf_dir):
    return Q.dq_summary(_dq_eval(spark, sf_dir), DQ_RULES)


@register("dq_threshold", _DQ_SUMMARY + "SELECT * FROM summary WHERE rule_type = 'THRESHOLD'")
def q_dq_threshold(spark, sf_dir):
    return _summary(spark, sf_dir).where(F.col("rule_type") == "THRESHOLD")


@register("dq_summary", _DQ_SUMMARY + "SELECT * FROM summary")
def q_dq_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


@register("dq_report", _DQ_SUMMARY + f"""
SELECT 'pl_lineitem' AS pipeline_name, CAST(TIMESTAMP '{NOW}' AS DATE) AS run_date, severity,
       count(*) AS rules, count(*) FILTER (WHERE status <> 'PASS') AS rules_not_passed,
       CAST(sum(failed_records) AS BIGINT) AS failed_records
FROM summary GROUP BY severity""")
def q_dq_report(spark, sf_dir):
    res = Q.dq_results(_summary(spark, sf_dir), run_id="run-1", pipeline_name="pl_lineitem",
                       source_table="lineitem", run_date=NOW_DT)
    return Q.dq_report(res)


@register("dq_quarantine", _DQ_EVAL + f"""
SELECT {', '.join(_DQ_KEYS)},
       concat_ws(',', CASE WHEN NOT rq_returnflag_nn THEN 'rq_returnflag_nn' END,
                      CASE WHEN NOT rq_status_regex THEN 'rq_status_regex' END) AS failed_rules
FROM ev WHERE NOT rq_returnflag_nn OR NOT rq_status_regex""")
def q_dq_quarantine(spark, sf_dir):
    ev = _dq_eval(spark, sf_dir)
    return Q.quarantined(ev, DQ_RULES).select(
        *_DQ_KEYS, F.array_join(F.array_intersect(
            F.col(Q.FAILED), F.array(F.lit("rq_returnflag_nn"), F.lit("rq_status_regex"))), ",")
        .alias("failed_rules"))


@register("dq_flag", _DQ_EVAL + f"""
SELECT {', '.join(_DQ_KEYS)},
       concat_ws(',', CASE WHEN NOT rq_line_unique THEN 'rq_line_unique' END,
                      CASE WHEN NOT rq_tax_custom THEN 'rq_tax_custom' END) AS dq_flags
FROM ev WHERE rq_returnflag_nn AND rq_status_regex""")
def q_dq_flag(spark, sf_dir):
    ev = _dq_eval(spark, sf_dir)
    return Q.loadable(ev, DQ_RULES).select(*_DQ_KEYS,
                                           F.array_join(Q.FLAGS, ",").alias("dq_flags"))


@register("dq_reject", _DQ_SUMMARY + """
SELECT COALESCE(max(CASE WHEN action_taken = 'REJECT' THEN 1 ELSE 0 END), 0) = 1 AS batch_rejected,
       count(*) FILTER (WHERE status = 'FAIL') AS rules_failed,
       count(*) FILTER (WHERE status = 'WARN') AS rules_warned
FROM summary""")
def q_dq_reject(spark, sf_dir):
    return Q.batch_verdict(_summary(spark, sf_dir))


@register("dq_warn", _DQ_SUMMARY + "SELECT * FROM summary WHERE status = 'WARN'")
def q_dq_warn(spark, sf_dir):
    return _summary(spark, sf_dir).where(F.col("status") == "WARN")


# ---------------------------------------------------------------------------
# Q12 row counts, Q13 drift, Q14 schema evolution, X3 late rows
# ---------------------------------------------------------------------------


@register("row_count_check", """
WITH c AS (SELECT 'source' AS stage, count(*) AS row_count FROM orders
           UNION ALL SELECT 'extracted', count(*) FROM orders
           UNION ALL SELECT 'landed', count(*) FROM orders
           UNION ALL SELECT 'typed_good', count(*) FROM orders)
SELECT stage, row_count, (SELECT count(*) FROM orders) AS expected,
       row_count = (SELECT count(*) FROM orders) AS matches FROM c""")
def q_row_count_check(spark, sf_dir):
    src = _table(spark, sf_dir, "orders")
    ext = extract(src, "FULL")
    landed = land(ext, scratch_dir(spark, "rowcount") + "/orders", BATCH1)
    good, _ = split_bad_rows(ext, src.schema)
    return row_count_check(source=src, extracted=ext, landed=landed.rows, typed_good=good)


@register("row_count_mismatch", """
WITH c AS (SELECT 'source' AS stage, count(*) AS row_count FROM part
           UNION ALL SELECT 'typed_good', count(*) FROM part WHERE p_partkey % 10 <> 0)
SELECT stage, row_count, (SELECT count(*) FROM part) AS expected,
       row_count = (SELECT count(*) FROM part) AS matches FROM c""")
def q_row_count_mismatch(spark, sf_dir):
    """Stages that differ: rows with a bad value do not reach the typed table."""
    src = _junk_part(_table(spark, sf_dir, "part"))
    good, _ = split_bad_rows(src, BAD_TARGET)
    return row_count_check(source=src, typed_good=good)


_DRIFT_PREV_COLS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"),
                    ("o_orderstatus", "string"), ("o_totalprice", "double"),
                    ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
_DRIFT_CURR_COLS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"),
                    ("o_orderstatus", "string"), ("o_totalprice", "decimal(12,2)"),
                    ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
                    ("o_status_final", "string")]
_DRIFT_PREV_SQL = "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'"
_DRIFT_CURR_SQL = ("SELECT o_orderkey, o_custkey, o_orderstatus, "
                   "CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, o_orderdate, "
                   "o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END "
                   "AS o_status_final FROM orders "
                   "WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'")


def _profile_sql(src: str, cols) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS row_count, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, CAST(min({c}) AS VARCHAR) AS min_value, "
        f"CAST(max({c}) AS VARCHAR) AS max_value, count(DISTINCT {c}) AS distinct_count "
        f"FROM ({src}) x" for c, t in cols)


def _rate(p: str) -> str:
    return (f"CASE WHEN {p}.row_count > 0 THEN round({p}.null_count * CAST(100 AS DOUBLE) "
            f"/ {p}.row_count, 4) END")


@register("load_drift", f"""
WITH a AS ({_profile_sql(_DRIFT_PREV_SQL, _DRIFT_PREV_COLS)}),
b AS ({_profile_sql(_DRIFT_CURR_SQL, _DRIFT_CURR_COLS)})
SELECT COALESCE(b.column_name, a.column_name) AS column_name,
       CASE WHEN a.column_name IS NULL THEN 'ADDED' WHEN b.column_name IS NULL THEN 'REMOVED'
            WHEN a.data_type <> b.data_type THEN 'RETYPED' ELSE 'SAME' END AS change,
       a.data_type AS prev_data_type, b.data_type AS curr_data_type,
       {_rate('a')} AS prev_null_pct, {_rate('b')} AS curr_null_pct,
       COALESCE({_rate('b')}, 0.0) - COALESCE({_rate('a')}, 0.0) AS null_pct_shift,
       a.min_value AS prev_min_value, b.min_value AS curr_min_value,
       a.max_value AS prev_max_value, b.max_value AS curr_max_value,
       a.distinct_count AS prev_distinct_count, b.distinct_count AS curr_distinct_count
FROM a FULL OUTER JOIN b ON a.column_name = b.column_name""")
def q_load_drift(spark, sf_dir):
    o = _table(spark, sf_dir, "orders")
    cut = F.lit(dt.datetime(1998, 1, 1))
    prev = o.where(F.col("o_orderdate") < cut)
    curr = (o.where(F.col("o_orderdate") >= cut)
             .withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(12,2)"))
             .withColumn("o_status_final", F.when(F.col("o_orderstatus") != "P",
                                                  F.col("o_orderstatus"))))
    return load_drift(prev, curr)


@register("schema_evolve", """
SELECT *, CAST(NULL AS VARCHAR) AS p_container FROM part WHERE p_size <= 25
UNION ALL
SELECT *, 'BOX-' || CAST(p_size AS VARCHAR) AS p_container FROM part WHERE p_size > 25""")
def q_schema_evolve(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    first = part.where(F.col("p_size") <= 25)
    second = part.where(F.col("p_size") > 25).withColumn(
        "p_container", F.concat(F.lit("BOX-"), F.col("p_size").cast("string")))
    return evolve_schema(first, second)


LATE_WM = "2024-01-20 00:00:00"


@register("late_rows", f"""
SELECT * FROM events e WHERE ts <= TIMESTAMP '{LATE_WM}' AND NOT EXISTS (
  SELECT 1 FROM events t WHERE t.ts < TIMESTAMP '{LATE_WM}' AND t.value <= 90
    AND t.event_id = e.event_id AND t.ts = e.ts)""")
def q_late_rows(spark, sf_dir):
    ev = _table(spark, sf_dir, "events")
    wm = dt.datetime(2024, 1, 20)
    # what the earlier load held: rows before the watermark that had arrived (value <= 90)
    held = ev.where((F.col("ts") < F.lit(wm)) & (F.col("value") <= 90))
    return late_rows(ev, held, ["event_id"], "ts", wm)


# ---------------------------------------------------------------------------
# Flows: E1, E2, E5, E6, E8, K4 (written to a fresh folder under the
# session's shared checkpoint root, then read back)
# ---------------------------------------------------------------------------

FLOW_NOW1 = dt.datetime(2025, 1, 1)
FLOW_NOW2 = dt.datetime(2025, 1, 2)


def _flow_cfg(name, table, sink, source_dir, load_type="CDC", pid=1):
    return {"pipeline_id": pid, "pipeline_name": name, "source_type": "PARQUET",
            "source_server": source_dir, "source_table": table, "load_type": load_type,
            "cdc_column": "updated_at" if load_type != "FULL" else None,
            "cdc_column_type": "TIMESTAMP", "sink_schema": "STAGING", "sink_table": sink,
            "adls_container": "raw", "adls_folder_path": f"supply_chain/{table}",
            "is_active": True}


def _source_system(spark, sf_dir, work, tables: dict[str, Callable[[Dialect], str]]) -> str:
    """Write the derived source tables once as Parquet: the "source system" the
    configuration rows point at."""
    root = work + "/source"
    sd = SparkDialect(sf_dir)
    # a source table lives in several files, as a real one would (the test
    # tables are single row groups, which would make every read one task);
    # a scan that is split so already is written as it is
    files = spark.sparkContext.defaultParallelism
    for name, build in tables.items():
        sql = build(sd)
        df = spark.sql(sql)
        if " JOIN " in sql or df.rdd.getNumPartitions() < files:
            df = df.repartition(files)
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    return root


def _ingest_table_oracle() -> str:
    si = STANDINS["purchase_orders"]
    d = DUCK
    base = si.base(d)
    first = staging_sql(si, d, base, "pl_purchase_orders", "BATCH-20250101-000000", "run-1",
                        "2025-01-01 00:00:00")
    changed = (f"SELECT * FROM ({change_source_sql(si, d)}) c "
               f"WHERE updated_at >= (SELECT max(updated_at) FROM ({base}) b)")
    raw2 = raw_rows_sql(si, d, changed, "pl_purchase_orders", "BATCH-20250102-000000", "run-2",
                        "2025-01-02 00:00:00", deleted="s._is_deleted")
    return merge_oracle_sql(si, d, target=first, raw=raw2, now="2025-01-02 00:00:00")


@register("ingest_table", _ingest_table_oracle())
def q_ingest_table(spark, sf_dir):
    """Initial run (default watermark: everything), then an incremental run of the
    changed source from the stored watermark (max updated_at of the first extract)."""
    si = STANDINS["purchase_orders"]
    work = scratch_dir(spark, "ingest_table")
    control = Control(spark, work + "/control")
    src = _source_system(spark, sf_dir, work, {"v1/purchase_orders": si.base,
                                               "v2/purchase_orders": lambda d: change_source_sql(si, d)})
    cfg1 = dict(_flow_cfg("pl_purchase_orders", "purchase_orders", "STG_PURCHASE_ORDERS", src),
                source_database="v1")
    r1 = ingest_table(spark, cfg1, control=control, lake_root=work, now=FLOW_NOW1,
                      run_id="run-1")
    # the source table has changed since: same pipeline, next day
    cfg2 = dict(cfg1, source_database="v2")
    r2 = ingest_table(spark, cfg2, control=control, lake_root=work, now=FLOW_NOW2,
                      run_id="run-2")
    for r in (r1, r2):
        if r.status not in ("SUCCESS", "PARTIAL", "SKIPPED"):
            raise RuntimeError(f"ingest run failed: {r.error}")
    return read_staging(spark, r1.staging_path)


@register("ingest_all", """
SELECT 'pl_suppliers' AS pipeline_name, 'supplier' AS source_table, 'SUCCESS' AS status,
       count(*) AS rows_extracted, count(*) AS rows_loaded, false AS has_error FROM supplier
UNION ALL
SELECT 'pl_sales_orders', 'orders', 'SUCCESS', count(*), count(*), false FROM orders
UNION ALL
SELECT 'pl_inventory', 'part', 'SUCCESS', count(*), count(*), false FROM part
UNION ALL
SELECT 'pl_orders', 'orders', 'FAILED', 0, 0, true""")
def q_ingest_all(spark, sf_dir):
    """Three tables and one without a merge spec (fails alone); one inactive row."""
    work = scratch_dir(spark, "ingest_all")
    control = Control(spark, work + "/control")
    src = _source_system(spark, sf_dir, work, {"supplier": STANDINS["suppliers"].base,
                                               "orders": STANDINS["sales_orders"].base,
                                               "part": STANDINS["inventory"].base})
    configs = [
        _flow_cfg("pl_suppliers", "supplier", "STG_SUPPLIERS", src, "FULL", 1),
        _flow_cfg("pl_sales_orders", "orders", "STG_SALES_ORDERS", src, "CDC", 2),
        _flow_cfg("pl_inventory", "part", "STG_INVENTORY", src, "INCREMENTAL", 3),
        _flow_cfg("pl_orders", "orders", "STG_ORDERS", src, "CDC", 4),
        dict(_flow_cfg("pl_inactive", "region", "STG_SUPPLIERS", src, "FULL", 5),
             is_active=False),
    ]
    # the control table itself, with the reference's columns; defaults filled on read
    from sluice.spec import PIPELINE_CONFIG_SCHEMA
    config = spark.createDataFrame(
        [tuple(c.get(f.name) for f in PIPELINE_CONFIG_SCHEMA.fields) for c in configs],
        PIPELINE_CONFIG_SCHEMA)
    ingest_all(spark, config, control=control, lake_root=work, now=FLOW_NOW1)
    return control.runs().select("pipeline_name", "source_table", "status", "rows_extracted",
                                 "rows_loaded",
                                 F.col("error_message").isNotNull().alias("has_error"))


_ALL_LOADED = [("pl_suppliers", "suppliers"), ("pl_sales_orders", "sales_orders"),
               ("pl_inventory", "inventory")]


@register("ingest_all_rows", " UNION ALL ".join(
    f"SELECT '{p}' AS pipeline_name, concat_ws('|', "
    + ", ".join(f"CAST({c} AS VARCHAR)" for c in STANDINS[k].spec.keys)
    + f") AS row_key, _cdc_operation, _is_deleted, _batch_id FROM ("
    + staging_sql(STANDINS[k], DUCK, STANDINS[k].base(DUCK), p, "BATCH-20250101-000000", "r",
                  "2025-01-01 00:00:00") + ")" for p, k in _ALL_LOADED))
def q_ingest_all_rows(spark, sf_dir):
    """The STAGING rows of three tables loaded side by side."""
    work = scratch_dir(spark, "ingest_all_rows")
    names = {"suppliers": "supplier", "sales_orders": "orders", "inventory": "part"}
    src = _source_system(spark, sf_dir, work, {names[k]: STANDINS[k].base for _, k in _ALL_LOADED})
    done = ingest_all(spark, [_flow_cfg(p, names[k], "STG_" + k.upper(), src, pid=i)
                              for i, (p, k) in enumerate(_ALL_LOADED)],
                      control=Control(spark, work + "/control"), lake_root=work, now=FLOW_NOW1)
    out = None
    for r, (p, k) in zip(done, _ALL_LOADED):
        if r.status != "SUCCESS":
            raise RuntimeError(f"ingest run failed: {r.error}")
        rows = read_staging(spark, r.staging_path).select(
            F.lit(p).alias("pipeline_name"),
            F.concat_ws("|", *[F.col(c).cast("string") for c in STANDINS[k].spec.keys])
             .alias("row_key"), "_cdc_operation", "_is_deleted", "_batch_id")
        out = rows if out is None else out.unionByName(rows)
    return out


@register("ingest_csv", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice,
       o_orderdate, 'INSERT' AS _cdc_operation, false AS _is_deleted FROM orders""")
def q_ingest_csv(spark, sf_dir):
    """A table without a built-in spec, from one config row: CSV source, composite key,
    column list of the target."""
    work = scratch_dir(spark, "ingest_csv")
    _table(spark, sf_dir, "orders").write.option("header", "true").csv(work + "/source/orders")
    cfg = dict(_flow_cfg("pl_orders", "orders", "STG_ORDERS", work + "/source"), source_type="CSV",
               cdc_column="o_orderdate", primary_key_columns="o_custkey, o_orderkey")
    target = schema_of("o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
                       "o_totalprice decimal(15,2), o_orderdate timestamp_ntz")
    r = ingest_table(spark, cfg, control=Control(spark, work + "/control"), lake_root=work,
                     now=FLOW_NOW1, targets={"STG_ORDERS": target})
    if r.status != "SUCCESS":
        raise RuntimeError(f"ingest run failed: {r.error}")
    return read_staging(spark, r.staging_path).select(*target.names, "_cdc_operation", "_is_deleted")


# ---------------------------------------------------------------------------
# Streaming: X1, X2, M13 (two file drops, two available-now runs, one checkpoint)
# ---------------------------------------------------------------------------

STREAM_CUT = "2024-01-15 00:00:00"


def _drops(spark, sf_dir, landing):
    ev = _table(spark, sf_dir, "events")
    cut = F.lit(dt.datetime(2024, 1, 15))
    return ev, (lambda: ev.where(F.col("ts") < cut).write.mode("append").parquet(landing)), \
        (lambda: ev.where(F.col("ts") >= cut).write.mode("append").parquet(landing))


@register("stream_landing", f"""
SELECT *, CASE WHEN ts < TIMESTAMP '{STREAM_CUT}' THEN 1 ELSE 2 END AS stream_run FROM events""")
def q_stream_landing(spark, sf_dir):
    work = scratch_dir(spark, "stream_landing")
    landing, sink, ckpt = work + "/landing", work + "/sink", work + "/ckpt"
    ev, drop1, drop2 = _drops(spark, sf_dir, landing)

    def to_sink(run_no):
        def f(batch_df, epoch_id):
            # one folder per micro-batch, overwritten on retry: exactly-once output
            (batch_df.drop("_source_file").withColumn("stream_run", F.lit(run_no))
                     .write.mode("overwrite").parquet(f"{sink}/epoch={epoch_id}"))
        return f
    drop1()
    stream_merge(stream_landing(spark, landing, ev.schema), to_sink(1), ckpt)
    drop2()
    stream_merge(stream_landing(spark, landing, ev.schema), to_sink(2), ckpt)
    return spark.read.parquet(sink).drop("epoch")


def _stream_merge_oracle() -> str:
    si, d = SpecOnly(EVENTS_SPEC), DUCK
    cols = "user_id, event_id, event_type, value, ts AS created_at, ts AS updated_at"
    d1 = f"SELECT {cols} FROM events WHERE ts < TIMESTAMP '{STREAM_CUT}'"
    d2 = f"SELECT {cols} FROM events WHERE ts >= TIMESTAMP '{STREAM_CUT}'"
    l1 = (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id "
          f"ORDER BY updated_at DESC NULLS FIRST) AS rn FROM ({d1})) WHERE rn = 1")
    first = staging_sql(si, d, l1, "pl_events", "EPOCH-0", "stream", "2025-01-01 00:00:00")
    raw2 = raw_rows_sql(si, d, d2, "pl_events", "EPOCH-1", "stream", "2025-01-02 00:00:00")
    return merge_oracle_sql(si, d, target=first, raw=raw2, now="2025-01-02 00:00:00")


@register("stream_merge", _stream_merge_oracle())
def q_stream_merge(spark, sf_dir):
    work = scratch_dir(spark, "stream_merge")
    landing, ckpt = work + "/landing", work + "/ckpt"
    ev, drop1, drop2 = _drops(spark, sf_dir, landing)
    table = StagingTable(spark, work + "/staging/EVENTS", EVENTS_SPEC)

    def merge_batch(batch_df, epoch_id):
        now = NOW_DT + dt.timedelta(days=int(epoch_id))
        rows = batch_df.select("user_id", "event_id", "event_type", "value",
                               F.col("ts").alias("created_at"), F.col("ts").alias("updated_at"),
                               "_source_file")
        raw = stamp_audit(rows, "pl_events", f"EPOCH-{epoch_id}", "stream", "STREAM", now)
        table.merge(raw, now, f"EPOCH-{epoch_id}")
    drop1()
    stream_merge(stream_landing(spark, landing, ev.schema), merge_batch, ckpt)
    drop2()
    stream_merge(stream_landing(spark, landing, ev.schema), merge_batch, ckpt)
    return table.read()


# ---------------------------------------------------------------------------
# E1 with rules: Q8 (rules read from a rules table), Q9 inside the flow,
# K9 result rows, E8 PARTIAL status
# ---------------------------------------------------------------------------


def _quality_source_sql(d: Dialect) -> str:
    return (f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, "
            f"NULLIF(l_returnflag, 'A') AS l_returnflag, "
            f"CASE WHEN l_partkey % 97 = 0 THEN lower(l_linestatus) ELSE l_linestatus END "
            f"AS l_linestatus, l_shipdate AS created_at, l_shipdate AS updated_at "
            f"FROM {d.t('lineitem')}")


_QUALITY_RULE_ROWS = [
    # rule_id, rule_name, rule_type, column_name, regex, min, max, ref_table, ref_column, action, severity, order
    (1, "lq_returnflag_nn", "NOT_NULL", "l_returnflag", None, None, None, None, None,
     "QUARANTINE", "HIGH", 1),
    (2, "lq_status_regex", "REGEX", "l_linestatus", "^[OF]$", None, None, None, None,
     "QUARANTINE", "HIGH", 2),
    (3, "lq_qty_range", "RANGE", "l_quantity", None, "1", "45", None, None, "WARN", "LOW", 3),
    (4, "lq_line_unique", "UNIQUENESS", "l_orderkey,l_linenumber", None, None, None, None,
     None, "FLAG", "MEDIUM", 4),
    (5, "lq_supplier_ref", "REFERENTIAL", "l_suppkey", None, None, None, "supplier",
     "s_suppkey", "WARN", "MEDIUM", 5),
]


def _quality_rules_df(spark):
    rows = [(rid, "pl_lineitem", name, typ, col, None, mn, mx, rx, None, None, rt, rc, act, sev,
             None, order, True, None)
            for rid, name, typ, col, rx, mn, mx, rt, rc, act, sev, order in _QUALITY_RULE_ROWS]
    return spark.createDataFrame(rows, DQ_RULES_SCHEMA)


@register("ingest_quality", f"""
WITH src AS ({_quality_source_sql(DUCK)}),
dups AS (SELECT l_orderkey AS dk, l_linenumber AS dl FROM src
         GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1),
ev AS (
  SELECT s.l_orderkey, s.l_linenumber,
         s.l_returnflag IS NOT NULL AS r1,
         (s.l_linestatus IS NULL OR regexp_matches(s.l_linestatus, '^[OF]$')) AS r2,
         (s.l_quantity IS NULL OR (s.l_quantity >= 1 AND s.l_quantity <= 45)) AS r3,
         d.dk IS NULL AS r4,
         (s.l_suppkey IS NULL OR s.l_suppkey IN (SELECT s_suppkey FROM supplier)) AS r5
  FROM src s LEFT JOIN dups d ON s.l_orderkey = d.dk AND s.l_linenumber = d.dl)
SELECT 'pl_lineitem' AS pipeline_name, 'PARTIAL' AS status, count(*) AS rows_extracted,
       count(*) FILTER (WHERE r1 AND r2) AS rows_loaded,
       count(*) FILTER (WHERE r1 AND r2 AND r3 AND r4 AND r5) AS rows_passed_dq,
       count(*) FILTER (WHERE NOT (r1 AND r2 AND r3 AND r4 AND r5)) AS rows_failed_dq,
       (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM ev WHERE r1 AND r2))
         AS staging_rows,
       CAST({len(_QUALITY_RULE_ROWS)} AS BIGINT) AS rule_results
FROM ev""")
def q_ingest_quality(spark, sf_dir):
    work = scratch_dir(spark, "ingest_quality")
    control = Control(spark, work + "/control")
    src = _source_system(spark, sf_dir, work, {"lineitem": _quality_source_sql})
    rules = Q.rules_from_table(_quality_rules_df(spark), "pl_lineitem")
    cfg = _flow_cfg("pl_lineitem", "lineitem", "STG_LINEITEM", src, "FULL")
    r = ingest_table(spark, cfg, control=control, lake_root=work, now=FLOW_NOW1,
                     specs={"LINEITEM": LINEITEM_SPEC}, rules=rules,
                     refs={"supplier": _table(spark, sf_dir, "supplier")})
    if r.status not in ("SUCCESS", "PARTIAL"):
        raise RuntimeError(f"ingest run failed: {r.error}")
    staging_rows = read_staging(spark, r.staging_path).agg(F.count(F.lit(1))).scalar()
    rule_results = control.dq_results().agg(F.count(F.lit(1))).scalar()
    return control.runs().select("pipeline_name", "status", "rows_extracted", "rows_loaded",
                                 "rows_passed_dq", "rows_failed_dq",
                                 staging_rows.alias("staging_rows"),
                                 rule_results.alias("rule_results"))


@register("ingest_quality_rows", f"""
WITH src AS ({_quality_source_sql(DUCK)}),
dups AS (SELECT l_orderkey AS dk, l_linenumber AS dl FROM src
         GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
SELECT DISTINCT s.l_orderkey, s.l_linenumber,
       CASE WHEN d.dk IS NULL THEN '' ELSE 'lq_line_unique' END AS dq_flags
FROM src s LEFT JOIN dups d ON s.l_orderkey = d.dk AND s.l_linenumber = d.dl
WHERE s.l_returnflag IS NOT NULL
  AND (s.l_linestatus IS NULL OR regexp_matches(s.l_linestatus, '^[OF]$'))""")
def q_ingest_quality_rows(spark, sf_dir):
    """The STAGING rows themselves, with the FLAG rules each row failed."""
    work = scratch_dir(spark, "ingest_quality_rows")
    src = _source_system(spark, sf_dir, work, {"lineitem": _quality_source_sql})
    r = ingest_table(spark, _flow_cfg("pl_lineitem", "lineitem", "STG_LINEITEM", src, "FULL"),
                     control=Control(spark, work + "/control"), lake_root=work, now=FLOW_NOW1,
                     specs={"LINEITEM": LINEITEM_SPEC},
                     rules=Q.rules_from_table(_quality_rules_df(spark), "pl_lineitem"),
                     refs={"supplier": _table(spark, sf_dir, "supplier")})
    if r.status not in ("SUCCESS", "PARTIAL"):
        raise RuntimeError(f"ingest run failed: {r.error}")
    return read_staging(spark, r.staging_path).select(
        "l_orderkey", "l_linenumber", F.array_join(Q.FLAGS, ",").alias("dq_flags"))


# ---------------------------------------------------------------------------
# Replay a landed batch (no new extract); the merge leaves STAGING as it was
# ---------------------------------------------------------------------------


@register("replay_batch", staging_sql(STANDINS["purchase_orders"], DUCK,
                                      STANDINS["purchase_orders"].base(DUCK),
                                      "pl_purchase_orders", "BATCH-20250101-000000", "run-1",
                                      "2025-01-01 00:00:00"))
def q_replay_batch(spark, sf_dir):
    si = STANDINS["purchase_orders"]
    work = scratch_dir(spark, "replay_batch")
    control = Control(spark, work + "/control")
    src = _source_system(spark, sf_dir, work, {"purchase_orders": si.base})
    cfg = _flow_cfg("pl_purchase_orders", "purchase_orders", "STG_PURCHASE_ORDERS", src)
    r1 = ingest_table(spark, cfg, control=control, lake_root=work, now=FLOW_NOW1,
                      run_id="run-1")
    r1_batch = "BATCH-20250101-000000"
    landed = replay(spark, work + "/landing", "raw", "supply_chain/purchase_orders",
                    "purchase_orders", FLOW_NOW1, r1_batch)
    if landed.limit(1).count() == 0:
        raise RuntimeError("nothing landed to replay")
    table = StagingTable(spark, r1.staging_path, si.spec)
    landing = landing_path(work + "/landing", "raw", "supply_chain/purchase_orders",
                           "purchase_orders", FLOW_NOW1)
    reprocess_batch(spark, landing, r1_batch, si.spec, table, FLOW_NOW2, work + "/replay_raw",
                    pipeline_name="pl_purchase_orders", run_id="run-1")
    return table.read()


# ---------------------------------------------------------------------------
# K8 through the single-pass RAW load: rejects read back from the RAW folder
# ---------------------------------------------------------------------------


@register("raw_rejects", f"""
SELECT p_partkey, CAST(NULL AS INTEGER) AS p_size, 'p_size' AS bad_columns,
       '{BATCH1}' AS _batch_id, 'FULL' AS _load_type, false AS _is_deleted
FROM part WHERE p_partkey % 10 = 0""")
def q_raw_rejects(spark, sf_dir):
    work = scratch_dir(spark, "raw_rejects")
    path = landing_path(work, "raw", "supply_chain/part", "part", NOW_DT)
    land(_junk_part(_table(spark, sf_dir, "part")), path, BATCH1)
    raw_path = work + "/RAW/RAW_PART"
    load_raw(read_landing(spark, path, BATCH1), BAD_TARGET, raw_path, pipeline_name="pl_part",
             batch_id=BATCH1, run_id="run-1", load_type="FULL", now=NOW_DT)
    rej = read_rejects(spark, raw_path)
    return rej.select("p_partkey", "p_size", F.array_join(BAD_COLUMNS, ",").alias("bad_columns"),
                      "_batch_id", "_load_type", "_is_deleted")


# ---------------------------------------------------------------------------
# K4 on its own: the STAGING sink, initial load then a change batch, both forms
# ---------------------------------------------------------------------------
T0_DT = dt.datetime(2024, 12, 31)


def _staging_merge(spark, sf_dir, key: str, join_hint: str | None = None,
                   again: bool = False) -> DataFrame:
    si = STANDINS[key]
    work = scratch_dir(spark, f"staging_{key}")
    table = StagingTable(spark, work + "/staging", si.spec, join_hint=join_hint)
    table.merge(_sql(spark, sf_dir, lambda d: initial_raw_sql(si, d)), T0_DT,
                "BATCH-20241231-000000")
    table.merge(_sql(spark, sf_dir, lambda d: raw_sql(si, d)), NOW_DT, BATCH1)
    if again:   # the same batch at a later time: nothing to write
        got = table.merge(_sql(spark, sf_dir, lambda d: raw_sql(si, d)),
                          NOW_DT + dt.timedelta(days=1), BATCH1)
        if got["rows_written"] or got["rows_changed"]:
            raise RuntimeError(f"a repeated batch changed the table: {got}")
    return table.read()


register("merge_staging_shipments", merge_oracle_sql(STANDINS["shipments"], DUCK))(
    lambda spark, sf_dir: _staging_merge(spark, sf_dir, "shipments"))
register("merge_staging_shuffle", merge_oracle_sql(STANDINS["shipments"], DUCK))(
    lambda spark, sf_dir: _staging_merge(spark, sf_dir, "shipments", "merge"))
register("merge_staging_replay", merge_oracle_sql(STANDINS["shipments"], DUCK))(
    lambda spark, sf_dir: _staging_merge(spark, sf_dir, "shipments", again=True))


from sluice.plans import catalog_checks  # noqa: E402,F401  registers its queries here
