"""Queries over several loads: repeated epochs, evolving schemas, reconciliation,
sketched profiles, renamed columns and split points."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import functions as F

from sluice.operators import quality as Q
from sluice.operators.incremental_checks import (key_filter, merge_filters, referential_delta, referential_violations,
                                                 unique_across_batches)
from sluice.operators.projection import stamp_audit
from sluice.operators.reconcile import reconcile_ranges
from sluice.operators.redrive import ATTEMPTS, redrive, with_content_key
from sluice.operators.sketches import drift_from_sketches, drift_renames, profile_sketches
from sluice.operators.trend import SCALE, trend_anomalies
from sluice.plans import catalog as C
from sluice.plans.flow import Control, ingest_table
from sluice.plans.standins import EVENTS_SPEC, SpecOnly, merge_oracle_sql, raw_rows_sql, staging_sql
from sluice.session import scratch_dir
from sluice.sinks.staging import StagingTable, read_staging
from sluice.sources.splits import split_points, split_predicates, split_reads
from sluice.spec import schema_of
from sluice.streaming.incremental import stream_landing, stream_late_rows, stream_merge

# -- X2, M13: a micro-batch that runs twice --------------------------------------

_NULL_USER = "CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id END AS user_id"


def _replay_oracle() -> str:
    si, d = SpecOnly(EVENTS_SPEC), C.DUCK
    cols = f"{_NULL_USER}, event_id, event_type, value, ts AS created_at, ts AS updated_at"
    d1, d2 = (f"SELECT {cols} FROM events WHERE ts {op} TIMESTAMP '{C.STREAM_CUT}'" for op in ("<", ">="))
    l1 = (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id "
          f"ORDER BY updated_at DESC NULLS FIRST) AS rn FROM ({d1})) WHERE rn = 1")
    first = staging_sql(si, d, l1, "pl_events", "EPOCH-0", "stream", "2025-01-01 00:00:00")
    raw2 = raw_rows_sql(si, d, d2, "pl_events", "EPOCH-1", "stream", "2025-01-02 00:00:00")
    return merge_oracle_sql(si, d, target=first, raw=raw2, now="2025-01-02 00:00:00")


@C.register("stream_merge_replay", _replay_oracle())
def q_stream_merge_replay(spark, sf_dir):
    """Every micro-batch is applied twice, as after a driver lost between the merge and
    the checkpoint; rows without a key would show a second merge."""
    work = scratch_dir(spark, "stream_merge_replay")
    landing, ckpt = work + "/landing", work + "/ckpt"
    ev, drop1, drop2 = C._drops(spark, sf_dir, landing)
    table = StagingTable(spark, work + "/staging/EVENTS", EVENTS_SPEC)

    def merge_batch(batch_df, epoch_id):
        now = C.NOW_DT + dt.timedelta(days=int(epoch_id))
        rows = batch_df.select(F.expr(_NULL_USER), "event_id", "event_type", "value",
                               F.col("ts").alias("created_at"), F.col("ts").alias("updated_at"), "_source_file")
        raw = stamp_audit(rows, "pl_events", f"EPOCH-{epoch_id}", "stream", "STREAM", now)
        table.merge(raw, now, f"EPOCH-{epoch_id}", epoch=("pl_events", int(epoch_id)))

    def lost_and_again(batch_df, epoch_id):
        merge_batch(batch_df, epoch_id)
        merge_batch(batch_df, epoch_id)
    for drop in (drop1, drop2):
        drop()
        stream_merge(stream_landing(spark, landing, ev.schema), lost_and_again, ckpt)
    return table.read()


# -- Q14 in the flow: three loads, one column new, two widened ----------------------

@C.register("ingest_evolving", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'C-' || CAST(o_custkey AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey,
       CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_totalprice AS DECIMAL(22,2)) + 0.25
            ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS DECIMAL(22,2)) END AS o_totalprice,
       CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + to_days(2) ELSE o_orderdate END AS o_orderdate,
       CASE WHEN o_orderkey % 2 <> 0 AND o_orderkey % 3 = 2 THEN 'web' END AS o_channel,
       CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 <> 2 THEN 'UPDATE' WHEN o_orderkey % 2 = 0 THEN 'UPDATE' ELSE 'INSERT' END AS _cdc_operation
FROM orders""")
def q_ingest_evolving(spark, sf_dir):
    """Load 1: keys with k % 3 <> 2; load 2: the others, with a new column; load 3: even
    keys again, two days later, with text customers, decimal prices and no channel."""
    work = scratch_dir(spark, "ingest_evolving")
    o = C._table(spark, sf_dir, "orders").withColumn("price", F.floor("o_totalprice"))
    k = F.col("o_orderkey")
    cols = lambda cust, price, date, *more: [k, cust.alias("o_custkey"), price.alias("o_totalprice"), date.alias("o_orderdate"), *more]
    loads = [
        o.where(k % 3 != 2).select(*cols(F.col("o_custkey").cast("int"), F.col("price").cast("int"), F.col("o_orderdate"))),
        o.where(k % 3 == 2).select(*cols(F.col("o_custkey"), F.col("price").cast("bigint"), F.col("o_orderdate"), F.lit("web").alias("o_channel"))),
        o.where(k % 2 == 0).select(*cols(F.concat(F.lit("C-"), F.col("o_custkey").cast("string")),
                                         (F.col("o_totalprice").cast("decimal(20,2)") + F.lit("0.25").cast("decimal(2,2)")).cast("decimal(22,2)"),
                                         F.expr("o_orderdate + INTERVAL 2 DAYS"))),
    ]
    target = schema_of("o_orderkey bigint, o_custkey int, o_totalprice int, o_orderdate timestamp_ntz")
    for i, load in enumerate(loads):
        load.write.parquet(f"{work}/source/v{i}/orders")
        cfg = dict(C._flow_cfg("pl_orders", "orders", "STG_ORDERS", work + "/source", load_type="FULL"), source_database=f"v{i}",
                   primary_key_columns="o_orderkey", cdc_column="o_orderdate")
        r = ingest_table(spark, cfg, control=Control(spark, work + "/control"), lake_root=work,
                         now=C.FLOW_NOW1 + dt.timedelta(days=i), targets={"STG_ORDERS": target}, evolve=True)
        if r.status != "SUCCESS":
            raise RuntimeError(f"load {i} failed: {r.error}")
    return read_staging(spark, r.staging_path).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_channel", "_cdc_operation")


# -- Q12: content, not counts --------------------------------------------------------

@C.register("reconcile_ranges", """
WITH r AS (SELECT CASE WHEN o_orderkey % 1499 = 1 THEN o_orderkey + 1000003 ELSE o_orderkey END AS o_orderkey, o_custkey, o_orderdate,
                  CASE WHEN o_orderkey % 997 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
                  CASE WHEN o_orderkey % 1201 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders)
SELECT COALESCE(l.o_orderkey, r.o_orderkey) AS o_orderkey, CAST(CASE WHEN l.o_orderkey IS NULL THEN 0 ELSE 1 END AS BIGINT) AS left_rows,
       CAST(CASE WHEN r.o_orderkey IS NULL THEN 0 ELSE 1 END AS BIGINT) AS right_rows,
       CASE WHEN r.o_orderkey IS NULL THEN 'LEFT_ONLY' WHEN l.o_orderkey IS NULL THEN 'RIGHT_ONLY' ELSE 'CHANGED' END AS difference
FROM orders l FULL OUTER JOIN r ON l.o_orderkey = r.o_orderkey
WHERE l.o_orderkey IS NULL OR r.o_orderkey IS NULL OR l.o_totalprice <> r.o_totalprice OR l.o_orderstatus IS DISTINCT FROM r.o_orderstatus""")
def q_reconcile_ranges(spark, sf_dir):
    """Changed values, a value lost to NULL, and keys that moved: counts are equal."""
    cols = ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus"]
    left = C._table(spark, sf_dir, "orders").select(*cols)
    k = F.col("o_orderkey")
    right = left.select(F.when(k % 1499 == 1, k + 1000003).otherwise(k).alias("o_orderkey"), "o_custkey", "o_orderdate",
                        F.when(k % 997 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
                        F.when(k % 1201 != 0, F.col("o_orderstatus")).alias("o_orderstatus"))
    work = scratch_dir(spark, "reconcile")
    right.write.parquet(work + "/right")
    return reconcile_ranges(left, spark.read.parquet(work + "/right"), ["o_orderkey"])


# -- Q13: windows of loads by their sketches, renamed columns --------------------------

_NUM = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


def _sketch_side(p: str, where: str, price: str, status: str) -> str:
    def col(c, x):
        num = {"o_orderdate": f"CAST(epoch_us({x}) AS DOUBLE)"}.get(c, f"CAST({x} AS DOUBLE)") if c in _NUM else None
        lo, hi = (f"min({num})", f"max({num})") if num else ("NULL", "NULL")
        tlo, thi = ("NULL", "NULL") if num else (f"min({x})", f"max({x})")
        q = (f"quantile_disc({num}, 0.25) AS q1, quantile_disc({num}, 0.5) AS q2, quantile_disc({num}, 0.75) AS q3" if num
             else "NULL AS q1, NULL AS q2, NULL AS q3")
        return (f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) FILTER (WHERE {x} IS NULL) AS null_count, {lo} AS min_number, "
                f"{hi} AS max_number, {tlo} AS min_text, {thi} AS max_text, count(DISTINCT {x}) AS d, {q} FROM orders WHERE {where}")
    return " UNION ALL ".join(col(c, {"o_totalprice": price, "o_orderstatus": status}.get(c, c))
                              for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"))


_EARLY, _LATE = "o_orderdate < TIMESTAMP '1998-01-01 00:00:00'", "o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'"


@C.register("drift_from_sketches", f"""
WITH a AS ({_sketch_side('prev_', _EARLY, 'o_totalprice', 'o_orderstatus')}),
b AS ({_sketch_side('curr_', _LATE, 'o_totalprice * 4', "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END")})
SELECT a.column_name, 'SAME' AS change, {', '.join(f'{s}.{c} AS {p}{c}' for c in ('row_count', 'null_count', 'min_number', 'max_number', 'min_text', 'max_text')
                                                    for s, p in (('a', 'prev_'), ('b', 'curr_')))},
       CASE WHEN b.d > 1.5 * a.d THEN 'UP' WHEN a.d > 1.5 * b.d THEN 'DOWN' ELSE 'SAME' END AS distinct_shift,
       CASE WHEN a.q1 IS NULL THEN NULL WHEN b.q2 > a.q3 THEN 'UP' WHEN b.q2 < a.q1 THEN 'DOWN' ELSE 'SAME' END AS quantile_shift
FROM a JOIN b ON a.column_name = b.column_name""")
def q_drift_from_sketches(spark, sf_dir):
    """Four loads leave their profile rows; the first three are compared with the last
    from those rows alone."""
    work = scratch_dir(spark, "sketches")
    o = C._table(spark, sf_dir, "orders")
    date = F.col("o_orderdate")
    cuts = [None, dt.datetime(1994, 1, 1), dt.datetime(1996, 1, 1), dt.datetime(1998, 1, 1), None]
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        load = o.where((date >= lo if lo else F.lit(True)) & (date < hi if hi else F.lit(True)))
        if i == 3:
            load = load.withColumns({"o_totalprice": F.col("o_totalprice") * 4,
                                     "o_orderstatus": F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))})
        profile_sketches(load, f"load-{i}").write.parquet(f"{work}/profiles/load={i}")
    out = drift_from_sketches(spark.read.parquet(work + "/profiles").drop("load"), ["load-0", "load-1", "load-2"], ["load-3"])
    return out.drop("prev_distinct_count", "curr_distinct_count", "prev_quantiles", "curr_quantiles")


def _jaccard(a: str, b: str) -> str:
    va, vb = (f"(SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM orders WHERE {c} IS NOT NULL)" for c in (a, b))
    return (f"(SELECT count(*) FROM {va} x JOIN {vb} y ON x.v = y.v) * 1.0 / "
            f"(SELECT count(*) FROM (SELECT v FROM {va} UNION SELECT v FROM {vb}))")


_RENAMED = {"customer_id": "o_custkey", "priority": "o_orderpriority", "o_flag": "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END"}


@C.register("drift_renames", " UNION ALL ".join(
    f"SELECT '{old}' AS removed_column, '{new}' AS added_column WHERE {_jaccard(old, x)} >= 0.8"
    for old in ("o_custkey", "o_orderpriority", "o_orderstatus") for new, x in _RENAMED.items()))
def q_drift_renames(spark, sf_dir):
    o = C._table(spark, sf_dir, "orders")
    new = o.select("o_orderkey", "o_totalprice", "o_orderdate", *[F.expr(x).alias(n) for n, x in _RENAMED.items()])
    return drift_renames(o, new).select("removed_column", "added_column")


# -- S5: computed split points -----------------------------------------------------------

@C.register("split_points", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 7 = 0 THEN NULL WHEN l_partkey % 3 = 0 THEN 12 ELSE l_partkey END AS l_partkey,
       l_suppkey, l_quantity FROM lineitem""")
def q_split_points(spark, sf_dir):
    """lineitem with many NULLs and one hot part, read in 16 even splits."""
    p = F.col("l_partkey")
    df = C._table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(p % 7 == 0, None).when(p % 3 == 0, 12).otherwise(p).alias("l_partkey"), "l_suppkey", "l_quantity")
    points, hot, nulls = split_points(df, "l_partkey", 16)
    return reduce(lambda a, b: a.unionByName(b), split_reads(df, split_predicates("l_partkey", points, hot, nulls)))


# -- Q5, V4: three batches of changed children and parents -------------------------------

def _fk(b: int) -> str:
    return f"CASE WHEN o_orderkey % 7 = {b} THEN o_custkey + 1000000 ELSE o_custkey END"


@C.register("referential_delta", " UNION ALL ".join(
    f"SELECT CAST({b} AS BIGINT) AS batch, o_orderkey, {_fk(b)} AS o_custkey FROM orders WHERE {_fk(b)} NOT IN "
    f"(SELECT c_custkey FROM customer WHERE c_custkey % 10 <> {b})" for b in (1, 2, 3)))
def q_referential_delta(spark, sf_dir):
    """Batch b breaks the orders with k % 7 = b and mends those of the batch before, deletes
    the customers with k % 10 = b and brings back those of the batch before."""
    work = scratch_dir(spark, "referential")
    orders, customer = C._table(spark, sf_dir, "orders"), C._table(spark, sf_dir, "customer").select("c_custkey")
    children = lambda b: orders.select("o_orderkey", F.expr(_fk(b)).alias("o_custkey"))
    parents = lambda b: customer.where(F.col("c_custkey") % 10 != b) if b else customer
    before = referential_violations(orders.select("o_orderkey", "o_custkey"), customer, "o_custkey", "c_custkey")
    out = []
    for b in (1, 2, 3):
        changed = orders.where((F.col("o_orderkey") % 7 == b) | (F.col("o_orderkey") % 7 == b - 1 if b > 1 else F.lit(False)))
        referential_delta(before, children(b), parents(b), changed.select("o_orderkey"), customer.where(F.col("c_custkey") % 10 == b),
                          ["o_orderkey"], "o_custkey", "c_custkey").write.parquet(f"{work}/batch{b}")
        before = spark.read.parquet(f"{work}/batch{b}")
        out.append(before.select(F.lit(b).cast("long").alias("batch"), "o_orderkey", "o_custkey"))
    return reduce(lambda a, b: a.unionByName(b), out)


# -- Q2, V3: keys that repeat within or across batches ------------------------------------

@C.register("unique_across_batches", """
WITH g AS (SELECT l_partkey % 3 AS batch, l_orderkey, l_linenumber, count(*) AS n_in_batch FROM lineitem GROUP BY ALL)
SELECT * FROM (SELECT g.*, EXISTS (SELECT 1 FROM g h WHERE h.batch < g.batch AND h.l_orderkey = g.l_orderkey
                                   AND h.l_linenumber = g.l_linenumber) AS seen_before FROM g)
WHERE n_in_batch > 1 OR seen_before""")
def q_unique_across_batches(spark, sf_dir):
    work, keys, space = scratch_dir(spark, "unique"), ["l_orderkey", "l_linenumber"], 1 << 24
    df = C._table(spark, sf_dir, "lineitem").select(*keys, (F.col("l_partkey") % 3).alias("batch"))
    seen, history, out = spark.createDataFrame([], "bucket bigint, bits binary"), df.limit(0).select(*keys), []
    for b in range(3):
        batch = df.where(F.col("batch") == b)
        out.append(unique_across_batches(batch, keys, seen, history, space).withColumn("batch", F.lit(b).cast("long")))
        merge_filters(seen, key_filter(batch, keys, space)).write.parquet(f"{work}/filter{b}")
        seen, history = spark.read.parquet(f"{work}/filter{b}"), df.where(F.col("batch") <= b).select(*keys)
    return reduce(lambda a, b: a.unionByName(b), out)


# -- X3: late rows as they come, over three runs of one stream -----------------------------

@C.register("stream_late_rows", """
SELECT e.* FROM events e WHERE EXISTS (SELECT 1 FROM events h WHERE h.user_id = e.user_id AND h.event_id % 3 < e.event_id % 3
                                       AND h.ts > e.ts)""")
def q_stream_late_rows(spark, sf_dir):
    work = scratch_dir(spark, "stream_late")
    ev = C._table(spark, sf_dir, "events")
    for run in range(3):
        ev.where(F.col("event_id") % 3 == run).write.mode("append").parquet(work + "/landing")
        late = stream_late_rows(stream_landing(spark, work + "/landing", ev.schema).drop("_source_file"), ["user_id"], "ts")
        stream_merge(late, lambda df, epoch: df.write.mode("overwrite").parquet(f"{work}/late/epoch={epoch}"), work + "/ckpt")
    return spark.read.schema(ev.schema).parquet(work + "/late").select(*ev.columns)


# -- G8, N4, N8: days that leave the trend --------------------------------------------------

_DAILY = ("SELECT o_orderpriority AS pipeline_name, CAST(o_orderdate AS DATE) AS run_date, "
          "count(*) * CASE WHEN extract(day FROM CAST(o_orderdate AS DATE)) = 13 THEN 9 ELSE 1 END AS rows_loaded FROM {t} GROUP BY 1, 2, o_orderdate")


@C.register("trend_anomalies", f"""
WITH d AS ({_DAILY.format(t='orders')}),
h AS (SELECT a.pipeline_name, a.run_date, CAST(a.rows_loaded AS DOUBLE) AS value, list(CAST(b.rows_loaded AS DOUBLE)) AS past
      FROM d a JOIN d b ON a.pipeline_name = b.pipeline_name AND dayofweek(a.run_date) = dayofweek(b.run_date)
           AND b.run_date BETWEEN a.run_date - 56 AND a.run_date - 1 GROUP BY ALL HAVING count(*) >= 3),
m AS (SELECT *, list_median(past) AS median FROM h),
s AS (SELECT *, list_median(list_transform(past, lambda x: abs(x - median))) AS mad FROM m)
SELECT pipeline_name, run_date, value, median, mad, CASE WHEN mad > 0 THEN abs(value - median) / ({SCALE} * mad) END AS score,
       CAST(len(past) AS BIGINT) AS n_history, CASE WHEN value > median THEN 'HIGH' ELSE 'LOW' END AS direction
FROM s WHERE CASE WHEN mad > 0 THEN abs(value - median) / ({SCALE} * mad) > 3.5 ELSE value <> median END""")
def q_trend_anomalies(spark, sf_dir):
    """Orders per priority and day as the runs of five pipelines, nine times as many on the 13th."""
    return trend_anomalies(C._sql(spark, sf_dir, lambda d: _DAILY.format(t=d.t("orders"))), "pipeline_name", "run_date", "rows_loaded")


# -- E9, K8: rejects driven again under a wider schema ---------------------------------------

_SIZE_TEXT = ("CASE WHEN p_partkey % 25 = 0 THEN 'n/a' WHEN p_partkey % 10 = 3 THEN CAST(p_size AS {s}) || '.5' "
              "ELSE CAST(p_size AS {s}) END")


@C.register("redrive_rejects", """
SELECT p_partkey, CASE WHEN p_partkey % 25 <> 0 THEN CAST(p_size AS DECIMAL(6,1)) + CASE WHEN p_partkey % 10 = 3 THEN 0.5 ELSE 0 END END AS p_size,
       CAST(CASE WHEN p_partkey % 25 = 0 OR p_partkey % 10 = 3 THEN 2 ELSE 1 END AS BIGINT) AS attempt,
       CASE WHEN p_partkey % 25 = 0 THEN 'FAILED' ELSE 'PASSED' END AS outcome FROM part""")
def q_redrive_rejects(spark, sf_dir):
    """First drive to whole sizes, second to decimals, third the same again: it moves nothing."""
    work = scratch_dir(spark, "redrive")
    landed = C._table(spark, sf_dir, "part").select("p_partkey", F.expr(_SIZE_TEXT.format(s="STRING")).alias("p_size"))
    log = spark.createDataFrame([], ATTEMPTS)
    done = []
    for i, (kind, version) in enumerate((("int", "v1"), ("decimal(6,1)", "v2"), ("decimal(6,1)", "v2"))):
        passed, new = redrive(landed, log, schema_of(f"p_partkey bigint, p_size {kind}"), version)
        passed.withColumn("p_size", F.col("p_size").cast("decimal(6,1)")).write.parquet(f"{work}/passed/drive={i}")
        new.write.parquet(f"{work}/log/drive={i}")
        log = spark.read.schema(new.schema).parquet(*[f"{work}/log/drive={k}" for k in range(i + 1)])
        done.append(spark.read.parquet(f"{work}/passed/drive={i}"))
    if not (done[2].isEmpty() and spark.read.parquet(f"{work}/log/drive=2").isEmpty()):
        raise RuntimeError("a second drive under one version moved rows")
    rows = reduce(lambda a, b: a.unionByName(b), done)
    last = log.groupBy("_content_key").agg(F.max("attempt").alias("attempt"), F.max_by("outcome", "attempt").alias("outcome"))
    return (with_content_key(landed).select("p_partkey", "_content_key").join(last, "_content_key")
            .join(rows.select("p_partkey", "p_size"), "p_partkey", "left").select("p_partkey", "p_size", "attempt", "outcome"))


# -- N5, J4: DQ results joined to their runs ----------------------------------------------

@C.register("dq_report_runs", C._RUNS_SQL + f""",
res AS (SELECT run_id, pipeline_name, CASE WHEN rows_loaded % 2 = 0 THEN 'HIGH' ELSE 'LOW' END AS severity,
               CASE WHEN rows_loaded % 3 = 0 THEN 'FAIL' ELSE 'PASS' END AS status, CAST(rows_loaded % 3 AS BIGINT) AS failed_records,
               CAST(TIMESTAMP '{C.NOW}' AS DATE) AS run_date FROM runs WHERE status <> 'RUNNING')
SELECT res.pipeline_name, res.run_date, res.severity, runs.status AS run_status, count(*) AS rules,
       count(*) FILTER (WHERE res.status <> 'PASS') AS rules_not_passed, CAST(sum(failed_records) AS BIGINT) AS failed_records
FROM res LEFT JOIN runs ON runs.run_id = res.run_id AND runs.pipeline_name = res.pipeline_name GROUP BY ALL""")
def q_dq_report_runs(spark, sf_dir):
    """One result row per finished run, reported with the run's status."""
    runs = C._runs(spark, sf_dir)
    n = F.col("rows_loaded")
    results = runs.where("status <> 'RUNNING'").select(
        "run_id", "pipeline_name", F.when(n % 2 == 0, "HIGH").otherwise("LOW").alias("severity"),
        F.when(n % 3 == 0, "FAIL").otherwise("PASS").alias("status"), (n % 3).cast("long").alias("failed_records"),
        F.lit(C.NOW_DT).cast("timestamp_ntz").alias("run_date"))
    return Q.dq_report(results, runs)
