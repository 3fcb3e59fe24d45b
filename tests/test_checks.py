"""Schema evolution, reconciliation, sketched profiles, renames and split points."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F, types as T

from sluice.operators.evolution import least_common_type, widen_schema
from sluice.operators.reconcile import differing_ranges, reconcile_ranges
from sluice.operators.sketches import drift_from_sketches, drift_renames, merge_profiles, profile_sketches
from sluice.plans.flow import Control, ingest_table
from sluice.sinks.staging import read_staging
from sluice.sources.splits import split_points, split_predicates, split_reads
from sluice.spec import schema_of

NOW = dt.datetime(2025, 1, 1)


@pytest.mark.parametrize("a,b,want", [
    ("int", "bigint", "bigint"), ("bigint", "decimal(10,2)", "decimal(21,2)"), ("decimal(10,2)", "decimal(12,4)", "decimal(12,4)"),
    ("decimal(38,0)", "decimal(38,10)", "string"), ("int", "double", "double"), ("bigint", "double", "string"),
    ("date", "timestamp_ntz", "timestamp_ntz"), ("boolean", "int", "string"), ("void", "int", "int"), ("float", "smallint", "float"),
    ("float", "int", "string"), ("string", "date", "string"), ("array<int>", "array<int>", "array<int>"), ("array<int>", "int", "string")])
def test_least_common_type(spark, a, b, want):
    kind = lambda x: spark.createDataFrame([], f"c {x}").schema["c"].dataType
    assert least_common_type(kind(a), kind(b)) == least_common_type(kind(b), kind(a)) == kind(want)


def test_widen_schema_keeps_order_and_names_every_change():
    wide, changes = widen_schema(schema_of("a int, b int, c string"), schema_of("D int, C string, A bigint"))
    assert wide == schema_of("a bigint, b int, c string, D int")
    assert [(c["column_name"], c["change"]) for c in changes] == [("a", "WIDENED"), ("b", "ABSENT"), ("D", "ADDED")]


@pytest.mark.parametrize("evolve", [False, True])
def test_a_new_source_column_is_never_dropped_in_silence(spark, work, evolve):
    rows = [(1, "a", NOW, "x"), (2, "b", NOW, None)]
    spark.createDataFrame(rows, "id bigint, v string, updated_at timestamp_ntz, extra string").write.parquet(work + "/src/t")
    cfg = {"pipeline_id": 1, "pipeline_name": "p", "source_type": "PARQUET", "source_server": work + "/src", "source_table": "t",
           "load_type": "FULL", "sink_table": "STG_T", "primary_key_columns": "id", "cdc_column": "updated_at"}
    ctl = Control(spark, work + "/ctl")
    r = ingest_table(spark, cfg, control=ctl, lake_root=work, now=NOW, evolve=evolve,
                     targets={"STG_T": schema_of("id int, v string, updated_at timestamp_ntz")})
    assert r.status == "SUCCESS", r.error
    got = read_staging(spark, r.staging_path)
    assert ("extra" in got.columns) == evolve and got.schema["id"].dataType == (T.LongType() if evolve else T.IntegerType())
    log = {(x.column_name, x.change, x.to_type) for x in ctl.schema_changes().collect()}
    assert ("extra", "ADDED" if evolve else "IGNORED", "string") in log
    assert (("id", "WIDENED", "bigint") in log) == evolve


def _pair(spark, seed):
    rng = random.Random(seed)
    left = [(rng.choice([None, rng.randrange(-500, 5000)]) if rng.random() < 0.05 else rng.randrange(5000), rng.choice([None, "x", "y"]),
             rng.random()) for _ in range(800)]
    right = [x for x in left if rng.random() > 0.02] + [(9000, "new", 1.0), (None, "new", 1.0)]
    right = [(k, ("z" if rng.random() < 0.02 else v), w) for k, v, w in right]
    return left, right


@pytest.mark.parametrize("seed,fanout,levels", [(1, 64, 2), (2, 3, 4), (3, 8, 1)])
def test_reconcile_finds_the_keys_whose_rows_differ(spark, seed, fanout, levels):
    left, right = _pair(spark, seed)
    a, b = (spark.createDataFrame(x, "k bigint, v string, w double") for x in (left, right))
    want = {}
    for k in {r[0] for r in left + right}:
        x, y = (sorted((r for r in side if r[0] == k), key=str) for side in (left, right))
        if x != y:
            want[k] = (len(x), len(y), "RIGHT_ONLY" if not x else "LEFT_ONLY" if not y else "CHANGED")
    got = {r.k: (r.left_rows, r.right_rows, r.difference) for r in reconcile_ranges(a, b, ["k"], fanout=fanout, levels=levels).collect()}
    assert got == want and None in got


def test_reconcile_edges(spark, work):
    a = spark.createDataFrame([(1, dt.date(2024, 1, 1), "x")], "k int, d date, v string")
    none = a.limit(0)
    assert reconcile_ranges(a, a.withColumn("k", F.col("k").cast("bigint")), ["k"]).count() == 0     # types may differ
    assert reconcile_ranges(none, none, ["k"]).count() == 0
    assert [r.difference for r in reconcile_ranges(a, none, ["d"]).collect()] == ["LEFT_ONLY"]
    nulls = spark.createDataFrame([(None, "x")], "k bigint, v string")
    assert [r.difference for r in reconcile_ranges(nulls, nulls.withColumn("v", F.lit("y")), ["k"]).collect()] == ["CHANGED"]
    big = spark.createDataFrame([(2**62 + i, "x") for i in range(50)], "k bigint, v string")
    other = big.withColumn("v", F.when(F.col("k") == 2**62 + 7, "y").otherwise(F.col("v")))
    assert [r.k for r in reconcile_ranges(big, other, ["k"], fanout=4, levels=3).collect()] == [2**62 + 7]
    with pytest.raises(TypeError):
        reconcile_ranges(a, a, ["v"])


def test_the_last_level_reads_differing_ranges_only(spark, work):
    df = spark.range(10_000).withColumn("v", F.lit(1))
    df.write.parquet(work + "/a")
    df.withColumn("v", F.when(F.col("id") == 4321, 2).otherwise(1)).write.parquet(work + "/b")
    a, b = spark.read.parquet(work + "/a"), spark.read.parquet(work + "/b")
    ranges, nulls = differing_ranges(a, b, "id", ["id", "v"], fanout=10, levels=2)
    assert ranges == [(4300, 4399)] and not nulls
    plan = reconcile_ranges(a, b, ["id"], fanout=10, levels=2)._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln]
    assert scans and all("GreaterThanOrEqual(id,4300)" in s and "LessThanOrEqual(id,4399)" in s for s in scans)


def test_merged_profiles_meet_the_exact_ones(spark, work):
    rng = random.Random(4)
    rows = [(i, rng.randrange(3000), rng.gauss(0, 100), rng.choice(["a", "b", None]), dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(99)))
            for i in range(20_000)]
    df = spark.createDataFrame(rows, "id bigint, k int, x double, s string, d date")
    for i in range(4):
        profile_sketches(df.where(F.col("id") % 4 == i), f"l{i}").write.parquet(f"{work}/p/l={i}")
    profile_sketches(df.limit(0), "l9").write.parquet(f"{work}/p/l=9")
    sketches = spark.read.parquet(work + "/p").drop("l")
    got = {r.column_name: r for r in merge_profiles(sketches).collect()}
    for i, c in enumerate(("id", "k", "x", "s", "d")):
        values = [r[i] for r in rows if r[i] is not None]
        assert got[c].row_count == 20_000 and got[c].null_count == 20_000 - len(values)
        assert abs(got[c].distinct_count / len(set(values)) - 1) < 0.03
        if c in ("id", "k", "x"):
            assert got[c].min_number == min(values) and got[c].max_number == max(values)
            for q, v in zip((0.25, 0.5, 0.75), got[c].quantiles):
                assert abs(sum(x <= v for x in values) / len(values) - q) < 0.02
    plan = drift_from_sketches(sketches, ["l0"], ["l1", "l2"])._jdf.queryExecution().executedPlan().toString()
    assert all(f"{work.split('/')[-1]}/p" in ln for ln in plan.splitlines() if "FileScan" in ln)
    shifts = drift_from_sketches(sketches, ["l9"], ["l1"]).collect()       # an empty load has no shift
    assert {r.distinct_shift for r in shifts} == {None} and {r.change for r in shifts} == {"SAME"}


def test_renames_are_mutual_best_matches(spark):
    a = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 7).alias("a"), (F.col("id") % 50).alias("b"), F.lit(None).cast("int").alias("c"))
    b = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 7).cast("string").alias("a2"), (F.col("id") * 7 + 7).alias("a3"),
                                 (F.col("id") % 50 + 25).alias("b2"), F.lit(None).cast("int").alias("c2"))
    got = {(r.removed_column, r.added_column): r.similarity for r in drift_renames(a, b).collect()}
    assert got == {("a", "a2"): 1.0}
    assert drift_renames(a, a).count() == 0
    half = {(r.removed_column, r.added_column): r.similarity for r in drift_renames(a, b, least=0.2).collect()}
    assert abs(half["b", "b2"] - 1 / 3) < 0.15


@pytest.mark.parametrize("kind", ["bigint", "double", "date", "timestamp_ntz", "decimal(12,2)"])
def test_splits_are_even_and_hold_every_row_once(spark, kind):
    n = 4000
    value = F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 4 == 1, 77).otherwise(F.col("id"))
    cast = {"date": lambda c: F.date_from_unix_date(c.cast("int")), "timestamp_ntz": lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")}
    df = spark.range(n).select("id", cast.get(kind, lambda c: c.cast(kind))(value).alias("v w"))
    points, hot, nulls = split_points(df, "v w", 8)
    predicates = split_predicates("v w", points, hot, nulls)
    reads = [{r.id for r in d.select("id").collect()} for d in split_reads(df, predicates)]
    assert sum(map(len, reads)) == n and set().union(*reads) == set(range(n))
    assert len(hot) == 1 and predicates[0] == "`v w` IS NULL"
    assert max(map(len, reads[2:])) <= 2 * n / len(reads)


def test_splits_of_little_data(spark):
    for rows in ([], [(None,)], [(5,)], [(5,)] * 100):
        df = spark.createDataFrame(rows, "v int")
        predicates = split_predicates("v", *split_points(df, "v", 4))
        assert sum(d.count() for d in split_reads(df, predicates)) == len(rows)
    assert split_predicates("v", *split_points(df, "v", 1)) == ["`v` IS NOT NULL"]
    assert split_predicates("v", ["a'b"], [], 0) == ["`v` < 'a''b'", "`v` >= 'a''b'"]
