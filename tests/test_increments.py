"""Checks that follow the changes, late rows of a stream, trend alerts, re-driven rejects."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sluice.operators.incremental_checks import (key_filter, merge_filters, referential_delta, referential_violations,
                                                 unique_across_batches)
from sluice.operators.redrive import ATTEMPTS, redrive
from sluice.operators.trend import trend_anomalies
from sluice.spec import schema_of
from sluice.streaming.incremental import stream_late_rows, stream_merge


@pytest.mark.parametrize("seed", [1, 2])
def test_referential_delta_equals_the_full_check(spark, work, seed):
    rng = random.Random(seed)
    parents = set(range(40))
    children = {i: rng.choice([None, *range(50)]) for i in range(300)}
    make = lambda c, p: (spark.createDataFrame(list(c.items()), "id int, fk int"),
                         spark.createDataFrame([(x,) for x in p] + [(None,)], "pk int"))
    before = referential_violations(*make(children, parents), "fk", "pk")
    for batch in range(3):
        old, had = dict(children), set(parents)
        for i in rng.sample(sorted(children), 20):
            if rng.random() < 0.3:
                del children[i]
            else:
                children[i] = rng.choice([None, *range(60)])
        children |= {1000 * (batch + 1) + i: rng.randrange(60) for i in range(10)}
        if batch != 1:                                      # a batch without a deleted parent, too
            parents -= set(rng.sample(sorted(parents), 4))
        parents |= {rng.randrange(40, 60)}
        changed = [(i,) for i in set(old) | set(children) if old.get(i, "no") != children.get(i, "no")]
        c, p = make(children, parents)
        gone = spark.createDataFrame([(x,) for x in had - parents], "pk int")
        delta = referential_delta(before, c, p, spark.createDataFrame(changed, "id int"), gone, ["id"], "fk", "pk")
        delta.write.parquet(f"{work}/v{batch}")
        before = spark.read.parquet(f"{work}/v{batch}")
        want = sorted((i, f) for i, f in children.items() if f is not None and f not in parents)
        assert sorted((r.id, r.fk) for r in before.collect()) == want


def test_unchanged_children_are_read_for_deleted_parents_only(spark, work):
    spark.range(100).select("id", (F.col("id") % 9).alias("fk")).write.parquet(work + "/children")
    children, parents = spark.read.parquet(work + "/children"), spark.range(5).withColumnRenamed("id", "pk")
    old, changed = children.where("fk > 4"), children.where("id < 3").select("id")
    scans = lambda gone: referential_delta(old, children, parents, changed, gone, ["id"], "fk", "pk")._jdf.queryExecution() \
        .optimizedPlan().toString().count("Relation [id")
    assert scans(parents.limit(0)) < scans(parents.limit(1))


@pytest.mark.parametrize("space", [1 << 10, 1 << 30])
def test_unique_across_batches_equals_the_full_check(spark, work, space):
    rng = random.Random(space)
    history, seen = [], spark.createDataFrame([], "bucket bigint, bits binary")
    for b in range(3):
        rows = [(rng.choice([None, rng.randrange(900)]) if rng.random() < 0.1 else rng.randrange(900), rng.choice("xy")) for _ in range(300)]
        rows += [(7, "hot")] * 100
        batch = spark.createDataFrame(rows, "k int, v string")
        past = spark.createDataFrame(history, "k int, v string")
        got = {(r.k, r.v): (r.n_in_batch, r.seen_before) for r in unique_across_batches(batch, ["k", "v"], seen, past, space).collect()}
        want = {}
        for x in set(rows):
            n, was = rows.count(x), x in history
            if x[0] is not None and (n > 1 or was):
                want[x] = (n, was)
        assert got == want
        merge_filters(seen, key_filter(batch, ["k", "v"], space)).write.parquet(f"{work}/f{b}")
        seen, history = spark.read.parquet(f"{work}/f{b}"), history + rows


def test_late_rows_of_a_stream_survive_a_restart(spark, work):
    schema = "k int, ts timestamp_ntz, v int"
    t = lambda n: None if n is None else dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)
    drops = [[(1, 5, 0), (1, 3, 1), (None, 4, 2), (2, None, 3)], [(1, 4, 4), (1, 5, 5), (1, 9, 6), (None, 1, 7), (2, 1, 8)],
             [(1, 8, 9), (2, 0, 10), (3, 1, 11), (1, None, 12)]]
    got = []
    for i, rows in enumerate(drops):
        spark.createDataFrame([(k, t(h), v) for k, h, v in rows], schema).coalesce(1).write.mode("append").parquet(work + "/in")
        stream = spark.readStream.schema(schema).parquet(work + "/in")
        late = stream_late_rows(stream, ["k"], "ts")
        stream_merge(late, lambda df, e: got.append(sorted(r.v for r in df.collect())), work + "/ckpt")   # a new query each time
    assert [g for g in got if g] == [[4, 7], [9, 10]]


def test_trend_anomalies(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    rows = [("a", day(7 * i), 100 + i % 3) for i in range(10)] + [("a", day(70), 500), ("a", day(77), None), ("a", day(84), 101)]
    rows += [("b", day(7 * i), 5) for i in range(6)] + [("b", day(42), 6), ("b", day(43), 900), ("c", day(0), 1), ("c", day(7), 99)]
    got = {(r.p, r.d): (r.value, r.direction, r.n_history, r.score is None)
           for r in trend_anomalies(spark.createDataFrame(rows, "p string, d date, n long"), "p", "d", "n").collect()}
    assert got == {("a", day(70)): (500.0, "HIGH", 8, False), ("b", day(42)): (6.0, "HIGH", 6, True)}


def test_redrive_takes_rows_that_have_not_passed(spark):
    landed = spark.createDataFrame([("1", "5"), ("2", "x"), ("2", "x"), ("3", None), ("4", "2.5")], "id string, n string")
    log = spark.createDataFrame([], ATTEMPTS)
    schemas = [("id int, n int", "v1"), ("id int, n int", "v1"), ("id int, n decimal(3,1)", "v2"), ("id int, n string", "v3")]
    moved = []
    for ddl, version in schemas:
        passed, new = redrive(landed, log, schema_of(ddl), version)
        moved.append(sorted((r.id, r.attempt) for r in passed.collect()))
        log = spark.createDataFrame(log.collect() + new.collect(), ATTEMPTS)
    assert moved == [[(1, 1), (3, 1)], [], [(4, 2)], [(2, 3), (2, 3)]]
    assert sorted((r.outcome, r.n_rows, r.bad_columns) for r in log.where("version = 'v2'").collect()) == [("FAILED", 2, "n"), ("PASSED", 1, "")]
