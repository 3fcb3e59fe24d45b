"""K4: partitioned STAGING behind a pointer: nothing lost in a crash, nothing rewritten without need."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F, types as T

from sluice.operators.projection import stamp_audit
from sluice.session import local_path
from sluice.sinks.staging import StagingTable, read_staging
from sluice.spec import TableSpec, _cols

COLS = "id bigint, v bigint, created_at timestamp_ntz, updated_at timestamp_ntz"
SPEC = TableSpec("T", ("id",), _cols(COLS))
D = dt.datetime(2024, 1, 1)


def _raw(spark, ids, day, batch):
    df = spark.createDataFrame([(i, None if i is None else i * 10, D, D + dt.timedelta(days=day))
                                for i in ids], COLS)
    return stamp_audit(df, "p", batch, "r", "CDC", D + dt.timedelta(days=100 + day))


def _table(spark, path, n=400, loads=4):
    t = StagingTable(spark, path, SPEC)
    step = n // loads
    for i in range(loads):
        t.merge(_raw(spark, range(i * step, (i + 1) * step), 0, f"B{i}"), D, f"B{i}")
    return t


def test_only_touched_partitions_are_written(spark, work):
    t = _table(spark, work + "/stg")
    before = t._pointer()["parts"]
    got = t.merge(_raw(spark, [7], 1, "C"), D, "C")
    after = t._pointer()["parts"]
    assert (got["rows_inserted"], got["rows_updated"], got["parts_written"]) == (0, 1, 1)
    assert sum(before[p] != after[p] for p in after) == 1 and set(before) == set(after)
    rows = t.read()
    assert rows.count() == 400 and rows.where("id = 7").first()["_batch_id"] == "C"
    assert rows.where("_batch_id = 'C'").count() == 1


def test_a_batch_without_change_writes_nothing(spark, work):
    t = _table(spark, work + "/stg")
    t.merge(_raw(spark, range(50, 150), 1, "C"), D, "C")
    before = t._pointer()
    got = t.merge(_raw(spark, range(50, 150), 1, "C"), D, "C")     # the same instant, too
    assert (got["rows_changed"], got["rows_written"], got["parts_written"]) == (0, 0, 0)
    assert got["rows_updated"] == 100          # the batch's labels, counted again
    assert t._pointer() == before
    assert t.merge(_raw(spark, [], 1, "E"), D, "E")["rows_written"] == 0


def test_a_crash_before_the_pointer_leaves_the_old_table(spark, work, monkeypatch):
    t = _table(spark, work + "/stg")
    before = sorted(t.read().collect())
    change = _raw(spark, range(300, 500), 1, "C")

    def lost(*a, **kw):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(t, "_publish", lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            t.merge(change, D, "C")
    assert sorted(t.read().collect()) == before
    got = t.merge(change, D, "C")
    assert (got["rows_inserted"], got["rows_updated"]) == (100, 100)
    assert t.read().count() == 500
    t.merge(_raw(spark, range(500), 2, "E"), D, "E")               # the lost attempt's folder goes
    named = {v for k in t.versions() for v in t._pointer(k)["parts"].values()}
    assert set(os.listdir(local_path(t.path) + "/_data")) == named


def test_the_version_before_stays_readable(spark, work):
    t = _table(spark, work + "/stg")
    v = t.versions()[-1]
    t.merge(_raw(spark, range(400), 1, "C"), D, "C")
    assert t.read(v).where("_batch_id = 'C'").count() == 0
    assert t.read().where("_batch_id = 'C'").count() == 400
    assert len(t.versions()) == 2


def test_cluster_columns_belong_to_the_key(spark, work):
    with pytest.raises(ValueError, match="key columns"):
        StagingTable(spark, work + "/stg", SPEC, cluster_by=["v"])


def test_an_epoch_is_merged_once(spark, work):
    """NULL keys insert on every merge, so a repeated epoch would show."""
    t = StagingTable(spark, work + "/stg", SPEC)
    for epoch, ids in ((0, [1, None]), (0, [1, None]), (1, [2, None]), (0, [3]), (1, [2, None])):
        t.merge(_raw(spark, ids, epoch, f"E{epoch}"), D, f"E{epoch}", ("q", epoch))
    assert sorted(map(str, (r["id"] for r in t.read().collect()))) == ["1", "2", "None", "None"]
    # another query's epochs are its own; an epoch that changes nothing counts as merged
    t.merge(_raw(spark, [9], 0, "F"), D, "F", ("other", 0))
    t.merge(_raw(spark, [], 0, "E2"), D, "E2", ("q", 2))
    t.merge(_raw(spark, [10], 0, "E2"), D, "E2", ("q", 2))
    assert t.read().where("id = 9").count() == 1 and t.read().where("id = 10").count() == 0


def test_null_keys_are_kept_and_counted(spark, work):
    t = StagingTable(spark, work + "/stg", SPEC)
    df = spark.createDataFrame([(None, i, D, D) for i in range(50)], COLS)
    t.merge(stamp_audit(df, "p", "B1", "r", "CDC", D), D, "B1")
    # W1 keeps one row for the NULL-key group per batch; a new batch adds another
    got = t.merge(stamp_audit(df, "p", "B2", "r", "CDC", D), D, "B2")
    assert got["rows_inserted"] == 1
    assert t.read().where(F.col("id").isNull()).count() == 2
    # NULL never matches: the same batch again inserts again, and counts both
    assert t.merge(stamp_audit(df, "p", "B2", "r", "CDC", D), D, "B2")["rows_inserted"] == 2


def test_counts_without_a_batch_id_are_this_merge(spark, work):
    t = _table(spark, work + "/stg")
    got = t.merge(_raw(spark, range(390, 410), 1, "C"), D)
    assert (got["rows_inserted"], got["rows_updated"]) == (10, 10)


@pytest.mark.parametrize("hint", [None, "merge", "shuffle_hash", "broadcast"])
def test_join_forms_agree_with_the_plain_merge(spark, work, hint):
    from sluice.operators.merge import empty_staging, merge_upsert
    base, change = (_raw(spark, range(0, 600), 0, "B1"),
                    _raw(spark, list(range(300, 900)) + [None], 1, "B2"))
    t = StagingTable(spark, work + "/t", SPEC, join_hint=hint)
    t.merge(base, D, "B1")
    got = t.merge(change, D + dt.timedelta(days=1), "B2")
    assert (got["rows_inserted"], got["rows_updated"]) == (301, 300)
    want = merge_upsert(merge_upsert(empty_staging(spark, SPEC), base, SPEC, D), change, SPEC,
                        D + dt.timedelta(days=1))
    assert sorted(t.read().collect(), key=repr) == sorted(want.collect(), key=repr)


def test_a_new_business_column_reaches_the_table(spark, work):
    t = _table(spark, work + "/stg")
    wide = TableSpec("T", ("id",), SPEC.columns + (("flags", T.ArrayType(T.StringType())),))
    raw = _raw(spark, [5, 2000], 1, "C").withColumn("flags", F.array(F.lit("late")))
    StagingTable(spark, t.path, wide).merge(raw, D, "C")
    got = {r["id"]: r["flags"] for r in read_staging(spark, t.path).collect()}
    assert got[5] == got[2000] == ["late"] and got[6] is None and len(got) == 401
    # a later batch without the column leaves it NULL where it changes a row
    t.merge(_raw(spark, [5], 2, "D"), D, "D")
    got = {r["id"]: r["flags"] for r in read_staging(spark, t.path).collect()}
    assert got[5] is None and got[2000] == ["late"]


def test_a_changed_type_rewrites_the_table_once(spark, work):
    t = _table(spark, work + "/stg")
    wide = TableSpec("T", ("id",), tuple((c, T.StringType() if c == "v" else k) for c, k in SPEC.columns))
    w = StagingTable(spark, t.path, wide)
    assert w.evolve(wide) and not w.evolve(wide)
    raw = stamp_audit(spark.createDataFrame([(5, "x", D, D + dt.timedelta(days=9))], COLS.replace("v bigint", "v string")),
                      "p", "C", "r", "CDC", D)
    w.merge(raw, D, "C")
    got = {r["id"]: r["v"] for r in w.read().collect()}
    assert got[5] == "x" and got[6] == "60" and len(got) == 400
    t.merge(_raw(spark, [6], 20, "E"), D, "E")          # a batch of the old type is cast up
    assert {r["id"]: r["v"] for r in w.read().collect()}[6] == "60" and w.read().count() == 400


def test_untouched_partitions_are_not_read(spark, work):
    t = _table(spark, work + "/stg")
    p = t._pointer()
    part = str(_raw(spark, [7], 1, "C").select(t._part_of(p)).first()[0])
    files = t._read(p, [part]).inputFiles()
    assert files and all(f"/_part={part}/" in f for f in files)


def test_wide_merge_plans_fast_with_default_constraint_propagation(spark, work):
    import time
    from sluice.operators.merge import merge_upsert
    from sluice.plans import catalog as C
    from sluice.plans.standins import STANDINS, raw_sql
    from conftest import SF_SMALL
    assert spark.conf.get("spark.sql.constraintPropagation.enabled") == "true"
    si = STANDINS["sales_orders"]                       # 17 business columns
    C._sql(spark, SF_SMALL, lambda d: raw_sql(si, d)).write.parquet(work + "/raw")
    raw = spark.read.parquet(work + "/raw")
    t = StagingTable(spark, work + "/stg", si.spec)
    t.merge(raw, D)
    m = merge_upsert(t.read(), raw, si.spec, D)
    t0 = time.time()
    m._jdf.queryExecution().optimizedPlan()
    assert time.time() - t0 < 10


def test_a_merge_shuffles_each_side_once_and_writes_once(spark, work, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter
    t, plans, write = _table(spark, work + "/stg"), [], DataFrameWriter.parquet

    def spy(self, path, *a, **kw):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *a, **kw)
    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.write", property(lambda df: DataFrameWriter(df)), raising=False)
    t.merge(_raw(spark, range(300, 500), 1, "C"), D, "C")
    assert len(plans) == 1 and "REBALANCE" not in plans[0]
    # the batch, the table, and the batch's NULL keys beside the join
    assert plans[0].count("Exchange hashpartitioning") == 3


def test_a_repeated_batch_is_compared_not_written(spark, work, monkeypatch):
    t = _table(spark, work + "/stg")
    t.merge(_raw(spark, range(50, 150), 1, "C"), D, "C")
    with monkeypatch.context() as m:
        m.setattr(t, "_write", lambda *a, **kw: pytest.fail("a repeated batch was written"))
        got = t.merge(_raw(spark, range(50, 150), 1, "C"), D, "C")
    assert got == {"rows_inserted": 0, "rows_updated": 100, "rows_changed": 0, "rows_written": 0, "parts_written": 0}
    # under the same label, one newer row and one more key are a change
    more = _raw(spark, range(50, 150), 1, "C").unionByName(_raw(spark, [60, 900], 2, "C"))
    got = t.merge(more, D, "C")
    assert (got["rows_changed"], got["rows_inserted"], got["rows_updated"]) == (2, 1, 100)
    assert t.read().count() == 401


def test_a_batch_that_reads_differently_loses_no_rows(spark, work, monkeypatch):
    """Which partitions a batch touches is one read of it, its rows are another."""
    from sluice.sinks import staging
    t = _table(spark, work + "/stg")
    before = sorted(t.read().collect())
    with monkeypatch.context() as m:
        m.setattr(staging, "batch_rows", lambda raw, batch_id: raw.where("id = 7"))
        with pytest.raises(RuntimeError, match="other keys"):
            t.merge(_raw(spark, range(100), 1, "C"), D, "C")
    assert sorted(t.read().collect()) == before
    assert t.merge(_raw(spark, range(100), 1, "C"), D, "C")["rows_updated"] == 100
