"""K4: the STAGING table, a plain partitioned Parquet table behind one pointer.

Built-in Parquet tables have no row-level MERGE, so a merge writes a new copy of
the partitions it touches:

* ``_data/<version>/_part=<p>/``: what one merge wrote, by Spark's own partitioned
  writer; ``_part`` is a hash of the key (or of ``cluster_by``, columns of the key);
* ``_versions/<n>.json``: the pointer: which version each partition is read from,
  the schema and the last epoch of each streaming query.  It is written aside and
  renamed as a merge's last step, so readers see a merge whole or not at all, and a
  merge lost before that is simply run again.  Its size follows the number of
  partitions, not of files.

A merge is one full outer join: the partitions that the batch's keys fall into are
read, joined with its latest rows (W1, whose exchange the join uses) and written by
the join's own tasks, so a row of either side is shuffled once.  A batch that the table
holds rows of already is first compared by key, guard columns and partition alone.
A batch that changes nothing publishes nothing.  One writer at a time per table;
the last ``KEEP`` versions stay readable.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from sluice.operators.merge import (CHANGED, SOURCE_META, batch_rows, changed_rows, empty_staging, merge_upsert,
                                    source_latest)
from sluice.session import delete, exists
from sluice.spec import STAGING_META_COLUMNS, TableSpec

PART = "_part"
PARTS = 8
KEEP = 2


class StagingTable:
    """``parts`` is the number of partitions of a new table (choose it so that one
    holds some GB); ``cluster_by`` names key columns whose equal values share one.
    ``join_hint`` passes a Spark join strategy hint on the batch side; none by
    default, so Spark chooses."""

    def __init__(self, spark: SparkSession, path: str, spec: TableSpec,
                 cluster_by: Sequence[str] = (), join_hint: str | None = None, parts: int = PARTS):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec
        self.cluster_by = list(cluster_by) or list(spec.keys)
        if not set(self.cluster_by) <= set(spec.keys):
            raise ValueError(f"cluster_by {self.cluster_by} must be key columns: a row keeps its partition")
        self.join_hint, self.parts = join_hint, parts

    # -- the pointer --------------------------------------------------------------

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _fs(self):
        return self._path("_versions").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        fs, root = self._fs(), self._path("_versions")
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(int(n[:-len(".json")]) for n in names if n.endswith(".json") and not n.startswith("."))

    def _pointer(self, version: int | None = None) -> dict:
        have = self.versions()
        if not have:
            return {"version": 0, "schema": self.spec.staging_schema(), "parts": {}, "n_parts": self.parts,
                    "cluster_by": self.cluster_by, "epochs": {}}
        version = have[-1] if version is None else version
        stream = self._fs().open(self._path(f"_versions/{version:012d}.json"))
        try:
            doc = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return doc | {"version": version, "schema": T.StructType.fromJson(doc["schema"])}

    def _publish(self, old: dict, **new) -> None:
        """Move the pointer: write aside, then rename; drop what no kept version names."""
        doc, version = old | new, old["version"] + 1
        fs, aside = self._fs(), self._path(f"_versions/.{uuid.uuid4().hex}")
        final = self._path(f"_versions/{version:012d}.json")
        fs.mkdirs(self._path("_versions"))
        out = fs.create(aside, False)
        out.write(bytearray(json.dumps(doc | {"version": version, "schema": json.loads(doc["schema"].json())}).encode()))
        out.close()
        if not fs.rename(aside, final):
            raise RuntimeError(f"{self.path}: version {version} exists already; one writer at a time")
        kept = self.versions()[-KEEP:]
        named = {v for k in kept for v in self._pointer(k)["parts"].values()}
        for s in fs.listStatus(self._path("_data")) if fs.exists(self._path("_data")) else ():
            if s.getPath().getName() not in named:
                fs.delete(s.getPath(), True)
        for v in set(self.versions()) - set(kept):
            fs.delete(self._path(f"_versions/{v:012d}.json"), False)

    # -- reading ------------------------------------------------------------------

    def exists(self) -> bool:
        return bool(self.versions())

    def _read(self, pointer: dict, parts: Sequence[str] | None = None) -> DataFrame:
        """The rows of the given partitions (all by default)."""
        have = pointer["parts"]
        folders = [f"{self.path}/_data/{have[p]}/{PART}={p}" for p in (have if parts is None else parts) if p in have]
        if not folders:
            return self.spark.createDataFrame([], pointer["schema"])
        return self.spark.read.schema(pointer["schema"]).parquet(*folders)

    def read(self, version: int | None = None) -> DataFrame:
        return self._read(self._pointer(version))

    def schema(self) -> T.StructType:
        return self._pointer()["schema"]

    # -- writing ------------------------------------------------------------------

    def _merged_spec(self, schema: T.StructType) -> TableSpec:
        """The spec with the table's column types, and with business columns that the
        table has beyond it (Q14): a batch without them leaves NULL in what it changes."""
        have = {f.name: f.dataType for f in schema.fields if f.name not in STAGING_META_COLUMNS}
        own = tuple((c, have.pop(c, t)) for c, t in self.spec.columns)
        return replace(self.spec, columns=own + tuple(have.items()))

    def _part_of(self, pointer: dict) -> Column:
        return F.pmod(F.hash(*pointer["cluster_by"]), F.lit(pointer["n_parts"]))

    def _write(self, df: DataFrame, pointer: dict, metrics: Sequence[Column] = ()) -> tuple[str, dict, dict]:
        """(folder, partition -> folder, observed counts).  The join's tasks write their
        rows as they are: with the key's hash also dealing its shuffle, a number of shuffle
        partitions divisible by ``n_parts`` gives each of them rows of one partition."""
        name = uuid.uuid4().hex
        obs = Observation(f"staging_{name}")
        (df.observe(obs, F.count(F.lit(1)).alias("n"), *metrics).drop(CHANGED).withColumn(PART, self._part_of(pointer))
           .write.partitionBy(PART).parquet(f"{self.path}/_data/{name}"))
        found = [s.getPath().getName() for s in self._fs().listStatus(self._path(f"_data/{name}"))]
        parts = {f.split("=", 1)[1]: name for f in found if f.startswith(PART + "=")}
        # a plan that Spark found empty reports no metrics
        return name, parts, {k: int(v or 0) for k, v in obs.get.items()} if parts else {"n": 0}

    def merge(self, raw: DataFrame, now: dt.datetime, batch_id: str | None = None,
              epoch: tuple[str, int] | None = None) -> dict:
        """Merge one batch of RAW rows; returns counts (G1).

        With a batch id, INSERT / UPDATE count the table's rows of that batch by
        label (a repeated batch reports its labels again); without one, they
        count what this merge changed.  ``rows_changed`` is always the latter.
        ``epoch`` (streaming query, epoch number) is published with the merge; an
        epoch that was published before, or a later one, is not merged again."""
        old = self._pointer()
        done = old["epochs"].get(epoch[0], -1) if epoch else -1
        if epoch and epoch[1] <= done:
            return {"rows_inserted": 0, "rows_updated": 0, "rows_changed": 0, "rows_written": 0, "parts_written": 0}
        return self._merge(raw, now, batch_id, old, {epoch[0]: epoch[1]} if epoch else {})

    def _merge(self, raw, now, batch_id, old, epoch) -> dict:
        spec = self._merged_spec(old["schema"])
        src = source_latest(raw, self.spec, batch_id)
        src = src.select(*[(F.col(c) if c in src.columns else F.lit(None)).cast(t).alias(c) for c, t in spec.columns],
                         *SOURCE_META)
        target, published, touched = empty_staging(self.spark, spec), {}, []
        if old["version"]:
            # at most one row per partition of the table
            published, kinds = old["parts"], dict(spec.columns)
            touched = [str(r[0]) for r in batch_rows(raw, batch_id)
                       .select(*[F.col(k).cast(kinds[k]).alias(k) for k in old["cluster_by"]])
                       .select(self._part_of(old)).distinct().collect()]
            if not touched:
                return self._unchanged(old, epoch, {"rows_inserted": 0, "rows_updated": 0, "rows_changed": 0})
            target = self._typed(self._read(old, touched), spec)
            if batch_id is not None:
                mine = target.where(F.col("_batch_id") == batch_id)
                if mine.limit(1).count() and not changed_rows(target, src, spec).limit(1).count():
                    got = mine.agg(*self._labels(F.lit(True))).first()
                    return self._unchanged(old, epoch, {"rows_inserted": got["ins"], "rows_updated": got["upd"], "rows_changed": 0})
        merged = merge_upsert(target, src.hint(self.join_hint) if self.join_hint else src, spec, now,
                              dedupe=False, mark=True)
        own = F.col(CHANGED) if batch_id is None else F.col("_batch_id") == batch_id
        name, parts, got = self._write(merged, old, [
            F.count_if(F.col(CHANGED)).alias("changed"), *self._labels(own)])
        counts = {"rows_inserted": got.get("ins", 0), "rows_updated": got.get("upd", 0), "rows_changed": got.get("changed", 0)}
        if not counts["rows_changed"] and old["version"]:
            delete(self.spark, f"{self.path}/_data/{name}")
            return self._unchanged(old, epoch, counts)
        if stray := set(parts) & set(published) - set(touched):
            delete(self.spark, f"{self.path}/_data/{name}")
            raise RuntimeError(f"{self.path}: the batch was read with other keys than before, in partitions {sorted(stray)}; "
                               "nothing is published")
        self._publish(old, schema=spec.staging_schema(), parts=published | parts, epochs=old["epochs"] | epoch)
        return counts | {"rows_written": got["n"], "parts_written": len(parts)}

    @staticmethod
    def _labels(own: Column) -> list[Column]:
        return [F.count_if(own & (F.col("_cdc_operation") == op)).alias(n) for op, n in (("INSERT", "ins"), ("UPDATE", "upd"))]

    def _unchanged(self, old: dict, epoch: dict, counts: dict) -> dict:
        if epoch:
            self._publish(old, epochs=old["epochs"] | epoch)
        return counts | {"rows_written": 0, "parts_written": 0}

    def _typed(self, df: DataFrame, spec: TableSpec) -> DataFrame:
        """The table's rows with columns that only the spec has as NULL."""
        return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in spec.columns],
                         *STAGING_META_COLUMNS)

    def evolve(self, spec: TableSpec) -> bool:
        """Q14: give the table the spec's column types.  New columns need no rewrite
        (older rows read NULL); a changed type rewrites the table once.  Returns whether it did."""
        old = self._pointer()
        kinds = {f.name: f.dataType for f in old["schema"].fields}
        if not old["version"] or all(kinds.get(c, t) == t for c, t in spec.columns):
            return False
        name, parts, _ = self._write(self._typed(self._read(old), spec), old)
        self._publish(old, schema=spec.staging_schema(), parts=parts)
        return True


def read_staging(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a STAGING table, by its own recorded schema."""
    if not exists(spark, f"{path.rstrip('/')}/_versions"):
        raise FileNotFoundError(f"no STAGING table at {path}")
    return StagingTable(spark, path, TableSpec("", (), ())).read()
