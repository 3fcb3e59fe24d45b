"""Written intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.session import scratch_dir


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


class Work:
    """One run's tables: a lost executor re-reads them instead of recomputing."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, scratch_dir(spark, name)
        self.tables = {}  # bucketed ones, by name

    def keep(self, df: DataFrame, name: str, batch: str | None = None, by: str | None = None,
             buckets: tuple[int, str] | None = None, more: bool = False) -> DataFrame:
        """``df`` as a written table; the write's shuffle files go when it ends.  ``batch``: bytes of an
        Arrow batch on its way to Python (held by the executor and by the worker); ``by``: a folder per value;
        ``buckets``: number and column of buckets, by which later groups need no shuffle of the table;
        ``more``: adds to the bucketed table of that name."""
        path = f"{self.root}/{name}"
        table = self.tables[name] if more else f"sluice_{uuid.uuid4().hex}"
        confs = {CLEANUP: "true"} | ({BATCH: batch} if batch else {})
        before = {k: self.spark.conf.get(k, None) for k in confs}
        try:
            for k, v in confs.items():
                self.spark.conf.set(k, v)
            out = df.write.mode("append" if more else "overwrite")
            if buckets:
                out.bucketBy(*buckets).option("path", path).format("parquet").saveAsTable(table)
                self.tables[name] = table
            else:
                (out.partitionBy(by) if by else out).parquet(path)
        finally:
            for k, v in before.items():
                if v is None:
                    self.spark.conf.unset(k)
                else:
                    self.spark.conf.set(k, v)
        return self.spark.table(table) if buckets else self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def components(work: Work, edges: DataFrame, a: str = "a", b: str = "b", name: str = "cc") -> DataFrame:
    """(node, label): the smallest node reachable over the edges, written as table ``name``.

    Minimum labels travel along the edges and through pointer jumps; every
    step is a written table, only the number of changed labels comes back.
    """
    both = work.keep(edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
                     .unionAll(edges.select(F.col(b), F.col(a))).distinct(), f"{name}_edges")
    labels = work.keep(both.groupBy(F.col("x").alias("node"))
                       .agg(F.least(F.min("y"), F.first("x")).alias("label")), f"{name}_0")
    step = 0
    while True:
        step += 1
        near = (both.join(labels.withColumnRenamed("node", "y"), "y")
                .groupBy(F.col("x").alias("node")).agg(F.min("label").alias("near")))
        best = labels.join(near, "node").select(
            "node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        new = best.join(jump, "label", "left").select(
            "node", F.least("label", F.coalesce("far", "label")).alias("label"),
            (F.least("label", F.coalesce("far", "label")) != F.col("old")).alias("moved"))
        new = work.keep(new, f"{name}_{step}")
        work.drop(f"{name}_{step - 1}")
        labels = new.select("node", "label")
        if not new.filter("moved").limit(1).count():
            labels = work.keep(labels, name)
            work.drop(f"{name}_edges")
            work.drop(f"{name}_{step}")
            return labels


def bloom(df: DataFrame, column: str, bits: int = 1 << 23):
    """Bit array over the 64-bit keys of a column; ``bits / 64`` rows at most
    reach the driver whatever the table's size.  Two probes per key."""
    import numpy as np
    probes = F.explode(F.array(F.pmod(F.col(column), F.lit(bits)),
                               F.pmod(F.shiftright(F.col(column), 24), F.lit(bits)))).alias("p")
    words = (df.select(probes).groupBy(F.shiftright("p", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("v")).collect())
    out = np.zeros(bits // 64, np.int64)
    for r in words:
        out[r.w] = r.v
    return out


def in_bloom(words, keys) -> "np.ndarray":
    """Which signed 64-bit keys may be in the bit array."""
    import numpy as np
    bits = len(words) * 64
    k = keys.astype(np.int64)
    ok = np.ones(len(k), bool)
    for p in (k % bits, (k >> 24) % bits):
        ok &= (words[p >> 6] >> (p & 63)) & 1 == 1
    return ok
