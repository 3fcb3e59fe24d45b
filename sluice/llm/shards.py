"""Sharding by a hypergeometric communication matrix.

A uniform random permutation of all rows, dealt into shards whose sizes differ
by one row at most.  Rows fall into blocks by a seeded hash of the whole row.
The number of a block's rows that go to each shard is a multivariate
hypergeometric draw, exactly as a uniform permutation would give it.

The matrix (blocks x shards) is never built whole.  A binary tree over the blocks
carries it: at a node, the shards' remaining rows are split between the node's
two halves by one hypergeometric draw seeded with the node; a block walks from
the root to its leaf and gets its row of the matrix.  All blocks that share a
node draw the same split, so columns add up exactly.

Then: rows are permuted within their block (order of a seeded hash), cut by the
matrix row, exchanged, and permuted again within the shard: a second hash orders
them, its range is cut into cells, and a row's slot is the rows of the cells
before plus its place in the cell, so no task ever holds a shard.  Only the row counts
of blocks come to the driver, ``MOST_BLOCKS`` numbers at most: a larger table has larger
blocks.  Slots where cells start are a table, joined by shard and cell.

Null values hash as values; repeated rows keep their own slots (they are
interchangeable); an empty table gives no rows; columns named ``shard`` or
``slot`` in the input are replaced, other names are free (columns have names of their
own on the way).
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from .work import Work


MOST_BLOCKS = 1 << 16
NUMPY_BOUND = 10 ** 9  # numpy's generator draws from fewer rows of each kind only


def _bounds(total: int, parts: int) -> np.ndarray:
    """First slot of each of ``parts`` near-equal slices, and the end."""
    return np.arange(parts + 1) * (total // parts) + np.minimum(np.arange(parts + 1), total % parts)


def _multi_hypergeometric(rng, left: np.ndarray, n: int) -> np.ndarray:
    """Of rows with ``left[i]`` of kind i, the kinds of ``n`` drawn ones."""
    out, rest = np.zeros_like(left), int(left.sum())
    for i, c in enumerate(left.tolist()):
        if n <= 0:
            break
        rest -= c
        out[i] = _hypergeometric(rng, c, rest, n)
        n -= int(out[i])
    return out


def _hypergeometric(rng, good: int, bad: int, n: int) -> int:
    if good == 0 or n == 0:
        return 0
    if bad == 0:
        return n
    if max(good, bad) < NUMPY_BOUND:
        return int(rng.hypergeometric(good, bad, n))
    return _by_inversion(rng, good, bad, n)


def _by_inversion(rng, good: int, bad: int, n: int) -> int:
    """A hypergeometric draw of any size: weights relative to the mode by the ratios of
    neighbours, as far as they count in double precision (12 deviations and 200 leave less
    than 1e-30 outside), and the distribution inverted."""
    total = good + bad
    lo, hi = max(0, n - bad), min(n, good)
    mode = min(max((n + 1) * (good + 1) // (total + 2), lo), hi)
    deviation = (n * (good / total) * (bad / total) * ((total - n) / (total - 1))) ** 0.5
    reach = int(12 * deviation) + 200
    a, b = max(lo, mode - reach), min(hi, mode + reach)
    k = np.arange(mode, b, dtype=np.float64)
    up = np.cumsum(np.log((good - k) / (k + 1) * ((n - k) / (bad - n + k + 1))))
    k = np.arange(mode, a, -1, dtype=np.float64)
    down = np.cumsum(np.log(k / (good - k + 1) * ((bad - n + k) / (n - k + 1))))
    at = np.cumsum(np.exp(np.concatenate((down[::-1], [0.0], up))))
    return a + min(int(np.searchsorted(at, rng.random() * at[-1], "right")), b - a)


@lru_cache(64)
def _split(seed: int, lo: int, hi: int, left: tuple[int, ...], n: int) -> np.ndarray:
    """Rows of each shard in the first half (``n`` rows) of a node; the upper nodes are
    the same for all blocks of a task."""
    return _multi_hypergeometric(np.random.default_rng([seed, lo, hi]), np.array(left, np.int64), n)


def _upto(sizes: np.ndarray) -> np.ndarray:
    """Rows before each block, and all."""
    return np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


def matrix_row(upto: np.ndarray, shards: np.ndarray, block: int, seed: int) -> np.ndarray:
    """Row ``block`` of the matrix: how many of its rows go to each shard."""
    lo, hi, left = 0, len(upto) - 1, shards.astype(np.int64)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        take = _split(seed, lo, hi, tuple(left.tolist()), int(upto[mid] - upto[lo]))
        lo, hi, left = (lo, mid, take) if block < mid else (mid, hi, left - take)
    return left


def _send(upto, shards, seed):
    def run(batches):
        now, ends, at = None, None, 0
        for batch in batches:
            block = batch.column("_block").to_numpy()
            shard = np.empty(len(block), np.int32)
            cut = np.flatnonzero(block[1:] != block[:-1]) + 1
            for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(block)]):
                if hi <= lo:
                    continue
                if block[lo] != now:
                    now, at = block[lo], 0
                    ends = np.cumsum(matrix_row(upto.value, shards, int(now), seed))
                shard[lo:hi] = np.searchsorted(ends, np.arange(at, at + hi - lo), "right")
                at += hi - lo
            keep = [n for n in batch.schema.names if n != "_block"]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in keep] + [pa.array(shard)],
                                             keep + ["shard"])
    return run


def _place(batches):
    """Slots of rows that come in the order of shard, cell and key, with their cell's first slot."""
    now, at = None, 0
    for batch in batches:
        pair = batch.column("shard").to_numpy().astype(np.int64) << 32 | batch.column("_cell").to_numpy()
        first = batch.column("_first").to_numpy()
        slot = np.empty(len(pair), np.int64)
        cut = np.flatnonzero(pair[1:] != pair[:-1]) + 1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(pair)]):
            if hi <= lo:
                continue
            if pair[lo] != now:
                now, at = pair[lo], int(first[lo])
            slot[lo:hi] = np.arange(at, at + hi - lo)
            at += hi - lo
        keep = [n for n in batch.schema.names if n not in ("_cell", "_key", "_first")]
        yield pa.RecordBatch.from_arrays([batch.column(n) for n in keep] + [pa.array(slot)], keep + ["slot"])


def shard_rows(df: DataFrame, shards: int, seed: int = 0, block_rows: int = 1 << 12,
               cell_rows: int = 1 << 12) -> DataFrame:
    """``df`` plus ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in a shard)."""
    spark = df.sparkSession
    work = Work(spark, "shards")
    df = df.drop("shard", "slot")
    names = df.columns
    df = df.toDF(*[f"c{i}" for i in range(len(names))])
    cols = [F.col(c) for c in df.columns]
    key = lambda n, *more: F.xxhash64(F.lit(seed + n), *more, *cols)
    total = df.count()
    blocks = min(MOST_BLOCKS, max(1, -(-total // block_rows)))
    keyed = df.withColumn("_block", F.pmod(key(0), F.lit(blocks)).cast("int"))
    sizes = np.zeros(blocks, np.int64)
    for r in keyed.groupBy("_block").count().collect():
        sizes[r["_block"]] = r["count"]
    upto = spark.sparkContext.broadcast(_upto(sizes))
    base = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in df.schema.fields)
    sent = (keyed.withColumn("_key", key(1)).repartition("_block")
            .sortWithinPartitions("_block", "_key", *cols)
            .mapInArrow(_send(upto, np.diff(_bounds(total, shards)), seed), f"{base}_key long, shard int"))
    cells = max(1, -(-total // (shards * cell_rows)))
    # the cell is the upper end of the second key's range
    sent = (sent.withColumn("_key", key(2, F.col("_key")))
            .withColumn("_cell", F.expr(f"cast(shiftrightunsigned(_key, 32) * {cells} div 4294967296 as int)"))
            .withColumn("_key", F.expr("shiftrightunsigned(_key, 1)")))
    sent = work.keep(sent, "sent")
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    first = (sent.groupBy("shard", "_cell").agg(F.count("*").alias("n"))
             .select("shard", "_cell", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("_first")))
    return (sent.join(first, ["shard", "_cell"]).select(*df.columns, "_key", "shard", "_cell", "_first")
            .repartition("shard", "_cell").sortWithinPartitions("shard", "_cell", "_key", *cols)
            .mapInArrow(_place, f"{base}shard int, slot long").toDF(*names, "shard", "slot"))
