"""Nearest neighbours by randomly rotated one-bit codes.

Fit on a bounded sample: the centre of the vectors.  Every vector is indexed: its
residual to the centre is turned by a random rotation and kept as packed sign bits,
with its length and the inner product of the residual with its code.  A query's
rotated residual is rounded to ``QUERY_BITS`` bits; bit planes and population counts
give the inner product with all codes of a block, and the scalars turn it into an
estimate with an error bound.  Per query a running 20th best score is kept; only
vectors whose upper bound reaches it are scored on the original vectors, in double
precision and in the order of the components.

Queries and vectors meet in a grid of blocks of bounded rows, so neither side is
broadcast; work is queries x rows, in blocks.  A block takes its queries together: bit
planes of some queries meet all codes at once, the best estimates are scored first, and
what their scores rule out is not scored.

Vectors that are null, zero, or hold null or non-finite components, and rows without an
id, take no part; vectors are compared with those of their own dimension.  Rows equal in
id and vector are one row, as a query and as a candidate.  Rows that share an id but not
the vector are rows of their own: each is a query with its own ranks, and a candidate for
the others; a query leaves out its own row only.  Ties go to the smaller id.  An empty
table gives no rows; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

VECTOR_BLOCK, QUERY_BLOCK = 1 << 14, 1 << 13  # rows of a block at most
QUERY_STEP, FIRST = 32, 512  # queries that a step takes together; candidates scored first
QUERY_BITS = 5
SAMPLE_ROWS = 20_000
ERROR = 4.0


def rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), dim)


class Codes:
    """One block of the index."""

    def __init__(self, vecs: np.ndarray, centre: np.ndarray, rot: np.ndarray):
        self.dim = vecs.shape[1]
        r = (vecs - centre) @ rot
        self.norm = np.linalg.norm(r, axis=1)
        unit = r / np.where(self.norm > 0, self.norm, 1)[:, None]
        on = unit >= 0
        width = -(-self.dim // 64) * 64
        bits = np.zeros((len(vecs), width), np.uint8)
        bits[:, :self.dim] = on
        self.words = np.packbits(bits, axis=1).view(np.uint64)
        self.ones = on.sum(1).astype(np.int64)
        self.fit = np.abs(unit).sum(1) / np.sqrt(self.dim)  # <code, unit residual>
        self.along = vecs @ centre - centre @ centre
        fit = np.maximum(self.fit, 1e-12)
        self.gain = self.norm / fit / np.sqrt(self.dim)
        self.lean = self.gain * (2 * self.ones - self.dim)
        spread = np.sqrt(np.maximum(0, 1 - fit * fit)) / fit / np.sqrt(max(1, self.dim - 1))
        self.doubt = ERROR * self.norm * spread
        self.grain = self.norm * np.sqrt(self.dim) / 2 / fit
        self.reach = float(np.linalg.norm(vecs, axis=1).max(initial=0))

    def bounds(self, queries: np.ndarray, centre: np.ndarray, rot: np.ndarray):
        """Estimated inner products of queries with the block, and their errors (queries x rows)."""
        q = (queries - centre) @ rot
        length = np.linalg.norm(q, axis=1)[:, None]
        low, high = q.min(1)[:, None], q.max(1)[:, None]
        step = np.maximum((high - low) / (2 ** QUERY_BITS - 1), 1e-300)
        level = np.rint((q - low) / step).astype(np.int64)
        planes = np.zeros((len(q), QUERY_BITS, self.words.shape[1] * 64), np.uint8)
        planes[:, :, :self.dim] = (level[:, None, :] >> np.arange(QUERY_BITS)[:, None]) & 1
        planes = np.packbits(planes, axis=2).view(np.uint64)
        hit = np.zeros((len(q), len(self.words)), np.int32)
        for j in range(QUERY_BITS):
            for w in range(self.words.shape[1]):
                both = np.bitwise_count(self.words[:, w] & planes[:, j, w, None])
                hit += both.astype(np.int32) << np.int32(j)
        # <code, rounded query>: the code has +1 / -1 over sqrt(dim)
        est = hit * (2.0 * step)
        est -= step * level.sum(1)[:, None]
        est *= self.gain
        est += low * self.lean
        est += self.along
        est += (queries @ centre)[:, None]
        err = self.doubt * length
        err += self.grain * step
        err += self.slack(queries)[:, None]
        return est, err

    def slack(self, queries: np.ndarray) -> np.ndarray:
        """More than the rounding of any order of summation."""
        return 1e-9 * (1 + np.linalg.norm(queries, axis=1) * self.reach)


def exact(vecs: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed in the order of the components."""
    out = np.zeros(len(vecs))
    for j in range(len(query)):
        out += vecs[:, j] * query[j]
    return out


def _best(k, ids, vecs, qid, q, est, err, slack):
    """Rows of the k nearest of one query in a block, nearest first, and their scores."""
    lo, hi = np.searchsorted(ids, [qid, qid + 1])
    own = lo + np.flatnonzero((vecs[lo:hi] == q).all(1))
    up, low = est + err, est - err
    up[own] = low[own] = -np.inf
    m = min(k, len(ids) - len(own))
    if not m:
        return own[:0], np.zeros(0)
    floor = np.partition(low, len(low) - m)[len(low) - m]
    near = np.flatnonzero(up >= floor)
    score = np.zeros(0)
    if len(near) > FIRST:
        top = np.argpartition(est[near], len(near) - FIRST)
        first, rest = near[top[-FIRST:]], near[top[:-FIRST]]
        score = vecs[first] @ q
        floor = max(floor, np.partition(score, FIRST - m)[FIRST - m] - slack)
        rest = rest[up[rest] >= floor]
        near, score = np.concatenate((first, rest)), np.concatenate((score, vecs[rest] @ q))
    else:
        score = vecs[near] @ q
    # the last step in double precision, in the order of the components
    near = near[score >= np.partition(score, len(score) - m)[len(score) - m] - 2 * slack]
    score = exact(vecs[near], q)
    order = np.lexsort((ids[near], -score))[:m]
    return near[order], score[order]


def _search(k, centres, seed):
    schema = pa.schema([("query_id", pa.int64()), ("own", pa.int64()), ("vec_id", pa.int64()),
                        ("score", pa.float64())])

    def answer(ids, vecs, index, asks, centre, rot):
        qids, own, qs = asks
        for at in range(0, len(qids), QUERY_STEP):
            some = slice(at, at + QUERY_STEP)
            est, err = index.bounds(qs[some], centre, rot)
            found = [_best(k, ids, vecs, *x) for x in zip(qids[some].tolist(), qs[some], est, err,
                                                          index.slack(qs[some]).tolist())]
            n = [len(f[0]) for f in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(qids[some], n)), pa.array(np.repeat(own[some], n)),
                 pa.array(ids[np.concatenate([f[0] for f in found])]),
                 pa.array(np.concatenate([f[1] for f in found]))], schema=schema)

    def run(batches):
        cell, ids, vecs, parts, index, rot, last = None, None, None, [], None, None, None
        for batch in batches:
            key = list(zip(*(batch.column(c).to_pylist() for c in ("dim", "vb", "qb"))))
            role, mat = batch.column("role").to_numpy(), batch.column("v")
            vid, own = batch.column("vec_id").to_numpy(), batch.column("own").to_numpy()
            cut = [i for i in range(1, len(key)) if key[i] != key[i - 1] or role[i] != role[i - 1]]
            for lo, hi in zip([0, *cut], [*cut, len(key)]):
                if hi <= lo:
                    continue
                if key[lo] != cell:
                    cell, parts, index, last = key[lo], [], None, None
                    rot = rotation(cell[0], seed)
                part = (vid[lo:hi], own[lo:hi], _matrix(mat.slice(lo, hi - lo), cell[0]))
                if role[lo] == 0:
                    parts.append(part)
                    continue
                if index is None:
                    if not parts:
                        continue
                    ids, _, vecs = _once(*(np.concatenate(x) for x in zip(*parts)))
                    index, parts = Codes(vecs, centres[cell[0]], rot), []
                part = _once(*part, last)
                if len(part[0]):
                    last = part[0][-1], part[2][-1]
                    yield from answer(ids, vecs, index, part, centres[cell[0]], rot)
    return run


def _once(ids, own, vecs, last=None):
    """Sorted rows without the repeats of a row, or of the row ``last`` before them."""
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (vecs[1:] != vecs[:-1]).any(1)
    if last is not None and len(ids) and ids[0] == last[0] and (vecs[0] == last[1]).all():
        new[0] = False
    return ids[new], own[new], vecs[new]


def nearest(vectors: DataFrame, id_col: str, vec_col: str, queries, k: int = 20, seed: int = 11) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each row that ``queries``
    (a condition on the id column) names, by inner product, among all other rows."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), queries.alias("asks"))
            .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
                    & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
                    & F.exists("v", lambda x: x != 0))
            .withColumn("dim", F.size("v")))
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.sum(F.col("asks").cast("int")).alias("q")).collect()
    centres = {r["dim"]: np.zeros(r["dim"]) for r in sizes}
    sums: dict[int, list] = {}
    for r in rows.orderBy(F.xxhash64("vec_id", F.lit(seed))).limit(SAMPLE_ROWS // 10).select("dim", "v").collect():
        sums.setdefault(r["dim"], []).append(r["v"])
    centres |= {d: np.mean(x, axis=0) for d, x in sums.items()}
    cores = max(1, vectors.sparkSession.sparkContext.defaultParallelism)
    grid = {}
    for r in sizes:  # more blocks of queries while the blocks of vectors are fewer than the cores
        nv, q = -(-r["n"] // VECTOR_BLOCK), r["q"] or 0
        grid[r["dim"]] = nv, max(1, -(-q // QUERY_BLOCK), min(-(-2 * cores // nv), q // (2 * QUERY_STEP)))

    def per_dim(which: int):
        return F.expr("case " + " ".join(f"when dim = {d} then {g[which]}" for d, g in grid.items())
                      + " else 1 end") if grid else F.lit(1)
    rows = (rows.withColumn("nv", per_dim(0)).withColumn("nq", per_dim(1))
            .withColumn("own", F.xxhash64("vec_id", "v")))
    base = (rows.withColumn("vb", F.pmod("own", "nv").cast("int"))
            .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)))
            .select("dim", "vb", F.col("qb").cast("int").alias("qb"), F.lit(0).alias("role"), "vec_id", "own", "v"))
    quest = (rows.filter("asks").withColumn("qb", F.pmod("own", "nq").cast("int"))
             .withColumn("vb", F.explode(F.sequence(F.lit(0), F.col("nv") - 1)))
             .select("dim", F.col("vb").cast("int").alias("vb"), "qb", F.lit(1).alias("role"), "vec_id", "own", "v"))
    hits = (base.unionAll(quest).repartition("dim", "vb", "qb")
            .sortWithinPartitions("dim", "vb", "qb", "role", "vec_id", "v")
            .mapInArrow(_search(k, centres, seed), "query_id long, own long, vec_id long, score double"))
    w = Window.partitionBy("query_id", "own").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
