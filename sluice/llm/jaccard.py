"""N-gram Jaccard join by vertical partitioning.

A document is the set of its distinct word shingles.  Two documents are linked
when ``100 * |x & y| >= percent * |x | y|``.  The global n-gram order (rare
first) is cut into fragments of equal mass; a pair's overlap is counted in each
fragment on its own and summed per pair.

1. One pass writes each document's set size, a 64-bit set key, a 1024-bit parity
   sketch, and per task the shingle counts of 2^18 hash buckets.  Their sum ranks
   the buckets: that rank, then the hash, is the global order.
2. Equal sets become one node (their copies are linked through it).  Each node
   sends its prefix (its ``n - ceil(t n) + 1`` rarest shingles); two linked nodes
   share a prefix shingle.  Shingles with one node vanish.
3. Buckets of nodes that share a shingle propose pairs.  A pair must pass the
   length and position bounds and the sketch bound (each element of the symmetric
   difference flips one parity bit, so the Hamming distance cannot exceed it).
   A node proposes its ``k`` nearest nodes of other components per round; ``k``
   grows eightfold until no bucket had to hold a pair back, so no link is lost
   and a group of near copies is not expanded into all pairs.  Buckets over
   ``CELL`` nodes are split into cells of group pairs.
4. Proposed pairs are counted exactly, fragment by fragment; a band of fragments is
   joined and its shuffle files are gone before the next band is.
5. Links are joined to components.

Null, empty and blank texts have the empty set and no links.  Rows with equal
ids count as one document per text.  A null id is returned with its own null
component.  64-bit keys stand for sets and shingles.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from . import textutil as tu
from .work import Work, bloom, components, in_bloom

BUCKETS, PARTS = 1 << 18, 16
SKETCH_BITS = 1024
FRAGMENTS, BANDS = 8, 4
CELL = 4096
BATCH = "2m"


def _bucket(h):
    return (h & np.uint64(BUCKETS - 1)).astype(np.int64)


def _set_key(s: np.ndarray) -> np.int64:
    return np.array([np.add.reduce(tu.mix64(s ^ np.uint64(0x6A09E667F3BCC909)))
                     + np.uint64(len(s))], np.uint64).view(np.int64)[0]


def _describe(width):
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()),
                        ("sketch", pa.binary()), ("part", pa.int32()), ("counts", pa.binary())])

    def run(batches):
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for c in tu.chunks(batch, "text"):
                sets = tu.shingle_sets(c.column("text"), width)
                sk, keys = [], []
                for s in sets:
                    bits = np.bincount((s >> np.uint64(54)).astype(np.int64), minlength=SKETCH_BITS) & 1
                    sk.append(np.packbits(bits.astype(np.uint8)).tobytes())
                    keys.append(_set_key(s))
                if sets:
                    counts += np.bincount(_bucket(np.concatenate(sets)), minlength=BUCKETS)
                n = [len(s) for s in sets]
                none = pa.nulls(len(n))
                yield pa.RecordBatch.from_arrays(
                    [c.column("id"), pa.array(n, pa.int64()), pa.array(keys, pa.int64()),
                     pa.array(sk, pa.binary()), none.cast(pa.int32()), none.cast(pa.binary())],
                    schema=schema)
        step = BUCKETS // PARTS
        blobs = [zlib.compress(counts[p * step:(p + 1) * step].astype(np.int64).tobytes(), 1)
                 for p in range(PARTS)]
        none = pa.nulls(PARTS)
        yield pa.RecordBatch.from_arrays(
            [none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.int64()),
             none.cast(pa.binary()), pa.array(range(PARTS), pa.int32()),
             pa.array(blobs, pa.binary())], schema=schema)
    return tu.released(run), "id long, n long, node long, sketch binary, part int, counts binary"


def _add_counts(batches):
    """Running sums of the tasks' bucket counts, one vector per part."""
    total = {}
    for b in batches:
        for part, blob in zip(b.column("part").to_pylist(), b.column("counts").to_pylist()):
            v = np.frombuffer(zlib.decompress(blob), np.int64)
            total[part] = total[part] + v if part in total else v
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()),
         pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["part", "counts"])


def _global_order(described: DataFrame):
    """(rank of every bucket, fragment of every bucket): fixed size."""
    rows = (described.filter("part is not null").select("part", "counts")
            .repartition(PARTS, "part").mapInArrow(_add_counts, "part int, counts binary").collect())
    counts = np.zeros(BUCKETS, np.int64)
    step = BUCKETS // PARTS
    for r in rows:
        counts[r.part * step:(r.part + 1) * step] += np.frombuffer(r.counts, np.int64)
    order = np.lexsort((np.arange(BUCKETS), counts))
    rank = np.empty(BUCKETS, np.int32)
    rank[order] = np.arange(BUCKETS)
    mass = np.cumsum(counts[order])
    frag = np.empty(BUCKETS, np.uint8)
    frag[order] = np.minimum(FRAGMENTS - 1, (mass - 1).clip(0) * FRAGMENTS // max(1, mass[-1]))
    return rank, frag


def _prefixes(width, percent, order):
    schema = pa.schema([("token", pa.int64()), ("node", pa.int64()), ("n", pa.int64()),
                        ("pos", pa.int32())])

    def run(batches):
        rank, seen = order.value[0], set()
        for batch in batches:
            for c in tu.chunks(batch, "text"):
                cols = [[], [], [], []]
                for s in tu.shingle_sets(c.column("text"), width):
                    key = _set_key(s)
                    if not len(s) or key in seen:
                        continue
                    seen.add(key)
                    n = len(s)
                    p = n - (percent * n + 99) // 100 + 1
                    r = rank[_bucket(s)]
                    if p < n:
                        near = np.flatnonzero(r <= np.partition(r, p - 1)[p - 1])
                        s, r = s[near], r[near]
                    s = s[np.lexsort((s, r))[:p]]
                    cols[0].append(s.view(np.int64))
                    cols[1].append(np.full(p, key))
                    cols[2].append(np.full(p, n, np.int64))
                    cols[3].append(np.arange(p, dtype=np.int32))
                if cols[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in cols],
                                                     schema=schema)
    return tu.released(run), "token long, node long, n long, pos int"


def _pairs_of(t, n, pos, comp, grp, sk, percent, k):
    """Proposed pairs (i, j) of one cell and whether some were held back."""
    out, more = [], False
    own, other = t
    for i in range(len(n) - 1):
        js = np.arange(i + 1, len(n))
        ok = (percent * n[js] <= 100 * n[i]) & (comp[js] != comp[i])
        if own != other:
            ok &= grp[js] != grp[i]
        both = n[js] + n[i]
        need = -(-percent * both // (100 + percent))
        ok &= 1 + np.minimum(n[i] - pos[i], n[js] - pos[js]) - 1 >= need
        js, need, both = js[ok], need[ok], both[ok]
        if not len(js):
            continue
        ham = np.bitwise_count(sk[js] ^ sk[i]).sum(1)
        ok = ham <= both - 2 * need
        js, ham = js[ok], ham[ok]
        if len(js) > k:
            more = True
            js = js[np.argsort(ham, kind="stable")[:k]]
        out += [(i, j) for j in js.tolist()]
    return out, more


def _propose(percent, k):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("held", pa.int64())])

    def flush(rows):
        if rows.num_rows < 2:
            return []
        get = lambda c: rows.column(c).combine_chunks().to_numpy(zero_copy_only=False)
        tok, own, other = get("token"), get("own"), get("other")
        n, pos, comp, node, grp = (get(c) for c in ("n", "pos", "comp", "node", "grp"))
        sk = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint64).reshape(len(n), -1)
        cut = np.flatnonzero((tok[1:] != tok[:-1]) | (own[1:] != own[:-1]) | (other[1:] != other[:-1])) + 1
        out = []
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(n)]):
            if hi - lo < 2:
                continue
            got, more = _pairs_of((own[lo], other[lo]), n[lo:hi], pos[lo:hi], comp[lo:hi],
                                  grp[lo:hi], sk[lo:hi], percent, k)
            token = int(tok[lo]) if more else None
            for i, j in got:
                x, y = int(node[lo + i]), int(node[lo + j])
                out.append((min(x, y), max(x, y), token))
        return out

    def run(batches):
        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            rest = pa.concat_tables([rest, t]) if rest is not None else t
            # the last cell of a batch may go on in the next
            key = [rest.column(c) for c in ("token", "own", "other")]
            last = [c[-1].as_py() for c in key]
            same = np.ones(rest.num_rows, bool)
            for c, v in zip(key, last):
                same &= c.to_numpy() == v
            lo = int(np.argmax(same)) if same.any() else rest.num_rows
            done, rest = rest.slice(0, lo), rest.slice(lo)
            yield from emit(done)
        if rest is not None:
            yield from emit(rest)

    def emit(rows):
        got = list(dict.fromkeys(flush(rows)))
        if got:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*got)], schema=schema)
    return tu.released(run), "a long, b long, held long"


def _segments(width, order, wanted):
    schema = pa.schema([("node", pa.int64()), ("frag", pa.int32()), ("items", pa.list_(pa.int64()))])

    def run(batches):
        frag, words, seen = order.value[1], wanted.value, set()
        for batch in batches:
            for c in tu.chunks(batch, "text"):
                nodes, frags, items = [], [], []
                for s in tu.shingle_sets(c.column("text"), width):
                    key = _set_key(s)
                    if not len(s) or key in seen or not in_bloom(words, np.array([key]))[0]:
                        continue
                    seen.add(key)
                    f = frag[_bucket(s)]
                    for v in np.unique(f).tolist():
                        nodes.append(key)
                        frags.append(v)
                        items.append(s[f == v].view(np.int64))
                if nodes:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes, pa.int64()), pa.array(frags, pa.int32()),
                         pa.array(items, pa.list_(pa.int64()))], schema=schema)
    return tu.released(run), "node long, frag int, items array<long>"


def _overlaps(work: Work, pairs: DataFrame, seg: DataFrame, nodes: DataFrame, percent: int,
              name: str) -> DataFrame:
    """Links among the pairs: overlaps counted per fragment, written band by band as
    tables ``name``_0 to _(BANDS - 1), summed per pair."""
    parts = None
    for band in range(BANDS):
        one = seg.filter(F.col("band") == band)
        a = one.select(F.col("node").alias("a"), "frag", F.col("items").alias("xs"))
        b = one.select(F.col("node").alias("b"), "frag", F.col("items").alias("ys"))
        part = work.keep(pairs.join(a, "a").join(b, ["b", "frag"])
                         .select("a", "b", F.size(F.array_intersect("xs", "ys")).alias("c")), f"{name}_{band}")
        parts = part if parts is None else parts.unionAll(part)
    n = nodes.select("node", "n")
    return (parts.groupBy("a", "b").agg(F.sum("c").alias("both"))
            .join(n.select(F.col("node").alias("a"), F.col("n").alias("na")), "a")
            .join(n.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b")
            .filter(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both")))
            .select("a", "b"))


def jaccard_components(docs: DataFrame, id_col: str, text_col: str, width: int = 3,
                       percent: int = 90) -> tuple[DataFrame, DataFrame]:
    """(documents, links): per row of ``docs`` (id, n_shingles, component_id), and
    the verified links between distinct sets as (a, b) set keys."""
    spark = docs.sparkSession
    work = Work(spark, "jaccard")
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    fn, schema = _describe(width)
    described = work.keep(base.mapInArrow(fn, schema), "described", BATCH)
    rows = described.filter("part is null")
    nodes = work.keep(rows.groupBy("node").agg(F.min("id").alias("min_id"), F.first("n").alias("n"),
                                               F.first("sketch").alias("sketch")), "nodes")
    order = spark.sparkContext.broadcast(_global_order(described))  # 1.3 MB, fixed

    fn, schema = _prefixes(width, percent, order)
    w = Window.partitionBy("token")
    shared = (base.select("text").mapInArrow(fn, schema)
              .withColumn("lo", F.min("node").over(w)).withColumn("hi", F.max("node").over(w))
              .withColumn("m", F.count("*").over(w)).filter("lo <> hi").drop("lo", "hi")
              .dropDuplicates(["token", "node"]))
    g = F.ceil(F.col("m") / F.lit(CELL)).cast("int")
    shared = shared.withColumn("g", g).withColumn("grp", F.pmod(F.hash("node"), F.col("g")))
    shared = work.keep(shared.select("token", "node", "n", "pos", "g", "grp"), "shared", BATCH)

    done, links, k = None, None, 2
    labels, step = None, 0
    while True:
        cells = shared.join(nodes.select("node", "sketch"), "node")
        if labels is None:
            cells = cells.withColumn("comp", F.col("node"))
        else:
            cells = (cells.join(labels, "node", "left")
                     .withColumn("comp", F.coalesce("label", "node")).drop("label"))
            cells = (cells.withColumn("lo", F.min("comp").over(w)).withColumn("hi", F.max("comp").over(w))
                     .filter("lo <> hi").drop("lo", "hi"))
        cells = (cells.withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
                 .withColumn("own", F.least("grp", "cell")).withColumn("other", F.greatest("grp", "cell"))
                 .select("token", "own", "other", "n", "node", "pos", "comp", "grp", "sketch"))
        fn, schema = _propose(percent, k)
        raw = work.keep(cells.repartition("token", "own", "other")
                        .sortWithinPartitions("token", "own", "other", F.desc("n"), "node")
                        .mapInArrow(fn, schema), f"raw_{step}", BATCH)
        asked = raw.select("a", "b").distinct()
        if done is not None:
            asked = asked.join(done, ["a", "b"], "left_anti")
        asked = work.keep(asked, f"asked_{step}")
        ends = asked.select(F.explode(F.array("a", "b")).alias("node"))
        wanted = spark.sparkContext.broadcast(bloom(ends, "node"))  # 1 MB, fixed
        fn, schema = _segments(width, order, wanted)
        seg = base.select("text").mapInArrow(fn, schema).dropDuplicates(["node", "frag"])
        seg = seg.withColumn("band", F.floor(F.col("frag") * BANDS / FRAGMENTS).cast("int"))
        seg = work.keep(seg, f"seg_{step}", BATCH, by="band")
        found = work.keep(_overlaps(work, asked, seg, nodes, percent, f"parts_{step}"), f"links_{step}")
        work.drop(f"seg_{step}")
        for band in range(BANDS):
            work.drop(f"parts_{step}_{band}")
        links = found if links is None else links.unionAll(found)
        done = asked if done is None else done.unionAll(asked)
        labels = components(work, links, name=f"labels_{step}")
        work.drop(f"labels_{step - 1}")
        # only shingles whose bucket held a pair back need another round
        held = raw.filter("held is not null").select(F.col("held").alias("token")).distinct()
        more = held.limit(1).count()
        if more:
            shared = work.keep(shared.join(held, "token", "left_semi"), f"shared_{step}")
        work.drop(f"raw_{step}")
        work.drop(f"shared_{step - 1}" if step else "shared")
        if not more:
            break
        k, step = k * 8, step + 1
    for past in range(step + 1):
        work.drop(f"asked_{past}")

    named = nodes.select("node", "min_id").join(labels, "node", "left")
    named = named.withColumn("label", F.coalesce("label", "node"))
    lowest = named.groupBy("label").agg(F.min("min_id").alias("component_id"))
    lowest = named.join(lowest, "label").select("node", "component_id")
    out = (rows.select("id", "n", "node").join(lowest, "node")
           .select("id", F.col("n").alias("n_shingles"),
                   F.when(F.col("id").isNull(), F.lit(None)).when(F.col("n") == 0, F.col("id"))
                   .otherwise(F.col("component_id")).alias("component_id")))
    return out, links
