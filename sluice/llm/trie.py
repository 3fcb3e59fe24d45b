"""Prefix trie of conversations as balanced parentheses, one sequence per shard.

A conversation is the list of its turns; a turn is known by 128 bits of its role and
text, so texts never cross a shuffle.  Conversations are sorted by (turn digests, id)
over range partitions, so a conversation that fills a third of the table is spread like
any other.  Each partition is read in shards of bounded size:

* the common prefixes of neighbours give the shard's trie as a parenthesis sequence;
* range min-max blocks of its excess answer ``findclose``, which delimits each subtree;
* the rank of the leaf pairs ``()`` counts leaves, cumulative arrays over the preorder
  give members and savings, a doubling range minimum the smallest member.

Only nodes on a shard's first and last path (its spines) can go on in another shard.
They leave as partial rows under the digest of their path, and one aggregate merges
them.  What neighbouring shards count twice is known from the common prefix of the last
path of one and the first of the next: shared children, a leaf that the next shard
continues, and the one occurrence of a turn that is not saved.  All corrections are
sums too, so no tree is walked again.

Rows without a conversation id have no conversation and are left out.  Null turns come
first; equal turns are ordered by digest; equal rows are separate turns.  Null role and
text are empty.  An empty table has no nodes, not even a root.  Other columns are not
read, so their names cannot clash.  A conversation is one row of 24 bytes a turn.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from .work import Work

DIGEST = 16
SHARD_TURNS = 1 << 18
BLOCK = 128

NODE = ("key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
        "n_children long, n_leaves long, saved long, ends array<long>, shard long, path binary, "
        "sizes array<long>, kind string")
_FIELDS = {"binary": pa.binary(), "long": pa.int64(), "array<long>": pa.list_(pa.int64()), "string": pa.string()}
_SCHEMA = pa.schema([(c.split()[0], _FIELDS[c.split()[1]]) for c in NODE.split(", ")])
COUNTS = ["n_convs", "n_children", "n_leaves", "saved"]


class Parentheses:
    """A balanced sequence with range min-max blocks over its excess."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.excess = np.cumsum(2 * bits.astype(np.int32) - 1, dtype=np.int32)
        pad = -len(bits) % BLOCK
        self.rows = np.concatenate((self.excess, np.full(pad, 1 << 30, np.int32))).reshape(-1, BLOCK)
        self.mins = [self.rows.min(1)]
        while len(self.mins[-1]) > 1:
            m = self.mins[-1]
            m = np.concatenate((m, np.full(len(m) % 2, 1 << 30, np.int32)))
            self.mins.append(m.reshape(-1, 2).min(1))
        pairs = bits.astype(bool) & np.concatenate((bits[1:] == 0, [False]))
        self.leaf_rank = np.cumsum(pairs, dtype=np.int64)

    def _scan(self, block, after, target):
        """First column of the block beyond ``after`` whose excess is down at the target; BLOCK if none."""
        out = np.empty(len(block), np.int64)
        cols = np.arange(BLOCK)
        for k in range(0, len(block), 1 << 15):
            s = slice(k, k + (1 << 15))
            hit = (self.rows[block[s]] <= target[s, None]) & (cols > after[s, None])
            out[s] = np.where(hit.any(1), hit.argmax(1), BLOCK)
        return out

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """Position of the parenthesis that closes each of ``opens``."""
        target = self.excess[opens] - 1
        block = opens // BLOCK
        col = self._scan(block, opens % BLOCK, target)
        out = block * BLOCK + col
        todo = np.flatnonzero(col == BLOCK)
        at, found = block[todo], []
        for mins in self.mins:                              # up: to a right sibling that goes low enough
            right = at + 1
            ok = (at % 2 == 0) & (right < len(mins))
            ok[ok] = mins[right[ok]] <= target[todo[ok]]
            found.append((todo[ok], right[ok]))
            todo, at = todo[~ok], at[~ok] // 2
        who, at = found[-1]
        for level in range(len(self.mins) - 2, -1, -1):     # down: to the first block that does
            mins, left = self.mins[level], at * 2
            at = left + (mins[left] > target[who])
            who, at = np.concatenate((who, found[level][0])), np.concatenate((at, found[level][1]))
        out[who] = at * BLOCK + self._scan(at, np.full(len(at), -1), target[who])
        return out


def _range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of values[lo:hi] per pair, by doubling; all ranges hold something."""
    out = np.empty(len(lo), values.dtype)
    level = np.frexp(hi - lo)[1] - 1
    table, width = values, 1
    for k in range(int(level.max()) + 1):
        if k:
            table, width = np.minimum(table[:len(table) - width], table[width:]), width * 2
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[lo[at]], table[hi[at] - width])
    return out


def common_prefix(a: bytes, b: bytes) -> int:
    """Turns that two paths share from the start."""
    n = min(len(a), len(b)) // DIGEST * DIGEST
    x, y = (np.frombuffer(v[:n], np.uint8).reshape(-1, DIGEST) for v in (a, b))
    differ = np.flatnonzero((x != y).any(1))
    return int(differ[0]) if len(differ) else n // DIGEST


def _keys(path: bytes, depth: int) -> list[bytes]:
    """Digests of the path's prefixes of 0 to ``depth`` turns."""
    h, out = hashlib.md5(), []
    for d in range(depth + 1):
        out.append(h.copy().digest())
        h.update(path[d * DIGEST:(d + 1) * DIGEST])
    return out


def _batch(n: int, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type) for f in _SCHEMA], schema=_SCHEMA)


def _seam(last: tuple, first: tuple) -> pa.RecordBatch:
    """What two neighbouring shards count twice: (path, sizes) of the last and the next conversation."""
    depth = common_prefix(last[0], first[0])
    keys = _keys(last[0], depth)
    sizes = np.array(last[1][:depth], np.int64)
    below = np.concatenate((np.cumsum(sizes[::-1])[::-1], [0]))     # of depths d + 1 to the end
    saved = np.concatenate((below[:1], below[:-1]))
    ends = len(last[0]) // DIGEST == depth
    return _batch(depth + 1, key=keys, parent_key=[None, *keys[:-1]], depth=range(depth + 1),
                  n_convs=[0] * (depth + 1), n_children=[-1] * depth + [0], n_leaves=[-int(ends)] * (depth + 1),
                  saved=saved, kind=["spine"] * (depth + 1))


def _shard(conv, lens, digests, sizes, shard):
    """Record batches of one shard of sorted conversations: whole nodes, spines, pieces of the spines' ends."""
    m, start = len(conv), np.concatenate(([0], np.cumsum(lens)))
    lcp = np.zeros(m, np.int64)
    both = np.minimum(lens[1:], lens[:-1])
    if both.sum():
        cut = np.concatenate(([0], np.cumsum(both)[:-1]))
        p = np.arange(both.sum()) - np.repeat(cut, both)
        same = (digests[p + np.repeat(start[1:m], both)] == digests[p + np.repeat(start[:m - 1], both)]).all(1)
        some = both > 0
        lcp[1:][some] = np.minimum.reduceat(np.where(same, np.repeat(both, both), p), cut[some])
    new = lens - lcp
    first = 1 + np.concatenate(([0], np.cumsum(new)[:-1]))
    n = 1 + int(new.sum())
    owner = np.repeat(np.arange(m), new)
    depth = np.concatenate(([0], np.arange(n - 1) - np.repeat(first - 1, new) + np.repeat(lcp, new) + 1))
    closed = np.cumsum(np.concatenate(([0], lens[:-1] - lcp[1:])))
    opens = np.concatenate(([0], np.arange(1, n) + closed[owner]))
    bits = np.zeros(2 * n, np.uint8)
    bits[opens] = 1
    tree = Parentheses(bits)
    close = tree.find_close(opens)
    stop = np.arange(n) + (close - opens + 1) // 2
    end_of = np.maximum.accumulate(np.where(new > 0, first + new - 1, 0))
    n_ends = np.bincount(end_of, minlength=n)
    ends_at = np.concatenate(([0], np.cumsum(n_ends)))
    weight = np.concatenate(([0], sizes[start[owner] + depth[1:] - 1]))
    n_convs = ends_at[stop] - ends_at[:-1]
    saving = np.concatenate(([0], np.cumsum((n_convs - 1) * weight)))
    by_depth = np.argsort(depth, kind="stable")
    order = depth[by_depth] * (n + 1) + by_depth
    parent = np.zeros(n, np.int64)
    parent[1:] = by_depth[np.searchsorted(order, (depth[1:] - 1) * (n + 1) + np.arange(1, n)) - 1]
    lowest = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(lowest, end_of, conv)
    out = {"depth": depth, "conv_id": _range_min(lowest, np.arange(n), stop), "n_convs": n_convs,
           "n_children": np.bincount(parent[1:], minlength=n),
           "n_leaves": tree.leaf_rank[close] - tree.leaf_rank[opens] + (close == opens + 1),
           "saved": saving[stop] - saving[:-1]}

    key_of, raw = {}, digests.tobytes()
    right = [int(end_of[-1])]
    while right[-1]:
        right.append(int(parent[right[-1]]))
    for row, nodes in ((0, range(int(lens[0]) + 1)), (m - 1, right[::-1])):
        path = raw[start[row] * DIGEST:start[row + 1] * DIGEST]
        key_of.update(zip(nodes, _keys(path, int(lens[row]))))
    spine = np.array(sorted(key_of), np.int64)
    whole = np.setdiff1d(np.arange(n), spine)
    at_spine = np.isin(parent[whole], spine)
    if len(whole):
        lists = pa.ListArray.from_arrays(pa.array(ends_at, pa.int32()), pa.array(conv))
        yield _batch(len(whole), kind=["node"] * len(whole), ends=lists.take(pa.array(whole)),
                     parent_key=[key_of.get(p) for p in parent[whole].tolist()],
                     parent_conv_id=pa.array(out["conv_id"][parent[whole]], mask=at_spine),
                     **{k: v[whole] for k, v in out.items()})
    yield _batch(len(spine), kind=["spine"] * len(spine), key=[key_of[v] for v in spine.tolist()],
                 parent_key=[key_of[int(parent[v])] if v else None for v in spine.tolist()],
                 **{k: v[spine] for k, v in out.items()})
    with_ends = spine[n_ends[spine] > 0].tolist()
    if with_ends:
        yield _batch(len(with_ends), kind=["ends"] * len(with_ends), key=[key_of[v] for v in with_ends],
                     shard=[shard] * len(with_ends), ends=[conv[ends_at[v]:ends_at[v + 1]] for v in with_ends])


def _build(limit: int):
    def run(batches):
        part = TaskContext.get().partitionId()
        rows, turns, count, edge, opened = [], 0, 0, None, None

        def flush():
            nonlocal rows, turns, count, edge, opened
            t = pa.Table.from_batches(rows).combine_chunks()
            conv = t["conv_id"].combine_chunks().to_numpy(zero_copy_only=False)
            paths, lists = t["path"].combine_chunks(), t["sizes"].combine_chunks()
            lens = np.diff(np.asarray(lists.offsets)).astype(np.int64)
            digests = np.frombuffer(b"".join(paths.to_pylist()), np.uint8).reshape(-1, DIGEST)
            head, tail = ((paths[i].as_py(), lists[i].as_py()) for i in (0, len(conv) - 1))
            if edge is not None:
                yield _seam(edge, head)
            else:
                opened = head
            edge = tail
            yield from _shard(conv, lens, digests, lists.flatten().to_numpy(zero_copy_only=False), (part << 32) + count)
            rows, turns, count = [], 0, count + 1

        for batch in batches:
            lo = 0
            size = np.diff(np.asarray(batch.column("sizes").offsets)) + 1
            while lo < batch.num_rows:
                room = np.searchsorted(np.cumsum(size[lo:]), limit - turns, "right")
                hi = min(lo + max(int(room), 0 if rows else 1), batch.num_rows)
                if hi > lo:
                    rows.append(batch.slice(lo, hi - lo))
                    turns += int(size[lo:hi].sum())
                if hi < batch.num_rows or turns >= limit:
                    yield from flush()
                lo = hi
        if rows:
            yield from flush()
        if edge is not None:
            yield _batch(2, kind=["first", "last"], shard=[part, part], path=[opened[0], edge[0]],
                         sizes=[opened[1], edge[1]])
    return run


def _seams(batches):
    for b in batches:
        cols = [b.column(c).to_pylist() for c in ("path", "sizes", "next_path", "next_sizes")]
        for path, sizes, next_path, next_sizes in zip(*cols):
            yield _seam((path, sizes), (next_path, next_sizes))


def turn_paths(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
               text: str = "text", near: int = 1) -> DataFrame:
    """(group, conv_id, path, sizes): one row per conversation, its turns' digests and UTF-8 sizes
    in order.  Rows come partitioned by group, the conversation id down to a multiple of ``near``."""
    who, what = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.md5(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, what).cast("binary"))
    cid = F.col(conv).cast("long")
    rows = (turns.filter(cid.isNotNull())
            .select((cid - cid % near).alias("group"), cid.alias("conv_id"),
                    F.struct(F.col(turn).alias("t"), digest.alias("d"), F.octet_length(what).cast("long").alias("n")).alias("x"))
            .repartition("group"))
    return (rows.groupBy("group", "conv_id").agg(F.sort_array(F.collect_list("x")).alias("xs"))
            .select("group", "conv_id", F.unhex(F.array_join("xs.d", "")).alias("path"), F.col("xs.n").alias("sizes")))


def share_openings(paths: DataFrame, near: int = 5, most: int = 9) -> DataFrame:
    """(conv_id, path, sizes) rebuilt: the first h turns of the group's first conversation, then the
    conversation's own turns after its first h; h is the crc32 of the decimal id modulo ``most``.
    ``paths`` comes from ``turn_paths(..., near=near)``."""
    own = Window.partitionBy("group")
    head = F.when(F.col("conv_id") == F.col("group"), F.struct(
        F.expr(f"substring(path, 1, {DIGEST * (most - 1)})").alias("p"), F.slice("sizes", 1, most - 1).alias("s")))
    h = f"cast(crc32(cast(cast(conv_id as string) as binary)) % {most} as int)"
    return (paths.withColumn("head", F.max(head).over(own)).withColumn("h", F.expr(h))
            .select("conv_id",
                    F.expr(f"concat(coalesce(substring(head.p, 1, {DIGEST} * h), x''), substring(path, {DIGEST} * h + 1))").alias("path"),
                    F.expr("concat(coalesce(slice(head.s, 1, h), array()), slice(sizes, h + 1, size(sizes)))").alias("sizes")))


def build_trie(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of the trie of all ``paths`` (conv_id, path, sizes).

    nodes: key (null for nodes that lie in one shard), conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved, ends (the ids that end at the
    node, ascending; null where key is set).  ends: for nodes with a key, their ids in
    pieces (key, shard, ends) that follow each other by shard.
    """
    work = Work(paths.sparkSession, "trie")
    paths = work.keep(paths.select("conv_id", "path", "sizes"), "paths")
    rows = work.keep(paths.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
                     .mapInArrow(_build(shard_turns), NODE), "rows")
    work.drop("paths")
    first, last = (rows.filter(F.col("kind") == k).select(F.col("shard").alias("part"), "path", "sizes") for k in ("first", "last"))
    # one small row per partition: the partition that comes next
    after = last.select("part").withColumn("next", F.lead("part").over(Window.orderBy("part"))).dropna()
    seams = (last.join(after, "part").join(first.select(F.col("part").alias("next"), F.col("path").alias("next_path"),
                                                        F.col("sizes").alias("next_sizes")), "next")
             .select("path", "sizes", "next_path", "next_sizes").mapInArrow(_seams, NODE))
    spine = work.keep(rows.filter("kind = 'spine'").unionByName(seams).groupBy("key")
                      .agg(F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"),
                           F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in COUNTS]), "spine")
    above = spine.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    cols = ["key", "conv_id", "depth", "parent_conv_id", *COUNTS, "ends"]
    whole = rows.filter("kind = 'node'")
    # parents off the spines are known already; the others are looked up among the spines
    nodes = (whole.filter("parent_key is null").select(*cols)
             .unionByName(whole.filter("parent_key is not null").drop("parent_conv_id").join(above, "parent_key").select(*cols))
             .unionByName(spine.join(above, "parent_key", "left").withColumn("ends", F.lit(None).cast("array<long>")).select(*cols)))
    return nodes, rows.filter("kind = 'ends'").select("key", "shard", "ends")


def _stream_hash(batches):
    """SHA-256 of each key's ids, comma-joined, over sorted pieces; holds one state and one piece."""
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
    key, h = None, None
    for b in batches:
        done = []
        for k, ids in zip(b.column("key").to_pylist(), b.column("ends").to_pylist()):
            if k != key:
                if key is not None:
                    done.append((key, h.hexdigest()))
                key, h = k, hashlib.sha256(",".join(map(str, ids)).encode())
            else:
                h.update(("," + ",".join(map(str, ids))).encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], schema=schema)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([h.hexdigest()])], schema=schema)


def ends_digest(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """nodes with ends_sha256, the SHA-256 of the ids that end at the node, ascending and
    comma-joined.  A digest is made in order: a node's pieces stream through one task."""
    made = ends.repartition("key").sortWithinPartitions("key", "shard").mapInArrow(_stream_hash, "key binary, ends_sha256 string")
    one = nodes.filter("key is null").withColumn("ends_sha256", F.sha2(F.array_join(F.col("ends").cast("array<string>"), ","), 256))
    some = nodes.filter("key is not null").join(made, "key", "left")
    none = hashlib.sha256(b"").hexdigest()
    return one.unionByName(some.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none))))
