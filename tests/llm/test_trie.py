"""The conversation trie against brute force over all prefixes."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import queries, trie

COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    """conv -> rebuilt turns, straight from the contract's words."""
    turns = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            digest = hashlib.md5(f"{len(r.encode())}:{r}{x}".encode()).hexdigest()
            turns.setdefault(c, []).append((t is not None, t or 0, digest, r, x))
    turns = {c: [(r, x) for _, _, _, r, x in sorted(v)] for c, v in turns.items()}
    out = {}
    for c, v in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - c % 5, [])[:h] + v[h:]
    return out


def brute(convs):
    nodes = {}
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    kids = {p: [] for p in nodes}
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
        own = (len(nodes[p]) - 1) * len(p[-1][1].encode()) if p else 0
        saved[p] = own + sum(saved[k] for k in kids[p])
    out = []
    for p, members in nodes.items():
        ends = sorted(c for c in members if len(convs[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids[p]), leaves[p],
                    saved[p], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, limit):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumn("path", F.lit("clash")).withColumn("group", F.lit("clash")).withColumn("key", F.lit(1))
    got = trie.ends_digest(*trie.build_trie(trie.share_openings(trie.turn_paths(df, near=5)), limit))
    return sorted(map(tuple, got.withColumnRenamed("saved", "saved_tokens").select(*COLS).collect()), key=str)


def made(seed, n=400):
    """Few distinct turns, so that prefixes are shared; a third of all conversations are one."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * n), n):
        same = rng.random() < 0.33
        for t in range(6 if same else rng.randrange(1, 14)):
            x = f"turn {t}" if same else rng.choice(["a", "bé", "", None, "cc" * rng.randrange(3)])
            rows.append((c, t if rng.random() < 0.97 else None, "user" if same else rng.choice(["u", "v", None]), x))
    rows += rng.sample(rows, 20) + [(None, 1, "u", "no conversation")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,limit", [(1, trie.SHARD_TURNS), (2, 40), (3, 7), (4, 1)])
def test_trie(spark, seed, limit):
    rows = made(seed)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(seed == 1).lower())   # seams between partitions too
    try:
        assert run(spark, rows, limit) == brute(rebuilt(rows))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_small_inputs(spark):
    assert run(spark, [], 5) == []
    assert run(spark, [(None, 0, "u", "x")], 5) == []
    for rows in ([(0, 0, None, None)], [(8, 0, "u", "x")], [(3, 1, "u", "long " * 100_000)] * 3,
                 [(c, t, "u", "same") for c in range(40) for t in range(9)],
                 [(0, t, "u", str(t)) for t in range(3000)] + [(1, t, "u", str(t)) for t in range(2500)]):
        assert run(spark, rows, 30) == brute(rebuilt(rows))


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op11_conversation_trie(spark, sf)
    assert got.columns == COLS
    assert sorted(map(tuple, got.collect()), key=str) == brute(rebuilt(rows))


def test_find_close():
    rng = np.random.default_rng(5)
    for n in (1, 2, 63, 500, 5000):
        bits, depth, left = [1], 1, n - 1
        while depth:
            up = left and (rng.random() < 0.5 or depth == 1)
            bits.append(int(up))
            depth, left = depth + (1 if up else -1), left - int(bool(up))
        stack, want = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                want[stack.pop()] = i
        p = trie.Parentheses(np.array(bits, np.uint8))
        opens = np.array(sorted(want))
        assert p.find_close(opens).tolist() == [want[i] for i in opens]
