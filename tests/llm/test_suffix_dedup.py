"""Repeated byte strings against brute force over all windows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import queries, suffix_dedup as sd


def brute(rows):
    least = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49) if d is not None else ():
            w = b[i:i + 50]
            least[w] = min(d, least.get(w, d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49) if d is not None else ():
            if least[b[i:i + 50]] < d:
                gone[i:i + 50] = b"\1" * 50
        spans, i = [], 0
        while i < len(b):
            j = i
            while j < len(b) and gone[j]:
                j += 1
            if j > i:
                spans.append([i, j])
            i = max(j, i + 1)
        out.append((d, len(b), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit("clash")).withColumn("kept", F.lit(1))
    got = sd.remove_repeats(df.repartition(3), "doc_id", "text", **kw).collect()
    return sorted(((r.doc_id, r.n_bytes, r.spans, bytes(r.kept)) for r in got), key=str)


def made(seed, n=120):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(1, 9)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passages = [prose(40) for _ in range(6)] + ["=" * 300, "ab" * 200, "漢字" * 60]
    common = prose(14)
    rows = []
    for d in rng.sample(range(1000), n):
        parts = [prose(rng.randrange(30))]
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            lo = rng.randrange(len(p) // 2)
            parts += [p[lo:lo + rng.randrange(20, 400)], prose(rng.randrange(6))]
        if rng.random() < 0.4:
            parts.insert(1, common)
        rows.append((d, "".join(parts)))
    rows += [(d + 2000, t) for d, t in rng.sample(rows, 20)]                     # copies
    rows += [(d, t + "x") for d, t in rng.sample(rows, 10)]                      # ids that repeat
    rows += [(3000, None), (3001, ""), (3002, "short"), (None, passages[0]), (3003, passages[0][:49]), (3004, passages[0][:50])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,kw", [(1, {}), (2, {"block_bytes": 3000}), (3, {"block_bytes": 500, "hot": 1}), (4, {"hot": 0})])
def test_remove_repeats(spark, seed, kw):
    rows = made(seed)
    assert run(spark, rows, **kw) == brute(rows)


def test_texts_longer_than_a_piece(spark):
    rng = random.Random(11)
    text = "".join(rng.choice("abcdefgh ") for _ in range(sd.PIECE + 20_000))
    rows = made(7, 30) + [(5000, text), (5001, "y" + text[sd.PIECE - 300:sd.PIECE + 300] + "w" * 60), (5002, "z" * 3000),
                          (5003, "y" + "z" * 2000), (4, "z" * 60), (5004, text[sd.PIECE - 49:sd.PIECE + 1])]
    assert run(spark, rows) == brute(rows)


def test_no_documents(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, None), (1, "a")]) == brute([(None, None), (1, "a")])


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op13_suffix_dedup(spark, sf)
    want = sorted((d, n, sum(b - a for a, b in s), len(s), hashlib.sha256(k).hexdigest()) for d, n, s, k in brute(rows))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect())) == want


def test_suffix_sort():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    pos = rng.permutation(2900)
    group = np.sort(rng.integers(0, 9, 2900))
    got, raw = sd.Suffixes(data).sort(pos, group), data.tobytes()
    for k in range(9):
        assert [raw[p:p + 50] for p in got[group == k]] == sorted(raw[p:p + 50] for p in pos[group == k])


@pytest.mark.parametrize("n", [1, 2900, (1 << 15) + 1, 70_000])
def test_sorted_suffixes_are_verified(n):
    """The check of a right order says so at any length, so that the byte sort is left to real collisions."""
    rng = np.random.default_rng(n)
    data = rng.integers(97, 99, n + 50).astype(np.uint8)
    data[n // 2:n // 2 + n // 4] = data[:n // 4]
    pos, group = rng.permutation(n), np.sort(rng.integers(0, 9, n))
    suffixes, raw = sd.Suffixes(data), data.tobytes()
    got = suffixes.sort(pos, group)
    keyed = [(k, raw[p:p + 50]) for k, p in zip(group.tolist(), got.tolist())]
    assert keyed == sorted(keyed)
    assert suffixes.same_as_before(got, group).tolist() == [False] + [a == b for a, b in zip(keyed, keyed[1:])]
    if n > 1:
        turned = got[::-1]
        with pytest.raises(sd.Collision):
            suffixes.same_as_before(turned, np.zeros(n, np.int64))


def test_byte_sort_is_left_to_collisions(monkeypatch):
    def spied(self, pos, group):
        try:
            return real(self, pos, group)
        except ValueError:
            fell.append(1)
            raise
    fell, real = [], sd.Suffixes.same_as_before
    monkeypatch.setattr(sd.Suffixes, "same_as_before", spied)
    text = np.frombuffer(b"the quick brown fox jumps over the lazy dog and on and on it goes" * 2, np.uint8)
    first = np.array([0, 65])
    h = np.full(2, sd._run_hashes(text)[:27].min())
    mask = sd.repeated_windows(text, first, np.array([16, 16]), h, np.array([1, 2]), np.zeros(2, np.int64), None)
    assert mask.tolist() == [0, (1 << 16) - 1] and not fell


def test_tasks_give_memory_back_and_batches_are_bounded(spark, monkeypatch):
    gone, sizes = [], {}
    monkeypatch.setattr(sd.tu, "release", lambda: gone.append(1))
    keep = sd.Work.keep
    monkeypatch.setattr(sd.Work, "keep", lambda self, df, name, batch=None, **kw: (sizes.update({name: batch}), keep(self, df, name, batch, **kw))[1])
    empty = sd._CUT, sd._schema("doc_id long, text binary").empty_table(), sd._schema(sd._BACK).empty_table()
    assert sd._freed(sd._cut)(*empty[1:]).num_rows == 0 and len(gone) == 1
    df = spark.createDataFrame([(1, "a" * 60), (2, "b" + "a" * 60)], "doc_id long, text string")
    assert sorted(bytes(r.kept) for r in sd.remove_repeats(df, "doc_id", "text").collect()) == [b"a" * 60, b"b"]
    assert sizes == {"shared": "2m", "back": "2m"}
