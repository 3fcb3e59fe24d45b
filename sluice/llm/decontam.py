"""Benchmark decontamination with an FM-index per training shard.

The benchmark's words get ids.  A shard is a bounded chunk of documents; its words
are mapped to those ids, and a maximal run of words that the benchmark lacks becomes
one separator, since no phrase can cross it.  Over that sequence each task builds a
suffix array (prefix doubling), its Burrows-Wheeler transform as a wavelet matrix
with rank sums, and sampled suffix positions.  All test phrases step backwards
through the ranks together; their occurrences are located by walking to the nearest
sampled position, and the spans are merged per document.

The benchmark is taken in blocks of ``BLOCK_WORDS`` words, each broadcast on its own
(its bound), so a benchmark of any size is searched in full.

Null, empty and wordless texts have no words and no hits; a benchmark row without
id or words is no phrase; equal items all count; columns with clashing names are
replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import textutil as tu

BLOCK_WORDS = 4_000_000
SHARD_BYTES = 4 << 20
SAMPLE = 8


class Phrases:
    """Distinct phrases of a block of benchmark items, over small word ids."""

    def __init__(self, items: list[tuple[int, str]], window: int):
        h, rows = tu.hashed_words(pa.array([t for _, t in items], pa.string()), tu.ALNUM_WORDS)
        self.vocab = np.unique(h)
        ids = np.searchsorted(self.vocab, h) + 1
        owners: dict[tuple, set] = {}
        for (item, _), lo, hi in zip(items, rows[:-1].tolist(), rows[1:].tolist()):
            w = min(window, hi - lo)
            for i in range(lo, hi - w + 1 if w else lo):
                owners.setdefault(tuple(ids[i:i + w].tolist()), set()).add(item)
        self.words = list(owners)
        self.owners = [sorted(v) for v in owners.values()]
        self.length = np.array([len(p) for p in self.words], np.int64)
        self.shortest = int(self.length.min()) if self.words else 0
        # one row per phrase, last word first
        self.back = np.zeros((len(self.words), window), np.int64)
        for k, p in enumerate(self.words):
            self.back[k, :len(p)] = p[::-1]


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Order of the suffixes; zeros are separators, each its own (by position)."""
    n = len(seq)
    sep = seq == 0
    seps = int(sep.sum())
    rank = np.empty(n, np.int64)
    rank[sep] = np.arange(seps)
    rank[~sep] = np.unique(seq[~sep], return_inverse=True)[1] + seps
    step = 1
    order = np.argsort(rank, kind="stable")
    while True:
        nxt = np.zeros(n, np.int64)
        if step < n:
            nxt[:-step] = rank[step:] + 1
        key = rank * np.int64(n + 2) + nxt
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        k = key[order]
        new[order] = np.concatenate(([0], np.cumsum(k[1:] != k[:-1])))
        rank = new
        if rank.max(initial=0) == n - 1:
            return order
        step *= 2


class FMIndex:
    """Wavelet-matrix ranks over the transform, with sampled positions."""

    def __init__(self, seq: np.ndarray, sample: int = SAMPLE):
        sa = suffix_array(seq)
        bwt = seq[sa - 1]  # the sequence ends in a separator, so row 0's left is one too
        self.bwt, n = bwt, len(seq)
        self.top = int(seq.max(initial=0)) + 1
        self.first = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=self.top))))
        self.bits = max(1, int(self.top - 1).bit_length())
        self.ones, self.zeros, cur = [], [], bwt
        for level in range(self.bits - 1, -1, -1):
            bit = (cur >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int32))
            self.zeros.append(n - int(self.ones[-1][-1]))
            cur = np.concatenate((cur[bit == 0], cur[bit == 1]))
        start = np.concatenate(([True], seq[:-1] == 0))
        known = start[sa] | (sa % sample == 0)
        self.known, self.place = known, np.cumsum(known) - 1
        self.samples = sa[known]

    def rank(self, word: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often word[k] stands in the first i[k] places of the transform."""
        lo, hi = np.zeros_like(i), i.copy()
        for level in range(self.bits):
            ones, z = self.ones[level], self.zeros[level]
            up = ((word >> (self.bits - 1 - level)) & 1).astype(bool)
            a, b = ones[lo], ones[hi]
            lo = np.where(up, z + a, lo - a)
            hi = np.where(up, z + b, hi - b)
        return hi - lo

    def search(self, back: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of phrases given last word first."""
        lo, hi = np.zeros(len(back), np.int64), np.full(len(back), len(self.bwt), np.int64)
        for k in range(back.shape[1]):
            act = np.flatnonzero((length > k) & (hi > lo))
            w = back[act, k]
            gone = w >= self.top
            hi[act[gone]] = lo[act[gone]]
            act, w = act[~gone], w[~gone]
            lo[act], hi[act] = (self.first[w] + self.rank(w, lo[act]),
                                self.first[w] + self.rank(w, hi[act]))
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        act = np.flatnonzero(~self.known[rows])
        while len(act):
            w = self.bwt[rows[act]]
            rows[act] = self.first[w] + self.rank(w, rows[act])
            steps[act] += 1
            act = act[~self.known[rows[act]]]
        return self.samples[self.place[rows]] + steps


def find(col: pa.Array, ph: Phrases):
    """(words per row, merged spans per row as word places, items per row, words)."""
    data, offs = tu.text_bytes(col)
    low, s, e, rows = tu.word_spans(data, offs, tu.ALNUM_WORDS)
    n_rows = len(offs) - 1
    spans: list[list] = [[] for _ in range(n_rows)]
    items: list[set] = [set() for _ in range(n_rows)]
    if len(s) and len(ph.words):
        h = tu.word_hashes(low, s, e)
        k = np.minimum(np.searchsorted(ph.vocab, h), len(ph.vocab) - 1)
        ids = np.where(ph.vocab[k] == h, k + 1, 0)
        first = np.zeros(len(ids) + 1, bool)
        first[rows] = True
        on = ids > 0
        begin = on & (first[:-1] | ~np.concatenate(([False], on[:-1])))
        end = on & (first[1:] | ~np.concatenate((on[1:], [False])))
        a, b = np.flatnonzero(begin), np.flatnonzero(end) + 1
        long = b - a >= ph.shortest
        a, b = a[long], b[long]
        if len(a):
            size = b - a + 1  # each run and its separator
            cum = np.concatenate(([0], np.cumsum(size)))
            inner = np.arange(cum[-1]) - np.repeat(cum[:-1], size)
            at = np.repeat(a, size) + inner
            seq = np.where(inner == np.repeat(size - 1, size), 0, ids[np.minimum(at, len(ids) - 1)])
            fm = FMIndex(seq)
            lo, hi = fm.search(ph.back, ph.length)
            got = np.flatnonzero(hi > lo)
            n = (hi - lo)[got]
            base = np.concatenate(([0], np.cumsum(n)))
            row = np.arange(base[-1]) - np.repeat(base[:-1], n) + np.repeat(lo[got], n)
            phrase = np.repeat(got, n)
            word = at[fm.locate(row)]
            doc = np.searchsorted(rows, word, "right") - 1
            for d, p in set(zip(doc.tolist(), phrase.tolist())):
                items[d].update(ph.owners[p])
            edge = np.zeros(len(ids) + 1, np.int64)
            np.add.at(edge, word, 1)
            np.add.at(edge, word + ph.length[phrase], -1)
            hit = np.cumsum(edge[:-1]) > 0
            sa = np.flatnonzero(hit & (first[:-1] | ~np.concatenate(([False], hit[:-1]))))
            sb = np.flatnonzero(hit & (first[1:] | ~np.concatenate((hit[1:], [False])))) + 1
            for x, y, d in zip(sa.tolist(), sb.tolist(), (np.searchsorted(rows, sa, "right") - 1).tolist()):
                spans[d].append((x - int(rows[d]), y - int(rows[d])))
    return np.diff(rows), spans, items, (s, e, rows, offs)


def _merge(spans: list) -> list:
    out: list = []
    for x, y in sorted(spans):
        if out and x <= out[-1][1]:
            out[-1][1] = max(out[-1][1], y)
        else:
            out.append([x, y])
    return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int):
    """Blocks of the benchmark's items, each of a bounded number of words."""
    rows = (benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
            .dropna().dropDuplicates().toLocalIterator())
    block, words = [], 0
    for r in rows:
        block.append((r.i, r.t))
        words += len(r.t) // 2 + 1
        if words >= BLOCK_WORDS:
            yield Phrases(block, window)
            block, words = [], 0
    if block:
        yield Phrases(block, window)


def _search(phrases, text_col, names, window):
    def run(batches):
        ph = phrases.value
        for batch in batches:
            for c in tu.chunks(batch, text_col, SHARD_BYTES):
                n, spans, items, _ = find(c.column(text_col), ph)
                old = list(zip(c.column("hit_spans").to_pylist(), c.column("hit_items").to_pylist()))
                spans = [_merge([tuple(x) for x in o[0]] + s) for o, s in zip(old, spans)]
                items = [sorted(set(o[1]) | i) for o, i in zip(old, items)]
                yield pa.RecordBatch.from_arrays(
                    [c.column(x) for x in names]
                    + [pa.array(n, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                       pa.array(items, pa.list_(pa.int64()))],
                    names + ["n_words", "hit_spans", "hit_items"])
    return tu.released(run)


def find_contamination(docs: DataFrame, text_col: str, benchmark: DataFrame, item_col: str,
                       item_text_col: str, window: int = 10) -> DataFrame:
    """``docs`` plus n_words, hit_spans (merged [first, end) word places) and
    hit_items (ids of the items with a window in the text)."""
    spark = docs.sparkSession
    keep = [f for f in docs.schema.fields if f.name not in ("n_words", "hit_spans", "hit_items")]
    names = [f.name for f in keep]
    ddl = ("".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in keep)
           + "n_words long, hit_spans array<array<int>>, hit_items array<long>")
    out = docs.select(*[F.col(f"`{n}`") for n in names], F.lit(0).cast("long").alias("n_words"),
                      F.array().cast("array<array<int>>").alias("hit_spans"),
                      F.array().cast("array<long>").alias("hit_items"))
    blocks = 0
    for ph in _blocks(benchmark, item_col, item_text_col, window):
        blocks += 1
        out = out.mapInArrow(_search(spark.sparkContext.broadcast(ph), text_col, names, window), ddl)
    if not blocks:
        out = out.mapInArrow(_search(spark.sparkContext.broadcast(Phrases([], window)), text_col, names, window), ddl)
    return out


def cut_spans(df: DataFrame, text_col: str) -> DataFrame:
    """Takes the words of hit_spans (and what stands between them) out of the text."""
    names = df.columns
    at = names.index(text_col)

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            spans = batch.column("hit_spans").to_pylist()
            for i, (t, sp) in enumerate(zip(texts, spans)):
                if t and sp:
                    raw = t.encode("utf-8")
                    _, s, e, _ = tu.word_spans(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]),
                                               tu.ALNUM_WORDS)
                    parts, last = [], 0
                    for x, y in sp:
                        parts.append(raw[last:s[x]])
                        last = e[y - 1]
                    texts[i] = b"".join([*parts, raw[last:]]).decode("utf-8")
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if k == at else batch.column(k) for k in range(len(names))], names)
    return df.mapInArrow(tu.released(run), df.schema)


def items_digest(items: list[int]) -> str:
    return hashlib.sha256(",".join(sorted(str(i) for i in items)).encode()).hexdigest()
