"""Removal of repeated byte strings by a hash-compared suffix sort.

Every byte that lies in a string of ``WINDOW`` bytes which also starts in a document with
a smaller id leaves.  Sending every suffix to a sort would move the text many times over,
so the suffixes meet where they can match:

1. Each window is known by the smallest hash among its runs of ``RUN`` bytes (a function of
   the window alone, so equal windows agree on it).  Neighbouring windows with one
   smallest hash form a segment.  Blocks of documents report their hashes in sorted,
   packed lists by hash range; a hash that one document alone holds needs no more work.
2. Blocks send their distinct segments with a shared hash, each with its smallest
   document.  Copies combine in the block; a hash that stands in very many places is
   split by its windows' own hashes, so that equal windows still meet.
3. Per hash, the distinct segments are one text.  Its suffixes are sorted by a mergesort:
   prefix polynomial hashes and a binary search find how far two suffixes agree, so a
   comparison takes a logarithmic number of probes.  Neighbours that agree over a whole
   window are one class, whose smallest document decides.  Every equality and every
   order of neighbours is verified on the bytes; a text that fails is sorted by its bytes.
4. The blocks get back, per segment, its smallest document and the windows that occur in
   a still smaller one, and cut.

The documents are written once, bucketed by block, so neither of the two later readings
shuffles a text.  Null text is empty.  A null id is neither smaller nor larger than
another: such rows stay whole and remove nothing.  Rows with equal ids are one document
number; they do not remove each other.  Long texts are scanned in pieces.  An empty table
gives no rows.  Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import textutil as tu
from .work import Work

WINDOW, RUN = 50, 24                      # RUN: a multiple of 8; longer runs meet less by chance
SPAN = WINDOW - RUN + 1
MASK = 64
PIECE = 1 << 20
BLOCK_BYTES = 16 << 20
BATCH = "2m"                              # of an Arrow batch on its way to Python
HOT = 13                                  # log2 of the places of one hash that stay together
_U = np.uint64
_STEP = _U(0x9E6C63D0876A9A4B | 1)
_BACK_STEP = _U(pow(int(_STEP), -1, 1 << 64))
_PROBES = (32, 16)                        # then eight bytes at once


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, zeros after the end."""
    raw = data.tobytes() + bytes(8)
    words = np.empty(len(data), np.uint64)
    for j in range(8):
        out = words[j::8]
        out[:] = np.frombuffer(raw, "<u8", len(out), j)
    return words


def _run_hashes(data: np.ndarray) -> np.ndarray:
    """48-bit hash of the RUN bytes from every position on."""
    n, words = len(data), _words(data)
    m = max(0, n - RUN + 1)
    h = words[:m]
    for j in range(8, RUN, 8):
        h = tu.mix64(h) * _STEP ^ words[j:j + m]
    return tu.mix64(h * _STEP) >> _U(16)


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int):
    """Powers of the step and of its inverse, kept for the longest text so far of up to a few pieces."""
    if len(_POWERS[0]) >= n:
        return _POWERS
    size = max(n, PIECE + 4096)
    made = [np.cumprod(np.concatenate(([_U(1)], np.full(size - 1, x))), dtype=np.uint64) for x in (_STEP, _BACK_STEP)]
    if size <= 2 * PIECE:
        _POWERS[:] = made
    return made


class Prefixes:
    """Prefix polynomial hashes of a text."""

    def __init__(self, data: np.ndarray):
        power, self.back = _powers(len(data) + 1)
        self.sums = np.concatenate(([_U(0)], np.cumsum(tu._BYTE_MIX[data] * power[:len(data)], dtype=np.uint64)))

    def of(self, lo, hi):
        """Hash of bytes lo to hi, wherever they stand."""
        return (self.sums[hi] - self.sums[lo]) * self.back[lo]


def _segment_hash(prefix, lo, n_bytes):
    return tu.mix64(prefix.of(lo, lo + n_bytes) + n_bytes.astype(np.uint64) * tu._LEN_MIX)


def segments(data: np.ndarray, offs: np.ndarray):
    """(row, first window, windows, hash) of the segments of rows data[offs[i]:offs[i + 1]]."""
    h = _run_hashes(data)
    n = len(data) - WINDOW + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none.astype(np.uint64)
    low, have = h, 1
    while have * 2 <= SPAN:
        low, have = np.minimum(low[:-have], low[have:]), have * 2
    low = np.minimum(low[:n], low[SPAN - have:SPAN - have + n])
    mark = np.zeros(n + 1, np.int32)                       # windows that run over a row's end
    np.add.at(mark, np.minimum(np.maximum(offs[1:] - WINDOW + 1, offs[:-1]), n), 1)
    np.add.at(mark, np.minimum(offs[1:], n), -1)
    good = np.cumsum(mark)[:n] == 0
    cut = np.concatenate(([True], (low[1:] != low[:-1]) | ~good[:-1])) | ~good
    at = np.concatenate((np.flatnonzero(cut), [n]))
    start, size = at[:-1], np.diff(at)
    start, size = start[good[start]], size[good[start]]
    parts = -(-size // MASK)
    inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.repeat(start, parts) + inner * MASK
    return (np.searchsorted(offs, first, "right") - 1, first, np.minimum(np.repeat(size, parts) - inner * MASK, MASK), low[first])


def _pieces(table):
    """(bytes, offsets, ids, first row, offset in the row) of pieces of at most PIECE bytes."""
    row = 0
    for batch in table.to_batches():
        for c in tu.chunks(batch, "text", PIECE):
            data, offs = tu.text_bytes(c.column("text"))
            ids = c.column("doc_id")
            if len(data) <= PIECE:
                yield data, offs, ids, row, 0
            else:                                          # one long text
                for lo in range(0, len(data) - WINDOW + 1, PIECE):
                    part = data[lo:lo + PIECE + WINDOW - 1]
                    yield part, np.array([0, len(part)]), ids, row, lo
            row += c.num_rows


def _found(table):
    """Per piece: its bytes, and of its segments the row, id, place in row, first window, windows, hash."""
    for data, offs, ids, row, lo in _pieces(table):
        r, first, n, h = segments(data, offs)
        known = ids.is_valid().to_numpy(zero_copy_only=False)[r]
        r, first, n, h = r[known], first[known], n[known], h[known]
        yield data, r + row, ids.fill_null(0).to_numpy(zero_copy_only=False)[r], first - offs[r] + lo, first, n, h


def _zip(x: np.ndarray) -> bytes:
    x = np.ascontiguousarray(x)
    return pa.compress(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes(), codec="zstd", asbytes=True)


def _unzip(raw: bytes, n: int, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(raw, n * size, codec="zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _range(h: np.ndarray, ranges: int) -> np.ndarray:
    return ((h >> _U(24)) * _U(ranges) >> _U(24)).astype(np.int32)


_LISTS = "block long, range int, n int, hashes binary, heat binary"
_SENT = "range int, block long, n int, h binary, doc binary, size binary, salt binary, split binary, more binary, n_text long, text binary"
_BACK = "block long, n int, h binary, g binary, doc binary, mask binary"
_CUT = "doc_id long, n_bytes long, spans array<array<long>>, kept binary"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<array<long>>": pa.list_(pa.list_(pa.int64()))}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in ddl.split(", ")])


def _rows(ddl: str, rows: list[tuple]):
    s = _schema(ddl)
    cols = list(zip(*rows)) or [[] for _ in s]
    return [pa.array(c, f.type) for c, f in zip(cols, s)], s


def _listed(ranges: int):
    """Distinct hashes of each block by range, with the log2 of their segments' number and a mark for several rows."""
    def flush(block, held):
        h, n = np.unique(np.concatenate([x for x, _ in held]), return_counts=True)
        _, rows = np.unique(np.concatenate([x for _, x in held]), return_counts=True)
        heat = np.frexp(n)[1].astype(np.uint8) - 1 | (rows > 1).astype(np.uint8) << 7
        r = _range(h, ranges)
        cut = [0, *(np.flatnonzero(np.diff(r)) + 1).tolist(), len(h)] if len(h) else [0]
        out = [(block, int(r[lo]), hi - lo, _zip(np.diff(h[lo:hi], prepend=_U(0))), _zip(heat[lo:hi])) for lo, hi in zip(cut, cut[1:])]
        if out:
            cols, s = _rows(_LISTS, out)
            yield pa.RecordBatch.from_arrays(cols, schema=s)

    def run(batches):
        block, held = None, []
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            cut = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for lo, hi in zip(cut, cut[1:]):
                if hi == lo:
                    continue
                if blocks[lo] != block:
                    if held:
                        yield from flush(block, held)
                    block, held = int(blocks[lo]), []
                for _, r, _, _, _, _, h in _found(pa.Table.from_batches([batch.slice(lo, hi - lo)])):
                    o = np.lexsort((r, h))
                    r, h = r[o], h[o]
                    held.append((h, h[np.concatenate(([True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])))] if len(h) else h))
        if held:
            yield from flush(block, held)
    return run


def _by_range(batches):
    """Rows of a sorted partition, one range at a time."""
    held, at = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if row["range"] != at and held:
                yield held
                held = []
            at = row["range"]
            held.append(row)
    if held:
        yield held


def _shared(batches):
    """Per block and range, the hashes that more than one row of documents holds."""
    for rows in _by_range(batches):
        h = np.concatenate([np.cumsum(_unzip(r["hashes"], r["n"], np.uint64)) for r in rows])
        heat = np.concatenate([_unzip(r["heat"], r["n"], np.uint8) for r in rows])
        owner = np.repeat(np.arange(len(rows)), [r["n"] for r in rows])
        o = np.argsort(h, kind="stable")
        h, heat, owner = h[o], heat[o], owner[o]
        start = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        places = np.add.reduceat(np.left_shift(1, (heat & 127).astype(np.int64)), start)
        size = np.diff(np.concatenate((start, [len(h)])))
        total = np.repeat(np.frexp(places)[1].astype(np.uint8) - 1, size)
        keep = (np.repeat(size, size) > 1) | (heat > 127)
        h, total, owner = h[keep], total[keep], owner[keep]
        o = np.argsort(owner, kind="stable")
        cut = np.searchsorted(owner[o], np.arange(len(rows) + 1))
        out = []
        for i, row in enumerate(rows):
            mine = o[cut[i]:cut[i + 1]]
            if len(mine):
                out.append((row["block"], row["range"], len(mine), _zip(np.diff(h[mine], prepend=_U(0))), _zip(total[mine])))
        if out:
            cols, s = _rows(_LISTS, out)
            yield pa.RecordBatch.from_arrays(cols, schema=s)


def _gather(data: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return data[np.repeat(first, n) + inner]


def _send(ranges: int, hot: int):
    """A block's distinct segments with a shared hash, by range."""
    def run(docs, lists):
        lists = lists.to_pylist()
        if not lists or not docs.num_rows:
            return pa.Table.from_arrays(*_rows(_SENT, [])[:1], schema=_schema(_SENT))
        block = lists[0]["block"]
        shared = np.concatenate([np.cumsum(_unzip(r["hashes"], r["n"], np.uint64)) for r in lists])
        heat = np.concatenate([_unzip(r["heat"], r["n"], np.uint8) for r in lists])
        o = np.argsort(shared)
        shared, heat = shared[o], heat[o]
        got, texts = [], []
        for data, _, doc, _, first, n, h in _found(docs):
            at = np.minimum(np.searchsorted(shared, h), len(shared) - 1)
            ok = shared[at] == h
            doc, first, n, h, at = doc[ok], first[ok], n[ok], h[ok], at[ok]
            g = _segment_hash(Prefixes(data), first, n + WINDOW - 1)
            got.append((h, g, doc, np.full(len(h), len(texts)), first, n, heat[at]))
            texts.append(data)
        h, g, doc, text, first, n, heat = (np.concatenate(x) for x in zip(*got))
        o = np.lexsort((doc, g, h))
        h, g, doc, text, first, n, heat = (x[o] for x in (h, g, doc, text, first, n, heat))
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (g[1:] != g[:-1]))) if len(h) else np.zeros(0, bool)
        start = np.flatnonzero(new)
        last = np.concatenate((start[1:], [len(h)])) - 1 if len(h) else start
        more = doc[last] != doc[start]
        h, doc, text, first, n, heat = (x[start] for x in (h, doc, text, first, n, heat))
        split = np.maximum(heat.astype(np.int64) - hot, 0).astype(np.uint8)
        who, salt = [np.flatnonzero(split == 0)], [np.zeros(int((split == 0).sum()), np.uint32)]
        for t in np.unique(text[split > 0]).tolist():      # very frequent hashes go where their windows belong
            i = np.flatnonzero((split > 0) & (text == t))
            own = np.repeat(i, n[i])
            at = np.repeat(first[i], n[i]) + np.arange(len(own)) - np.repeat(np.cumsum(n[i]) - n[i], n[i])
            prefix = Prefixes(texts[t])
            s = tu.mix64(prefix.of(at, at + WINDOW)) & ((_U(1) << split[own].astype(np.uint64)) - _U(1))
            both = np.unique(own * (1 << 32) + s.astype(np.int64))
            who.append(both >> 32)
            salt.append((both & 0xFFFFFFFF).astype(np.uint32))
        who, salt = np.concatenate(who), np.concatenate(salt)
        r = _range(tu.mix64(h[who] + salt.astype(np.uint64) * _STEP) >> _U(16), ranges)
        o = np.lexsort((first[who], text[who], r))
        who, salt, r = who[o], salt[o], r[o]
        cut = [0, *(np.flatnonzero(np.diff(r)) + 1).tolist(), len(r)] if len(r) else [0]
        out = []
        for lo, hi in zip(cut, cut[1:]):
            w = who[lo:hi]
            size = n[w] + WINDOW - 1
            raw = []
            for t in np.unique(text[w]).tolist():
                i = w[text[w] == t]
                raw.append(_gather(texts[t], first[i], n[i] + WINDOW - 1))
            raw = np.concatenate(raw)
            out.append((int(r[lo]), block, hi - lo, _zip(h[w]), _zip(doc[w]), _zip(size.astype(np.uint8)), _zip(salt[lo:hi]),
                        _zip(split[w]), _zip(more[w].astype(np.uint8)), len(raw), _zip(raw)))
        cols, s = _rows(_SENT, out)
        return pa.Table.from_arrays(cols, schema=s)
    return run


class Collision(ValueError):
    """Two strings with one hash."""


class Suffixes:
    """The suffixes that start at the given positions of a text, compared over one window."""

    def __init__(self, data: np.ndarray):
        prefix, n = Prefixes(data), len(data)

        def spans(size):                                    # hash of the ``size`` bytes from every position on
            return (prefix.sums[size:] - prefix.sums[:max(0, n + 1 - size)]) * prefix.back[:max(0, n + 1 - size)]
        self.window, self.spans = spans(WINDOW), [(size, spans(size)) for size in _PROBES]
        self.words = _words(data).byteswap()                # eight bytes from every position on, ordered as bytes are

    def compare(self, a, b):
        """-1, 0 or 1 per pair: a binary search over prefix hashes finds, to eight bytes, how far the two agree;
        the next eight bytes decide."""
        out = np.zeros(len(a), np.int8)
        todo = np.flatnonzero(self.window[a] != self.window[b])
        a, b = a[todo], b[todo]
        for size, hashes in self.spans:
            step = (hashes[a] == hashes[b]) * size
            a, b = a + step, b + step
        same = self.words[a] == self.words[b]
        a, b = a + same * 8, b + same * 8
        x, y = self.words[np.minimum(a, len(self.words) - 1)], self.words[np.minimum(b, len(self.words) - 1)]
        out[todo] = (x > y).astype(np.int8) - (x < y).astype(np.int8)
        return out

    def sort(self, pos: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Positions ordered within their (contiguous) groups by a bottom-up mergesort."""
        if not len(pos):
            return pos
        pos = pos.copy()
        start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        size = np.diff(np.concatenate((start, [len(pos)])))
        base, count = np.repeat(start, size), np.repeat(size, size)
        width = 1
        while width < size.max():
            at = np.flatnonzero(count > width)              # groups of several runs
            inner = at - base[at]
            run = inner // width
            left = run % 2 == 0
            lo = base[at] + (run ^ 1) * width
            hi = np.minimum(lo + width, base[at] + count[at])
            lo = np.minimum(lo, hi)
            zero, mine = lo.copy(), pos[at]
            for _ in range(int(width).bit_length()):        # how many of the other run go before
                todo = np.flatnonzero(lo < hi)
                mid = (lo[todo] + hi[todo]) // 2
                sign = self.compare(mine[todo], pos[mid])
                up = np.where(left[todo], sign > 0, sign >= 0)
                lo[todo[up]], hi[todo[~up]] = mid[up] + 1, mid[~up]
            out = base[at] + (run & ~1) * width + inner % width + (lo - zero)
            pos[out] = mine
            width *= 2
        return pos

    def same_as_before(self, pos: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Whether each sorted suffix holds the window of the one before; equality and order are
        verified on the bytes."""
        same = np.zeros(len(pos), bool)
        for lo in range(1, len(pos), 1 << 15):
            at = pos[lo - 1:lo + (1 << 15)]
            open_, less = np.ones(len(at) - 1, bool), np.zeros(len(at) - 1, bool)
            for j in (*range(0, WINDOW - 7, 8), WINDOW - 8):
                w = self.words[at + j]
                less |= open_ & (w[:-1] < w[1:])
                open_ &= w[:-1] == w[1:]
            inside = group[lo - 1:lo - 1 + len(open_)] == group[lo:lo + len(open_)]
            if (inside & ~open_ & ~less).any():
                raise Collision
            same[lo:lo + len(open_)] = inside & open_
        return same


def repeated_windows(data, first, n, h, doc, group, use) -> np.ndarray:
    """Per segment the mask of windows that occur in a segment of its group with a smaller document.

    Segment i has windows first[i] to first[i] + n[i]; ``use`` says which windows take part.
    Windows of a group meet where their smallest hash stands in the same place.
    """
    own = np.repeat(np.arange(len(first)), n)
    inner = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
    at = first[own] + inner
    if use is not None:
        own, inner, at = own[use], inner[use], at[use]
    runs = _run_hashes(data)
    of_text = np.zeros(len(data), np.uint64)
    size = n + WINDOW - 1
    of_text[np.repeat(first, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = np.repeat(h, size)
    hit = np.where(runs == of_text[:len(runs)], np.arange(len(runs)), len(data) * 2)
    place = np.minimum.accumulate(hit[::-1])[::-1][at] - at
    # first found from the left inside the window, so equal windows have equal places
    bucket = group[own] * WINDOW + np.minimum(place, WINDOW - 1)
    o = np.argsort(bucket, kind="stable")
    own, inner, at, bucket = own[o], inner[o], at[o], bucket[o]
    suffixes = Suffixes(data)
    who = np.empty(len(data), np.int64)
    who[at] = np.arange(len(at))
    pos = suffixes.sort(at, bucket)
    try:
        same = suffixes.same_as_before(pos, bucket)
    except Collision:
        raw = data.tobytes()
        keyed = sorted((b, raw[p:p + WINDOW], p) for b, p in zip(bucket.tolist(), at.tolist()))
        pos = np.array([p for _, _, p in keyed], np.int64)
        same = np.array([False] + [x[:2] == y[:2] for x, y in zip(keyed, keyed[1:])])
    mask = np.zeros(len(first), np.uint64)
    if len(pos):
        own, inner = own[who[pos]], inner[who[pos]]
        start = np.flatnonzero(~same)
        least = np.repeat(np.minimum.reduceat(doc[own], start), np.diff(np.concatenate((start, [len(pos)]))))
        late = least < doc[own]
        np.bitwise_or.at(mask, own[late], _U(1) << inner[late].astype(np.uint64))
    return mask


def _chunked(size: np.ndarray, group: np.ndarray):
    """Cuts of about half a piece between groups.  One group alone may be longer, by no more than
    the places of one hash that stay together (HOT)."""
    heads = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    heads = np.concatenate((heads, [len(group)]))
    total = np.concatenate(([0], np.cumsum(size)))
    lo = 0
    while lo < len(heads) - 1:
        hi = int(np.searchsorted(total[heads], total[heads[lo]] + PIECE // 2, "right")) - 1
        hi = max(hi, lo + 1)
        yield int(heads[lo]), int(heads[hi])
        lo = hi


def _decide(batches):
    """Per segment sent: its smallest document and the windows held by a smaller one."""
    for rows in _by_range(batches):
        col = lambda c, kind: np.concatenate([_unzip(r[c], r["n"], kind) for r in rows])
        h, doc, size = col("h", np.uint64), col("doc", np.int64), col("size", np.uint8).astype(np.int64)
        salt, split, more = col("salt", np.uint32), col("split", np.uint8), col("more", np.uint8)
        text = np.concatenate([_unzip(r["text"], r["n_text"], np.uint8) for r in rows])
        owner = np.repeat(np.arange(len(rows)), [r["n"] for r in rows])
        at = np.cumsum(size) - size
        g = np.empty(len(h), np.uint64)
        for lo in range(0, len(h), 4096):
            s = slice(lo, lo + 4096)
            part = text[at[lo]:at[s][-1] + size[s][-1]]
            g[s] = _segment_hash(Prefixes(part), at[s] - at[lo], size[s])
        o = np.lexsort((doc, g, salt, h))
        new = np.concatenate(([True], (h[o][1:] != h[o][:-1]) | (g[o][1:] != g[o][:-1]) | (salt[o][1:] != salt[o][:-1])))
        for lo in range(0, len(o) - 1, 1 << 14):           # equal keys must be equal bytes
            a, b = o[lo:lo + (1 << 14)], o[lo + 1:lo + (1 << 14) + 1]
            a = a[:len(b)]
            i = np.flatnonzero(~new[lo + 1:lo + 1 + len(b)])
            if len(i):
                same = size[a[i]] == size[b[i]]
                same &= (_gather(text, at[a[i]], size[a[i]]).tobytes() == _gather(text, at[b[i]], size[b[i]]).tobytes())
                if not same.all():
                    raise ValueError("two segments with one 112-bit key")
        entry = np.cumsum(new) - 1
        e = o[new]                                          # the smallest document of each distinct segment
        key = np.concatenate(([True], (h[e][1:] != h[e][:-1]) | (salt[e][1:] != salt[e][:-1])))
        group = np.cumsum(key) - 1
        several = np.flatnonzero(np.bincount(group)[group] > 1)
        mask = np.zeros(len(e), np.uint64)
        for lo, hi in _chunked(size[e[several]], group[several]) if len(several) else ():
            i = several[lo:hi]
            w = e[i]
            first = np.cumsum(size[w]) - size[w]
            data, n = _gather(text, at[w], size[w]), size[w] - WINDOW + 1
            mask[i] = repeated_windows(data, first, n, h[w], doc[w], group[i], _in_salt(data, first, n, salt[w], split[w]))
        least, found = np.empty(len(h), np.int64), np.empty(len(h), np.uint64)
        least[o], found[o] = doc[e][entry], mask[entry]
        tell = (least < doc) | (found != 0) | (more != 0)
        out = []
        for i, row in enumerate(rows):
            lo, hi = np.searchsorted(owner, [i, i + 1])
            t = lo + np.flatnonzero(tell[lo:hi])
            if len(t):
                out.append((row["block"], len(t), _zip(h[t]), _zip(g[t]), _zip(least[t]), _zip(found[t])))
        if out:
            cols, s = _rows(_BACK, out)
            yield pa.RecordBatch.from_arrays(cols, schema=s)


def _in_salt(data, first, n, salt, split):
    """Which windows of split hashes belong here; None where nothing is split."""
    if not split.any():
        return None
    own = np.repeat(np.arange(len(first)), n)
    at = first[own] + np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
    prefix = Prefixes(data)
    s = tu.mix64(prefix.of(at, at + WINDOW)) & ((_U(1) << split[own].astype(np.uint64)) - _U(1))
    return s == salt[own]


def _cut(docs, back):
    """The block's documents without the repeated bytes."""
    back = back.to_pylist()
    col = lambda c, kind: np.concatenate([_unzip(r[c], r["n"], kind) for r in back]) if back else np.zeros(0, kind)
    h, g, least, mask = col("h", np.uint64), col("g", np.uint64), col("doc", np.int64), col("mask", np.uint64)
    o = np.lexsort((h, g))
    h, g, least, mask = h[o], g[o], least[o], mask[o]
    if len(h):                                              # a split hash answers once per part
        start = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (g[1:] != g[:-1]))))
        h, g, least, mask = h[start], g[start], np.minimum.reduceat(least, start), np.bitwise_or.reduceat(mask, start)
    hits = []
    for data, row, doc, place, first, n, seg in _found(docs) if len(h) else ():
        k = _segment_hash(Prefixes(data), first, n + WINDOW - 1)
        at = np.searchsorted(g, k)
        ok = at < len(g)
        ok[ok] = (g[at[ok]] == k[ok]) & (h[at[ok]] == seg[ok])
        row, doc, place, n, at = row[ok], doc[ok], place[ok], n[ok], at[ok]
        whole = doc > least[at]
        part = ~whole & (mask[at] != 0)
        own = np.repeat(np.flatnonzero(part), n[part])
        inner = np.arange(len(own)) - np.repeat(np.cumsum(n[part]) - n[part], n[part])
        on = (mask[at[own]] >> inner.astype(np.uint64)) & _U(1) == 1
        hits.append((np.concatenate((row[whole], row[own[on]])), np.concatenate((place[whole], place[own[on]] + inner[on])),
                     np.concatenate((n[whole], np.ones(int(on.sum()), np.int64)))))
    row, place, n = (np.concatenate(x) for x in zip(*hits)) if hits else [np.zeros(0, np.int64)] * 3
    o = np.lexsort((place, row))
    row, lo = row[o], place[o]
    hi = lo + n[o] + WINDOW - 1
    out, seen = [], 0
    for batch in docs.select(["doc_id", "text"]).to_batches():
        for c in tu.chunks(batch, "text", PIECE):
            data, offs = tu.text_bytes(c.column("text"))
            a, b = np.searchsorted(row, [seen, seen + c.num_rows])
            cover = np.zeros(len(data) + 1, np.int32)
            base = offs[row[a:b] - seen]
            np.add.at(cover, base + lo[a:b], 1)
            np.add.at(cover, base + hi[a:b], -1)
            gone = np.cumsum(cover)[:len(data)] > 0
            edge = np.zeros(len(data) + 1, bool)
            edge[offs] = True
            before = np.concatenate(([False], gone[:-1]))[:len(data)]
            start = np.flatnonzero(gone & (~before | edge[:-1]))
            after = np.concatenate((gone[1:], [False]))[:len(data)]
            stop = np.flatnonzero(gone & (~after | edge[1:])) + 1
            at = np.searchsorted(start, offs)
            spans = np.stack((start, stop), 1) - np.repeat(offs[:-1], np.diff(at))[:, None]
            inner = pa.ListArray.from_arrays(pa.array(np.arange(len(start) + 1) * 2, pa.int32()), pa.array(spans.ravel(), pa.int64()))
            kept = np.concatenate(([0], np.cumsum(~gone)))[offs]
            out.append(pa.RecordBatch.from_arrays(
                [c.column("doc_id"), pa.array(np.diff(offs)), pa.ListArray.from_arrays(pa.array(at, pa.int32()), inner),
                 pa.Array.from_buffers(pa.binary(), c.num_rows, [None, pa.py_buffer(kept.astype(np.int32)), pa.py_buffer(data[~gone].tobytes())])],
                schema=_schema(_CUT)))
            seen += c.num_rows
    return pa.Table.from_batches(out, schema=_schema(_CUT))


def _freed(run):
    """``run``, a function of two groups, that gives freed memory back after each."""
    def group(left, right):
        try:
            return run(left, right)
        finally:
            tu.release()
    return group


def remove_repeats(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES, hot: int = HOT) -> DataFrame:
    """Per row: the id, n_bytes (UTF-8), spans ([start, end) of the removed bytes, maximal), kept (binary)."""
    spark = docs.sparkSession
    work = Work(spark, "suffix")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    count, total = base.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    ranges = max(1, min(1 << 20, -(-total // block_bytes)))
    each = max(1, int(block_bytes * count / max(total, 1)))
    # a block is a run of rows of one input partition: written as bucketed files without a shuffle
    mid = F.monotonically_increasing_id()
    block = F.shiftright(mid, 33) * F.lit(1 << 24) + F.floor(mid.bitwiseAND(F.lit((1 << 33) - 1)) / F.lit(each))
    name = f"sluice_suffix_{uuid.uuid4().hex}"
    (base.withColumn("block", block.cast("long")).write.bucketBy(ranges, "block").option("path", f"{work.root}/texts")
     .format("parquet").saveAsTable(name))
    texts = spark.table(name)
    lists = texts.select("block", "doc_id", "text").mapInArrow(tu.released(_listed(ranges)), _LISTS)
    shared = work.keep(lists.repartition("range").sortWithinPartitions("range").mapInArrow(tu.released(_shared), _LISTS),
                       "shared", batch=BATCH)
    sent = texts.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_freed(_send(ranges, hot)), _SENT)
    back = work.keep(sent.repartition("range").sortWithinPartitions("range").mapInArrow(tu.released(_decide), _BACK),
                     "back", batch=BATCH)
    return (texts.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_freed(_cut), _CUT)
            .withColumnRenamed("doc_id", id_col))
