"""Vectorised text helpers for Arrow batches: words, word hashes, shingles.

Everything works on the UTF-8 bytes of a bounded chunk of rows, so a worker's
memory follows ``CHUNK_BYTES`` (plus the longest single text), not the batch.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20

_RNG = np.random.default_rng(20240229)
_BYTE_MIX = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E6C63D0876A9A4B | 1)
_LEN_MIX = np.uint64(0xD6E8FEB86659FD93)


def byte_table(is_word) -> np.ndarray:
    """256 entries: 0 for a separator byte, else the byte with A-Z lower-cased."""
    t = np.zeros(256, np.uint8)
    for b in range(256):
        low = b + 32 if 65 <= b <= 90 else b
        if is_word(low):
            t[b] = low
    return t


# [^\x20\x09-\x0D]+ ; NUL counts as a word byte and is mapped to 0x7F's slot 255,
# a byte that UTF-8 text cannot hold.
SPACE_WORDS = byte_table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
SPACE_WORDS[0] = 255
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM_WORDS = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on uint64 arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as the empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    _, offs, data = col.buffers()
    o = np.frombuffer(offs, np.int64)[col.offset:col.offset + len(col) + 1]
    if data is None or not len(col):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[o[0]:o[-1]], o - o[0]


def chunks(batch, column: str, limit: int = CHUNK_BYTES):
    """Slices of a record batch that hold about ``limit`` bytes of ``column``."""
    _, offs = text_bytes(batch.column(column))
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), batch.num_rows)
        yield batch.slice(lo, hi - lo)
        lo = hi


def release() -> None:
    """Gives freed memory of this worker process back to the machine at the end of a task:
    Spark keeps the process for later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def released(run):
    """``run``, a function of batches, whose task gives its freed memory back at the end."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            release()
    return task


def word_spans(data: np.ndarray, offs: np.ndarray, table: np.ndarray):
    """Start and end byte of every word, and the words before each row (rows + 1)."""
    low = table[data]
    on = low != 0
    first = np.zeros(len(data) + 1, bool)
    first[offs] = True
    prev = np.empty_like(on)
    if len(on):
        prev[0] = False
        prev[1:] = on[:-1]
    starts = np.flatnonzero(on & (~prev | first[:-1]))
    nxt = np.empty_like(on)
    if len(on):
        nxt[-1] = False
        nxt[:-1] = on[1:]
    ends = np.flatnonzero(on & (~nxt | first[1:])) + 1
    return low, starts, ends, np.searchsorted(starts, offs)


def word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word (polynomial over mixed bytes, then mixed)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers = np.full(int((ends - starts).max()), _BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    out = np.empty(len(starts), np.uint64)
    for k in range(0, len(starts), 1 << 16):  # bounds the positions held at once
        first, lens = starts[k:k + (1 << 16)], (ends - starts)[k:k + (1 << 16)]
        cum = np.concatenate(([0], np.cumsum(lens)))
        inner = np.arange(cum[-1]) - np.repeat(cum[:-1], lens)
        h = np.add.reduceat(_BYTE_MIX[low[inner + np.repeat(first, lens)]] * powers[inner], cum[:-1])
        out[k:k + (1 << 16)] = mix64(h + lens.astype(np.uint64) * _LEN_MIX)
    return out


def hashed_words(col: pa.Array, table: np.ndarray):
    """(hash of every word, offsets of the rows' words)."""
    data, offs = text_bytes(col)
    low, s, e, rows = word_spans(data, offs, table)
    return word_hashes(low, s, e), rows


def shingle_sets(col: pa.Array, width: int, table: np.ndarray = SPACE_WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes per row; fewer words than ``width`` make
    one shingle of the whole sequence, no words an empty set."""
    h, rows = hashed_words(col, table)
    odd = [mix64(np.uint64(0xA24BAED4963EE407 + 2 * k) * np.ones(1, np.uint64))[0] | np.uint64(1)
           for k in range(width)]
    n = max(0, len(h) - width + 1)
    s = np.full(n, width, np.uint64)
    for k in range(width):
        s += h[k:k + n] * odd[k]
    s = mix64(s)
    out = []
    for lo, hi in zip(rows[:-1].tolist(), rows[1:].tolist()):
        if hi - lo >= width:
            out.append(np.unique(s[lo:hi - width + 1]))
        elif hi > lo:
            x = np.uint64(hi - lo) + sum((h[lo + k:lo + k + 1] * odd[k] for k in range(hi - lo)),
                                         np.zeros(1, np.uint64))
            out.append(mix64(x))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def with_column(batch, extra: dict[str, pa.Array]):
    """The batch plus (or with replaced) columns, as a record batch."""
    names = [n for n in batch.schema.names if n not in extra]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + list(extra.values()),
                                      names + list(extra))
