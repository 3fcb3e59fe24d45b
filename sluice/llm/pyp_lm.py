"""Language-model scores from a hierarchical Pitman-Yor model.

Word restaurants, one per previous word (and one for the start of a text), share one
parent restaurant of words.  Its tables order their dishes from a spelling model: letter restaurants in the
context of the last two bytes share the restaurants of the last byte, these share
one without context, and that one draws from the uniform distribution over the 256
bytes and the end of a word.  Half of the parent's base is uniform over the known words and
one unknown, the convention of the base score; the other half is the spelling.

A table count is sampled by seating a dish's customers one after the other, given
all other seatings (a Gibbs sweep over the dishes); from the 65th customer of a dish
on they come in groups of a twentieth, whose new tables are one binomial draw.
Customers of a parent are its children's tables.  Discounts follow from the dishes
with one and two customers.  After ``BURN`` sweeps, the predictive probabilities of
``SAMPLES`` sweeps are averaged.

Work is split twice.  A chunk is a bounded piece of the documents; it keeps its
documents as numbers of its own distinct words.  A shard holds the words of one hash
range, and with each word the contexts it followed with their counts from all chunks.
Before a sweep each shard sends its tables of each context to the shard where the
context's own word lives, which adds them up and sends the sums back.  Shards lie in
tables bucketed by their number, so the messages travel and the shards do not.  A chunk
numbers its words shard by shard, so that questions are its pairs' hashes, and answers
are, in the same order, what a pair's customers give it, its word's probability in the
parent and its context's customers and weight of a new table.  Questions are asked a
band of chunks at a time, whose messages are deleted before the next.  The driver sees
totals and the letter restaurants (at most 257^3 dishes).

Null and empty texts are one end token.  A null id counts as the id "" (held out,
as its crc32 is 0).  Equal rows are scored each; columns other than id and text are
not read.  64-bit hashes stand for words.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import textutil as tu
from .work import Work

BURN, SAMPLES = 1, 2
STRENGTH = 1.0
CHUNK_BYTES = 4 << 20
BANDS = 4  # chunks ask their questions in so many turns
TURNS = 2  # chunks send their words to the shards in so many turns
END_HASH = np.uint64(0x2545F4914F6CDD1D)
START_HASH = np.uint64(0x9E3779B97F4A7C15)  # the context that starts a text
LAST = 256  # the symbol that ends a word


def _pack(**arrays) -> bytes:
    """Arrays in one binary value: hashes as they are, of others bytes of equal weight side by side
    and compressed."""
    out = []
    for name, a in arrays.items():
        if a.dtype == np.int64 and a.size and -(1 << 31) <= a.min() and a.max() < 1 << 31:
            a, kind = a.astype(np.int32), a.dtype  # four bytes hold them
        else:
            kind = a.dtype
        a = np.ascontiguousarray(a)
        if a.dtype == np.uint64 or not a.size:
            raw = body = a.tobytes()
        else:
            raw = a.view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes()
            body = pa.compress(raw, codec="zstd", asbytes=True)
        head = f"{name}:{kind.str}:{a.dtype.str}:{','.join(map(str, a.shape))}:{len(body)}:{len(raw)};".encode()
        out += [len(head).to_bytes(2, "little"), head, body]
    return b"".join(out)


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    out, at, view = {}, 0, memoryview(blob)
    while at < len(blob):
        n = int.from_bytes(blob[at:at + 2], "little")
        name, kind, held, shape, packed, size = blob[at + 2:at + 2 + n].decode()[:-1].split(":")
        at += 2 + n
        held, packed, size = np.dtype(held), int(packed), int(size)
        if held == np.uint64 or not size:
            flat = np.frombuffer(blob, held, size // held.itemsize, at).copy()
        else:
            raw = pa.decompress(pa.py_buffer(view[at:at + packed]), size, codec="zstd")
            flat = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(held.itemsize, -1).T).view(held)
        out[name] = flat.reshape([int(x) for x in shape.split(",") if x]).astype(np.dtype(kind), copy=False)
        at += packed
    return out


def _ranked(x: np.ndarray, most: int):
    """np.unique with the inverse, of integers from 0 to ``most``: one sort of values with their places
    in the low bits where both fit."""
    bits = len(x).bit_length()
    if int(most).bit_length() + bits > 63 or not len(x):
        return np.unique(x, return_inverse=True)
    both = np.sort(x.astype(np.int64) << bits | np.arange(len(x)))
    at, x = both & ((1 << bits) - 1), both >> bits
    new = np.concatenate(([True], x[1:] != x[:-1]))
    inv = np.empty(len(x), np.int64)
    inv[at] = np.cumsum(new) - 1
    return x[new], inv


def _shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return (h >> np.uint64(33)).astype(np.int64) % shards


def _context(local: np.ndarray, size: np.ndarray, start: int) -> np.ndarray:
    """The word before each token; ``start`` before the first of a document."""
    ctx = np.empty_like(local)
    ctx[1:] = local[:-1]
    ctx[np.cumsum(size) - size] = start
    return ctx


_CHUNK = pa.schema([("role", pa.int32()), ("place", pa.int64()), ("chunk", pa.int64()), ("blob", pa.binary())])
_CHUNK_DDL = "role int, place long, chunk long, blob binary"


def _chunk_row(*row):
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _CHUNK.types)], schema=_CHUNK)


def _read(shards: int):
    """Documents to chunks: a row with the chunk's documents and words (place = chunk)."""
    from pyspark import TaskContext

    def one(batch, chunk):
        data, offs = tu.text_bytes(batch.column("text"))
        low, s, e, rows = tu.word_spans(data, offs, tu.SPACE_WORDS)
        h = tu.word_hashes(low, s, e)
        ids = [None if i is None else str(i) for i in batch.column("id").to_pylist()]
        held = np.array([zlib.crc32((i or "").encode()) % 10 == 0 for i in ids], bool)
        n = np.diff(rows)
        ends = rows[1:] + np.arange(len(n))  # places of the end tokens
        full = np.empty(len(h) + len(n), np.uint64)
        is_end = np.zeros(len(full), bool)
        is_end[ends] = True
        full[is_end], full[~is_end] = END_HASH, h
        uniq, first, local = np.unique(np.append(full, START_HASH), return_index=True, return_inverse=True)
        size = n + 1
        # words are numbered shard by shard: answers need no numbers
        shard = _shard_of(uniq, shards)
        order = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[order], np.arange(shards + 1))
        number = np.empty(len(uniq), np.int64)
        number[order] = np.arange(len(uniq))
        uniq, first, local = uniq[order], first[order], number[local]
        local, start = local[:-1], int(local[-1])
        # spelling: position of the first occurrence among the words
        word = np.cumsum(~is_end) - 1
        ws, we = np.zeros(len(uniq), np.int64), np.zeros(len(uniq), np.int64)
        real = ~np.append(is_end, True)[first]
        ws[real], we[real] = s[word[first[real]]], e[word[first[real]]]
        lens = we - ws
        at = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens) + np.repeat(ws, lens)
        return 1, chunk, chunk, _pack(local=local.astype(np.int32), size=size.astype(np.int32), start=np.array([start]),
                                      held=held, id=np.array([0 if i is None else int(i) for i in ids], np.int64),
                                      none=np.array([i is None for i in ids], bool), cut=cut.astype(np.int32),
                                      hash=uniq, len=lens.astype(np.int32), spell=low[at])

    def run(batches):
        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            for c in tu.chunks(batch, "text", CHUNK_BYTES):
                yield _chunk_row(*one(c, (part << 32) + k))
                k += 1
    return run


def _pairs(d: dict):
    """Pairs (word * words + context) of a chunk in order, the pair of each token, and
    the first pair of each shard."""
    words, local = int(d["cut"][-1]), d["local"].astype(np.int64)
    pairs, inv = _ranked(local * words + _context(local, d["size"].astype(np.int64), int(d["start"][0])), words * words)
    return pairs, inv, np.searchsorted(pairs, d["cut"].astype(np.int64) * words)


def _split(counted: bool, turn: int = 0, turns: int = 1):
    """A chunk's words and pairs for each shard of this turn: with spelling and training
    counts (role 0), or as questions, hashes alone (role 1)."""
    def rows(chunk, d):
        pairs, inv, pcut = _pairs(d)
        cut, words = d["cut"], int(d["cut"][-1])
        pw, px = pairs // words, pairs % words
        if counted:
            train = np.repeat(~d["held"], d["size"])
            counts = np.bincount(inv, train, len(pairs)).astype(np.int32)
            follow = np.bincount(px[inv[train]], minlength=words).astype(np.int32)
            at = np.concatenate(([0], np.cumsum(d["len"])))
        for k in np.flatnonzero(np.diff(cut)).tolist():
            if k % turns != turn:
                continue
            own, mine = slice(cut[k], cut[k + 1]), slice(pcut[k], pcut[k + 1])
            near, x = _ranked(px[mine], words)
            out = {"hash": d["hash"][own], "ctx": d["hash"][near], "px": x.astype(np.int32),
                   "pw": np.bincount(pw[mine] - cut[k], minlength=cut[k + 1] - cut[k]).astype(np.int32)}
            if counted:
                out |= {"follow": follow[own], "c": counts[mine], "len": d["len"][own],
                        "spell": d["spell"][at[cut[k]]:at[cut[k + 1]]]}
            yield _chunk_row(0 if counted else 1, k, chunk, _pack(**out))

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                yield from rows(b.column("chunk")[i].as_py(), _unpack(b.column("blob")[i].as_py()))
    return run


def _documents(batches):
    """Chunks without their words' hashes and spelling."""
    for b in batches:
        for i in range(b.num_rows):
            d = _unpack(b.column("blob")[i].as_py())
            yield _chunk_row(*(b.column(c)[i].as_py() for c in _CHUNK.names[:3]),
                             _pack(**{k: v for k, v in d.items() if k not in ("hash", "len", "spell")}))


def _take_spans(data: np.ndarray, lens: np.ndarray, pick: np.ndarray) -> np.ndarray:
    start = np.cumsum(lens) - lens
    n = lens[pick]
    return data[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[pick], n)]


def _word_of(pw: np.ndarray) -> np.ndarray:
    """Word of each pair from the numbers of pairs of the words."""
    return np.repeat(np.arange(len(pw)), pw)


def _merge_words(parts: list[dict]) -> dict:
    h = np.concatenate([p["hash"] for p in parts])
    uniq, first, inv = np.unique(h, return_index=True, return_inverse=True)
    follow = np.bincount(inv, np.concatenate([p["follow"] for p in parts]), len(uniq)).astype(np.int64)
    lens = np.concatenate([p["len"] for p in parts])
    spell = _take_spans(np.concatenate([p["spell"] for p in parts]), lens, first)
    ctx, near = np.unique(np.concatenate([p["ctx"] for p in parts]), return_inverse=True)
    w0, x0, keys, counts = 0, 0, [], []
    for p in parts:
        on = p["c"] > 0  # pairs of held-out documents alone have no customers
        keys.append(inv[w0 + _word_of(p["pw"])[on]] * max(1, len(ctx)) + near[x0 + p["px"][on]])
        counts.append(p["c"][on])
        w0, x0 = w0 + len(p["hash"]), x0 + len(p["ctx"])
    keys, inv = _ranked(np.concatenate(keys), len(uniq) * max(1, len(ctx)))
    c = np.bincount(inv, np.concatenate(counts), len(keys)).astype(np.int64)
    w, x = keys // max(1, len(ctx)), keys % max(1, len(ctx))
    used, x = _ranked(x, len(ctx))
    return {"hash": uniq, "follow": follow, "len": lens[first], "spell": spell, "ctx": ctx[used],
            "pw": np.bincount(w, minlength=len(uniq)).astype(np.int32), "px": x.astype(np.int32), "c": c}


def _first_state(shards):
    """Words of each shard (rows come in shard order) with their pairs from all chunks;
    one table per dish.  Contexts are put in the order of their words' shards."""
    def done(now, parts):
        s = _merge_words(parts)
        home = _shard_of(s["ctx"], shards)
        order = np.argsort(home, kind="stable")
        number = np.empty(len(order), np.int32)
        number[order] = np.arange(len(order))
        s |= {"ctx": s["ctx"][order], "px": number[s["px"]],
              "cut": np.searchsorted(home[order], np.arange(shards + 1)),
              "t": np.ones(len(s["c"]), np.int32), "up": (s["pw"] > 0).astype(np.int32),
              "give": np.zeros(len(s["c"]), np.float32), "parent": np.zeros((0, len(s["hash"])), np.float32),
              "weight": np.zeros((0, len(s["hash"])), np.float32)}
        return _state_row(now, _pack(**s), _totals(s))

    def run(batches):
        now, parts, rows = None, [], 0
        for b in batches:
            for i in range(b.num_rows):
                place = b.column("place")[i].as_py()
                if place != now:
                    if parts:
                        yield done(now, parts)
                    now, parts, rows = place, [], 0
                parts.append(_unpack(b.column("blob")[i].as_py()))
                rows += len(parts[-1]["px"])
                if rows > 1_000_000 and len(parts) > 8:
                    parts = [_merge_words(parts)]
                    rows = 0
        if parts:
            yield done(now, parts)
    return run


_STATE = pa.schema([("place", pa.int64()), ("blob", pa.binary()), ("totals", pa.list_(pa.int64())),
                    ("letters", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])
_STATE_DDL = "place long, blob binary, totals array<long>, letters array<long>, times array<long>"


def _state_row(place, blob, totals, letters=(), times=()):
    return pa.RecordBatch.from_arrays(
        [pa.array([place], pa.int64()), pa.array([blob], pa.binary()), pa.array([totals], pa.list_(pa.int64())),
         pa.array([letters], pa.list_(pa.int64())), pa.array([times], pa.list_(pa.int64()))], schema=_STATE)


def _totals(s):
    """Customers of all contexts, of the parent and its tables, words, and dishes with
    one or two customers."""
    c, up, p = s["c"], s["up"], _from_children(s)
    return [int(c.sum()), int(p.sum()), int(up.sum()), int((p > 0).sum()),
            int((c == 1).sum()), int((c == 2).sum()), int((p == 1).sum()), int((p == 2).sum())]


def _from_children(s) -> np.ndarray:
    """Customers of the parent's dishes: the tables of all contexts."""
    return np.bincount(_word_of(s["pw"]), s["t"], len(s["pw"])).astype(np.int64)


def seat(rng, c: np.ndarray, tables, prior: np.ndarray, discount: float) -> np.ndarray:
    """Tables of dishes with ``c`` customers each, seated in turn.  ``tables`` is the
    restaurant's weight of a new table (strength + discount * its tables), ``prior``
    the parent's probability of the dish."""
    t = (c > 0).astype(np.int64)
    weight = np.broadcast_to(tables, c.shape) * prior
    act, at = np.flatnonzero(c > 1), 1
    while len(act):
        step = 1 if at < 64 else max(1, at // 20)
        n = np.minimum(step, c[act] - at)
        w = weight[act]
        new = w / (w + at - discount * t[act])
        t[act] += (rng.random(len(act)) < new) if step == 1 else rng.binomial(n, np.clip(new, 0, 1))
        at += step
        act = act[c[act] > at]
    return t


class Letters:
    """Letter restaurants: sorted dish keys per depth, with customers and tables."""

    def __init__(self, depths=None):
        self.depths = depths or []

    @staticmethod
    def keys(lens: np.ndarray, spell: np.ndarray) -> list[np.ndarray]:
        """Per depth (0 to 2 bytes of context) the dish of each letter of each word,
        the end of the word included; context 257 stands before the first byte."""
        n = lens.astype(np.int64) + 1
        sym = np.full(int(n.sum()), LAST, np.int64)
        ends = np.cumsum(n) - 1
        inner = np.ones(len(sym), bool)
        inner[ends] = False
        sym[inner] = spell
        first = ends - n + 1
        one = np.full(len(sym), 257, np.int64)
        one[1:] = sym[:-1]
        one[first] = 257
        two = np.full(len(sym), 257, np.int64)
        two[2:] = sym[:-2]
        two[first] = 257
        second = first[n > 1] + 1
        two[second] = 257
        return [sym, one * 512 + sym, (two * 512 + one) * 512 + sym]

    @classmethod
    def sample(cls, rng, keys: np.ndarray, times: np.ndarray, old: "Letters") -> "Letters":
        """Seats the letters of all ordered words (depth 2), then the parents."""
        depths = []
        for depth in (2, 1, 0):
            keys, inv = np.unique(keys, return_inverse=True)
            c = np.zeros(len(keys), np.int64)
            np.add.at(c, inv, times)
            one, two = int((c == 1).sum()), int((c == 2).sum())
            d = min(0.95, max(0.1, one / max(1, one + 2 * two)))
            ctx, cinv = np.unique(keys >> 9, return_inverse=True)
            prior = (old.prob(depth - 1, keys & ((1 << 9 * depth) - 1) if depth else keys)
                     if old.depths and depth else np.full(len(keys), 1 / 257))
            tables = np.bincount(cinv, minlength=len(ctx))
            t = seat(rng, c, (STRENGTH + d * tables)[cinv], prior, d)
            depths.append({"keys": keys, "c": c, "t": t, "d": d, "ctx": ctx,
                           "C": np.bincount(cinv, c, len(ctx)), "T": np.bincount(cinv, t, len(ctx))})
            keys, times = (keys & ((1 << 9 * depth) - 1), t) if depth else (keys, t)
        return cls(depths[::-1])

    def prob(self, depth: int, keys: np.ndarray) -> np.ndarray:
        if depth < 0:
            return np.full(len(keys), 1 / 257)
        p = self.prob(depth - 1, keys & ((1 << 9 * depth) - 1) if depth else keys)
        m = self.depths[depth]
        k = np.minimum(np.searchsorted(m["keys"], keys), len(m["keys"]) - 1)
        hit = m["keys"][k] == keys
        c, t = np.where(hit, m["c"][k], 0), np.where(hit, m["t"][k], 0)
        x = np.minimum(np.searchsorted(m["ctx"], keys >> 9), len(m["ctx"]) - 1)
        seen = m["ctx"][x] == keys >> 9
        big, tables = np.where(seen, m["C"][x], 0), np.where(seen, m["T"][x], 0)
        return (np.maximum(c - m["d"] * t, 0) + (STRENGTH + m["d"] * tables) * p) / (STRENGTH + big)

    @classmethod
    def dishes(cls, lens: np.ndarray, spell: np.ndarray):
        """Distinct dishes of depth 2, and which of them each letter is."""
        return _ranked(cls.keys(lens, spell)[2], 1 << 27)

    def words(self, lens: np.ndarray, uniq: np.ndarray, inv: np.ndarray) -> np.ndarray:
        """Probability of each word's spelling, from its dishes."""
        logs = np.log(self.prob(2, uniq))[inv]
        n = lens.astype(np.int64) + 1
        return np.exp(np.add.reduceat(logs, np.cumsum(n) - n)) if len(n) else np.zeros(0)


def _parent(s, g, base):
    """The parent's P(word) of a shard's words."""
    up = _from_children(s)
    return (np.maximum(up - g["d1"] * s["up"], 0) + (STRENGTH + g["d1"] * g["T1"]) * base) / (STRENGTH + g["C1"])


def _sampled(s, g, parent, sums) -> dict:
    """The shard with its part of the predictive probabilities of this sample; ``sums``
    are the tables of its words as contexts."""
    give = s["give"] + (np.maximum(s["c"] - g["d2"] * s["t"], 0) / SAMPLES).astype(np.float32)
    weight = (STRENGTH + g["d2"] * sums) / SAMPLES
    return s | {"give": give, "parent": np.vstack([s["parent"], parent[None].astype(np.float32)]),
                "weight": np.vstack([s["weight"], weight[None].astype(np.float32)])}


def _tables(batches):
    """A shard's tables of each context, for the shard of the context's word (role 0)."""
    for b in batches:
        for i in range(b.num_rows):
            place, s = b.column("place")[i].as_py(), _unpack(b.column("blob")[i].as_py())
            t = np.bincount(s["px"], s["t"], len(s["ctx"])).astype(np.int32)
            for k in np.flatnonzero(np.diff(s["cut"])).tolist():
                own = slice(s["cut"][k], s["cut"][k + 1])
                yield _chunk_row(0, k, place, _pack(ctx=s["ctx"][own], t=t[own]))


def _sum_tables(parts: list[dict]):
    """(contexts, their tables from all shards)."""
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ctx, inv = np.unique(np.concatenate([p["ctx"] for p in parts]), return_inverse=True)
    return ctx, np.bincount(inv, np.concatenate([p["t"] for p in parts]), len(ctx)).astype(np.int64)


def _own_sums(s, ctx, t) -> np.ndarray:
    """Tables of the shard's words as contexts; 0 where a word was none."""
    out = np.zeros(len(s["hash"]), np.int64)
    out[np.searchsorted(s["hash"], ctx)] = t  # each context is a word of its shard
    return out


def _reply(batches):
    """Sums for each shard that sent tables (role 0), and for the words' own (role -2)."""
    def done(place, parts):
        ctx, t = _sum_tables([p for _, p in parts])
        yield _chunk_row(-2, place, place, _pack(ctx=ctx, t=t))
        for shard, p in parts:
            yield _chunk_row(0, shard, place, _pack(t=t[np.searchsorted(ctx, p["ctx"])]))
    now, parts = None, []
    for b in batches:
        for i in range(b.num_rows):
            _, place, shard, blob = (b.column(c)[i].as_py() for c in _CHUNK.names)
            if place != now:
                if parts:
                    yield from done(now, parts)
                now, parts = place, []
            parts.append((shard, _unpack(blob)))
    if parts:
        yield from done(now, parts)


def _messages(table) -> list[tuple]:
    """Rows of one place in the order of their role and sender."""
    return sorted(zip(*(table.column(c).to_pylist() for c in ("role", "chunk", "blob"))), key=lambda x: x[:2])


def _sweep(glob, number, keep, seed):
    """A shard with its words' own sums (role -2) and the sums of its contexts (role 0, in
    the order of their shards)."""
    def done(place, s, own, sums):
        g, letters = glob.value
        rng = np.random.default_rng([seed, number, place])
        tables = np.concatenate(sums) if sums else np.zeros(0, np.int64)
        keys, inv = Letters.dishes(s["len"], s["spell"])
        spelled = letters.words(s["len"], keys, inv) if letters.depths else np.zeros(len(s["hash"]))
        base = (spelled + 1 / (g["V"] + 1)) / 2
        parent = _parent(s, g, base)
        if keep:
            s = _sampled(s, g, parent, _own_sums(s, *own))
        t = seat(rng, s["c"].astype(np.int64), STRENGTH + g["d2"] * tables[s["px"]], parent[_word_of(s["pw"])], g["d2"])
        s["t"] = t.astype(np.int32)
        up = seat(rng, _from_children(s), STRENGTH + g["d1"] * g["T1"], base, g["d1"])
        s["up"] = up.astype(np.int32)
        n = s["len"].astype(np.int64) + 1
        share = spelled / 2 / base if letters.depths else np.full(len(base), 0.5)
        ordered = rng.binomial(up, np.clip(share, 0, 1))
        times = np.bincount(inv, np.repeat(ordered, n), len(keys)).astype(np.int64)
        on = times > 0
        return _state_row(place, _pack(**s), _totals(s), keys[on].tolist(), times[on].tolist())

    def run(state, messages):
        out = []
        for place, blob in zip(state.column("place").to_pylist(), state.column("blob").to_pylist()):
            own, sums = (np.zeros(0, np.uint64), np.zeros(0, np.int64)), []
            for role, _, message in _messages(messages):
                part = _unpack(message)
                if role == -2:
                    own = part["ctx"], part["t"]
                else:
                    sums.append(part["t"])
            out.append(done(place, _unpack(blob), own, sums))
        tu.release()
        return pa.Table.from_batches(out, schema=_STATE)
    return run


def _known(glob):
    """What a shard answers from, once it has the tables of its words as contexts: its pairs
    sorted by word and context."""
    def ready(s, sums):
        g, letters = glob.value
        base = (letters.words(s["len"], *Letters.dishes(s["len"], s["spell"])) + 1 / (g["V"] + 1)) / 2
        s = _sampled(s, g, _parent(s, g, base), _own_sums(s, *_sum_tables(sums)))
        order = np.argsort(s["ctx"])
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        key = _word_of(s["pw"]) * max(1, len(order)) + rank[s["px"]]
        by = np.argsort(key)
        total = np.bincount(_word_of(s["pw"]), s["c"], len(s["hash"])).astype(np.int64)
        return {"hash": s["hash"], "total": total, "parent": s["parent"], "weight": s["weight"],
                "follow": s["follow"], "ctx": s["ctx"][order], "step": np.diff(key[by], prepend=0), "give": s["give"][by]}

    def run(state, messages):
        out = []
        for place, blob in zip(state.column("place").to_pylist(), state.column("blob").to_pylist()):
            known = ready(_unpack(blob), [_unpack(m) for _, _, m in _messages(messages)])
            out.append(_chunk_row(-1, place, 0, _pack(**known)))
        tu.release()
        return pa.Table.from_batches(out, schema=_CHUNK)
    return run


def _answer(known, questions):
    """A shard's answers to the chunks' questions."""
    out = []
    for own, blob in zip(known.column("place").to_pylist(), known.column("blob").to_pylist()):
        s = _unpack(blob)
        keys = np.cumsum(s["step"])
        for chunk, question in zip(questions.column("chunk"), questions.column("blob")):
            q = _unpack(question.as_py())
            k = np.searchsorted(s["hash"], q["hash"])
            give = np.zeros(len(q["px"]), np.float32)
            if len(keys):
                x = np.minimum(np.searchsorted(s["ctx"], q["ctx"]), len(s["ctx"]) - 1)
                met = s["ctx"][x] == q["ctx"]
                key = k[_word_of(q["pw"])] * len(s["ctx"]) + x[q["px"]]
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = (keys[at] == key) & met[q["px"]]
                give[hit] = s["give"][at[hit]]
            out.append(_chunk_row(0, chunk.as_py(), own, _pack(
                c=s["total"][k], follow=s["follow"][k], give=give, parent=s["parent"][:, k], weight=s["weight"][:, k])))
    tu.release()
    return pa.Table.from_batches(out, schema=_CHUNK)


def _score(total, distinct):
    names = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches):
        now, parts = None, []
        for b in batches:
            for i in range(b.num_rows):
                role, place, shard, blob = (b.column(c)[i].as_py() for c in _CHUNK.names)
                if place != now:
                    now, parts = place, []
                if role == 0:
                    parts.append((shard, blob))
                    continue
                d = _unpack(blob)
                words = int(d["cut"][-1])
                pairs, inv, pcut = _pairs(d)
                c, follow = np.zeros(words, np.int64), np.zeros(words, np.int64)
                give, weight, parent = np.zeros(len(pairs)), np.zeros((SAMPLES, words)), np.zeros((SAMPLES, words))
                for shard, blob in parts:
                    a, own = _unpack(blob), slice(d["cut"][shard], d["cut"][shard + 1])
                    c[own], follow[own] = a["c"], a["follow"]
                    parent[:, own], weight[:, own] = a["parent"], a["weight"]
                    give[pcut[shard]:pcut[shard + 1]] = a["give"]
                w, x = pairs // words, pairs % words
                p = np.log10((give + sum(weight[k, x] * parent[k, w] for k in range(SAMPLES))) / (STRENGTH + follow[x]))
                base = np.log10((c + 0.1) / (total + 0.1 * (distinct + 1)))
                first = np.cumsum(d["size"]) - d["size"]
                known = np.add.reduceat((c > 0).astype(np.int64)[d["local"]], first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(d["id"], pa.int64(), mask=d["none"]), pa.array(d["held"]),
                     pa.array(d["size"].astype(np.int64)), pa.array(known),
                     pa.array(np.full(len(first), total, np.int64)),
                     pa.array(np.add.reduceat(base[d["local"]], first)),
                     pa.array(np.add.reduceat(p[inv], first))], names)
    return run


def score_texts(docs: DataFrame, id_col: str, text_col: str, shards: int | None = None,
                seed: int = 5) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    work = Work(spark, "lm")
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    shards = shards or max(16, 2 * base.rdd.getNumPartitions())
    read = work.keep(base.mapInArrow(tu.released(_read(shards)), _CHUNK_DDL), "read", batch=str(2 * CHUNK_BYTES))
    for turn in range(TURNS):
        sent = read.mapInArrow(tu.released(_split(True, turn, TURNS)), _CHUNK_DDL).select("place", "blob")
        state = work.keep(sent.repartition(shards, "place").sortWithinPartitions("place")
                          .mapInArrow(tu.released(_first_state(shards)), _STATE_DDL),
                          "state_0", buckets=(shards, "place"), more=turn > 0)

    def totals(df):
        rows = np.array([r.totals for r in df.select("totals").collect()], np.int64)
        v = rows.sum(0).tolist() if len(rows) else [0] * 8
        disc = lambda a, b: min(0.95, max(0.1, a / max(1, a + 2 * b)))
        return {"C": v[0], "C1": v[1], "T1": v[2], "V": v[3], "d2": disc(v[4], v[5]), "d1": disc(v[6], v[7])}

    def tables(state):
        return state.select("place", "blob").mapInArrow(_tables, _CHUNK_DDL)

    def meet(shelf, messages, fn, ddl):
        return shelf.select("place", "blob").groupBy("place").cogroup(messages.groupBy("place")).applyInArrow(fn, ddl)

    g, letters = totals(state), Letters()
    words, tokens = g["V"], g["C"]
    rng = np.random.default_rng([seed, 0])
    for number in range(1, BURN + SAMPLES + 1):
        # the state before a sweep is the sample of the sweep before it
        keep = number - 1 > BURN
        fn = _sweep(spark.sparkContext.broadcast((g, letters)), number, keep, seed)
        sums = (tables(state).repartition(shards, "place").sortWithinPartitions("place", "chunk")
                .mapInArrow(_reply, _CHUNK_DDL))
        state = work.keep(meet(state, sums, fn, _STATE_DDL), f"state_{number}", buckets=(shards, "place"))
        work.drop(f"state_{number - 1}")
        g = totals(state)
        rows = (state.select(F.explode(F.arrays_zip("letters", "times")).alias("x"))
                .groupBy("x.letters").agg(F.sum("x.times").alias("n")).collect())  # at most 257^3 dishes
        if rows:
            letters = Letters.sample(rng, np.array([r[0] for r in rows], np.int64),
                                     np.array([r[1] for r in rows], np.int64), letters)
    if not letters.depths:  # nothing to learn from
        letters = Letters.sample(rng, np.array([LAST], np.int64), np.array([0], np.int64), letters)
    fn = _known(spark.sparkContext.broadcast((g, letters)))
    known = work.keep(meet(state, tables(state), fn, _CHUNK_DDL), "known", buckets=(shards, "place"))
    work.drop(f"state_{BURN + SAMPLES}")
    turn = F.pmod(F.shiftright("chunk", 32) + F.col("chunk").bitwiseAND(F.lit((1 << 32) - 1)), F.lit(BANDS))
    out = []
    for band in range(BANDS):
        asked = read.filter(turn == band)
        answers = meet(known, asked.mapInArrow(_split(False), _CHUNK_DDL), _answer, _CHUNK_DDL)
        rows = answers.unionAll(asked.mapInArrow(_documents, _CHUNK_DDL))
        scores = (rows.repartition(max(1, shards // BANDS), "place").sortWithinPartitions("place", "role")
                  .mapInArrow(tu.released(_score(tokens, words)),
                              "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                              "base_score double, score double"))
        out.append(work.keep(scores, f"scores_{band}"))
    work.drop("known")
    work.drop("read")
    return reduce(DataFrame.unionAll, out).withColumnRenamed("id", id_col)
