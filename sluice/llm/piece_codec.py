"""SentencePiece encoding and decoding by a batched numpy Viterbi.

Texts are cut where no piece holds the two characters side by side, so no merge
crosses a cut; equal units are found by their hashes and compared character by
character.  Distinct words advance together, one character a step, the longest
first.  At each end position every substring that ends there is hashed from prefix
sums and probed in the sorted keys of the pieces; the best admissible piece and its
length are stored as backpointers, picked by vectorised maxima.

The public model file holds a BPE model: its encoding is the order of merges, not
the largest sum of scores.  The lattice therefore admits a piece after another only
where the two stand next to each other in some merge result (an exact test on the
two pieces' merge trees, memoised per pair).  A path of admissible neighbours is the
library's encoding, and exactly one piece can end each prefix's path, so the maxima
find it.  For a unigram model the same steps maximise the sum of scores.

Runs of spaces merge after everything else and from the left; characters in no
piece become byte pieces.  Null and empty texts have no ids; decoding gives back the
text (a text that holds the space mark itself comes back with a space there).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import textutil as tu

SPACE = "▁"
MEMO_BYTES = 64 << 20  # of the units that a task remembers
ENTRY = 150  # bytes of an entry besides its unit and ids
PAIRS = 1 << 20
BATCH = 1 << 20  # characters of the words that advance together
UNITS = 1 << 16  # units hashed at once
OTHER, SINGLE, MARK = 0, 1, 2  # classes of characters: in no piece, never beside another, the space mark
_P = np.uint64(0x9E3779B97F4A7C15 | 1)


class Pieces:
    """Pieces of a model file: all that decoding needs."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_id = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.control = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i)}
        self.table = None
        self._prepare(sp, [i for i in range(n) if not (sp.is_byte(i) or i in self.control)])

    def _prepare(self, sp, normal: list[int]) -> None:
        """Nothing more to hold for decoding."""

    def decode(self, ids: np.ndarray, offs: np.ndarray) -> list[str]:
        """Texts of the rows ids[offs[i]:offs[i + 1]]."""
        if self.table is None:
            raw = [bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in self.control
                   else p.replace(SPACE, " ").encode("utf-8") for i, p in enumerate(self.pieces)]
            size = np.array([len(r) for r in raw])
            self.table = np.frombuffer(b"".join(raw), np.uint8), np.cumsum(size) - size, size
        data, start, size = self.table
        n = size[ids]
        ends = np.concatenate(([0], np.cumsum(n)))
        text = data[np.arange(ends[-1]) - np.repeat(ends[:-1], n) + np.repeat(start[ids], n)].tobytes()
        cut = ends[offs].tolist()
        return [text[a + 1:b].decode("utf-8", "replace") for a, b in zip(cut, cut[1:])]


class Model(Pieces):
    """The pieces and what the lattice needs of them."""

    def _prepare(self, sp, normal: list[int]) -> None:
        self.score = {i: sp.get_score(i) for i in normal}
        self.id_of = {self.pieces[i]: i for i in normal}
        self.space_runs = {len(s): i for s, i in self.id_of.items() if set(s) == {SPACE}}
        words = [i for i in normal if SPACE not in self.pieces[i][1:]]
        self.split = {}
        words = [i for i in words if self._reaches(i)]
        self.longest = max(len(self.pieces[i]) for i in words)
        self.known = {c for i in words for c in self.pieces[i]} - {SPACE}
        self.classes = self._classes(words)
        self.power = _powers(self.longest)
        by_len = sorted(words, key=lambda i: -len(self.pieces[i]))
        size = np.array([len(self.pieces[i]) for i in by_len])
        h, base, _ = self._hashes([self.pieces[i] for i in by_len], size)
        words, keys = by_len, tu.mix64(h[base[size] + np.arange(len(size))] + size.astype(np.uint64))
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(words, np.int64)[order]
        if len(np.unique(self.keys)) != len(self.keys):
            raise ValueError("two pieces have one key")
        self.near = np.zeros(PAIRS, bool)  # slots that some piece's key falls in
        self.near[(keys & np.uint64(PAIRS - 1)).astype(np.int64)] = True
        self.edges: dict[tuple[int, int], list[int]] = {}
        self.pair_key = np.full(PAIRS, -1, np.int64)
        self.pair_ok = np.zeros(PAIRS, bool)
        self.code = [int(i).to_bytes(4, "little") for i in range(len(self.pieces))]
        self.memo: dict[str, bytes] = {}  # units to their ids, four bytes each
        self.runs: dict[int, bytes] = {}
        self.held = 0  # bytes of the memo

    def forget(self) -> None:
        """Frees what a task remembers; its worker process lives on."""
        self.memo, self.runs, self.held = {}, {}, 0

    def _merge(self, s: str) -> tuple[list[str], tuple | None]:
        """Merges in the library's order, for the few strings of the vocabulary."""
        parts, last = list(s), None
        while len(parts) > 1:
            best = max(((self.score[self.id_of[a + b]], -k) for k, (a, b) in enumerate(zip(parts, parts[1:]))
                        if a + b in self.id_of), default=None)
            if best is None:
                break
            k = -best[1]
            last = (parts[k], parts[k + 1])
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return parts, last

    def _reaches(self, i: int) -> bool:
        """Whether the merges make this piece of its own characters."""
        parts, last = self._merge(self.pieces[i])
        if len(parts) == 1:
            self.split[i] = None if last is None else (self.id_of.get(last[0]), self.id_of.get(last[1]))
        return len(parts) == 1

    def _neighbours(self, a: int, b: int) -> bool:
        """Whether the merges of the joined characters leave a | b.

        Down the right edge of a's merge tree and the left edge of b's stand the
        pairs that meet at the cut while the merges run.  The cut holds when each
        pair is consumed, to the left or right, before the pair itself may merge.
        """
        first, second = self._edge(a, 1), self._edge(b, 0)
        x, y = 0, 0  # at the top: nothing consumes a or b
        while True:
            up_a = self.score[first[x - 1]] if x else -np.inf
            up_b = self.score[second[y - 1]] if y else -np.inf
            joined = self.id_of.get(self.pieces[first[x]] + self.pieces[second[y]])
            if joined is not None:
                s = self.score[joined]
                if s > up_a and s >= up_b:
                    return False
            more_a, more_b = x + 1 < len(first), y + 1 < len(second)
            if not more_a and not more_b:
                return True
            # undo the later merge of the two
            if more_a and (not more_b or self._later(first[x], second[y])):
                x += 1
            else:
                y += 1

    def _later(self, a: int, b: int) -> bool:
        return self.score[a] < self.score[b]

    def _edge(self, i: int, side: int) -> list[int]:
        out = self.edges.get((i, side))
        if out is None:
            out = [i]
            while self.split.get(out[-1]):
                out.append(self.split[out[-1]][side])
            self.edges[i, side] = out
        return out

    def _classes(self, words: list[int]) -> np.ndarray:
        """Class of every code point.  Characters that stand side by side in a piece share one."""
        group = {}
        for i in words:
            beside = self.pieces[i].lstrip(SPACE)
            if len(beside) > 1:
                one = set(beside).union(*(group.get(c, ()) for c in beside))
                group.update(dict.fromkeys(one, one))
        out = np.full(0x110000, OTHER, np.uint16)
        out[[ord(c) for c in self.known]] = SINGLE
        out[ord(SPACE)] = MARK
        for k, one in enumerate({id(g): g for g in group.values()}.values(), MARK + 1):
            out[[ord(c) for c in one]] = k
        return out

    def _hashes(self, words: list[str], size: np.ndarray):
        """(hash of every prefix, where the prefixes of each length begin, words that reach each length).

        The words come longest first, so those that reach a length are the first ones;
        the prefix of length j of word i stands at base[j] + i.
        """
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        first, m = np.cumsum(size) - size, int(size[0])
        alive = np.searchsorted(-size, -np.arange(m + 1), "right")
        base = np.cumsum(alive) - alive
        h = np.zeros(int(alive.sum()), np.uint64)
        for j, (k, lo, at) in enumerate(zip(alive[1:].tolist(), base[:-1].tolist(), base[1:].tolist())):
            h[at:at + k] = h[lo:lo + k] * _P + (codes[first[:k] + j] + np.uint64(1))
        return h, base, alive

    def _solve(self, words: list[str]) -> list[bytes]:
        """Ids of words, which come longest first."""
        n, size = len(words), np.array([len(w) for w in words])
        h, base, alive = self._hashes(words, size)
        last = np.full(len(h), -1, np.int32)
        back = np.zeros(len(h), np.int32)
        start = base.tolist()
        for end, k in enumerate(alive.tolist()):
            rows, here = np.arange(k), h[start[end]:start[end] + k]
            for length in range(min(end, self.longest), 0, -1):
                before = rows + start[end - length]
                key = tu.mix64(here - h[before] * self.power[length] + np.uint64(length))
                hit = np.flatnonzero(self.near[(key & np.uint64(PAIRS - 1)).view(np.int64)])
                if end > length and len(hit):
                    hit = hit[last[before[hit]] >= 0]
                if not len(hit):
                    continue
                probe = key[hit]
                at = np.searchsorted(self.keys, probe)
                at[at == len(self.keys)] = 0
                same = self.keys[at] == probe
                hit, piece = hit[same], self.ids[at[same]]
                if end > length and len(hit):
                    ok = self._allowed(last[before[hit]] * np.int64(len(self.pieces)) + piece)
                    hit, piece = hit[ok], piece[ok]
                if not len(hit):
                    continue
                last[start[end] + rows[hit]] = piece
                back[start[end] + rows[hit]] = length
                left = np.ones(len(rows), bool)
                left[hit] = False
                rows, here = rows[left], here[left]
                if not len(rows):
                    break
        # all words walk back together; a piece is kept at its end
        on = np.zeros(len(h), bool)
        rows, at = np.arange(n), size
        if last[base[at] + rows].min() < 0:
            raise ValueError("a word has no path")
        while len(rows):
            place = base[at] + rows
            on[place] = True
            at = at - back[place]
            rows, at = rows[at > 0], at[at > 0]
        place = np.flatnonzero(on)
        word = place - base[np.searchsorted(base, place, "right") - 1]
        data = last[place[np.argsort(word, kind="stable")]].astype("<i4").tobytes()
        ends = (4 * np.cumsum(np.bincount(word, minlength=n))).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def _allowed(self, pair: np.ndarray) -> np.ndarray:
        """Which neighbours may stand, from a table of the pairs seen last."""
        slot = (tu.mix64(pair.astype(np.uint64)) & np.uint64(PAIRS - 1)).astype(np.int64)
        ok = self.pair_ok[slot]
        new = np.flatnonzero(self.pair_key[slot] != pair)
        if len(new):
            uniq, inv = np.unique(pair[new], return_inverse=True)
            got = np.array([self._neighbours(*divmod(p, len(self.pieces))) for p in uniq.tolist()])
            ok[new] = got[inv]
            self.pair_key[slot[new]] = pair[new]
            self.pair_ok[slot[new]] = got[inv]
        return ok

    def _run(self, k: int) -> bytes:
        """Ids of k space marks that no word took: merged from the left."""
        if k not in self.runs:
            parts, at = [1] * k, 0
            while at + 1 < len(parts):
                if parts[at] + parts[at + 1] in self.space_runs:
                    parts[at:at + 2] = [parts[at] + parts[at + 1]]
                    at = max(0, at - 1)
                else:
                    at += 1
            self.runs[k] = b"".join(self.code[self.space_runs[p]] for p in parts)
        return self.runs[k]

    def _unit(self, unit: str, solved: dict[str, bytes]) -> bytes:
        """Ids of a unit: a character of no piece, a run of spaces, or a word."""
        word = unit.lstrip(SPACE)
        run = len(unit) - len(word)
        if not word:
            return self._run(run)
        if word not in self.known and len(word) == 1:
            return b"".join(self.code[self.byte_id[b]] for b in word.encode("utf-8"))
        got = solved[unit[max(0, run - 1):]]
        if run < 2:
            return got
        if got[:4] == self.code[self.id_of[SPACE]]:
            return self._run(run) + got[4:]
        return self._run(run - 1) + got

    def _cut(self, codes: np.ndarray, texts: np.ndarray) -> np.ndarray:
        """Where units begin: runs of space marks with the characters of one class that follow."""
        cls = self.classes[codes]
        before, cls = cls[:-1], cls[1:]
        cut = np.ones(len(codes), bool)
        cut[1:] = ((cls != before) | (cls <= SINGLE)) & ((before != MARK) | (cls == OTHER))
        cut[texts] = True
        return np.flatnonzero(cut)

    def _distinct(self, whole: str, codes: np.ndarray, start: np.ndarray) -> tuple[list[str], np.ndarray]:
        """(the distinct units, which of them each unit is)."""
        size = np.diff(start, append=len(codes))
        power = _powers(int(size.max()))
        h = np.empty(len(start), np.uint64)
        for lo in range(0, len(start), UNITS):
            first, n = start[lo:lo + UNITS], size[lo:lo + UNITS]
            a, b = first[0], first[-1] + n[-1]
            place = np.arange(a, b) - np.repeat(first, n)
            h[lo:lo + UNITS] = np.add.reduceat((codes[a:b] + np.uint64(1)) * power[place], first - a)
        _, one, which = np.unique(h, return_index=True, return_inverse=True)
        ends = start + size
        units = [whole[a:b] for a, b in zip(start[one].tolist(), ends[one].tolist())]
        same = (size == size[one][which]).all()
        for lo in range(0, len(start), UNITS) if same else ():
            first, n = start[lo:lo + UNITS], size[lo:lo + UNITS]
            a, b = first[0], first[-1] + n[-1]
            twin = np.arange(a, b) + np.repeat(start[one[which[lo:lo + UNITS]]] - first, n)
            same = same and (codes[a:b] == codes[twin]).all()
        if not same:  # two units with one hash
            number: dict[str, int] = {}
            which = np.array([number.setdefault(whole[a:b], len(number))
                              for a, b in zip(start.tolist(), ends.tolist())])
            units = list(number)
        return units, which

    def rows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and where each text's ids begin and end."""
        whole = "".join([SPACE + t for t in texts if t]).replace(" ", SPACE)
        if not whole:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        offs = np.concatenate(([0], np.cumsum([len(t) + 1 if t else 0 for t in texts])))
        start = self._cut(codes, offs[offs < len(codes)])
        units, which = self._distinct(whole, codes, start)
        self._learn(units)
        ids = [self.memo[u] for u in units]
        pool = np.frombuffer(b"".join(ids), "<i4")
        n = np.array([len(i) // 4 for i in ids])
        first = (np.cumsum(n) - n)[which]
        n = n[which]
        ends = np.concatenate(([0], np.cumsum(n)))
        return pool[np.arange(ends[-1]) + np.repeat(first - ends[:-1], n)], ends[np.searchsorted(start, offs)]

    def _learn(self, units: list[str]) -> None:
        """Puts the ids of distinct units into the memo."""
        need = [u for u in units if u not in self.memo]
        todo = set()
        for u in need:
            word = u.lstrip(SPACE)
            if word and (len(word) > 1 or word in self.known):
                todo.add(SPACE + word if len(u) > len(word) else word)
        todo = sorted(todo, key=len, reverse=True)
        solved: dict[str, bytes] = {}
        cut = np.cumsum([len(w) for w in todo]) // BATCH
        for part in np.split(np.arange(len(todo)), np.flatnonzero(np.diff(cut)) + 1) if todo else ():
            words = todo[part[0]:part[-1] + 1]
            solved.update(zip(words, self._solve(words)))
        if self.held > MEMO_BYTES:
            self.memo = {u: self.memo[u] for u in units if u in self.memo}
            self.held = sum(map(_entry, self.memo.items()))
        for u in need:
            self.memo[u] = self._unit(u, solved)
            self.held += _entry((u, self.memo[u]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        ids, offs = self.rows(texts)
        return [ids[a:b].tobytes() for a, b in zip(offs.tolist(), offs[1:].tolist())]


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, _P, np.uint64))), dtype=np.uint64)


def _entry(item: tuple[str, bytes]) -> int:
    return ENTRY + 2 * len(item[0]) + len(item[1])


_WORKER: dict[tuple, Pieces] = {}


def model(path: str, kind: type = Model):
    """This process's model of a file, made once."""
    if (path, kind) not in _WORKER:
        _WORKER[path, kind] = kind(path)
    return _WORKER[path, kind]


def _schema_of(df: DataFrame, drop: set[str]) -> tuple[list[str], str]:
    keep = [f for f in df.schema.fields if f.name not in drop]
    return [f.name for f in keep], "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in keep)


def encode(docs: DataFrame, text_col: str, path: str, ids_col: str = "piece_ids") -> DataFrame:
    """``docs`` plus ids_col: the ids of each whole text, without begin or end ids."""
    names, ddl = _schema_of(docs, {ids_col})

    def run(batches):
        m = model(path)
        try:
            for batch in batches:
                for c in tu.chunks(batch, text_col, 2 << 20):
                    yield pa.RecordBatch.from_arrays([c.column(n) for n in names] + [ids_of(m, c)], names + [ids_col])
        finally:
            m.forget()
            tu.release()

    def ids_of(m, c):
        ids, offs = m.rows([t or "" for t in c.column(text_col).to_pylist()])
        return pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(ids))
    return docs.mapInArrow(run, f"{ddl}`{ids_col}` array<int>")


def decode(df: DataFrame, ids_col: str, path: str, text_col: str = "decoded") -> DataFrame:
    """``df`` plus text_col: the text that the ids stand for (null: empty)."""
    names, ddl = _schema_of(df, {text_col})

    def run(batches):
        m = model(path, Pieces)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                c = batch.slice(lo, 512)
                ids = c.column(ids_col)
                n = np.nan_to_num(pc.list_value_length(ids).to_numpy(zero_copy_only=False)).astype(np.int64)
                texts = m.decode(ids.flatten().to_numpy(zero_copy_only=False),
                                 np.concatenate(([0], np.cumsum(n))))
                yield pa.RecordBatch.from_arrays([c.column(n) for n in names]
                                                 + [pa.array(texts, pa.string())], names + [text_col])
    return df.mapInArrow(run, f"{ddl}`{text_col}` string")

