"""Token counts of a byte-level BPE vocabulary by the whole-token shortcut.

Offline, on the driver, every vocabulary string is put to the proof: it is kept
when the splitting pattern leaves it in one piece and the merges turn it into one
token.  In the texts a pre-token found in that table counts as one; only the rest
runs through the merges, once per distinct pre-token of a worker's bounded memo.

Special strings inside a text count as one token each, which is the library's
default.  Splitting uses Python's ``re`` up to the first code points
that it and the library class differently (found offline); a text that goes beyond
them is split by the library itself.  Null counts as the empty text.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import textutil as tu

# Fixed value: the published splitting pattern of this vocabulary family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO = 400_000


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest
    follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(plain))
    return out


_LETTER = _byte_letters()
_TO_LETTERS = {b: ord(c) for b, c in _LETTER.items()}


def _letters(s: str) -> str:
    return s.encode("utf-8").decode("latin-1").translate(_TO_LETTERS)


def prove_whole_tokens(path: str) -> tuple[frozenset, int, list[str]]:
    """(strings that encode alone as one token, first code point that is left to
    the library's splitter, special strings).  Bounded by the vocabulary."""
    import regex
    from tokenizers import Tokenizer
    tok, pat = Tokenizer.from_file(path), regex.compile(PATTERN)
    special = [t.content for t in tok.get_added_tokens_decoder().values()]
    back = {c: b for b, c in _LETTER.items()}
    whole = set()
    for v in tok.get_vocab(with_added_tokens=False):
        try:
            s = bytes(back[c] for c in v).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue
        if pat.findall(s) == [s] and len(tok.model.tokenize(v)) == 1:
            whole.add(s)
    # code points up to the first that the two splitters class differently
    limit = 0
    while limit < 0x3000:
        t = "".join(f"a{c}a1{c}1!{c}! " for c in map(chr, range(limit, limit + 16)))
        if [t[a:b] for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(t)] != pat.findall(t):
            break
        limit += 16
    return frozenset(whole), limit, special


class _Cost(dict):
    """Tokens of a pre-token: one where it is proven whole, else by the merges.
    The memo of the rest is forgotten when it has grown large."""

    def __init__(self, model, whole):
        super().__init__(dict.fromkeys(whole, 1))
        self.model, self.whole = model, whole

    def __missing__(self, s):
        if len(self) >= MEMO + len(self.whole):
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        n = len(self.model.tokenize(_letters(s)))
        if len(s) <= 64:
            self[s] = n
        return n


def _splitter(limit: int):
    """The pattern for code points under ``limit``, its classes spelled out."""
    import regex
    chars = [chr(c) for c in range(limit)]
    letter, digit, space = (re.escape("".join(c for c in chars if regex.fullmatch(p, c)))
                            for p in (r"\p{L}", r"\p{N}", r"\s"))
    return re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+"
                      f"|[{space}]+(?![^{space}])|[{space}]+").findall


_WORKER: dict = {}


def _counter(path: str, proof):
    """This worker's counting function; made once and kept between tasks."""
    if path not in _WORKER:
        from tokenizers import Tokenizer
        whole, limit, special = proof.value
        tok = Tokenizer.from_file(path)
        split = _splitter(limit)
        cost = _Cost(tok.model, whole)
        beyond = re.compile(f"[{chr(limit)}-{chr(0x10FFFF)}]").search
        parts = re.compile("|".join(re.escape(s) for s in special)) if special else None

        def pieces(text):
            if not text.isascii() and beyond(text):
                return [text[a:b] for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(text)]
            return split(text)

        def count(text):
            n, texts = 0, [text]
            if parts is not None and parts.search(text):
                texts = parts.split(text)
                n = len(texts) - 1
            for t in texts:
                if t:
                    n += sum(map(cost.__getitem__, pieces(t)))
            return n
        _WORKER[path] = count
    return _WORKER[path]


def count_tokens(docs: DataFrame, id_col: str, text_col: str, path: str, limit: int = 512) -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit)."""
    proof = docs.sparkSession.sparkContext.broadcast(prove_whole_tokens(path))

    def run(batches):
        count = _counter(path, proof)
        for batch in batches:
            for c in tu.chunks(batch, "text"):
                _, offs = tu.text_bytes(c.column("text"))
                n = [count(t or "") for t in c.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [c.column("id"), pa.array(offs[1:] - offs[:-1], pa.int64()), pa.array(n, pa.int64())],
                    names=["id", "n_bytes", "n_tokens"])
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return (rows.mapInArrow(run, "id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit).withColumnRenamed("id", id_col))
