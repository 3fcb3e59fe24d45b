"""Cross-tokenizer alignment over distinct texts.

Equal texts meet in one aggregate by the full text, which combines copies before the
shuffle; each distinct text is tokenised and aligned once and its pairs weigh as many
documents as hold it.  The measures go back to the documents by the text's SHA-256.

Two tokenizations of the same bytes link exactly once per interval between neighbouring
token ends of either side, so ends as marks on the byte positions give all links, and
the marks that both sides share give the groups, a chunk of texts at a time.

Texts are handled in blocks of bounded size.  A block leaves one row per distinct id
pair with the number of documents that hold it, and per text its pairs as codes into
that list.  Pair rows are summed over the corpus, the highest count per A id is taken,
and each block gets its own pairs' counts back: what is shuffled for the counts are
pairs per block, not links.

Null and empty texts, and texts that either side does not give back byte for byte,
have no tokens: all measures are zero and the digest is ''.  Equal rows are separate
documents.  An empty table gives no rows.  Only the id and the text are read, so other
columns cannot clash.  A very long text is a chunk of its own.

A ids come from the fast encoder of the same merge order where an offline proof holds
(ids follow the merges, and both splitters class a block of code points alike); texts
with other code points go through the vocabulary's own library.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from . import textutil as tu
from .token_count import _LETTER, PATTERN
from .work import Work

CHUNK_BYTES = 1 << 20
BLOCK_BYTES = 12 << 20
LONG_RUN = 4096
_B_BITS = 20
_TEXTS = ("block long, keys array<binary>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
          "shas array<string>, n_pairs array<int>, codes binary, mults binary")
_PAIRS = "code int, a int, b int, docs long"
_ALIGNED = f"{_TEXTS}, {_PAIRS}"
_MEASURES = "key binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
    kinds |= {f"array<{k}>": pa.list_(v) for k, v in kinds.items()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def _pack(x: np.ndarray) -> bytes:
    """An unsigned 32-bit array by byte planes, compressed."""
    return pa.compress(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def _unpack(raw: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(raw, n * 4, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _blocks_alike(fast, slow) -> list[tuple[int, int]]:
    """Runs of code points that both encoders treat alike, in steps of 16."""
    out, step = [], 16
    for lo in range(0, 0x30000, step):
        if 0xD800 <= lo < 0xE000:
            continue
        t = "".join(f"a{c}a1{c}1!{c}! {c} " for c in map(chr, range(lo, lo + step)))
        if fast(t).tolist() != slow(t):
            continue
        if out and out[-1][1] == lo:
            out[-1] = (out[-1][0], lo + step)
        else:
            out.append((lo, lo + step))
    return out


def prove_fast(path: str) -> list[tuple[int, int]]:
    """Code points for which the fast encoder gives the library's ids; none if ids do not follow the merges."""
    import json
    from tokenizers import Tokenizer
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    ids, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    rank = [ids["".join(m)] for m in merges]
    if rank != sorted(rank) or len(set(rank)) != len(rank):
        return []
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return _blocks_alike(_fast_encoder(path), lambda t: tok.encode(t, add_special_tokens=False).ids)


def _byte_strings(path: str) -> dict[bytes, int]:
    """Entries of a byte-level vocabulary as bytes; added tokens are left out."""
    from tokenizers import Tokenizer
    back = {c: b for b, c in _LETTER.items()}
    return {bytes(back[c] for c in s): i for s, i in Tokenizer.from_file(path).get_vocab(with_added_tokens=False).items()
            if all(c in back for c in s)}


def _fast_encoder(path: str):
    import tiktoken
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=_byte_strings(path), special_tokens={})
    return lambda t: np.asarray(enc.encode_to_numpy(t, disallowed_special=()), np.int64)


class _Side:
    """Bytes of a tokenizer's ids."""

    def __init__(self, raw: list[bytes]):
        self.size = np.array([len(r) for r in raw], np.int64)
        self.at = np.concatenate(([0], np.cumsum(self.size)[:-1]))
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)

    def join(self, ids: np.ndarray) -> np.ndarray:
        n = self.size[ids]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return self.bytes[np.repeat(self.at[ids], n) + inner]


class Aligner:
    """Both tokenizers of one worker."""

    def __init__(self, path_a: str, path_b: str, alike: list[tuple[int, int]]):
        import sentencepiece
        self.path_a, self._slow = path_a, None
        self.fast = _fast_encoder(path_a) if alike else None
        self.odd = re.compile("[^" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b - 1))}" for a, b in alike) + "]").search if alike else None
        self.run = re.compile(r"\s{%d}" % LONG_RUN).search
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path_b)
        strings = _byte_strings(path_a)
        raw_a = [b""] * (max(strings.values()) + 1)
        for s, i in strings.items():
            raw_a[i] = s
        raw_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) or sp.is_unknown(i) else p.replace("▁", " ").encode()
                 for i, p in ((i, sp.id_to_piece(i)) for i in range(sp.get_piece_size()))]
        self.a, self.b = _Side(raw_a), _Side(raw_b)
        self.signs = np.array([f"{i}{c}" for n, c in ((len(raw_a), ","), (len(raw_a), "|"), (len(raw_b), ","), (len(raw_b), ";"))
                               for i in range(n)], object)

    def encode_a(self, text: str) -> np.ndarray:
        # beyond the proof, and on runs of white space that a backtracking splitter may refuse, the library decides
        if self.fast is None or not text.isascii() and self.odd(text) or self.run(text):
            if self._slow is None:
                from tokenizers import Tokenizer
                self._slow = Tokenizer.from_file(self.path_a)
                self._slow.encode_special_tokens = True
            return np.array(self._slow.encode(text, add_special_tokens=False).ids, np.int64)
        return self.fast(text)

    def align(self, texts: list[str]):
        """(n_a, n_b, n_groups, n_links, digests, text of every link, pair of every link)."""
        spaced = [" " + t for t in texts]
        raw = [s.encode() for s in spaced]
        size = np.array([len(r) for r in raw], np.int64)
        ids = [[self.encode_a(s) for s in spaced], [np.array(x, np.int64) for x in self.sp.encode(texts)]]
        good = np.ones(len(texts), bool)
        for side, rows in zip((self.a, self.b), ids):
            for i, x in enumerate(rows):
                # a text that starts with its own space mark has one more byte than it gave
                good[i] &= side.size[x].sum() == size[i] and side.join(x).tobytes() == raw[i]
        keep = np.flatnonzero(good & (size > 1))
        zeros = [np.zeros(len(texts), np.int64) for _ in range(4)]
        digests = [""] * len(texts)
        if not len(keep):
            return *zeros, digests, np.zeros(0, np.int64), np.zeros(0, np.int64)
        (a, n_a), (b, n_b) = ((np.concatenate([rows[i] for i in keep]), np.array([len(rows[i]) for i in keep])) for rows in ids)
        total = int(size[keep].sum())
        end_a, end_b = np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b])
        at_a, at_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        at_a[end_a], at_b[end_b] = True, True
        last_a, last_b = at_b[end_a], at_a[end_b]
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        ends = np.flatnonzero(at_a | at_b)
        link_a, link_b = ((np.cumsum(x, dtype=np.int32) - x)[ends] for x in (at_a, at_b))
        text_of = np.repeat(np.arange(len(keep)), n_a)
        link_text = text_of[link_a]
        n_groups = np.bincount(text_of[last_a], minlength=len(keep))
        first_b = np.concatenate(([0], np.flatnonzero(last_b) + 1))
        first_a = np.concatenate(([0], np.flatnonzero(last_a) + 1))
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + first_b[group_a]] = a + last_a * len(self.a.size)
        order[np.arange(len(b)) + first_a[group_b + 1]] = b + 2 * len(self.a.size) + last_b * len(self.b.size)
        cut = np.concatenate(([0], np.cumsum(n_a + n_b))).tolist()
        for i, lo, hi in zip(keep.tolist(), cut, cut[1:]):
            digests[i] = hashlib.sha256("".join(self.signs[order[lo:hi]].tolist())[:-1].encode()).hexdigest()
        for out, x in zip(zeros, (n_a, n_b, n_groups, np.bincount(link_text, minlength=len(keep)))):
            out[keep] = x
        return *zeros, digests, keep[link_text], a[link_a] << _B_BITS | b[link_b]


_WORKER: dict = {}


def _aligner(path_a, path_b, alike) -> Aligner:
    if (path_a, path_b) not in _WORKER:
        _WORKER[path_a, path_b] = Aligner(path_a, path_b, alike)
    return _WORKER[path_a, path_b]


def _align(path_a, path_b, alike, block_bytes):
    schema = _schema(_ALIGNED)
    names = [c.split()[0] for c in _TEXTS.split(", ")]

    def row(n, **cols):
        return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type) for f in schema], schema=schema)

    def run(batches):
        aligner, part = _aligner(path_a, path_b, alike), TaskContext.get().partitionId()
        held, size, seq = [], 0, 0

        def flush():
            block = (part << 32) + seq
            pairs, code = np.unique(np.concatenate([h["pairs"] for h in held]), return_inverse=True)
            docs = np.bincount(code, np.concatenate([np.repeat(h["copies"], h["n_pairs"]) for h in held]), len(pairs)).astype(np.int64)
            lo = 0
            for h in held:
                mine = code[lo:lo + len(h["pairs"])]
                lo += len(mine)
                step = np.diff(mine, prepend=0)
                starts = (np.cumsum(h["n_pairs"]) - h["n_pairs"])[h["n_pairs"] > 0]
                step[starts] = mine[starts]
                yield row(1, **{"block": [block], "codes": [_pack(step)], "mults": [_pack(h["mults"])]}
                          | {n: [h[n]] for n in names if n in h and n not in ("codes", "mults")})
            for lo in range(0, len(pairs), 1 << 16):
                p = pairs[lo:lo + (1 << 16)]
                yield row(len(p), block=np.full(len(p), block), code=np.arange(lo, lo + len(p)), a=p >> _B_BITS,
                          b=p & ((1 << _B_BITS) - 1), docs=docs[lo:lo + len(p)])

        for batch in batches:
            for c in tu.chunks(batch, "text", CHUNK_BYTES):
                n_a, n_b, n_groups, n_links, shas, text, pair = aligner.align(c.column("text").to_pylist())
                both, mults = np.unique((text << 40) | pair, return_counts=True)
                held.append({"keys": c.column("key").to_pylist(), "copies": c.column("n").to_numpy(zero_copy_only=False), "n_a": n_a, "n_b": n_b,
                             "n_groups": n_groups, "n_links": n_links, "shas": shas, "pairs": both & ((1 << 40) - 1), "mults": mults,
                             "n_pairs": np.bincount(both >> 40, minlength=c.num_rows)})
                size += int(c.column("text").nbytes)
                if size >= block_bytes:
                    yield from flush()
                    held, size, seq = [], 0, seq + 1
        if held:
            yield from flush()
    return run


def _measure(batches):
    """Measures of the texts of sorted blocks: the block's pair counts come first."""
    schema = _schema(_MEASURES)
    block, got, table = None, [], None
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        texts = batch.column("codes").is_valid().to_numpy(zero_copy_only=False)
        cut = [0, *(np.flatnonzero((np.diff(blocks) != 0) | np.diff(texts.astype(np.int8)).astype(bool)) + 1).tolist(), len(blocks)]
        for lo, hi in zip(cut, cut[1:]):
            if hi == lo:
                continue
            if blocks[lo] != block:
                block, got, table = blocks[lo], [], None
            part = batch.slice(lo, hi - lo)
            if not texts[lo]:
                got.append((part.column("code").to_numpy(), part.column("docs").to_numpy(), part.column("best").to_numpy(zero_copy_only=False)))
                continue
            if table is None and got:
                code, docs, best = (np.concatenate(x) for x in zip(*got))
                table = np.empty(len(code), np.int64), np.empty(len(code), np.int64)
                table[0][code], table[1][code] = docs, best
                got = []
            for r in part.to_pylist():
                n = np.array(r["n_pairs"], np.int64)
                total = int(n.sum())
                sums = []
                if total:
                    step, mults = _unpack(r["codes"], total).astype(np.int64), _unpack(r["mults"], total).astype(np.int64)
                    run = np.cumsum(step)
                    first = np.cumsum(n) - n
                    code = run - np.repeat(np.concatenate(([0], run))[first], n)
                    for t in table:
                        add = np.concatenate(([0], np.cumsum(mults * t[code])))
                        sums.append(add[first + n] - add[first])
                else:
                    sums = [np.zeros(len(n), np.int64)] * 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, f.type) for x, f in zip((r["keys"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], sums[1], sums[0], r["shas"]), schema)],
                    schema=schema)


def align_texts(docs: DataFrame, id_col: str, text_col: str, path_a: str, path_b: str,
                block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs).  documents: per row the id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256.  pairs: a, b, docs (documents that hold the pair linked) and
    best (the highest of its A id)."""
    spark = docs.sparkSession
    work = Work(spark, "align")
    alike = prove_fast(path_a)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    key = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key")
    full = F.col("text").isNotNull() & (F.col("text") != "")
    distinct = base.filter(full).groupBy("text").agg(F.count("*").alias("n")).select("text", "n", key)
    rows = work.keep(distinct.mapInArrow(_align(path_a, path_b, alike, block_bytes), _ALIGNED), "aligned")
    owned = rows.filter("code is not null").select("block", "code", "a", "b", "docs")
    counts = owned.groupBy("a", "b").agg(F.sum("docs").alias("docs"))
    # a window holds at most one row per B id
    pairs = work.keep(counts.withColumn("best", F.col("docs") == F.max("docs").over(Window.partitionBy("a"))), "pairs")
    back = owned.drop("docs").join(pairs, ["a", "b"]).select("block", "code", "docs", "best")
    texts = rows.filter("code is null").select(*[c.split()[0] for c in _TEXTS.split(", ")])
    both = back.unionByName(texts, allowMissingColumns=True)
    measures = work.keep(both.repartition("block").sortWithinPartitions("block", F.col("codes").isNotNull())
                         .mapInArrow(_measure, _MEASURES), "measures")
    work.drop("aligned")
    cols = [c.split()[0] for c in _MEASURES.split(", ")[1:]]
    some = base.filter(full).select("doc_id", key).join(measures, "key").select("doc_id", *cols)
    none = base.filter(~F.coalesce(full, F.lit(False))).select("doc_id", *[F.lit(0).cast("long").alias(c) for c in cols[:-1]], F.lit("").alias(cols[-1]))
    return some.unionAll(none).withColumnRenamed("doc_id", id_col), pairs
