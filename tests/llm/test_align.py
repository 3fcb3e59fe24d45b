"""Cross-tokenizer alignment against brute force over all token pairs."""

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from sluice.llm import align, queries

COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [None, "", " ", "   ", "\n", "one", "a<|endoftext|> b <s></s><unk>", "▁ mark", "mark▁", "x\ny\n\n  z\t\t!", "Ünï çödé 漢字 😀 ́ ١٢٣ Ⅷ ﻿ ​",
       "naïve café's we'll don't I'M", "a" * 3000, "é" * 500, "\x00 \x01", "　  x", "<0x41> b", "日本語のテキスト", "\U0001d400 \U000e0001"]


def brute(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path("piece_bpe_32k.model"))
    letters = {c: b for b, c in align._LETTER.items()}
    bytes_a = {i: bytes(letters[c] for c in s) for s, i in tok.get_vocab(with_added_tokens=False).items()}

    def bytes_b(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    links, out = [], []
    for d, t in rows:
        t = t or ""
        want = (" " + t).encode()
        a, b = tok.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)
        ends = []
        for ids, raw in ((a, bytes_a.get), (b, bytes_b)):
            at, e = 0, []
            for i in ids:
                at += len(raw(i))
                e.append(at)
            ends.append(e)
        if not t or any(b"".join(map(f, ids)) != want for f, ids in ((bytes_a.get, a), (bytes_b, b))):
            links.append([])
            out.append((d, 0, 0, 0, 0, ""))
            continue
        pairs, j = [], 0
        span = [list(zip([0, *e], e)) for e in ends]
        for (lo, hi), i in zip(span[0], a):
            while j and span[1][j][0] > lo:
                j -= 1
            while span[1][j][1] <= lo:
                j += 1
            k = j
            while k < len(b) and span[1][k][0] < hi:
                pairs.append((i, b[k]))
                k += 1
        both = sorted(set(ends[0]) & set(ends[1]))
        parts, x, y = [], 0, 0
        for e in both:
            p, q = x, y
            while x < len(a) and ends[0][x] <= e:
                x += 1
            while y < len(b) and ends[1][y] <= e:
                y += 1
            parts.append(",".join(map(str, a[p:x])) + "|" + ",".join(map(str, b[q:y])))
        links.append(pairs)
        out.append((d, len(a), len(b), len(both), len(pairs), hashlib.sha256(";".join(parts).encode()).hexdigest()))
    docs = collections.Counter(p for ps in links for p in set(ps))
    top = collections.defaultdict(int)
    for (i, _), n in docs.items():
        top[i] = max(top[i], n)
    return sorted((*o[:5], sum(docs[p] == top[p[0]] for p in ps), sum(docs[p] for p in ps), o[5]) for o, ps in zip(out, links)), docs


@pytest.mark.parametrize("block", [align.BLOCK_BYTES, 2000])
def test_alignment(spark, block):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(ODD)]
    rows += [(20_000 + i, "a third of all documents are this one, 漢字") for i in range(100)] + [(20_000, "a third of all documents are this one, 漢字")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash")).withColumn("n", F.lit(9))
    got, pairs = align.align_texts(docs, "doc_id", "text", queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model"), block)
    want, counts = brute(rows)
    assert sorted(map(tuple, got.select(*COLS).collect())) == want
    assert {(r.a, r.b): r.docs for r in pairs.collect()} == counts


def test_no_documents(spark):
    for rows in ([], [(1, None), (2, "")]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got, _ = align.align_texts(docs, "doc_id", "text", queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model"))
        assert sorted(map(tuple, got.select(*COLS).collect())) == [(i, 0, 0, 0, 0, 0, 0, "") for i, _ in rows]


def test_long_texts():
    p = queries.tokenizer_path("byte_bpe_50k.json")
    a = align.Aligner(p, queries.tokenizer_path("piece_bpe_32k.model"), align.prove_fast(p))
    for t in (" " * 1_000_000, "a" * 1_000_000, "word " * 200_000, "\n" * 300_000 + "x", "漢" * 100_000):
        n_a, n_b, n_groups, n_links, digests, text, pair = a.align([t, "x"])
        assert n_links[0] == n_a[0] + n_b[0] - n_groups[0] and n_links[0] == (text == 0).sum() and digests[1]
