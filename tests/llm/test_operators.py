"""The training-data operators against brute force on small tables."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import ann, decontam, html_wrap, line_dedup, piece_codec, pyp_lm, queries, shards, textutil, token_count
from sluice.llm.cotrain import classify
from sluice.llm.jaccard import jaccard_components
from sluice.llm.work import BATCH, Work

SF = "/root/testdata/sf0.001"
ODD = [None, "", "   ", "one", "one two", "a" * 3000, "x\ny\nx", "Ünï çödé 漢字 😀", "a  b   c ", "▁ mark"]


def _lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def _words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", _lower(t))


@pytest.fixture(scope="module")
def docs(spark):
    """The small documents, the odd texts, copies and near copies, a clashing column."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(ODD)]
    long = " ".join(f"w{i}" for i in range(60))
    rows += [(20_000 + i, long) for i in range(3)] + [(20_000, long)]
    rows += [(20_100 + i, long.replace(f"w{i * 30}", "other")) for i in range(2)] + [(20_200, long + " tail end")]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("clash"))


def _rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
def test_jaccard_components(docs, width, percent):
    rows = _rows(docs)
    sets = []
    for _, t in rows:
        w = _words(t)
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width
                    else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[root(i)] = min(d, low.get(root(i), d))
    want = sorted((d, len(sets[i]), low[root(i)]) for i, (d, _) in enumerate(rows))
    got = jaccard_components(docs, "doc_id", "text", width, percent)[0]
    assert sorted(map(tuple, got.select("id", "n_shingles", "component_id").collect())) == want


def test_token_counts(docs):
    from tokenizers import Tokenizer
    path = queries.tokenizer_path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    want = sorted((d, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for d, t in _rows(docs))
    got = token_count.count_tokens(docs, "doc_id", "text", path)
    assert sorted(tuple(r)[:3] for r in got.collect()) == want


def test_special_string_counts_as_one(spark):
    from tokenizers import Tokenizer
    path = queries.tokenizer_path("byte_bpe_50k.json")
    text = "a<|endoftext|> b<|endoftext|>"
    got = token_count.count_tokens(spark.createDataFrame([(1, text)], "doc_id long, text string"), "doc_id", "text", path)
    assert got.first().n_tokens == len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)


def test_piece_codec(docs):
    import sentencepiece
    path = queries.tokenizer_path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    got = piece_codec.decode(piece_codec.encode(docs, "text", path), "piece_ids", path).collect()
    for r in got:
        assert r.piece_ids == sp.encode(r.text or "")
        assert r.decoded == (r.text or "").replace("▁", " ")


def test_space_runs():
    import sentencepiece
    path = queries.tokenizer_path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [" " * k + w for k in range(40) for w in ("", "the", "漢")]
    assert [np.frombuffer(x, np.int32).tolist() for x in piece_codec.model(path).encode(texts)] == sp.encode(texts)


@pytest.mark.parametrize("block", [decontam.BLOCK_WORDS, 50])
def test_decontamination(spark, docs, block, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", block)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").unionAll(
        spark.createDataFrame([(900, "one two"), (901, "ONE, two"), (902, None), (None, "one"), (903, "...")], "item_id long, text string"))
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(t))
    win = collections.defaultdict(set)
    for i, t in bench.dropna().collect():
        w = word(t)
        k = min(10, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            win[tuple(w[j:j + k])].add(i)
    found = decontam.find_contamination(docs, "text", bench, "item_id", "text")
    for r in found.collect():
        w, hit, items = word(r.text), set(), set()
        for k in {len(x) for x in win}:
            for j in range(len(w) - k + 1):
                if tuple(w[j:j + k]) in win:
                    items |= win[tuple(w[j:j + k])]
                    hit.update(range(j, j + k))
        assert (r.n_words, set(r.hit_items)) == (len(w), items)
        assert {x for a, b in r.hit_spans for x in range(a, b)} == hit
    cut = {r.doc_id: r.text for r in decontam.cut_spans(found, "text").collect()}
    assert cut[10_004] == "" and cut[10_000] is None


def test_items_digest():
    assert decontam.items_digest([]) == hashlib.sha256(b"").hexdigest()


def test_sharding(docs):
    got = shards.shard_rows(docs, 16, seed=1, block_rows=16, cell_rows=4).collect()
    assert len(got) == docs.count()
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    sizes = [len(v) for v in by.values()]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in by.values())


def test_matrix_adds_up():
    sizes, cols = np.array([5, 0, 9, 3]), np.array([6, 6, 5])
    m = np.array([shards.matrix_row(shards._upto(sizes), cols, b, 3) for b in range(4)])
    assert (m.sum(1) == sizes).all() and (m.sum(0) == cols).all()


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert shards.shard_rows(none, 16).count() == 0
    assert jaccard_components(none, "doc_id", "text")[0].count() == 0
    assert line_dedup.dedup_lines(none, "doc_id", "text").count() == 0
    assert pyp_lm.score_texts(none, "doc_id", "text").count() == 0
    assert classify(none, spark.createDataFrame([], "doc_id long, quality int")).count() == 0


def test_nearest(spark):
    rng = np.random.default_rng(0)
    v = rng.standard_normal((300, 24))
    v[7] = v[8] = v[9]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(900, None), (920, [0.0] * 24), (940, [float("nan")] * 24)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, e array<float>"), "vec_id", "e", F.col("vec_id") % 20 == 0, 20)
    v = v.astype(np.float32).astype(np.float64)
    by = collections.defaultdict(list)
    for r in got.orderBy("query_id", "rank").collect():
        by[r.query_id].append((r.vec_id, r.score))
    assert sorted(by) == list(range(0, 300, 20))
    for q, hits in by.items():
        s = ann.exact(v, v[q])
        want = [i for i in np.lexsort((np.arange(300), -s)) if i != q][:20]
        assert hits == [(i, s[i]) for i in want]


def test_nearest_of_repeated_rows(spark):
    rng = np.random.default_rng(5)
    v = rng.standard_normal((90, 8))
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    # a query that comes three times, a candidate that comes twice, an id with two vectors, a null id
    rows += [rows[20]] * 2 + [rows[33], (40, rows[1][1]), (None, rows[2][1])]
    df = spark.createDataFrame(rows, "vec_id long, e array<double>").withColumn("own", F.lit("x")).repartition(7)
    got = ann.nearest(df, "vec_id", "e", F.col("vec_id") % 20 == 0, 20).collect()
    once = sorted({(i, tuple(x)) for i, x in rows if i is not None})
    want = []
    for i, q in once:
        if i % 20 == 0:
            best = sorted((-float(ann.exact(np.array([x]), np.array(q))[0]), j) for j, x in once if (j, x) != (i, q))[:20]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(want)
    none = spark.createDataFrame([], "vec_id long, e array<float>")
    assert ann.nearest(none, "vec_id", "e", F.col("vec_id") % 20 == 0).count() == 0


def test_nearest_scores_what_the_bounds_leave(spark):
    rng = np.random.default_rng(6)
    v = rng.standard_normal((3000, 16)) * 10.0 ** rng.integers(-3, 4, 3000)[:, None]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, e array<double>")
    got = collections.defaultdict(list)
    for r in ann.nearest(df, "vec_id", "e", F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    for q in range(0, 3000, 20):
        s = ann.exact(v, v[q])
        assert got[q] == [i for i in np.lexsort((np.arange(3000), -s)) if i != q][:20]


def test_sharding_keeps_any_names_and_rows(spark):
    df = spark.createDataFrame([(i // 3, None if i % 7 else "x", i % 5) for i in range(2000)],
                               "_key long, `_block` string, `_cell` int")
    df = df.withColumn("_first", F.lit(1)).withColumn("a.b", F.col("_cell")).withColumn("Shard", F.lit("old"))
    got = shards.shard_rows(df, 16, seed=2, block_rows=64, cell_rows=8)
    assert got.columns == ["_key", "_block", "_cell", "_first", "a.b", "shard", "slot"]
    rows = [tuple(r) for r in got.collect()]
    assert sorted(map(str, (r[:5] for r in rows))) == sorted(str((*r[:5],)) for r in map(tuple, df.collect()))
    assert sorted(r[5:] for r in rows) == [(s, k) for s in range(16) for k in range(125)]


def test_sharding_is_a_uniform_shuffle(spark):
    """Over many seeds every row comes to every shard, and to both halves of it, equally often."""
    df = spark.range(240).withColumn("w", F.lit("w")).coalesce(1)
    seen = np.zeros((240, 4, 2))
    for seed in range(8):
        for r in shards.shard_rows(df, 4, seed=seed, block_rows=40, cell_rows=10).collect():
            seen[r.id, r.shard, r.slot // 30] += 1
    # 8 draws of one in eight; rows are alike, so the spread over 1920 cells is binomial
    assert seen.sum() == 1920 and abs(seen.var() - 7 / 8) < 0.15 and seen.max() <= 8


def test_matrix_of_many_blocks_is_quick():
    upto = shards._upto(np.full(1 << 21, 7))
    m = [shards.matrix_row(upto, np.full(16, 7 << 17), b, 3) for b in range(0, 1 << 21, 1 << 12)]
    assert all(r.sum() == 7 for r in m)


def test_sharding_query(spark):
    got = queries.op7_sharding(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    raw = {d: (t or "").encode() for d, t in docs.items()}
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted(
        (d, len(b) + 1, zlib.crc32(b)) for d, b in raw.items())
    assert {r.law for r in got} == {"rows"}


def test_banded_distance(spark):
    pairs = [("kitten sitting there", "kitten sittin here"), ("abcdefghij", "abcdefghij"), ("abcdefghij", "bcdefghija"),
             ("aaaaabbbbb", "aaaacbbbb"), ("hello world éa", "hello wurld ea"), ("xyz" * 30, "xyz" * 29 + "x")]
    df = spark.createDataFrame([p if len(p[0]) >= len(p[1]) else p[::-1] for p in pairs], "l string, s string")
    df = df.withColumn("cl", F.split("l", "")).withColumn("cs", F.split("s", ""))
    df = df.select((line_dedup.banded_distance("cl", "cs", 2) <= 2).alias("near"), (F.levenshtein("l", "s") <= 2).alias("want"))
    assert all(r.near == r.want for r in df.collect())


def test_line_dedup(spark):
    line = "a line that is long enough to count here"
    rows = [(1, f"{line}\nshort\nonly in the first document, once"), (2, f"short\n{line}x"), (3, f"{line[:-1]}\n{line}"),
            (4, None), (5, ""), (6, "a line that is quite different from them"), (None, "null id keeps its own line, surely")]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in
           line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()}
    assert got[1] == (rows[0][1], 3, 0)
    assert got[2] == ("", 2, 2)  # an equal line leaves at any length
    assert got[3] == ("", 2, 2)
    assert got[4] == (None, 0, 0) and got[5][0] == "" and got[6][2] == 0 and got[None][2] == 0


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def _lines_left(rows):
    """Brute force over all pairs of lines: (id, text, removed) of every distinct row."""
    rows = sorted(set(rows), key=lambda r: (r[0] is not None, r[0]))
    lines = list(dict.fromkeys(x for _, t in rows if t for x in t.split("\n") if x.strip(" \t\r")))
    label = {x: x for x in lines}
    for i, x in enumerate(lines):
        for y in lines[:i]:
            if label[x] != label[y] and min(len(x), len(y)) >= line_dedup.MIN_CHARS and _distance(x, y) <= 2:
                old, new = label[x], label[y]
                label = {k: new if v == old else v for k, v in label.items()}
    seen, out = set(), []
    for d, t in rows:
        kept = []
        for x in t.split("\n") if t else []:
            if x in label and label[x] in seen:
                continue
            seen.add(label.get(x))
            kept.append(x)
        n = len(t.split("\n")) if t is not None else 0
        out.append((d, None if t is None else "\n".join(kept), n, n - len(kept) if t else 0))
    return out


def test_line_dedup_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefgh  éß漢"))
    base = ["".join(rng.choice(letters, n)) for n in (20, 21, 22, 30, 41, 90) for _ in range(4)]

    def changed(line):
        x = list(line)
        for _ in range(int(rng.integers(0, 5))):
            i = int(rng.integers(0, len(x)))
            x[i:i + int(rng.integers(0, 2))] = rng.choice(letters, int(rng.integers(0, 2))).tolist()
        return "".join(x)
    pool = base + [changed(b) for b in base for _ in range(4)] + ["", "  ", "short", "short.", "x" * 4000]
    rows = [(int(i), "\n".join(rng.choice(pool, int(rng.integers(1, 7))))) for i in range(60)]
    rows += [(5, None), (None, base[0]), (61, "")]
    df = spark.createDataFrame(rows + rows[:3], "doc_id long, text string").withColumn("n_removed", F.lit("clash"))
    got = {(r.doc_id, r.text, r.n_lines, r.n_removed)
           for r in line_dedup.dedup_lines(df, "doc_id", "text").collect()}
    assert line_dedup.dedup_lines(df, "doc_id", "text").count() == len(rows) + 3
    # rows of one id are ordered by a hash of their text, so the two rows of id 5 stand alone
    assert got == set(_lines_left(rows))


def test_line_dedup_of_a_hot_line(spark):
    """One line in every row and near copies of it: the first row keeps it."""
    line = "this line stands in every single row of the table"
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(
        F.lit(line), F.when(F.col("id") % 3 == 0, "!").otherwise(""), F.lit("\n"),
        F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    got = line_dedup.dedup_lines(df, "doc_id", "text")
    assert got.filter("n_removed = 0").select("doc_id").collect() == [(0,)]
    assert got.filter("n_removed = 1 and length(text) = 64").count() == 3999


def test_pitman_yor(docs):
    rows = _rows(docs)
    tok = {(d, t): _words(t) + [None] for d, t in rows}
    held = lambda d: zlib.crc32(str(d).encode()) % 10 == 0
    c = collections.Counter(w for d, t in rows if not held(d) for w in tok[d, t])
    total = sum(c.values())
    got = pyp_lm.score_texts(docs, "doc_id", "text").collect()
    want = sorted((d, held(d), len(tok[d, t]), sum(c[w] > 0 for w in tok[d, t]), total) for d, t in rows)
    assert sorted(tuple(r)[:5] for r in got) == want
    base = sorted((d, sum(math.log10((c[w] + .1) / (total + .1 * (len(c) + 1))) for w in tok[d, t])) for d, t in rows)
    assert np.allclose([b for _, b in base], [b for _, b in sorted((r.doc_id, r.base_score) for r in got)])
    assert all(r.score < 0 for r in got)


def test_seating_is_a_partition():
    c = np.array([0, 1, 2, 5, 400, 100_000])
    t = pyp_lm.seat(np.random.default_rng(1), c, 50.0, np.full(6, 0.01), 0.6)
    assert t[0] == 0 and t[1] == 1 and (t[c > 0] >= 1).all() and (t <= c).all() and t[4] < 400


def test_html():
    page = ("<html><head><title>t</title><style>p{}</style><script>var a='</p>';</script></head><body><nav><a>m</a></nav>"
            "<div class='cookie-notice'>ok?</div><article><h1>Head &amp; more</h1><p><b>One\n two<br><p>Three</p>"
            "<div class='ad'>buy</div><form>f</form><section id='comments'><p>nice</p></section></article>"
            "<aside>s</aside><footer>&copy;</footer>")
    assert html_wrap.extract(page, None) == "Head & more\nOne two\nThree"
    assert html_wrap.extract(None, None) == "" and html_wrap.extract("plain  text", None) == "plain text"


def test_html_wrapper_finds_the_main_group():
    pages = [f"<body><div class='top'><a>home</a></div><div class='c'><p>{'text ' * (20 + i)}</p><p>b {i}</p></div><div class='f'>same</div>"
             for i in range(6)]
    w = html_wrap.wrapper(html_wrap.parse(pages[0]))
    for p in pages[1:]:
        html_wrap._fold(w, html_wrap.wrapper(html_wrap.parse(p)))
    rule = html_wrap._rule(w)
    assert html_wrap.extract(pages[3], rule) == ("text " * 23).strip() + "\nb 3"


def test_quality_holds_on_unseen_labels(spark):
    out = queries.op3_quality(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    both = out.join(labels, "doc_id").collect()
    assert sum(r.keep == (r.quality == 1) for r in both) >= 0.95 * len(both)


def test_pipeline(spark):
    import corpus_pipeline
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_pieces", "piece_ids"] and 0 < out.count()


def test_lm_knows_the_word_before(spark):
    held = [i for i in range(1000, 1200) if zlib.crc32(str(i).encode()) % 10 == 0][:4]
    train = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10]
    texts = ["red apple red apple red apple", "blue cloud blue cloud blue cloud"]
    rows = [(i, texts[k % 2]) for k, i in enumerate(train)]
    asked = ["red apple", "red cloud", "blue cloud", "blue apple"]
    df = spark.createDataFrame(rows + list(zip(held, asked)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in pyp_lm.score_texts(df, "doc_id", "text").collect()}
    s = [got[i].score for i in held]
    assert all(got[i].held_out for i in held)
    # the same words in another order of contexts: only word contexts tell them apart
    assert s[0] - s[1] > 1 and s[2] - s[3] > 1
    # P(red | start) is a half, P(apple | red) near one, P(end | apple) a third
    assert abs(s[0] - math.log10(0.5 * 1 / 3)) < 0.2


def _by_host(pages):
    w = html_wrap.wrapper(html_wrap.parse(pages[0]))
    for p in pages[1:]:
        html_wrap._fold(w, html_wrap.wrapper(html_wrap.parse(p)))
    return [html_wrap.extract(p, html_wrap._rule(w)) for p in pages]


def test_html_template_is_told_by_whole_texts():
    note = "<div>All rights reserved.</div>"
    # a div that agrees in 200 characters and differs later
    pages = [f"<article><h1>t {i}</h1><div>{'same ' * 60}end {i}</div></article>" for i in range(6)]
    assert all(got.endswith(f"end {i}") for i, got in enumerate(_by_host(pages)))
    # copies of one article, menus around it differ
    pages = [f"<div>m {i}</div><article><h1>t</h1><div>the body</div></article>" for i in range(6)]
    assert _by_host(pages) == ["t\nthe body"] * 6
    # a fixed div before a variable one of the same path; the fixed one leaves
    pages = [f"<article>{note}<p>a {i}</p><div>body {i}</div></article>" for i in range(6)]
    assert _by_host(pages) == [f"a {i}\nbody {i}" for i in range(6)]
    # links of the text stay, marked ones leave
    pages = [f"<article><p>a {i}</p><ul><li><a>source</a></li></ul><ul class='menu'><li><a>x</a></li></ul></article>"
             for i in range(6)]
    assert _by_host(pages) == [f"a {i}\nsource" for i in range(6)]


def test_html_of_any_depth_and_broken_tags():
    import time
    start = time.time()
    for tag in ("div", "b", "span", "li"):
        for page in (f"<{tag}>" * 100_000 + "end", f"<article>{f'<{tag}>' * 100_000}end{f'</{tag}>' * 100_000}tail</article>"):
            assert html_wrap.extract(page, None).startswith("end")
    assert html_wrap.extract(f"<article>{'<div>a' * 300}{'b</div>' * 300}</article>", None).split() == \
        ["a"] * 299 + ["ab"] + ["b"] * 299
    # boilerplate below the depth stays out
    assert html_wrap.extract(f"<article>{'<div>' * 300}x<div class='ad'>buy<p>now</div>y", None).split() == ["x", "y"]
    for bad in ("<a ", "<a x=", "<a x='", '<a x="', "<script ", "<!--", "<li><div>", "<p><table><div>", "</p>", "<a href='x\">"):
        html_wrap.extract("<p>text</p>" + bad * 30_000, None)
    assert html_wrap.extract("<p>text</p>" + "<a " * 30_000, None) == "text"
    assert time.time() - start < 40


def test_html_attribute_values_and_formulas():
    assert html_wrap.extract("<article><p title='a > b' x=\"c>d\">one <i a=b>two</i></article>", None) == "one two"
    assert html_wrap.extract("<article><p>if <math><mi>x</mi><mo>=</mo><mn>2</mn></math> then</article>", None) == "if x=2 then"


def test_html_wrapper_is_bounded():
    name = lambda i: "".join(chr(97 + (i * 7919 >> s) % 26) for s in (0, 3, 6, 9, 12))
    pages = [f"<body><div class='top'><a>home</a></div><article><h1>t {i}</h1>"
             + "".join(f"<div class='{name(50 * i + j)}'><p>text {i} {j}</p></div>" for j in range(50))
             + "</article><div class='end'>same</div>" for i in range(400)]
    w = html_wrap.wrapper(html_wrap.parse(pages[0]))
    for p in pages[1:]:
        html_wrap._add(w, html_wrap.wrapper(html_wrap.parse(p)))
        assert html_wrap._size(w) <= html_wrap.NODES
    rule = html_wrap._rule(w)
    want = lambda i: "\n".join([f"t {i}", *(f"text {i} {j}" for j in range(50))])
    assert all(html_wrap.extract(p, rule) == want(i) for i, p in enumerate(pages[::40]) for i in [40 * i])
    # a page of more different children than a node may have keeps its whole text
    page = "<article>" + "".join(f"<div class='{name(j)}'>w{j}</div>" for j in range(3000)) + "</article>"
    assert html_wrap.extract(page, None).split() == [f"w{j}" for j in range(3000)]


def test_html_pages_table(spark):
    rows = [(1, "http://a/x", None), (2, None, ""), (3, "", "<p>b</p>"), (3, "", "<p>b</p>"), (None, "http://a/y", "<p>c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("z")).withColumn("rule", F.lit(1))
    got = html_wrap.extract_pages(df).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [
        (1, "http://a/x", "", 0), (2, None, "", 0), (3, "", "b", 1), (3, "", "b", 1), (None, "http://a/y", "c", 1)]))
    assert html_wrap.extract_pages(df.limit(0)).count() == 0


def test_codec_forgets_between_tasks_and_bounds_its_memo(monkeypatch):
    import sentencepiece
    path = queries.tokenizer_path("piece_bpe_32k.model")
    sp, m = sentencepiece.SentencePieceProcessor(model_file=path), piece_codec.model(path)
    m.forget()
    monkeypatch.setattr(piece_codec, "MEMO_BYTES", 20_000)
    texts = [" ".join(f"word{i * k}" for i in range(40)) for k in range(1, 40)]
    for t in texts:
        assert np.frombuffer(m.encode([t])[0], np.int32).tolist() == sp.encode(t)
        assert m.held == sum(map(piece_codec._entry, m.memo.items())) < 20_000 + 2 * 40 * 220
    m.forget()
    assert not m.memo and not m.held


def test_codec_solves_a_word_once_beside_any_marks_and_all_lengths_together(monkeypatch):
    import sentencepiece
    path = queries.tokenizer_path("piece_bpe_32k.model")
    sp, m = sentencepiece.SentencePieceProcessor(model_file=path), piece_codec.model(path)
    m.forget()
    calls, solve = [], m._solve
    monkeypatch.setattr(m, "_solve", lambda words, *more: calls.append(len(words)) or solve(words, *more))
    words = ["retion", "thonheretions", "a", "приветствие"]
    texts = [w + mark for w in words for mark in ("", ".", ",", "?!", "1", "漢字", "%%%", "\U0001f600")] + ["漢字获取数据" * 3000]
    assert [x.tolist() for x in map(lambda i: np.frombuffer(i, np.int32), m.encode(texts))] == sp.encode(texts)
    assert len(calls) == 1 and calls[0] < 25
    m.forget()


def test_codec_equals_the_library_on_mixed_scripts():
    import random
    import sentencepiece
    path = queries.tokenizer_path("piece_bpe_32k.model")
    sp, m = sentencepiece.SentencePieceProcessor(model_file=path), piece_codec.model(path)
    rng = random.Random(5)
    parts = [*(m.pieces[i].replace("▁", " ") for i in m.split), *" \n\t.,-'▁é0\0", "  ", "\U0001f600", "\u200b"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(3000)]
    assert [np.frombuffer(i, np.int32).tolist() for i in m.encode(texts)] == sp.encode(texts)
    m.forget()


@pytest.mark.parametrize("step", [None, np.uint64(1)])  # 1: words of the same letters have one hash
def test_codec_compares_units_of_one_hash(monkeypatch, step):
    m = piece_codec.model(queries.tokenizer_path("piece_bpe_32k.model"))
    monkeypatch.setattr(piece_codec, "UNITS", 3)
    if step:
        monkeypatch.setattr(piece_codec, "_P", step)
    words = ["▁ab", "▁ba", "▁ab", ",", "▁▁▁x", "1", "1", "▁bc", "▁▁▁x", "▁ad"]
    whole = "".join(words)
    codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    units, which = m._distinct(whole, codes, m._cut(codes, np.zeros(1, np.int64)))
    assert [units[i] for i in which] == words and len(units) == len(set(words))


def test_matrix_rows_of_large_tables():
    sizes, cols = np.full(8, 5 * 10**9), np.full(16, 25 * 10**8)
    m = np.array([shards.matrix_row(shards._upto(sizes), cols, b, 3) for b in range(8)])
    assert (m.sum(0) == cols).all() and (m.sum(1) == sizes).all() and (m >= 0).all()
    # a draw is within ten deviations of its mean (about 16,000)
    assert abs(m - 5 * 10**9 / 16).max() < 200_000 and m.std() > 1000
    # more rows than numpy takes, counted against its law where both draw
    rng = np.random.default_rng(4)
    got = np.array([shards._by_inversion(rng, 300, 700, 90) for _ in range(4000)])
    want = rng.hypergeometric(300, 700, 90, 4000)
    assert abs(got.mean() - want.mean()) < 0.4 and abs(got.std() - want.std()) < 0.3
    assert shards._by_inversion(rng, 2 * 10**9, 1, 2 * 10**9) in (2 * 10**9 - 1, 2 * 10**9)
    small = [shards._hypergeometric(rng, 2 * 10**9, 6 * 10**9, 4) for _ in range(2000)]
    assert 0 <= min(small) and max(small) <= 4 and abs(np.mean(small) - 1) < 0.1


def test_jaccard_joins_one_band_at_a_time(docs, monkeypatch):
    plans, keep = {}, Work.keep

    def watched(self, df, name, *args, **kw):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return keep(self, df, name, *args, **kw)
    monkeypatch.setattr(Work, "keep", watched)
    jaccard_components(docs.drop("n_words"), "doc_id", "text")[0].count()
    parts = [n for n in plans if n.startswith("parts_0_")]
    assert len(parts) == 4
    for n in parts:
        assert "(band#" in plans[n] and f"= {n[-1]})" in plans[n]
    assert "items" not in plans["links_0"]


def test_batches_to_python_are_bounded_in_bytes(spark):
    import pyarrow as pa

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])
    texts = spark.range(0, 4000, 1, 1).select(F.rpad(F.col("id").cast("string"), 1000, "x").alias("text"))
    before = spark.conf.get(BATCH)
    got = Work(spark, "test").keep(texts.mapInArrow(sizes, "n long"), "sizes", "256k")
    assert spark.conf.get(BATCH) == before
    assert got.agg(F.max("n")).first()[0] < 300_000 and got.agg(F.sum("n")).first()[0] >= 4_000_000


@pytest.mark.parametrize("ends", [True, False])
def test_tasks_give_memory_back(monkeypatch, ends):
    calls = []
    monkeypatch.setattr(textutil, "release", lambda: calls.append(1))
    task = textutil.released(lambda batches: (b for b in batches))(iter([1, 2]))
    assert next(task) == 1 and not calls
    list(task) if ends else task.close()
    assert calls == [1]


def test_lm_messages_are_small_and_come_back_whole():
    few = np.ones(100_000, np.int32)
    some = {"t": few, "hash": np.arange(5, dtype=np.uint64) << np.uint64(60), "none": np.zeros((0, 3), np.float32),
            "two": np.arange(6, dtype=np.float32).reshape(2, 3), "wide": np.array([1 << 40, -3]), "c": few.astype(np.int64)}
    back = pyp_lm._unpack(pyp_lm._pack(**some))
    assert all((back[k] == v).all() and back[k].dtype == v.dtype and back[k].shape == v.shape for k, v in some.items())
    assert len(pyp_lm._pack(t=few)) < 10_000
    x = np.random.default_rng(1).integers(0, 50, 1000)
    for most in (50, 1 << 62):
        assert all((a == b).all() for a, b in zip(pyp_lm._ranked(x, most), np.unique(x, return_inverse=True)))


def test_lm_asks_one_band_at_a_time(spark, docs, monkeypatch):
    tables = []
    keep, drop = pyp_lm.Work.keep, pyp_lm.Work.drop
    monkeypatch.setattr(pyp_lm.Work, "keep", lambda self, df, name, **kw: (tables.append((name, kw)), keep(self, df, name, **kw))[1])
    monkeypatch.setattr(pyp_lm.Work, "drop", lambda self, name: (tables.append((f"-{name}", {})), drop(self, name))[1])
    scores = []
    for bands in (1, 3):
        monkeypatch.setattr(pyp_lm, "BANDS", bands)
        tables.clear()
        scores.append(sorted(tuple(r) for r in pyp_lm.score_texts(docs.repartition(5, "doc_id"), "doc_id", "text", shards=3).collect()))
    assert len(scores[0]) == docs.count() and np.allclose([r[1:] for r in scores[0]], [r[1:] for r in scores[1]])
    names = [name for name, _ in tables]
    assert names[-6:] == ["-state_3", "scores_0", "scores_1", "scores_2", "-known", "-read"]
    assert all(kw["buckets"] == (3, "place") for name, kw in tables if name.startswith(("state_", "known")))
    assert [kw["more"] for name, kw in tables if name == "state_0"] == [False, True]
    # a shard's groups meet messages without a shuffle of the shards
    shelf = pyp_lm.Work(spark, "test").keep(spark.range(10).withColumnRenamed("id", "place"), "t", buckets=(3, "place"))
    both = shelf.groupBy("place").cogroup(docs.select(F.lit(1).cast("long").alias("place")).groupBy("place")).applyInArrow(
        lambda a, b: a, "place long")
    assert both._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1 and both.count() == 10


def test_line_dedup_makes_one_band_at_a_time(spark, monkeypatch):
    tables = []
    keep = line_dedup.Work.keep
    monkeypatch.setattr(line_dedup.Work, "keep", lambda self, df, name, **kw: (tables.append(name), keep(self, df, name, **kw))[1])
    line = "a line of more than twenty characters"
    rows = [(1, f"{line}\nx"), (2, f"{line}!\nx"), (3, f"b{line}\ny"), (4, line[:15] + "#" + line[15:]), (5, f"{line[::-1]}")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", bands=2).collect()
    assert {r.doc_id: r.text for r in got} == {1: f"{line}\nx", 2: "", 3: "y", 4: "", 5: line[::-1]}
    assert tables[:4] == ["distinct_0", "distinct_1", "shared_0", "shared_1"]
