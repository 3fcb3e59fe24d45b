"""Quality classifier by co-training of a text view and a metadata view.

The text view sees how a document is written (shares of character classes, word and
line repetition, word shapes); the metadata view sees its language, source and length
columns.  Both are logistic models fitted on a bounded sample of the labelled rows
(``MAX_LABELLED``, the smallest id hashes).  In each of ``ROUNDS`` rounds every
unlabelled document is scored by both; each view's most confident ``PER_ROUND``
documents (split by the classes' shares) become training rows of the other view, with
its label.  Each task picks its own most confident rows before they are ranked, so
only 2 * PER_ROUND rows a round reach the driver.  A held-back third of the sample
calibrates both views and then weighs them; all documents are scored with the result.

Null text, language or source count as empty; without labels of both classes every
document is kept with score 1.  Several labels of one id: the lowest counts.  Rows
with equal id are scored each.  Ties go to the smaller id hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from . import textutil as tu
from .work import Work

MAX_LABELLED, ROUNDS, PER_ROUND = 9000, 3, 600
SOURCES, LANGS, LENGTHS = 32, 8, 12


def _share(mask: np.ndarray, offs: np.ndarray, n: np.ndarray) -> np.ndarray:
    c = np.concatenate(([0], np.cumsum(mask)))
    return (c[offs[1:]] - c[offs[:-1]]) / np.maximum(1, n)


def text_features(col: pa.Array) -> np.ndarray:
    """One row of features per text."""
    data, offs = tu.text_bytes(col)
    n = np.diff(offs)
    low, s, e, rows = tu.word_spans(data, offs, tu.SPACE_WORDS)
    h = tu.word_hashes(low, s, e)
    words = np.diff(rows)
    upper = (data >= 65) & (data <= 90)
    letter = upper | ((data >= 97) & (data <= 122)) | (data >= 128)
    digit = (data >= 48) & (data <= 57)
    space = tu.SPACE_WORDS[data] == 0
    mark = ~(letter | digit | space)
    plain = np.isin(data, [33, 39, 40, 41, 44, 46, 58, 59, 63, 45])
    out = [_share(m, offs, n) for m in (upper, digit, space, mark & plain, mark & ~plain, data >= 128, data == 10)]
    cu, cm, cl = (np.concatenate(([0], np.cumsum(m))) for m in (upper, mark & ~plain, letter))
    lens = e - s
    word = [(cu[e] - cu[s] > 1), (cm[e] - cm[s] > 0), (cl[e] - cl[s] == 0), lens > 24, lens <= 2,
            (data[e - 1] == 33) if len(e) else np.zeros(0, bool)]
    out += [_share(w, rows, words) for w in word]
    out.append(np.array([a.mean() if len(a) else 0 for a in np.split(lens, rows[1:-1])]) / 10 if len(n) else n * 0.0)
    distinct, top, again = (np.zeros(len(n)) for _ in range(3))
    for k, (a, b) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist())):
        if b > a:
            x = np.sort(h[a:b])
            cut = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1], [True])))
            runs = np.diff(cut)
            distinct[k], top[k] = len(runs) / (b - a), runs.max() / (b - a)
            again[k] = (h[a + 1:b] == h[a:b - 1]).mean() if b - a > 1 else 0
    short = np.maximum(0, 1 - words / 20)
    out += [distinct, top, again, short, np.log1p(words) / 10, distinct * np.log1p(words) / 5]
    x = np.stack(out, 1)
    return np.hstack([x, np.sqrt(np.abs(x))]).astype(np.float32)


def meta_features(lang: list, source: list, length: list) -> np.ndarray:
    """One-hot language, source and length class, from the metadata columns alone."""
    import zlib
    x = np.zeros((len(lang), LANGS + SOURCES + LENGTHS + 1), np.float32)
    rows = np.arange(len(lang))
    size = np.array([np.log2(1 + max(0, v or 0)) for v in length])
    x[rows, [zlib.crc32((v or "").encode()) % LANGS for v in lang]] = 1
    x[rows, [LANGS + zlib.crc32((v or "").encode()) % SOURCES for v in source]] = 1
    x[rows, LANGS + SOURCES + np.clip(size.astype(int) - 4, 0, LENGTHS - 1)] = 1
    x[:, -1] = size / 20
    return x


class Logistic:
    """Ridge logistic regression by Newton steps on standardised features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        z = np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))]).astype(np.float64)
        self.w = np.zeros(z.shape[1])
        pull = np.full(z.shape[1], ridge)
        pull[-1] = 1e-6
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
            grad = z.T @ (y - p) - pull * self.w
            hess = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(pull)
            step = np.linalg.solve(hess, grad)
            self.w += step
            if np.abs(step).max() < 1e-6:
                break

    def odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale @ self.w[:-1] + self.w[-1], -30, 30)


def _features(docs: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            for c in tu.chunks(b, "text"):
                t = text_features(c.column("text"))
                m = meta_features(*(c.column(x).to_pylist() for x in ("lang", "source", "n_chars")))
                yield pa.RecordBatch.from_arrays(
                    [c.column("id"), c.column("label"), pa.array(list(t), pa.list_(pa.float32())),
                     pa.array(list(m), pa.list_(pa.float32()))], ["id", "label", "t", "m"])
    return docs.mapInArrow(tu.released(run), "id long, label int, t array<float>, m array<float>")


def _arrays(batch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _confident(views, used, share):
    """A task's most confident rows: slot 0/1 by the text view, 2/3 by the metadata
    view; odd slots are the good class."""
    quota = [max(1, round(PER_ROUND * (1 - share))), max(1, round(PER_ROUND * share))]

    def run(batches):
        text, meta = views.value
        best: list[list] = [[] for _ in range(4)]
        for b in batches:
            if not b.num_rows:
                continue
            t, m = _arrays(b, "t", len(text.mean)), _arrays(b, "m", len(meta.mean))
            ids, tie = b.column("id").to_numpy(zero_copy_only=False), b.column("tie").to_numpy()
            free = ~np.isin(tie, used.value)
            for v, odds in enumerate((text.odds(t), meta.odds(m))):
                for good in (0, 1):
                    s = odds if good else -odds
                    pick = np.flatnonzero(free & (s > 0))
                    pick = pick[np.lexsort((tie[pick], -s[pick]))[:quota[good]]]
                    rows = best[2 * v + good] + [(float(s[i]), int(tie[i]), t[i], m[i]) for i in pick.tolist()]
                    best[2 * v + good] = sorted(rows, key=lambda r: (-r[0], r[1]))[:quota[good]]
        for slot, rows in enumerate(best):
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([slot] * len(rows), pa.int32()), pa.array([r[0] for r in rows]),
                     pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.float32())),
                     pa.array([r[3] for r in rows], pa.list_(pa.float32()))], ["slot", "s", "tie", "t", "m"])
    return run, quota


def train(work: Work, rows: DataFrame, seed: int):
    """(text model, metadata model, weights of the calibrated views) or None."""
    spark = rows.sparkSession
    tie = F.xxhash64(F.lit(seed), "id")
    sample = rows.filter("label is not null").orderBy(tie, "id").limit(MAX_LABELLED).collect()
    y = np.array([r.label for r in sample], np.float64)
    if len(y) < 10 or y.min() == y.max():
        return None
    t, m = np.array([r.t for r in sample], np.float32), np.array([r.m for r in sample], np.float32)
    back = np.arange(len(y)) % 3 == 2
    if y[back].min() == y[back].max() or y[~back].min() == y[~back].max():
        back = np.zeros(len(y), bool)
    fit = ~back
    hold = back if back.any() else fit
    share = float(y[fit].mean())
    tx, ty, mx, my = [t[fit]], [y[fit]], [m[fit]], [y[fit]]
    used: list[int] = []
    pool = rows.filter("label is null").withColumn("tie", tie)
    for _ in range(ROUNDS):
        views = Logistic(np.vstack(tx), np.concatenate(ty)), Logistic(np.vstack(mx), np.concatenate(my))
        fn, quota = _confident(spark.sparkContext.broadcast(views),
                               spark.sparkContext.broadcast(np.array(used, np.int64)), share)
        near = pool.mapInArrow(fn, "slot int, s double, tie long, t array<float>, m array<float>")
        w = Window.partitionBy("slot").orderBy(F.desc("s"), "tie")
        got = near.withColumn("k", F.row_number().over(w)).filter(F.col("k") <= max(quota)).collect()
        for r in got:
            if r.k <= quota[r.slot % 2]:
                used.append(r.tie)
                # a view's label teaches the other view
                if r.slot < 2:
                    mx.append(np.array([r.m], np.float32))
                    my.append(np.array([r.slot % 2], np.float64))
                else:
                    tx.append(np.array([r.t], np.float32))
                    ty.append(np.array([r.slot % 2], np.float64))
    text, meta = Logistic(np.vstack(tx), np.concatenate(ty)), Logistic(np.vstack(mx), np.concatenate(my))
    platt = [Logistic(o[:, None], y[hold], 1e-3) for o in (text.odds(t[hold]), meta.odds(m[hold]))]
    views = np.stack([platt[0].odds(text.odds(t[hold])[:, None]), platt[1].odds(meta.odds(m[hold])[:, None])], 1)
    return text, meta, platt, Logistic(views, y[hold], 1e-3)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", source_col: str = "source", length_col: str = "n_chars",
             label_col: str = "quality", threshold: float = 0.5, seed: int = 3) -> DataFrame:
    """Per row: id, p_text, p_meta, score (probability of good quality), keep."""
    spark = docs.sparkSession
    work = Work(spark, "quality")
    lab = (labels.select(F.col(id_col).cast("long").alias("lid"), F.col(label_col).cast("int").alias("label"))
           .dropna().groupBy("lid").agg(F.min("label").alias("label")))
    marked = work.keep(docs.select(F.col(id_col).cast("long").alias("id")).distinct()
                       .join(lab, F.col("id") == F.col("lid")).select("id", "label"), "marked")
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.lit(None).cast("int").alias("label"),
                       F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(source_col).cast("string").alias("source"), F.col(length_col).cast("long").alias("n_chars"))
    feats = work.keep(_features(base).drop("label"), "features", "2m")
    rows = feats.join(marked.withColumnRenamed("id", "mid"), F.col("id") == F.col("mid"), "left").drop("mid")
    rows = work.keep(rows, "rows")
    model = train(work, rows, seed)
    if model is None:
        one = F.lit(1.0)
        return rows.select(F.col("id").alias(id_col), one.alias("p_text"), one.alias("p_meta"),
                           one.alias("score"), F.lit(True).alias("keep"))
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        text, meta, platt, both = shared.value
        p = lambda o: 1 / (1 + np.exp(-o))
        for b in batches:
            if b.num_rows:
                a = platt[0].odds(text.odds(_arrays(b, "t", len(text.mean)))[:, None])
                c = platt[1].odds(meta.odds(_arrays(b, "m", len(meta.mean)))[:, None])
                s = p(both.odds(np.stack([a, c], 1)))
                yield pa.RecordBatch.from_arrays([b.column("id"), *(pa.array(x.astype(np.float64)) for x in (p(a), p(c), s)),
                                                  pa.array(s >= threshold)], ["id", "p_text", "p_meta", "score", "keep"])
    return (rows.select("id", "t", "m").mapInArrow(tu.released(run), "id long, p_text double, p_meta double, score double, keep boolean")
            .withColumnRenamed("id", id_col))
