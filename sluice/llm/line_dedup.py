"""Line dedup by a segment-partition edit join, in DataFrame operations only.

Equal lines form a class, and so do lines of at least ``MIN_CHARS`` characters that lie
within ``EDITS`` edits of one another (directly or through other lines); its first
occurrence in the order of (id, text key, line number) stays, the others leave their
texts.  Blank lines stay.  Shorter lines are compared by equality alone: two edits may
turn one short word into another.

1. Occurrences combine into distinct lines (first place, number, text), so a line in
   many rows is one row before it is compared with others.
2. A line is cut into EDITS + 1 segments.  Two lines within EDITS edits share a
   segment of the shorter at a start that the length difference and the segment's
   number bound, so a line is indexed under (length, segment number, segment) and
   probes the lengths up to EDITS below its own at those starts only.
3. Keys that one line alone holds vanish in a window over the key.  A bit array of the
   remaining lines' hashes (fixed size, broadcast) picks their texts.
4. Lines that share a key and agree in length and in their letter counts up to
   2 * EDITS are candidates; a bit-parallel edit distance in a diagonal band decides.
5. Classes are the components of the verified pairs.

Distinct lines are combined one band of hashes at a time, and keys are made one band of the
segments at a time: a band's shuffle files are deleted before the next band is made.

Null texts stay null and empty ones empty.  A text whose lines all leave becomes
empty.  Rows with equal id and text are one document and get equal results.  A null
id sorts first.  An empty table gives an empty one.  Input columns named n_lines,
n_removed, _dkey or _gone are replaced.  64-bit hashes stand for lines.  Lines end at
\\n only and may be of any length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .work import Work, components

EDITS, MIN_CHARS = 2, 20
BITS = 1 << 23
BAND = 32
LETTERS = "etanrioshdlugwyc"


def segment_probes(edits: int) -> list[tuple[int, int, int, int]]:
    """(length difference, segment, shift of its start, 1 for a probe) of every key."""
    out = [(0, i, 0, 0) for i in range(1, edits + 2)]
    for delta in range(edits + 1):
        for i in range(1, edits + 2):
            lo = max(-(i - 1), delta - (edits + 1 - i))
            hi = min(i - 1, delta + (edits + 1 - i))
            out += [(delta, i, s, 1) for s in range(lo, hi + 1) if (delta, s) != (0, 0)]
    return out


def _keys(long: DataFrame, edits: int, band: int, bands: int) -> DataFrame:
    """(key, hash with the role in its lowest bit) of the lines (h, line, n), for the segments of a band."""
    probes = F.expr("array(%s)" % ", ".join(f"named_struct('delta', {d}, 'i', {i}, 'shift', {s}, 'role', {r})"
                                            for d, i, s, r in segment_probes(edits) if i % bands == band))
    # four bytes a character: a segment is cut at once, without counting characters up to it
    rows = long.select("h", "n", F.encode("line", "UTF-32").alias("codes"), F.explode(probes).alias("p")).select(
        "h", "n", "codes", "p.*")
    rows = (rows.withColumn("q", F.expr(f"cast((n - delta) div {edits + 1} as int)"))
            # the first segments have q characters, the others one more
            .withColumn("short", F.expr(f"{edits + 1} - (n - delta) % {edits + 1}"))
            .withColumn("start", F.expr("q * (i - 1) + greatest(0, i - 1 - short) + 1 + shift"))
            .withColumn("size", F.expr("q + if(i > short, 1, 0)"))
            .filter("start >= 1 and start + size - 1 <= n"))
    return rows.select(F.expr("xxhash64(n - delta, i, substring(codes, 4 * start - 3, 4 * size))").alias("key"),
                       F.expr("h | cast(role as bigint)").alias("h"))


def _let(name: str, value: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def banded_distance(longer: str, shorter: str, edits: int) -> Column:
    """Edit distance of two columns of character arrays, the longer first, if it is
    at most ``edits`` (else some larger number): one word slides down the diagonal,
    its top bit ``edits`` characters ahead."""
    mask, top = (1 << BAND) - 1, BAND - 1
    match = " | ".join(f"if(get({longer}, i + {o}) = c, {1 << (top - edits + o)}L, 0L)"
                       for o in range(-edits, edits + 1))
    masks = f"transform({shorter}, (c, i) -> named_struct('x', {match}, 'i', i))"
    late = f"(t.i >= size({longer}) - {edits})"
    step = _let("d0", "((((t.x & s.vp) + s.vp) ^ s.vp) | t.x | s.vn) & %dL" % mask,
                _let("hp", f"(s.vn | ~(d0 | s.vp)) & {mask}L",
                     "named_struct("
                     f"'vp', ((d0 & s.vp) | ~(shiftright(d0, 1) | hp)) & {mask}L, "
                     "'vn', shiftright(d0, 1) & hp, "
                     f"'d', s.d + if({late}, if((hp & s.hm) <> 0, 1, 0) - if((d0 & s.vp & s.hm) <> 0, 1, 0), "
                     f"if((d0 & {1 << top}L) = 0, 1, 0)), "
                     f"'hm', if({late}, shiftright(s.hm, 1), s.hm))"))
    ones = (mask >> (BAND - edits - 1)) << (BAND - edits - 1)
    zero = f"named_struct('vp', {ones}L, 'vn', 0L, 'd', {edits}, 'hm', {1 << (BAND - 2)}L)"
    return F.expr(f"aggregate({masks}, {zero}, (s, t) -> {step}, s -> s.d)")


def _lines(docs: DataFrame) -> DataFrame:
    """Every line that is not blank, with its place and the hash that stands for it."""
    return (docs.select("id", "dkey", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
            .filter(F.btrim("line", F.lit(" \t\r")) != "").withColumn("h", F.expr("xxhash64(line) & -2L")))


def _letter_counts(line: str) -> Column:
    return F.array(*[F.length(line) - F.length(F.replace(F.col(line), F.lit(c))) for c in LETTERS])


def near_pairs(work: Work, distinct: DataFrame, edits: int, bands: int = 1) -> DataFrame:
    """(a, b): hashes of the distinct lines (h, line) within ``edits`` edits."""
    long = distinct.select("h", "line", F.length("line").alias("n")).filter(F.col("n") >= MIN_CHARS)
    w = Window.partitionBy("key")
    line = F.expr("h & -2L")
    kept = []
    for band in range(bands):  # lines meet in one segment, so in one band
        keys = _keys(long, edits, band, bands)
        shared = (keys.withColumn("lo", F.min(line).over(w)).withColumn("hi", F.max(line).over(w))
                  .withColumn("index", F.min(F.expr("h & 1L")).over(w))
                  .filter("lo <> hi and index = 0").select("key", "h").distinct())
        kept.append(work.keep(shared, f"shared_{band}"))
    shared = reduce(DataFrame.unionAll, kept)
    probe = F.pmod(F.shiftright("h", 1), F.lit(BITS))
    bits = (shared.select(probe.alias("p")).groupBy(F.shiftright("p", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("on")))
    texts = (long.withColumn("p", probe).withColumn("word", F.shiftright("p", 6))
             .join(F.broadcast(bits), "word")  # BITS / 64 rows at most
             .filter(F.expr("shiftright(on, cast(p & 63 as int)) & 1L") == 1)
             .select(F.col("h").alias("line_key"), "line", "n").withColumn("letters", _letter_counts("line")))
    texts = work.keep(texts, "texts")
    held = shared.withColumn("line_key", F.expr("h & -2L")).join(texts, "line_key")
    a = held.filter("(h & 1L) = 0").select("key", F.col("line_key").alias("a"), F.col("line").alias("la"),
                                           F.col("n").alias("na"), F.col("letters").alias("xs"))
    b = held.select("key", F.col("line_key").alias("b"), F.col("line").alias("lb"), F.col("n").alias("nb"),
                    F.col("letters").alias("ys"), F.expr("(h & 1L) = 0").alias("same"))
    apart = sum((F.abs(F.col("xs")[i] - F.col("ys")[i]) for i in range(len(LETTERS))), F.lit(0))
    pairs = (a.join(b, (a["key"] == b["key"]) & (a["a"] != b["b"]) & (~F.col("same") | (a["a"] < b["b"]))
                    & (F.abs(a["na"] - b["nb"]) <= edits) & (apart <= 2 * edits))
             .select("a", "b", "la", "lb").dropDuplicates(["a", "b"]))
    # b is the longer: it probed the index of a's length
    chars = work.keep(pairs.select("a", "b", F.split("la", "").alias("ca"), F.split("lb", "").alias("cb")),
                      "chars")  # written, or the split would run again for every character
    pairs = work.keep(chars.filter(banded_distance("cb", "ca", edits) <= edits).select("a", "b"), "pairs")
    for name in (*(f"shared_{band}" for band in range(bands)), "texts", "chars"):
        work.drop(name)
    return pairs


def dedup_lines(docs: DataFrame, id_col: str, text_col: str, edits: int = EDITS, bands: int = 1) -> DataFrame:
    """``docs`` with the repeated lines taken out of the text, plus n_lines and
    n_removed (long).  More ``bands`` (of hashes, and of segments) hold less disk and split the lines more often."""
    spark = docs.sparkSession
    work = Work(spark, "lines")
    key = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), key.alias("dkey"))
    at = F.struct("id", "dkey", "pos")
    hash_band = F.pmod(F.shiftright("h", 1), F.lit(bands))
    distinct = reduce(DataFrame.unionAll, [
        work.keep(_lines(base).filter(hash_band == band).groupBy("h").agg(
            F.min(at).alias("at"), F.count("*").alias("c"), F.first("line").alias("line")), f"distinct_{band}")
        for band in range(bands)])
    labels = components(work, near_pairs(work, distinct, edits, bands)).withColumnRenamed("node", "h")
    first = (distinct.select("h", "at", "c").join(labels, "h", "left").filter("c > 1 or label is not null")
             .withColumn("label", F.coalesce("label", "h")))
    first = work.keep(first.select("h", "at", "label"), "first")
    for band in range(bands):
        work.drop(f"distinct_{band}")
    keeper = first.groupBy("label").agg(F.min("at").alias("keeper"))
    keeper = first.select("h", "label").join(keeper, "label").select("h", "keeper")
    gone = (_lines(base).drop("line").join(keeper, "h").filter(~at.eqNullSafe(F.col("keeper")))
            .select("dkey", "pos").distinct()
            .groupBy("dkey").agg(F.sort_array(F.collect_list("pos")).alias("gone")))
    gone = work.keep(gone, "gone")
    out = docs.drop("n_lines", "n_removed", "_dkey", "_gone").withColumn("_dkey", key)
    out = out.join(gone.select(F.col("dkey").alias("_dkey"), F.col("gone").alias("_gone")), "_dkey", "left")
    name = "`" + text_col.replace("`", "``") + "`"
    lines = f"split({name}, '\\n')"
    # the runs of lines between those that leave
    last = "coalesce(if(i = 0, null, get(_gone, i - 1)), -1)"
    runs = f"transform(array_append(_gone, size(l)), (g, i) -> slice(l, {last} + 2, g - {last} - 1))"
    kept = F.expr(f"array_join(flatten({_let('l', lines, runs)}), '\\n')")
    n_lines = F.when(F.col(name).isNull(), F.lit(0)).otherwise(F.size(F.split(F.col(name), "\n")))
    return (out.withColumn("n_lines", n_lines.cast("long"))
            .withColumn("n_removed", F.coalesce(F.greatest(F.size("_gone"), F.lit(0)), F.lit(0)).cast("long"))
            .withColumn(text_col, F.when(F.col("_gone").isNull(), F.col(name)).otherwise(kept))
            .drop("_dkey", "_gone"))
