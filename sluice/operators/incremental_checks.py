"""Q5/V4 and Q2/V3 over batches: checks that follow the changes instead of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# -- referential integrity ------------------------------------------------------------


def referential_violations(children: DataFrame, parents: DataFrame, fk: str, parent_key: str) -> DataFrame:
    """The full check: children whose ``fk`` names no parent; NULL names none and passes."""
    known = parents.select(F.col(parent_key).alias("__p")).where("__p IS NOT NULL").distinct()
    return children.where(F.col(fk).isNotNull()).join(known, F.col(fk) == F.col("__p"), "left_anti")


def referential_delta(violations: DataFrame, children: DataFrame, parents: DataFrame, changed: DataFrame,
                      deleted_parents: DataFrame, keys: Sequence[str], fk: str, parent_key: str) -> DataFrame:
    """The violations after a batch, from those before it: (keys, fk).

    ``children`` and ``parents`` are the tables after the batch, ``changed`` the keys of
    children that were inserted, updated or deleted, ``deleted_parents`` the parent keys
    that went.  Three small sets make the answer: old violations that were not touched and
    still have no parent, changed children without a parent, and unchanged children of
    deleted parents.  Only the last reads the unchanged children, and only where a parent
    was deleted.  ``keys`` identify a child and are never NULL."""
    keys, cols = list(keys), [*keys, fk]
    touched = changed.select(*keys).distinct()
    old = violations.select(*cols).join(touched, keys, "left_anti")
    fresh = children.select(*cols).join(touched, keys, "left_semi")
    out = referential_violations(old.unionByName(fresh), parents, fk, parent_key)
    gone = deleted_parents.select(F.col(parent_key).alias(fk)).where(F.col(fk).isNotNull()).distinct()
    if gone.isEmpty():
        return out
    orphans = children.select(*cols).join(gone, fk, "left_semi").join(touched, keys, "left_anti")
    # a child that was in violation before stays counted once
    orphans = orphans.join(violations.select(*keys), keys, "left_anti")
    return out.unionByName(referential_violations(orphans.select(*cols), parents, fk, parent_key))


# -- uniqueness across batches ----------------------------------------------------------

FILTER = "bucket bigint, bits binary"
SPACE = 1 << 40


def _position(keys: Sequence[str], space: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(space))


def key_filter(batch: DataFrame, keys: Sequence[str], space: int = SPACE) -> DataFrame:
    """A batch's keys as bitmaps per range of key hashes (``FILTER``), 4 KB a range.

    ``space`` is the number of hash positions; with few keys in a large space most
    bitmaps hold few bits, so choose some ten positions a key."""
    p = _position(keys, space)
    return (batch.select(F.bitmap_bucket_number(p).alias("bucket"), F.bitmap_bit_position(p).alias("bit")).distinct()
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")))


def merge_filters(*filters: DataFrame) -> DataFrame:
    """The filter of all keys of several batches."""
    out = filters[0]
    for f in filters[1:]:
        out = out.unionByName(f)
    return out.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


_BIT_SET = "(shiftright(cast(conv(hex(substring(bits, cast(bit div 8 as int) + 1, 1)), 16, 10) as int), cast(bit % 8 as int)) & 1) = 1"


def unique_across_batches(batch: DataFrame, keys: Sequence[str], seen: DataFrame, history: DataFrame,
                          space: int = SPACE) -> DataFrame:
    """Keys of a batch that are not unique: (keys, n_in_batch, seen_before).

    ``seen`` is the merged filter of earlier batches, ``history`` their keys.  The batch is
    grouped by key first, so a hot key is one row; its groups meet the filter's bitmaps by
    range, and only keys whose bit is set are looked up in the history, so a false positive
    is confirmed away.  A NULL in a key passes, as in SQL."""
    keys = list(keys)
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    p = _position(keys, space)
    groups = (batch.where(whole).groupBy(*keys).agg(F.count("*").alias("n_in_batch"))
              .withColumns({"bucket": F.bitmap_bucket_number(p), "bit": F.bitmap_bit_position(p)}))
    marked = (groups.join(seen, "bucket", "left").withColumn("hit", F.coalesce(F.expr(_BIT_SET), F.lit(False)))
              .select(*keys, "n_in_batch", "hit"))
    hits = marked.where("hit").select(*keys)
    # the few keys that may have been seen, against the history's key columns
    known = history.select(*keys).join(hits, keys, "left_semi").distinct().withColumn("seen_before", F.lit(True))
    return (marked.where(F.col("hit") | (F.col("n_in_batch") > 1)).join(known, keys, "left")
            .select(*keys, "n_in_batch", F.coalesce("seen_before", F.lit(False)).alias("seen_before"))
            .where(F.col("seen_before") | (F.col("n_in_batch") > 1)))
