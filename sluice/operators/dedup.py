"""Latest row per key (top-1 per group)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _order(df: DataFrame, c: str | Column, nulls_first: bool) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.desc_nulls_first() if nulls_first else col.desc_nulls_last()


def _known(df: DataFrame, columns: Sequence[str | Column]) -> list[str | Column]:
    """The order columns, names found as Spark finds them; an unknown name is an
    error, only the optional ``_ingestion_timestamp`` may be absent."""
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    fold = (lambda c: c) if sensitive else str.lower
    names, out = {fold(c) for c in df.columns}, []
    for c in columns:
        if not isinstance(c, str) or fold(c) in names:
            out.append(c)
        elif c != "_ingestion_timestamp":
            raise ValueError(f"unknown order column {c!r}; the table has {', '.join(df.columns)}")
    return out


def latest_per_key(df: DataFrame, keys: Sequence[str], order_columns: Sequence[str | Column],
                   nulls_first: bool = True, tiebreak: bool = True) -> DataFrame:
    """Keep one row per key: the greatest by ``order_columns``, descending.

    NULL orders first under DESC (the reference warehouse's rule), and
    NULL keys form one group.  ``tiebreak`` adds a hash of the whole row as
    a last order column so that a full tie picks the same row on every
    recomputation (a lost executor re-running the stage must not choose
    differently).

    Plan: Catalyst turns ``row_number() = 1`` into a partial
    ``WindowGroupLimit`` before the exchange and a final one after it, so
    a key holding a third of the rows is cut to one row per map task before
    it is shuffled.
    """
    cols = [c for c in df.columns]
    order = [_order(df, c, nulls_first) for c in _known(df, order_columns)]
    if tiebreak:
        order.append(F.xxhash64(*[F.col(c) for c in cols]).desc())
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    return (df.withColumn("__rn", F.row_number().over(w))
              .where(F.col("__rn") == 1)
              .drop("__rn"))
