"""Ordered string aggregation per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def ordered_concat(df: DataFrame, group: Sequence[str], column: str,
                   order: Sequence[str] | None = None, sep: str = ",",
                   alias: str | None = None, descending: bool = False) -> DataFrame:
    """``listagg(column, sep) WITHIN GROUP (ORDER BY order)`` per group.

    The output string of a group holds every value of that group, so the
    operator is meant for groups of bounded size (a table's column list,
    the lines of one order); it is a hash aggregate keyed by ``group``.
    """
    order = list(order or [column])
    direction = " DESC" if descending else ""
    order_sql = ", ".join(f"`{c}`{direction} NULLS LAST" for c in order)
    esc = sep.replace("'", "''")
    expr = F.expr(f"listagg(CAST(`{column}` AS STRING), '{esc}') WITHIN GROUP (ORDER BY {order_sql})")
    return df.groupBy(*group).agg(expr.alias(alias or f"{column}_list"))


def column_list(df: DataFrame, exclude: Sequence[str] = (), upper: bool = True) -> str:
    """The target's column list in ordinal order (metadata only, no data read)."""
    names = [c for c in df.columns if c.lower() not in {e.lower() for e in exclude}]
    return ",".join(n.upper() if upper else n for n in names)


def ordered_concat_chunks(df: DataFrame, group: Sequence[str], column: str,
                          order: Sequence[str] | None = None, sep: str = ",",
                          alias: str | None = None, partitions: int | None = None) -> DataFrame:
    """Exact ordered concatenation for groups of any size, as ordered chunks.

    Rows are range-partitioned on ``(group, order)``: Spark samples the key
    distribution, so a group holding a third of all rows is spread over many
    tasks, each holding a contiguous, ordered run of it.  Each
    (partition, group) run is concatenated inside its task (the partial
    aggregate holds at most one partition's rows), and the result has one
    row per run: ``group..., chunk, <alias>``.  Concatenating a group's
    chunks in ``chunk`` order gives exactly ``ordered_concat``'s string.
    """
    order = list(order or [column])
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *[F.col(c) for c in list(group) + order])
                .withColumn("chunk", F.spark_partition_id()))
    return ordered_concat(ranged, list(group) + ["chunk"], column, order, sep, alias)
