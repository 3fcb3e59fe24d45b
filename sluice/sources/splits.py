"""Split points for a parallel source read, computed instead of typed in.

One approximate-quantile aggregate gives equi-depth boundaries of a column.  A value
that spans several quantiles is hot and becomes a split of its own, as NULL does, so the
other splits stay even.  The splits are SQL predicates that together hold every row once:
they serve a JDBC read (``predicates``) and any DataFrame alike.
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F


def _literal(v) -> str:
    """A value as an SQL literal; text is quoted, quotes inside are doubled."""
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, decimal.Decimal)):
        return str(v)
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP '{v.isoformat(sep=' ')}'"
    if isinstance(v, dt.date):
        return f"DATE '{v.isoformat()}'"
    return "'" + str(v).replace("'", "''") + "'"


def split_points(df: DataFrame, column: str, splits: int, accuracy: int = 10_000) -> tuple[list, list, int]:
    """(boundaries, hot values, rows without a value) for about ``splits`` even splits.

    Numbers, dates and timestamps only (quantiles need a number line).  A hot value is
    one that two neighbouring quantiles share, so it holds a split's worth of rows."""
    if splits < 1:
        raise ValueError("splits must be at least 1")
    marks = [k / splits for k in range(1, splits)]
    col = F.col(f"`{column}`")
    got = df.agg(F.percentile_approx(col, marks or [0.5], accuracy).alias("q"), F.count_if(col.isNull()).alias("n")).first()
    q = (got["q"] or []) if marks else []
    hot = sorted({a for a, b in zip(q, q[1:]) if a == b})
    return sorted(set(q)), hot, got["n"]


def split_predicates(column: str, boundaries: list, hot: list, nulls: int = 1, quote: str = "`") -> list[str]:
    """Predicates of the splits: [boundary, next boundary), hot values and NULL apart."""
    name = f"{quote}{column}{quote}"
    out = [f"{name} IS NULL"] if nulls else []
    out += [f"{name} = {_literal(v)}" for v in hot]
    edges = [None, *boundaries, None]
    for lo, hi in zip(edges, edges[1:]):
        parts = []
        if lo is not None:
            parts.append(f"{name} {'>' if lo in hot else '>='} {_literal(lo)}")
        if hi is not None:
            parts.append(f"{name} < {_literal(hi)}")
        out.append(" AND ".join(parts) or f"{name} IS NOT NULL")
    return out


def split_reads(df: DataFrame, predicates: list[str]) -> list[DataFrame]:
    """One DataFrame per split; each predicate reaches the scan."""
    return [df.where(p) for p in predicates]


def jdbc_split_read(spark: SparkSession, url: str, table: str, column: str, splits: int,
                    properties: Mapping[str, str] | None = None, quote: str = '"') -> DataFrame:
    """A JDBC table read in even splits, one connection each; the quantiles come from
    one read of the split column alone."""
    props = dict(properties or {})
    one = spark.read.jdbc(url, table, properties=props).select(column)
    return spark.read.jdbc(url, table, predicates=split_predicates(column, *split_points(one, column, splits), quote=quote),
                           properties=props)
