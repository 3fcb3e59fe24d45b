"""Input derivations written once as SQL, rendered for Spark SQL or DuckDB.

The driver's test tables hold no change history, so change batches are
derived from them deterministically.  Each derivation is SQL text built
with a ``Dialect`` so that the Spark side and the oracle read identical
inputs; the operator under test is then run by the library on Spark and
re-stated independently in the oracle SQL.
"""

from __future__ import annotations


class Dialect:
    name = "duckdb"

    def __init__(self, sf_dir: str | None = None):
        self.sf_dir = sf_dir

    def t(self, table: str) -> str:
        return table

    ts_type = "TIMESTAMP"
    str_type = "VARCHAR"

    def ts(self, text: str) -> str:
        return f"TIMESTAMP '{text}'"

    def add_days(self, x: str, n: str) -> str:
        return f"({x} + to_days(CAST({n} AS INTEGER)))"

    def add_secs(self, x: str, n: str) -> str:
        return f"({x} + to_seconds(CAST({n} AS BIGINT)))"

    def add_micros(self, x: str, n: str) -> str:
        return f"({x} + to_microseconds(CAST({n} AS BIGINT)))"

    def to_date(self, x: str) -> str:
        return f"CAST({x} AS DATE)"

    def fmt(self, x: str, java_pattern: str) -> str:
        py = (java_pattern.replace("yyyy", "%Y").replace("MM", "%m").replace("dd", "%d")
              .replace("HH", "%H").replace("mm", "%M").replace("ss", "%S"))
        return f"strftime({x}, '{py}')"

    def rlike(self, x: str, pattern: str) -> str:
        return f"regexp_matches({x}, '{pattern}')"

    def int_div(self, a: str, b: str) -> str:
        return f"({a} // {b})"


class SparkDialect(Dialect):
    name = "spark"
    ts_type = "TIMESTAMP_NTZ"
    str_type = "STRING"

    def t(self, table: str) -> str:
        return f"parquet.`{self.sf_dir.rstrip('/')}/{table}.parquet`"

    def ts(self, text: str) -> str:
        return f"TIMESTAMP_NTZ '{text}'"

    def add_days(self, x: str, n: str) -> str:
        return f"timestampadd(DAY, CAST({n} AS INT), {x})"

    def add_secs(self, x: str, n: str) -> str:
        return f"timestampadd(SECOND, CAST({n} AS BIGINT), {x})"

    def add_micros(self, x: str, n: str) -> str:
        return f"timestampadd(MICROSECOND, CAST({n} AS BIGINT), {x})"

    def to_date(self, x: str) -> str:
        return f"to_date({x})"

    def fmt(self, x: str, java_pattern: str) -> str:
        return f"date_format({x}, '{java_pattern}')"

    def rlike(self, x: str, pattern: str) -> str:
        return f"({x} RLIKE '{pattern}')"

    def int_div(self, a: str, b: str) -> str:
        return f"({a} DIV {b})"
