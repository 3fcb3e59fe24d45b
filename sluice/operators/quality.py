"""V1-V4 constraint checks and Q1-Q11 the declarative rule engine.

Rules are control rows (a handful per table) read on the driver; the
data work is one projection of boolean pass columns over the table, plus
one set of failing values per UNIQUENESS and REFERENTIAL rule, joined back.  The summary is one aggregate over all rules, unpivoted.

Semantics follow SQL CHECK: a NULL value passes unless the rule is about
NULL (NOT_NULL).  THRESHOLD is a table-level rule: its rows never fail on
their own, the table fails when the pass rate is below the threshold.
"""

from __future__ import annotations

from dataclasses import dataclass, fields as dc_fields
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from sluice.functions.scalar import set_names
from sluice.spec import RULE_ACTIONS, RULE_DEFAULTS, RULE_TYPES, SEVERITIES

FAILED = "_dq_failed"
FLAGS = "_dq_flags"
PASS_PREFIX = "_dq_pass__"


@dataclass
class Rule:
    rule_name: str
    rule_type: str
    column_name: str | None = None
    rule_expression: str | None = None
    min_value: str | None = None
    max_value: str | None = None
    regex_pattern: str | None = None
    expected_value: str | None = None
    threshold_pct: Decimal | float | None = None
    ref_table: str | None = None
    ref_column: str | None = None
    action_on_failure: str = "QUARANTINE"
    severity: str = "HIGH"
    error_message: str | None = None
    rule_order: int = 1
    is_active: bool = True
    rule_id: int | None = None
    pipeline_name: str | None = None

    @property
    def pass_column(self) -> str:
        return PASS_PREFIX + self.rule_name

    @property
    def columns(self) -> list[str]:
        return [c.strip() for c in (self.column_name or "").split(",") if c.strip()]


def rules_from_table(rules_df: DataFrame, pipeline_name: str) -> list[Rule]:
    """Q8: active rules of one pipeline in ``rule_order`` (control rows only).

    A row with an unknown rule type, action or severity, or one of two rows of
    the same rule name, is refused (V1, V3): a rule that matches no branch
    would let bad rows load without a word.
    """
    names = {f.name for f in dc_fields(Rule)}
    rows = (rules_df.where((F.col("pipeline_name") == pipeline_name)
                           & F.coalesce(F.col("is_active"), F.lit(True)))
                    .orderBy(F.coalesce(F.col("rule_order"), F.lit(1)), "rule_name").collect())
    out = []
    for r in rows:
        d = {k: v for k, v in r.asDict().items() if k in names and v is not None}
        for k, v in RULE_DEFAULTS.items():
            d.setdefault(k, v)
        out.append(Rule(**d))
    for r in out:
        for what, value, allowed in (("rule_type", r.rule_type, RULE_TYPES),
                                     ("action_on_failure", r.action_on_failure, RULE_ACTIONS),
                                     ("severity", r.severity, SEVERITIES)):
            if (value or "").upper() not in allowed:
                raise ValueError(f"rule {r.rule_name}: {what} {value!r} is not one of {allowed}")
    if len({r.rule_name for r in out}) < len(out):
        raise ValueError(f"{pipeline_name}: two active rules share a name")
    return out


def _typed_bound(df: DataFrame, col: str, value: str | None) -> Column | None:
    if value is None or str(value) == "":
        return None
    return F.lit(str(value)).cast(df.schema[col].dataType)


def _row_condition(df: DataFrame, r: Rule) -> Column:
    """Boolean per row, TRUE = passes, never NULL."""
    t = r.rule_type.upper()
    if t == "NOT_NULL":
        return F.col(r.columns[0]).isNotNull()
    if t == "RANGE":
        c = F.col(r.columns[0])
        lo, hi = _typed_bound(df, r.columns[0], r.min_value), _typed_bound(df, r.columns[0],
                                                                           r.max_value)
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (c >= lo)
        if hi is not None:
            cond = cond & (c <= hi)
        return c.isNull() | cond
    if t == "REGEX":
        c = F.col(r.columns[0])
        return c.isNull() | c.cast("string").rlike(r.regex_pattern)
    if t == "CUSTOM":
        return F.coalesce(F.expr(r.rule_expression), F.lit(True))
    if t == "THRESHOLD":
        if r.rule_expression:
            cond = F.expr(r.rule_expression)
        else:
            cond = F.col(r.columns[0]) == _typed_bound(df, r.columns[0], r.expected_value)
        return F.coalesce(cond, F.lit(False))
    raise ValueError(f"not a row-level rule type: {r.rule_type}")


def evaluate_rules(df: DataFrame, rules: list[Rule],
                   refs: dict[str, DataFrame] | None = None, tmp: str | None = None) -> DataFrame:
    """Add one boolean pass column per rule and ``_dq_failed`` (names of failed rules).

    UNIQUENESS (W2/Q2) and REFERENTIAL (J3/Q5) rules first find their failing
    *values*, all of them in one job over the rules' own columns
    (``failing_values``); these are joined back to the rows, and every row of a
    duplicate group fails.  NULL fails neither.

    ``tmp`` (a folder on shared storage that the caller deletes) has the
    failing values written first: Spark then knows their size and, as they are
    few in a sound table, need not shuffle the rows for the joins.
    """
    out = df
    sets = [i for i, r in enumerate(rules) if r.rule_type.upper() in SET_RULES]
    bad = failing_values(df, rules, refs or {}) if sets else None
    if tmp and sets:
        bad.write.parquet(f"{tmp}/failing")
        bad = df.sparkSession.read.schema(bad.schema).parquet(f"{tmp}/failing")
    for i, r in enumerate(rules):
        if i not in sets:
            out = out.withColumn(r.pass_column, _row_condition(df, r))
            continue
        cols = _set_columns(r)
        mine = bad.where(F.col("__rule") == i).select(*[F.col(c).alias("__k_" + c) for c in cols], F.lit(True).alias("__bad"))
        out = (out.join(mine, [F.col(c) == F.col("__k_" + c) for c in cols], "left")
                  .withColumn(r.pass_column, F.col("__bad").isNull())
                  .drop("__bad", *["__k_" + c for c in cols]))
    row_rules = [r for r in rules if r.rule_type.upper() != "THRESHOLD"]
    failed = [F.when(~F.col(r.pass_column), F.lit(r.rule_name)) for r in row_rules]
    arr = set_names(failed) if failed else F.array().cast("array<string>")
    return out.withColumn(FAILED, arr)


SET_RULES = ("UNIQUENESS", "REFERENTIAL")


def _set_columns(r: Rule) -> list[str]:
    return list(r.columns if r.rule_type.upper() == "UNIQUENESS" else r.columns[:1])


def failing_values(df: DataFrame, rules: list[Rule], refs: dict[str, DataFrame]) -> DataFrame:
    """(__rule, the set rules' columns): values that fail a UNIQUENESS or REFERENTIAL rule.

    Per rule one grouped count over the rule's own columns, combined map-side, so a hot
    value is one row before the shuffle; duplicates are the groups of several rows, and
    values without a reference are looked up as groups, not as rows.  The rules' sets are
    one table, so one job finds them side by side."""
    sets = [(i, r) for i, r in enumerate(rules) if r.rule_type.upper() in SET_RULES]
    all_cols = list(dict.fromkeys(c for _, r in sets for c in _set_columns(r)))
    out = None
    for i, r in sets:
        cols = _set_columns(r)
        values = df.where(~_any_null(cols)).groupBy(*cols)
        if r.rule_type.upper() == "UNIQUENESS":
            bad = values.agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
        else:
            if r.ref_table not in refs:
                raise KeyError(f"rule {r.rule_name}: reference table {r.ref_table} not given")
            held = refs[r.ref_table].select(F.col(r.ref_column).alias("__ref"))
            bad = values.agg(F.lit(1)).join(held, F.col(cols[0]) == F.col("__ref"), "left_anti")
        bad = bad.select(F.lit(i).alias("__rule"), *[(F.col(c) if c in cols else F.lit(None).cast(df.schema[c].dataType)).alias(c)
                                                     for c in all_cols])
        out = bad if out is None else out.unionByName(bad)
    return out


def _any_null(cols: list[str]) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def dq_summary(evaluated: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per rule total, passed, failed, pass rate and status, one aggregate.

    Also ``rows_passed_dq`` / ``rows_failed_dq`` (a row fails when any
    row-level rule fails) are returned as two extra columns.
    """
    aggs = [F.count(F.lit(1)).alias("__total"),
            F.count_if(F.size(F.col(FAILED)) > 0).alias("__rows_failed")]
    for i, r in enumerate(rules):
        aggs.append(F.count_if(~F.col(r.pass_column)).alias(f"__f{i}"))
    one = evaluated.agg(*aggs)
    meta = evaluated.sparkSession.createDataFrame(
        [(i, r.rule_id, r.rule_name, r.rule_type.upper(), r.column_name,
          (r.action_on_failure or "QUARANTINE").upper(), (r.severity or "HIGH").upper(),
          None if r.threshold_pct is None else Decimal(str(r.threshold_pct)))
         for i, r in enumerate(rules)],
        "i int, rule_id int, rule_name string, rule_type string, column_name string, "
        "action_on_failure string, severity string, threshold_pct decimal(5,2)")
    long = one.unpivot(["__total", "__rows_failed"], [f"__f{i}" for i in range(len(rules))],
                       "__col", "failed_records")
    long = long.withColumn("i", F.substring(F.col("__col"), 4, 10).cast("int")).drop("__col")
    s = long.join(F.broadcast(meta), "i")  # one row per rule: bounded by the rule count
    total = F.col("__total").cast("bigint")
    failed = F.col("failed_records").cast("bigint")
    rate = F.when(total > 0, F.round((total - failed) * F.lit(100) / total, 2)).cast("decimal(5,2)")
    breached = F.when(F.col("rule_type") == "THRESHOLD",
                      F.coalesce(rate < F.col("threshold_pct"), F.lit(True)) & (total > 0))\
                .otherwise(failed > 0)
    status = (F.when(~breached, F.lit("PASS"))
               .when(F.col("action_on_failure") == "WARN", F.lit("WARN"))
               .otherwise(F.lit("FAIL")))
    action = F.when(breached, F.col("action_on_failure")).otherwise(F.lit("NONE"))
    return s.select(
        "rule_id", "rule_name", "rule_type", "column_name", "severity",
        total.alias("total_records"), (total - failed).alias("passed_records"),
        failed.alias("failed_records"), rate.alias("pass_rate_pct"), status.alias("status"),
        action.alias("action_taken"),
        (total - F.col("__rows_failed")).cast("bigint").alias("rows_passed_dq"),
        F.col("__rows_failed").cast("bigint").alias("rows_failed_dq"))


def _failed_with_action(rules: list[Rule], action: str, breached=()) -> Column:
    """Names of the failed rules of one action.  A THRESHOLD rule counts only if the
    batch breached it (``breached``); then the rows that miss its condition fail it."""
    mine = [r for r in rules if (r.action_on_failure or "QUARANTINE").upper() == action]
    table = [r for r in mine if r.rule_type.upper() == "THRESHOLD"]
    names = [r.rule_name for r in mine if r not in table]
    out = (F.array_intersect(F.col(FAILED), F.array(*[F.lit(n) for n in names])) if names
           else F.array().cast("array<string>"))
    late = [F.when(~F.col(r.pass_column), F.lit(r.rule_name)) for r in table
            if r.rule_name in breached]
    return F.concat(out, set_names(late)) if late else out


def quarantined(evaluated: DataFrame, rules: list[Rule], breached=()) -> DataFrame:
    """Q9 QUARANTINE: rows diverted because a QUARANTINE rule failed."""
    return evaluated.where(F.size(_failed_with_action(rules, "QUARANTINE", breached)) > 0)


def loadable(evaluated: DataFrame, rules: list[Rule], breached=()) -> DataFrame:
    """Q9: rows that load: not quarantined; FLAG failures listed in ``_dq_flags``.

    WARN failures load unchanged (their result row says WARN).  ``breached``
    names the THRESHOLD rules whose pass rate the batch missed.
    """
    return (evaluated.where(F.size(_failed_with_action(rules, "QUARANTINE", breached)) == 0)
                     .withColumn(FLAGS, _failed_with_action(rules, "FLAG", breached)))


def batch_verdict(summary: DataFrame) -> DataFrame:
    """Q9 REJECT: the batch is refused when any REJECT rule fails."""
    return summary.agg(
        F.coalesce(F.max((F.col("action_taken") == "REJECT").cast("int")), F.lit(0))
         .cast("boolean").alias("batch_rejected"),
        F.count_if(F.col("status") == "FAIL").alias("rules_failed"),
        F.count_if(F.col("status") == "WARN").alias("rules_warned"))


# ---------------------------------------------------------------------------
# V1-V4: constraint checks as violation queries.
# ---------------------------------------------------------------------------

def domain_violations(df: DataFrame, column: str, allowed) -> DataFrame:
    """V1: rows whose value is outside the allowed set (NULL passes)."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(allowed)))


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    """V2: rows holding NULL in a NOT NULL column."""
    return df.where(F.col(column).isNull())


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """V2: fill a column's DEFAULT where the value is NULL."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
                           for c, v in defaults.items() if c in df.columns})


def unique_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """V3: key values held by more than one row, with their count."""
    return (df.where(~_any_null(columns)).groupBy(*columns)
              .agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1))


def fk_violations(df: DataFrame, column: str, ref: DataFrame, ref_column: str) -> DataFrame:
    """V4: rows whose foreign key has no parent (left anti join; NULL passes)."""
    parents = ref.select(F.col(ref_column).alias("__p")).where(F.col("__p").isNotNull())
    return (df.where(F.col(column).isNotNull())
              .join(parents, F.col(column) == F.col("__p"), "left_anti"))


def dq_results(summary: DataFrame, run_id: str, pipeline_name: str, source_table: str,
               run_date, dq_file_path: str | None = None) -> DataFrame:
    """K9 rows: the summary stamped with run, pipeline, table and date."""
    return summary.select(
        F.lit(run_id).alias("run_id"), F.lit(pipeline_name).alias("pipeline_name"),
        F.lit(source_table).alias("source_table"), "rule_id", "rule_name", "rule_type",
        "column_name", "severity", "total_records", "passed_records", "failed_records",
        "pass_rate_pct", "status", "action_taken",
        F.lit(dq_file_path).cast("string").alias("dq_file_path"),
        F.lit(run_date).cast("timestamp_ntz").alias("run_date"))


def dq_report(results: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Per pipeline, day and rule severity: rules, rules not passed, failed rows.

    With ``runs`` (the run log's current view) the results are first joined to
    their run (J4, left join on run id and pipeline) and the report is also
    split by the run's final status.
    """
    keys = ["pipeline_name", F.to_date("run_date").alias("run_date"), "severity"]
    if runs is not None:
        r = runs.select("run_id", "pipeline_name", F.col("status").alias("run_status"))
        results = results.join(r, ["run_id", "pipeline_name"], "left")
        keys.append("run_status")
    return (results.groupBy(*keys)
                   .agg(F.count(F.lit(1)).alias("rules"),
                        F.count_if(F.col("status") != "PASS").alias("rules_not_passed"),
                        F.sum("failed_records").cast("bigint").alias("failed_records")))
