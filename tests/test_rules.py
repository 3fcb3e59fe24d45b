"""Rule engine: each type with a passing, a failing and a NULL value (Q1-Q11)."""

from decimal import Decimal

from sluice.operators import quality as Q


def _df(spark):
    return spark.createDataFrame([
        (1, 5, "AB", 10), (2, 50, "x1", 99), (3, None, None, None), (3, 7, "CD", 10),
    ], "id int, qty int, code string, ref int")


def test_row_rules(spark):
    rules = [Q.Rule("nn", "NOT_NULL", "qty"),
             Q.Rule("uq", "UNIQUENESS", "id", action_on_failure="FLAG"),
             Q.Rule("rg", "RANGE", "qty", min_value="1", max_value="10", action_on_failure="WARN"),
             Q.Rule("open", "RANGE", "qty", min_value="6"),
             Q.Rule("rx", "REGEX", "code", regex_pattern="^[A-Z]+$"),
             Q.Rule("fk", "REFERENTIAL", "ref", ref_table="r", ref_column="k",
                    action_on_failure="REJECT"),
             Q.Rule("cu", "CUSTOM", rule_expression="qty < 40")]
    refs = {"r": spark.createDataFrame([(10,)], "k int")}
    ev = Q.evaluate_rules(_df(spark), rules, refs)
    got = {(r["id"], r["qty"]): sorted(r[Q.FAILED]) for r in ev.collect()}
    assert got[(1, 5)] == ["open"]
    assert got[(2, 50)] == ["cu", "fk", "rg", "rx"]
    assert got[(3, None)] == ["nn", "uq"]        # NULL passes all but NOT_NULL
    assert got[(3, 7)] == ["uq"]
    s = {r["rule_name"]: r for r in Q.dq_summary(ev, rules).collect()}
    assert s["uq"]["failed_records"] == 2 and s["uq"]["status"] == "FAIL"
    assert s["rg"]["status"] == "WARN" and s["rg"]["action_taken"] == "WARN"
    assert s["nn"]["pass_rate_pct"] == Decimal("75.00")
    assert s["nn"]["rows_failed_dq"] == 4 and s["nn"]["rows_passed_dq"] == 0
    v = Q.batch_verdict(Q.dq_summary(ev, rules)).first()
    assert v["batch_rejected"] is True
    assert {r["id"] for r in Q.quarantined(ev, rules).collect()} == {1, 2, 3}
    flags = {(r["id"], r["qty"]): list(r[Q.FLAGS]) for r in Q.loadable(ev, rules).collect()}
    assert flags == {(3, 7): ["uq"]}   # only a FLAG rule failed: loaded, flagged


def test_threshold(spark):
    rules = [Q.Rule("th", "THRESHOLD", "qty", expected_value="5", threshold_pct=Decimal("25"))]
    ev = Q.evaluate_rules(_df(spark), rules)
    s = Q.dq_summary(ev, rules).first()
    assert s["pass_rate_pct"] == Decimal("25.00") and s["status"] == "PASS"
    assert all(len(r[Q.FAILED]) == 0 for r in ev.collect())   # table-level only


def test_constraint_checks(spark):
    df = spark.createDataFrame([(1, "A"), (1, "Z"), (2, None)], "k int, s string")
    assert Q.domain_violations(df, "s", ["A"]).count() == 1
    assert Q.not_null_violations(df, "s").count() == 1
    assert Q.unique_violations(df, ["k"]).first()["n_rows"] == 2
    ref = spark.createDataFrame([(1,)], "p int")
    assert [r.k for r in Q.fk_violations(df, "k", ref, "p").collect()] == [2]
    filled = Q.with_defaults(df, {"s": "DEF"})
    assert filled.where("s = 'DEF'").count() == 1


def test_rules_from_table(spark):
    from sluice.spec import DQ_RULES_SCHEMA
    rows = [(1, "p", "b", "NOT_NULL", "c", None, None, None, None, None, None, None, None,
             None, None, None, 2, True, None),
            (2, "p", "a", "REGEX", "c", None, None, None, "^x", None, None, None, None,
             "WARN", "LOW", None, 1, True, None),
            (3, "p", "z", "CUSTOM", None, "1=1", None, None, None, None, None, None, None,
             None, None, None, 1, False, None)]
    rules = Q.rules_from_table(spark.createDataFrame(rows, DQ_RULES_SCHEMA), "p")
    assert [r.rule_name for r in rules] == ["a", "b"]
    assert rules[1].action_on_failure == "QUARANTINE" and rules[1].severity == "HIGH"
