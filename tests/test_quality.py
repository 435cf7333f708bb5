import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as q
from tidemark.plans.rules import ALL_RULES
from tidemark.sources.store import Scratch


@pytest.fixture(scope="module")
def tables(spark):
    """One planted violation (or two) per rule."""
    return {
        "t": spark.createDataFrame(
            [(1, "a", 0, 5), (1, "a", 1, 30), (2, None, 2, 31), (None, None, 1, None),
             (None, "b", None, -1)],
            "id int, name string, flag int, nights int"),
        "p": spark.createDataFrame([("a",), ("a",), (None,)], "name string"),
        "none": spark.createDataFrame([], "id int"),
    }


@pytest.mark.parametrize("rule, violations", [
    (q.unique("t", "id"), 1),                                  # NULL twice is fine
    (q.unique("t", "nights"), 0),
    (q.not_null("t", "id"), 2),
    (q.not_null("p", "name"), 1),
    (q.relationships("t", "name", "p", "name"), 1),            # 'b'; NULL passes
    (q.accepted_values("t", "flag", [0, 1]), 1),               # 2; NULL passes
    (q.accepted_range("t", "nights", 0, 30), 2),
    (q.accepted_range("t", "nights", low=0), 1),
    (q.accepted_range("t", "nights", high=30), 1),
    (q.unique_combination("t", ["id", "name"]), 1),            # (1, a)
    (q.unique_combination("p", ["name"]), 1),
    (q.unique_combination("t", ["name"]), 2),                  # a, and NULL with NULL
    (q.unique("none", "id"), 0),
    (q.not_null("none", "id"), 0),
    (q.relationships("none", "id", "p", "name"), 0),
])
def test_each_rule(tables, rule, violations):
    got = q.dq_report(tables, [rule]).collect()
    assert [(r.violations, r.passed) for r in got] == [(violations, violations == 0)]


def test_combination_columns_do_not_run_together(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("a", None), ("a", "null")],
                               "x string, y string")
    report = q.dq_report({"t": df}, [q.unique_combination("t", ["x", "y"])])
    assert report.first().passed


def test_report_has_one_row_per_rule_in_one_frame(tables):
    rules = [q.unique("t", "id"), q.unique("p", "name"), q.not_null("t", "id"),
             q.not_null("t", "name"), q.relationships("t", "name", "p", "name"),
             q.unique("none", "id")]
    got = {(r.table_name, r.rule, r.column_name): r.violations
           for r in q.dq_report(tables, rules).collect()}
    assert got == {("t", "unique", "id"): 1, ("p", "unique", "name"): 1,
                   ("t", "not_null", "id"): 2, ("t", "not_null", "name"): 2,
                   ("t", "relationships", "name"): 1, ("none", "unique", "id"): 0}


def test_suite_size():
    kinds = [r.kind for r in ALL_RULES]
    assert len(ALL_RULES) == 37
    assert {k: kinds.count(k) for k in set(kinds)} == {
        q.UNIQUE: 7, q.NOT_NULL: 16, q.RELATIONSHIPS: 4, q.ACCEPTED_VALUES: 1,
        q.ACCEPTED_RANGE: 2, q.UNIQUE_COMBINATION: 7}


@pytest.mark.parametrize("staged", [False, True])
def test_values_that_share_a_fingerprint_are_told_apart(spark, monkeypatch, staged):
    """Every value has the same first fingerprint: counts come from the values."""
    monkeypatch.setattr(q, "_mark", lambda rule: F.when(F.col(rule.columns[0]).isNotNull(), F.lit(7).cast("long")))
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("c",), (None,), (None,)], "x string")
    parents = spark.createDataFrame([("a",), ("c",)], "y string")
    rules = [q.unique("t", "x"), q.relationships("t", "x", "p", "y")]
    stage = Scratch(spark, "repeated") if staged else None
    got = q.dq_report({"t": df, "p": parents}, rules, stage).collect()
    assert {r.rule: r.violations for r in got} == {q.UNIQUE: 2, q.RELATIONSHIPS: 1}


def test_unique_values_do_not_travel(spark):
    """Of a table whose long values are all different but two, the shuffles carry fingerprints."""
    df = Scratch(spark, "wide")(spark.range(20_000).select(
        F.repeat(F.sha2(F.greatest("id", F.lit(1)).cast("string"), 256), 20).alias("x")), "t")
    report = q.dq_report({"t": df}, [q.unique("t", "x")], Scratch(spark, "repeated"))
    assert report.first().violations == 1
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
