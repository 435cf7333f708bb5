"""Data-quality rules, evaluated as one report of violation counts.

What counts as a violation: each value (or combination) that occurs more than once for the
uniqueness rules, each row for the others.  NULL passes every rule but ``not_null`` and
``unique_combination``, where two NULLs are equal.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIQUE = "unique"
NOT_NULL = "not_null"
RELATIONSHIPS = "relationships"
ACCEPTED_VALUES = "accepted_values"
ACCEPTED_RANGE = "accepted_range"
UNIQUE_COMBINATION = "unique_combination"


@dataclass(frozen=True)
class Rule:
    """One rule on one table.  ``columns`` has several names only for unique_combination."""

    table: str
    kind: str
    columns: tuple[str, ...]
    parent: str | None = None
    parent_column: str | None = None
    values: tuple = ()
    low: float | None = None
    high: float | None = None

    @property
    def label(self) -> str:
        return ",".join(self.columns)


def unique(table: str, column: str) -> Rule:
    return Rule(table, UNIQUE, (column,))


def not_null(table: str, column: str) -> Rule:
    return Rule(table, NOT_NULL, (column,))


def relationships(table: str, column: str, parent: str, parent_column: str) -> Rule:
    return Rule(table, RELATIONSHIPS, (column,), parent=parent, parent_column=parent_column)


def accepted_values(table: str, column: str, values: Sequence) -> Rule:
    return Rule(table, ACCEPTED_VALUES, (column,), values=tuple(values))


def accepted_range(table: str, column: str, low: float | None = None,
                   high: float | None = None) -> Rule:
    return Rule(table, ACCEPTED_RANGE, (column,), low=low, high=high)


def unique_combination(table: str, columns: Sequence[str]) -> Rule:
    return Rule(table, UNIQUE_COMBINATION, tuple(columns))


def _row_fails(rule: Rule) -> Column:
    c = F.col(rule.columns[0])
    if rule.kind == NOT_NULL:
        return c.isNull()
    if rule.kind == ACCEPTED_VALUES:
        return ~c.isin(*rule.values)
    tests = []
    if rule.low is not None:
        tests.append(c < F.lit(rule.low))
    if rule.high is not None:
        tests.append(c > F.lit(rule.high))
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _row_violations(df: DataFrame, rules: Mapping[int, Rule]) -> DataFrame:
    """All row-level rules of a table in a single scan: (rule_no, violations)."""
    counts = df.agg(*[F.count_if(_row_fails(r)).alias(f"n{i}") for i, r in rules.items()])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("rule_no"), F.col(f"n{i}").alias("violations")) for i in rules])))


def _parts(rule: Rule) -> list[Column]:
    """The checked columns as text: JSON would cut timestamps to milliseconds, and a child may
    be of another type than its parent."""
    return [F.col(c).cast("string").alias(c) for c in rule.columns]


def _value(rule: Rule) -> Column:
    """The checked value as text; a combination as JSON, in which NULL is a value too."""
    if rule.kind == UNIQUE_COMBINATION:
        return F.to_json(F.struct(*_parts(rule)), {"ignoreNullFields": "false"})
    return _parts(rule)[0]


def _mark(rule: Rule) -> Column:
    """A 64-bit fingerprint of the checked value, NULL where NULL passes the rule."""
    if rule.kind == UNIQUE_COMBINATION:
        nulls = [F.isnull(c) for c in rule.columns]
        return F.xxhash64(*nulls, *_parts(rule))
    text = _parts(rule)[0]
    return F.when(text.isNotNull(), F.xxhash64(text))


def _spread(df: DataFrame, rules: Mapping[int, Rule], **columns: Callable[[Rule], Column]) -> DataFrame:
    """(rule_no, ...) for every row and rule of a table, rows with a NULL in the first column
    left out."""
    cells = [F.struct(F.lit(i).alias("rule_no"), *[make(r).alias(n) for n, make in columns.items()])
             for i, r in rules.items()]
    one = cells[0] if len(cells) == 1 else F.explode(F.array(*cells))
    return df.select(one.alias("cell")).select("cell.*").where(F.col(next(iter(columns))).isNotNull())


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def duplicates(tables: Mapping[str, DataFrame], rules: Mapping[int, Rule],
               stage: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """(rule_no, violations) of all uniqueness rules.

    First only 64-bit fingerprints of the values are counted, in one shuffle for all rules.
    Values whose fingerprint is not found twice are unique for sure and never travel.  The rest,
    none in a sound table, are then counted as they are.  ``stage`` stores a frame and reads it
    back: with it only tables of rules with repeated fingerprints are read again, and Spark knows
    that these are few and sends them to the rows; without, the rows meet them in a shuffle.  Counting combines inside the map tasks, so a value
    with a third of all rows is one row per task.
    """
    by_table = _by_table(rules)
    marks = _union([_spread(tables[t], rs, mark=_mark) for t, rs in by_table.items()])
    repeated = (marks.groupBy("rule_no", "mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                .select("rule_no", "mark"))
    if stage:
        repeated = stage(repeated, "repeated")
        hit = {r.rule_no for r in repeated.select("rule_no").distinct().collect()}  # at most one row per rule
        by_table = _by_table({i: r for i, r in rules.items() if i in hit})
        if not hit:
            return repeated.select("rule_no", F.lit(0).cast("long").alias("violations"))
    values = _union([_spread(tables[t], rs, mark=_mark, value=_value) for t, rs in by_table.items()])
    counts = (values.join(repeated, ["rule_no", "mark"], "left_semi")
              .groupBy("rule_no", "value").agg(F.count(F.lit(1)).alias("n")))
    return counts.groupBy("rule_no").agg(F.count_if(F.col("n") > 1).alias("violations"))


def orphans(tables: Mapping[str, DataFrame], rules: Mapping[int, Rule]) -> DataFrame:
    """(rule_no, violations) of all relationship rules in one shuffle.

    Child values (counted) and parent values (marked) meet in one grouping by rule and
    value, so no child row is ever joined.  Values travel as two 64-bit fingerprints: two
    different ones agree in both with a chance of 1 in 10**14 among 10**12 values.
    """
    def second(rule: Rule) -> Column:
        return F.xxhash64(F.lit(1), _parts(rule)[0])

    children = _union([_spread(tables[t], rs, mark=_mark, other=second) for t, rs in _by_table(rules).items()])
    parents = _union([
        _spread(tables[r.parent], {i: unique(r.parent, r.parent_column)}, mark=_mark, other=second)
        for i, r in rules.items()])
    both = children.withColumn("child", F.lit(1)).unionByName(
        parents.withColumn("child", F.lit(0)))
    values = both.groupBy("rule_no", "mark", "other").agg(
        F.sum("child").alias("n"), F.min("child").alias("lost"))
    lost = F.when(F.col("lost") == 1, F.col("n")).otherwise(0)
    return values.groupBy("rule_no").agg(F.sum(lost).alias("violations"))


def _by_table(rules: Mapping[int, Rule]) -> dict[str, dict[int, Rule]]:
    tables: dict[str, dict[int, Rule]] = {}
    for i, r in rules.items():
        tables.setdefault(r.table, {})[i] = r
    return tables


def dq_report(tables: Mapping[str, DataFrame], rules: Sequence[Rule],
              stage: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """One row per rule: table_name, rule, column_name, violations, passed.

    Row-level rules take one scan per table; all uniqueness rules share one shuffle of
    fingerprints, and all relationships another.  ``stage`` is for :func:`duplicates`; without
    it the report is lazy.
    """
    numbered = dict(enumerate(rules))

    def of(*kinds: str) -> dict[int, Rule]:
        return {i: r for i, r in numbered.items() if r.kind in kinds}

    unique_rules, parent_rules = of(UNIQUE, UNIQUE_COMBINATION), of(RELATIONSHIPS)
    parts = [_row_violations(tables[t], rs) for t, rs in
             _by_table(of(NOT_NULL, ACCEPTED_VALUES, ACCEPTED_RANGE)).items()]
    if unique_rules:
        parts.append(duplicates(tables, unique_rules, stage))
    if parent_rules:
        parts.append(orphans(tables, parent_rules))
    spark = next(iter(tables.values())).sparkSession
    names = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("no"), F.lit(r.table).alias("table_name"),
                 F.lit(r.kind).alias("rule"), F.lit(r.label).alias("column_name"))
        for i, r in numbered.items()])))
    # A rule over an empty table has no counted row, hence the left join.
    found = _union(parts).withColumnRenamed("rule_no", "_rule_no")
    violations = F.coalesce("violations", F.lit(0)).cast("bigint")
    return (names.join(found, F.col("no") == F.col("_rule_no"), "left")
            .select("table_name", "rule", "column_name", violations.alias("violations"))
            .withColumn("passed", F.col("violations") == 0))
