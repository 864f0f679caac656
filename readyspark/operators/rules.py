"""Data-quality rules compiled into one fused aggregate.

Every rule adds additive counters to a single aggregate; schema-only rules
(column present or absent) add none. When a suite holds a class-share rule the
aggregate runs in two levels: counters grouped by the class column (partial
aggregation map-side, one row per class and task crosses the shuffle), then
summed over the classes. So a whole suite, the class shares included, costs
one job with one small shuffle, whatever the table size or class skew.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readyspark import presets as P
from readyspark.operators.gaterows import E, GateRow, rows_from

TABLE = "table"


@dataclass(frozen=True)
class RowCount:
    min_value: int | None = None
    max_value: int | None = None


@dataclass(frozen=True)
class NonEmpty:
    pass


@dataclass(frozen=True)
class ColumnExists:
    column: str


@dataclass(frozen=True)
class ColumnAbsent:
    column: str


@dataclass(frozen=True)
class NotNull:
    column: str
    mostly: float = 1.0


@dataclass(frozen=True)
class InSet:
    column: str
    values: tuple
    mostly: float = 1.0


@dataclass(frozen=True)
class Between:
    column: str
    min_value: float | None = None
    max_value: float | None = None
    strict_min: bool = False
    strict_max: bool = False
    mostly: float = 1.0


@dataclass(frozen=True)
class MinClassShare:
    column: str
    min_share: float = 0.1
    min_classes: int = 1


@dataclass
class _Plan:
    gate: str
    types: dict
    counters: dict = field(default_factory=dict)  # name -> SQL condition of the rows it counts
    rows: list = field(default_factory=list)
    share_columns: list[str] = field(default_factory=list)

    def counter(self, name: str, condition: str) -> str:
        self.counters[name] = condition
        return f"coalesce(`{name}`, 0)"

    def aggregates(self, weight: str | None = None) -> list[Column]:
        """The counters; ``weight`` is a column that says how many rows a row stands for."""
        sql = "count_if({})" if weight is None else f"sum(if({{}}, {_q(weight)}, 0L))"
        return [F.expr(f"{sql.format(condition)} AS `{name}`") for name, condition in self.counters.items()]


def _q(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _lit_sql(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def _nullish_sql(column: str, dtype: T.DataType) -> str:
    c = _q(column)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return f"({c} IS NULL OR isnan({c}))"
    return f"({c} IS NULL)"


def _membership_sql(column: str, dtype: T.DataType, values: Sequence[Any]) -> str:
    c = _q(column)
    if isinstance(dtype, T.NumericType) and all(
            isinstance(v, (int, float)) and not isinstance(v, bool) for v in values):
        return f"{c} IN ({', '.join(repr(v) for v in values)})"
    return f"CAST({c} AS STRING) IN ({', '.join(_lit_sql(str(v)) for v in values)})"


def _missing(plan: _Plan, metric: str, column: str, threshold=None, comparison=None):
    plan.rows.append(GateRow(plan.gate, metric, None, threshold, comparison,
                             passed=False, subject=column))


def _compile(plan: _Plan, i: int, rule) -> None:
    g, types = plan.gate, plan.types
    n = "coalesce(`_n`, 0)"
    if isinstance(rule, NonEmpty):
        plan.rows.append(GateRow(g, "non_empty", E(n), 0, ">", subject=TABLE, cases=E(n)))
    elif isinstance(rule, RowCount):
        if rule.min_value is not None:
            plan.rows.append(GateRow(g, "row_count", E(n), rule.min_value, ">=", subject=TABLE, cases=E(n)))
        if rule.max_value is not None:
            plan.rows.append(GateRow(g, "row_count", E(n), rule.max_value, "<=", subject=TABLE, cases=E(n)))
    elif isinstance(rule, ColumnExists):
        present = rule.column in types
        plan.rows.append(GateRow(g, "column_exists", 1.0 if present else 0.0, 1.0, "==",
                                 subject=rule.column))
    elif isinstance(rule, ColumnAbsent):
        present = rule.column in types
        plan.rows.append(GateRow(g, "column_absent", 1.0 if present else 0.0, 0.0, "==",
                                 subject=rule.column))
    elif isinstance(rule, NotNull):
        if rule.column not in types:
            return _missing(plan, "not_null", rule.column, rule.mostly, ">=")
        filled = plan.counter(f"_c{i}", f"NOT {_nullish_sql(rule.column, types[rule.column])}")
        share = f"try_divide(CAST({filled} AS DOUBLE), CAST({n} AS DOUBLE))"
        plan.rows.append(GateRow(g, "not_null", E(share), rule.mostly, ">=",
                                 passed=E(f"coalesce({share} >= {float(rule.mostly)!r}, {n} = 0)"),
                                 subject=rule.column, cases=E(n), violations=E(f"{n} - {filled}")))
    elif isinstance(rule, (InSet, Between)):
        metric = "in_set" if isinstance(rule, InSet) else "between"
        if rule.column not in types:
            return _missing(plan, metric, rule.column, 1.0 - rule.mostly, "<=")
        c = _q(rule.column)
        if isinstance(rule, InSet):
            ok = _membership_sql(rule.column, types[rule.column], rule.values)
        else:
            conds = []
            if rule.min_value is not None:
                conds.append(f"{c} {'>' if rule.strict_min else '>='} {rule.min_value!r}")
            if rule.max_value is not None:
                conds.append(f"{c} {'<' if rule.strict_max else '<='} {rule.max_value!r}")
            ok = " AND ".join(conds) if conds else "true"
        present = f"NOT {_nullish_sql(rule.column, types[rule.column])}"
        cases = plan.counter(f"_c{i}", present)
        bad = plan.counter(f"_v{i}", f"{present} AND NOT coalesce({ok}, false)")
        share = f"try_divide(CAST({bad} AS DOUBLE), CAST({cases} AS DOUBLE))"
        limit = 1.0 - rule.mostly
        # decided on the good share: 1.0 - mostly is not exact, 9 of 10 is
        good = f"try_divide(CAST({cases} - {bad} AS DOUBLE), CAST({cases} AS DOUBLE))"
        plan.rows.append(GateRow(g, metric, E(share), limit, "<=",
                                 passed=E(f"coalesce({good} >= {float(rule.mostly)!r}, {cases} = 0)"),
                                 subject=rule.column, cases=E(cases), violations=E(bad)))
    elif isinstance(rule, MinClassShare):
        if rule.column not in types:
            return _missing(plan, "min_class_share", rule.column, rule.min_share, ">=")
        if rule.column not in plan.share_columns:
            plan.share_columns.append(rule.column)
        k = plan.share_columns.index(rule.column)
        share = f"try_divide(CAST(`_cls_min{k}` AS DOUBLE), CAST(`_cls_total{k}` AS DOUBLE))"
        # a missing share (no non-null class) passes, as the credit gates do
        passed = (f"coalesce({share} >= {float(rule.min_share)!r}, {share} IS NULL) "
                  f"AND coalesce(`_cls_k{k}`, 0) >= {int(rule.min_classes)}")
        plan.rows.append(GateRow(g, "min_class_share", E(share), rule.min_share, ">=", passed=E(passed),
                                 subject=rule.column, cases=E(f"`_cls_total{k}`")))
    else:
        raise TypeError(f"unknown rule {rule!r}")


def evaluate_rules(df: DataFrame, rules: Sequence, gate: str, weight: str | None = None) -> DataFrame:
    """All rules of a suite from one fused aggregate, as gate rows. ``weight``: the
    column that says how many rows a row stands for; the rules don't see it."""
    plan = _Plan(gate, {f.name: f.dataType for f in df.schema.fields if f.name != weight})
    plan.counters["_n"] = "true"
    for i, rule in enumerate(rules):
        _compile(plan, i, rule)
    names, aggs = list(plan.counters), plan.aggregates(weight)
    columns = plan.share_columns
    if not columns:
        one = df.agg(*aggs)
    else:
        # a row counts once per class column, under that column's class; the other
        # counters are taken from the first column's groups alone
        if len(columns) == 1:
            spread, keys = df, [F.lit(0).alias("_ci"), F.col(columns[0]).alias("_cls")]
        else:
            classes = [F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("c")) for i, c in enumerate(columns)]
            spread = df.withColumn("_pair", F.explode(F.array(*classes)))
            keys = [F.col("_pair.i").alias("_ci"), F.col("_pair.c").alias("_cls")]
        per_class = spread.groupBy(*keys).agg(*aggs)
        mine = lambda i: (F.col("_ci") == i) & F.col("_cls").isNotNull()
        shares = [x for i in range(len(columns)) for x in (
            F.sum(F.when(mine(i), F.col("_n"))).alias(f"_cls_total{i}"),
            F.min(F.when(mine(i), F.col("_n"))).alias(f"_cls_min{i}"), F.count_if(mine(i)).alias(f"_cls_k{i}"))]
        one = per_class.agg(*[F.sum(F.when(F.col("_ci") == 0, F.col(k))).alias(k) for k in names], *shares)
    return rows_from(one, plan.rows)


def raise_on_failed(rows: DataFrame, gate: str) -> None:
    """Raise one error listing every failed rule of evaluated gate rows."""
    failed = rows.where(~F.col("passed")).collect()  # only failed gate rows reach the driver
    if failed:
        lines = [f"- {r['metric']} failed for {r['subject']} (value {r['value']})" for r in failed]
        raise ValueError(f"{gate} failed:\n" + "\n".join(lines))


def assert_rules(df: DataFrame, rules: Sequence, gate: str) -> DataFrame:
    """E9 with the stop: raise one error listing every failed rule, else return
    ``df`` unchanged."""
    raise_on_failed(evaluate_rules(df, rules, gate), gate)
    return df


def raw_suite(columns: Sequence[str], target: str = P.TARGET) -> list:
    """Rules on the raw table: present, big enough, target present, columns
    mostly filled, no class too rare."""
    return ([NonEmpty(), RowCount(min_value=P.RAW_MIN_ROWS), ColumnExists(target)]
            + [NotNull(c, P.RAW_NOT_NULL_MOSTLY) for c in columns]
            + [MinClassShare(target, P.MIN_CLASS_SHARE)])


def prepared_suite(target: str = P.TARGET) -> list:
    """Rules on the prepared table: size, encoded target, features present and
    filled, value ranges, and the sensitive attributes gone."""
    return ([RowCount(min_value=P.PREPARED_MIN_ROWS),
             ColumnExists(target),
             InSet(target, (0, 1)),
             MinClassShare(target, P.MIN_CLASS_SHARE)]
            + [ColumnExists(f) for f in P.EXPECTED_FEATURES]
            + [NotNull(f) for f in P.EXPECTED_FEATURES]
            + [Between("monthly_payment", min_value=0, strict_min=True),
               InSet("has_additional_security", (0, 1)),
               InSet("high_risk_financial_status", (0, 1)),
               InSet("age_group", tuple(P.AGE_LABELS))]
            + [ColumnAbsent(c) for c in P.DELETED_ATTRIBUTES])
