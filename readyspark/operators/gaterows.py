"""The gate-result row model shared by every check (FIXTURES F11).

A check produces a small long table:
(gate, metric, subject, value, threshold, comparison, passed, cases, violations).
Rows are built from one-row aggregates with ``inline(array(struct ...))``, so
producing them never needs a collect.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GATE_COLUMNS = ["gate", "metric", "subject", "value", "threshold", "comparison",
                "passed", "cases", "violations"]

GATE_SCHEMA = ("gate string, metric string, subject string, value double, threshold double, "
               "comparison string, passed boolean, cases long, violations long")


class E(str):
    """A SQL expression (as opposed to a plain text literal) in a GateRow field."""


def _sql_lit(v: Any, dtype: str) -> str:
    if isinstance(v, E):
        return f"CAST(({v}) AS {dtype})"
    if v is None:
        return f"CAST(NULL AS {dtype})"
    if isinstance(v, bool):
        return f"CAST({'true' if v else 'false'} AS {dtype})"
    if isinstance(v, (int, float)):
        return f"CAST({float(v)!r} AS {dtype})" if dtype == "double" else f"CAST({v!r} AS {dtype})"
    return "CAST('" + str(v).replace("\\", "\\\\").replace("'", "\\'") + f"' AS {dtype})"


def _lit(v: Any, dtype: str) -> Column:
    if isinstance(v, Column):
        return v.cast(dtype)
    return F.lit(v).cast(dtype)


def compare(value: Column, comparison: str, threshold: Column) -> Column:
    ops = {
        ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
        "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
        "==": lambda a, b: a == b,
    }
    return ops[comparison](value, threshold)


@dataclass
class GateRow:
    gate: str
    metric: str
    value: Any
    threshold: Any = None
    comparison: str | None = None
    passed: Any = None
    subject: Any = None
    cases: Any = None
    violations: Any = None

    def struct(self) -> Column:
        value = _lit(self.value, "double")
        threshold = _lit(self.threshold, "double")
        if self.passed is None and self.comparison is not None:
            passed = compare(value, self.comparison, threshold)
        elif self.passed is None:
            passed = F.lit(True)  # an informational row is not a check
        else:
            passed = _lit(self.passed, "boolean")
        return F.struct(
            F.lit(self.gate).alias("gate"),
            F.lit(self.metric).alias("metric"),
            _lit(self.subject, "string").alias("subject"),
            value.alias("value"),
            threshold.alias("threshold"),
            F.lit(self.comparison).cast("string").alias("comparison"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
            _lit(self.cases, "long").alias("cases"),
            _lit(self.violations, "long").alias("violations"),
        )


    def is_sql(self) -> bool:
        return not any(isinstance(v, Column) for v in
                       (self.value, self.threshold, self.passed, self.subject, self.cases, self.violations))

    def sql(self) -> str:
        value = _sql_lit(self.value, "double")
        threshold = _sql_lit(self.threshold, "double")
        if self.passed is None and self.comparison is not None:
            passed = f"({value} {'=' if self.comparison == '==' else self.comparison} {threshold})"
        elif self.passed is None:
            passed = "true"
        else:
            passed = _sql_lit(self.passed, "boolean")
        fields = [("gate", _sql_lit(self.gate, "string")), ("metric", _sql_lit(self.metric, "string")),
                  ("subject", _sql_lit(self.subject, "string")), ("value", value), ("threshold", threshold),
                  ("comparison", _sql_lit(self.comparison, "string")),
                  ("passed", f"coalesce({passed}, false)"), ("cases", _sql_lit(self.cases, "bigint")),
                  ("violations", _sql_lit(self.violations, "bigint"))]
        return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields) + ")"


def rows_from(one_row: DataFrame, rows: list[GateRow]) -> DataFrame:
    """Unpivot GateRow specs evaluated on a one-row DataFrame into gate rows.
    Rows given as SQL are built as one expression (one parse, not one JVM call
    per field)."""
    if all(r.is_sql() for r in rows):
        return one_row.selectExpr(f"inline(array({', '.join(r.sql() for r in rows)}))").select(*GATE_COLUMNS)
    return one_row.select(F.inline(F.array(*[r.struct() for r in rows]))).select(*GATE_COLUMNS)
