"""Model gates and the readiness report.

Each gate returns gate rows (see ``gaterows``). Inputs are scored tables, so
every gate is one or two aggregates; thresholds are parameters.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readyspark import presets as P
from readyspark.operators.gaterows import GATE_COLUMNS, GateRow, rows_from
from readyspark.operators.metrics import METRICS, classification_metrics, confusion, rate_columns
from readyspark.session import cut_lineage

PERFORMANCE = "performance"
FAIRNESS = "fairness"
ROBUSTNESS = "robustness"
METAMORPHIC = "metamorphic"


def group_rates(df: DataFrame, group: str, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """G1: samples, FPR, FNR, TPR per group (0 for an empty denominator).
    A null group is its own row."""
    conf = confusion(df, label, prediction, [group])
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    z = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    return conf.select(group, "samples", "tn", "fp", "fn", "tp",
                       z(fp, fp + tn).alias("false_positive_rate"),
                       z(fn, fn + tp).alias("false_negative_rate"),
                       z(tp, tp + fn).alias("true_positive_rate"))


def separation_gap(rates: DataFrame, group: str, groups: Sequence[str] | None = P.FAIRNESS_GROUPS,
                   threshold: float = P.FAIRNESS_THRESHOLD) -> DataFrame:
    """Mean of the absolute FPR and FNR gaps, passed when <= threshold.

    With two named groups the gap is between them and an absent group fails
    the gate (value null). With ``groups=None`` the gap is max minus min over
    all non-null groups. One aggregate over the small rates table.
    """
    g = F.col(group)
    if groups is not None:
        a, b = groups
        pick = lambda name, col: F.max(F.when(g == name, F.col(col)))
        one = rates.agg(
            F.abs(pick(a, "false_positive_rate") - pick(b, "false_positive_rate")).alias("fpr_difference"),
            F.abs(pick(a, "false_negative_rate") - pick(b, "false_negative_rate")).alias("fnr_difference"))
    else:
        live = rates.where(g.isNotNull())
        one = live.agg(
            (F.max("false_positive_rate") - F.min("false_positive_rate")).alias("fpr_difference"),
            (F.max("false_negative_rate") - F.min("false_negative_rate")).alias("fnr_difference"))
    sep = (F.col("fpr_difference") + F.col("fnr_difference")) / 2
    return rows_from(one, [
        GateRow(FAIRNESS, "fpr_difference", F.col("fpr_difference")),
        GateRow(FAIRNESS, "fnr_difference", F.col("fnr_difference")),
        GateRow(FAIRNESS, "separation_difference", sep, threshold, "<="),
    ])


def fairness_gate(scored: DataFrame, group: str, label: str = "label", prediction: str = "prediction",
                  groups: Sequence[str] | None = P.FAIRNESS_GROUPS,
                  threshold: float = P.FAIRNESS_THRESHOLD, strict: bool = False) -> DataFrame:
    """G1 + G2. Rate rows per group (metric = rate name, subject = group) and
    the gap rows. ``strict`` raises when a named group is absent."""
    rates = group_rates(scored, group, label, prediction)
    if strict and groups is not None:
        found = rates.agg(*[F.coalesce(F.bool_or(F.col(group) == g), F.lit(False)).alias(f"_{i}")
                            for i, g in enumerate(groups)]).first()  # one row, however many groups there are
        absent = [g for i, g in enumerate(groups) if not found[i]]
        if absent:
            raise ValueError(f"fairness needs groups {list(groups)}; absent: {absent}")
    per_group = rates.select(F.inline(F.array(*[
        F.struct(F.lit(FAIRNESS).alias("gate"), F.lit(m).alias("metric"),
                 F.col(group).cast("string").alias("subject"), F.col(m).cast("double").alias("value"),
                 F.lit(None).cast("double").alias("threshold"), F.lit(None).cast("string").alias("comparison"),
                 F.lit(True).alias("passed"), F.col("samples").cast("long").alias("cases"),
                 F.lit(None).cast("long").alias("violations"))
        for m in ("false_positive_rate", "false_negative_rate", "true_positive_rate")]))).select(*GATE_COLUMNS)
    return per_group.unionByName(separation_gap(rates, group, groups, threshold))


def performance_gate(metrics: DataFrame, baseline: DataFrame,
                     thresholds: Mapping[str, float] = P.PERFORMANCE_THRESHOLDS) -> DataFrame:
    """Every metric strictly above its threshold; accuracy above the
    majority baseline (a one-row table). Metric rows meet thresholds in a join
    of two tables of six rows."""
    spark = metrics.sparkSession
    fixed = spark.createDataFrame([(m, float(t)) for m, t in thresholds.items()], "metric string, threshold double")
    base = baseline.select(F.lit("accuracy").alias("metric"), F.col("baseline_accuracy").alias("threshold"))
    limits = fixed.unionByName(base)
    joined = metrics.join(limits, on="metric", how="left")
    return joined.select(
        F.lit(PERFORMANCE).alias("gate"), F.col("metric"), F.lit(None).cast("string").alias("subject"),
        F.col("value"), F.col("threshold"), F.lit(">").alias("comparison"),
        F.coalesce(F.col("value") > F.col("threshold"), F.lit(False)).alias("passed"),
        F.lit(None).cast("long").alias("cases"), F.lit(None).cast("long").alias("violations"))


def _robustness_counts(label: str) -> list:
    """True and false positives and false negatives of the clean, perturbed and
    inflated predictions, as aggregates over the multi-variant table."""
    y, v = F.col(label), F.col("variant")
    aggs = []
    # the base prediction of every row is read from its perturbation copy
    for name, pred, cond in (("clean", F.col("pred_base"), v == "perturbation"),
                             ("perturbation", F.col("prediction"), v == "perturbation"),
                             ("inflation", F.col("prediction"), v == "inflation")):
        aggs += [F.count_if((y == 1) & (pred == 1) & cond).alias(f"tp_{name}"),
                 F.count_if((y == 0) & (pred == 1) & cond).alias(f"fp_{name}"),
                 F.count_if((y == 1) & (pred == 0) & cond).alias(f"fn_{name}")]
    return aggs


def _robustness_rows(one: DataFrame, threshold: float) -> DataFrame:
    f1 = {n: F.coalesce(F.try_divide((2 * F.col(f"tp_{n}")).cast("double"),
                                     (2 * F.col(f"tp_{n}") + F.col(f"fp_{n}") + F.col(f"fn_{n}")).cast("double")),
                        F.lit(0.0))
          for n in ("clean", "perturbation", "inflation")}
    r_p = F.try_divide(f1["perturbation"], f1["clean"])
    r_i = F.try_divide(f1["inflation"], f1["clean"])
    return rows_from(one, [
        GateRow(ROBUSTNESS, "f1_clean", f1["clean"]),
        GateRow(ROBUSTNESS, "f1_perturbation", f1["perturbation"]),
        GateRow(ROBUSTNESS, "f1_inflation", f1["inflation"]),
        GateRow(ROBUSTNESS, "robustness_perturbation", r_p),
        GateRow(ROBUSTNESS, "robustness_inflation", r_i),
        GateRow(ROBUSTNESS, "mean_robustness_score", (r_p + r_i) / 2, threshold, ">="),
    ])


def _metamorphic_counts(directions: Mapping[str, str], tolerance: float) -> list:
    for name, d in directions.items():
        if d not in ("increase", "decrease"):
            raise ValueError(f"unknown expected direction {d!r} for {name}")
    v, m = F.col("variant"), F.col("mask")
    p, p0 = F.col("p_bad"), F.col("p_base")
    aggs = []
    for name, d in directions.items():
        bad = (p < p0 - tolerance) if d == "increase" else (p > p0 + tolerance)
        aggs += [F.count_if((v == name) & m).alias(f"c_{name}"),
                 F.count_if((v == name) & m & bad).alias(f"v_{name}")]
    return aggs


def _metamorphic_rows(one: DataFrame, directions: Mapping[str, str], max_rate: float) -> DataFrame:
    rows = []
    for name in directions:
        cases, viol = F.col(f"c_{name}"), F.col(f"v_{name}")
        rate = F.coalesce(F.try_divide(viol.cast("double"), cases.cast("double")), F.lit(0.0))
        rows.append(GateRow(METAMORPHIC, "violation_rate", rate, max_rate, "<=", subject=name,
                            cases=cases, violations=viol))
    return rows_from(one, rows)


def robustness_gate(variant_scores: DataFrame, label: str = "label",
                    threshold: float = P.ROBUSTNESS_THRESHOLD) -> DataFrame:
    """F1 of the clean, perturbed and inflated predictions (one aggregate
    over the multi-variant table), their ratios and the mean ratio."""
    return _robustness_rows(variant_scores.agg(*_robustness_counts(label)), threshold)


def metamorphic_gate(variant_scores: DataFrame, directions: Mapping[str, str],
                     max_rate: float = P.MAX_VIOLATION_RATE, tolerance: float = 0.0) -> DataFrame:
    """Per relation the masked cases, the violations (p_bad moved
    against the expected direction by more than ``tolerance``) and their rate
    (0 when there are no cases); passed when rate <= max_rate."""
    one = variant_scores.agg(*_metamorphic_counts(directions, tolerance))
    return _metamorphic_rows(one, directions, max_rate)


def variant_gates(variant_scores: DataFrame, directions: Mapping[str, str], label: str = "label",
                  threshold: float = P.ROBUSTNESS_THRESHOLD, max_rate: float = P.MAX_VIOLATION_RATE,
                  tolerance: float = 0.0) -> DataFrame:
    """G4 and G6 of one multi-variant table from one aggregate: base and every
    variant are scored once. The aggregate's row is written, so the two sets of
    gate rows built from it don't score again."""
    one = cut_lineage(variant_scores.agg(*_robustness_counts(label), *_metamorphic_counts(directions, tolerance)))
    return _robustness_rows(one, threshold).unionByName(_metamorphic_rows(one, directions, max_rate))


def report(gate_rows: Sequence[DataFrame]) -> DataFrame:
    """All gate rows in one table."""
    out = gate_rows[0]
    for g in gate_rows[1:]:
        out = out.unionByName(g)
    return out


def overview(rows: DataFrame) -> DataFrame:
    """G8 overview: one row per gate with its verdict."""
    return rows.groupBy("gate").agg(F.bool_and("passed").alias("gate_passed"),
                                    F.count(F.lit(1)).alias("checks"))


def verdict(rows: DataFrame) -> DataFrame:
    """One row, true when every check of every gate passed."""
    return rows.agg(F.coalesce(F.bool_and("passed"), F.lit(False)).alias("production_ready"),
                    F.count_if(~F.col("passed")).alias("failed_checks"))


__all__ = ["group_rates", "separation_gap", "fairness_gate", "performance_gate", "robustness_gate",
           "metamorphic_gate", "variant_gates", "report", "overview", "verdict", "METRICS", "classification_metrics",
           "rate_columns"]
