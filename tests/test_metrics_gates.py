"""Metrics and gate cases of FIXTURES F10/F11."""

import math

import pytest

from readyspark.operators import gates as G
from readyspark.operators import metrics as M
from readyspark.operators.variants import Variant, score_variants
from readyspark.operators.score import Scorecard, Term


def scored(spark, y, p, s=None, g=None):
    rows = [(i, y[i], p[i], None if s is None else s[i], None if g is None else g[i]) for i in range(len(y))]
    return spark.createDataFrame(rows, "id long, label int, prediction int, p_bad double, sex string")


def test_six_metrics(spark):
    df = scored(spark, [0, 1, 0, 0], [0, 1, 1, 0], [0.10, 0.80, 0.60, 0.30])
    m = {r["metric"]: r["value"] for r in M.classification_metrics(df).collect()}
    assert m["accuracy"] == 0.75 and m["precision"] == 0.5 and m["recall"] == 1.0
    assert math.isclose(m["f1"], 2 / 3) and m["roc_auc"] == 1.0
    assert math.isclose(m["mcc"], 0.5773502691896258)


def test_auc_ties_and_buckets(spark):
    y = [0, 1, 0, 1, 1, 0, 1, 0, 0, 1]
    s = [0.2, 0.2, 0.5, 0.5, 0.9, 0.1, 0.7, 0.7, 0.3, 0.6]
    df = scored(spark, y, [0] * 10, s)
    pairs = [(a, b) for a in range(10) for b in range(10) if y[a] == 1 and y[b] == 0]
    brute = sum(1.0 if s[a] > s[b] else 0.5 if s[a] == s[b] else 0.0 for a, b in pairs) / len(pairs)
    assert math.isclose(M.roc_auc(df, "label", "p_bad").first()[0], brute)
    assert math.isclose(M.roc_auc(df, "label", "p_bad", rows_per_bucket=2).first()[0], brute)


def test_zero_division_gives_zero(spark):
    m = {r["metric"]: r["value"] for r in M.classification_metrics(scored(spark, [0, 0], [0, 0], [0.1, 0.2])).collect()}
    assert m["precision"] == 0.0 and m["recall"] == 0.0 and m["f1"] == 0.0 and m["mcc"] == 0.0
    assert m["roc_auc"] is None


# five of the first group, six of the second, interleaved
SEX = ["male", "female", "female", "male", "female", "male", "female", "male", "female", "male", "female"]


def fair(spark, y, p):
    rows = G.fairness_gate(scored(spark, y, p, g=SEX), "sex", "label", "prediction").collect()
    return {(r["metric"], r["subject"]): (r["value"], r["passed"]) for r in rows}


def test_fairness_unequal_and_equal(spark):
    # male rows 0, 3, 5, 7, 9 with labels 0 0 0 0 1; female rows 1, 2, 4, 6, 8, 10 with labels 0 0 1 1 1 1
    y = [0, 0, 0, 0, 1, 0, 1, 0, 1, 1, 1]
    p = [1, 0, 1, 0, 1, 0, 0, 0, 1, 1, 1]  # male FP 1 of 4, FN 0 of 1; female FP 1 of 2, FN 1 of 4
    r = fair(spark, y, p)
    assert r[("false_positive_rate", "male")][0] == 0.25 and r[("false_positive_rate", "female")][0] == 0.5
    assert r[("false_negative_rate", "male")][0] == 0.0 and r[("true_positive_rate", "female")][0] == 0.75
    assert r[("separation_difference", None)] == (0.25, False)
    r = fair(spark, y, y)  # all right in both groups
    assert r[("separation_difference", None)] == (0.0, True)


def test_fairness_empty_denominators(spark):
    male = [i for i, s in enumerate(SEX) if s == "male"]
    ones = [1 if i in male else i % 2 for i in range(11)]
    r = fair(spark, ones, [i % 3 == 0 and 1 or 0 for i in range(11)])
    assert r[("false_positive_rate", "male")][0] == 0.0  # no negative among them
    zeros = [0 if i in male else i % 2 for i in range(11)]
    r = fair(spark, zeros, [1] * 11)
    assert r[("false_negative_rate", "male")][0] == 0.0 and r[("true_positive_rate", "male")][0] == 0.0


def test_fairness_missing_group(spark):
    df = scored(spark, [0, 1], [0, 1], g=["male", "male"])
    rows = {r["metric"]: r for r in G.fairness_gate(df, "sex", "label", "prediction").collect()}
    assert rows["separation_difference"]["passed"] is False
    with pytest.raises(ValueError):
        G.fairness_gate(df, "sex", "label", "prediction", strict=True)


def test_majority_baseline(spark):
    train = spark.createDataFrame([(0,)] * 7 + [(1,)] * 3, "label int")
    test = spark.createDataFrame([(0,)] * 6 + [(1,)] * 4, "label int")
    assert M.majority_baseline(train, test).first()["baseline_accuracy"] == 0.6


def test_performance_gate_boundary(spark):
    vals = {"accuracy": .75, "precision": .60, "recall": .75, "f1": .65, "roc_auc": .85, "mcc": .45}
    metrics = spark.createDataFrame(list(vals.items()), "metric string, value double")
    base = spark.createDataFrame([(0, 0.70)], "majority_class int, baseline_accuracy double")
    assert all(r["passed"] for r in G.performance_gate(metrics, base).collect())
    at = spark.createDataFrame([("precision", 0.5)], "metric string, value double")
    assert not G.performance_gate(at, base).first()["passed"]


def test_robustness_and_metamorphic(spark):
    # base p: .3,.4,.5,.6 -> labels by cutoff .45; a duration variant lowers every p by .1
    df = spark.createDataFrame([(i, 1 if i < 2 else 0, float(d)) for i, d in enumerate([30, 40, 50, 60])],
                               "id long, label int, duration double")
    card = Scorecard(0.0, [Term("duration", 0.01)], cutoff=0.35)
    from pyspark.sql import functions as F
    variants = [Variant("perturbation", {}), Variant("inflation", {"duration": F.col("duration") - 20}),
                Variant("duration_increase", {"duration": F.col("duration") - 10}, F.lit(True), "increase")]
    vs = score_variants(df, card, variants, keep=["id", "label"])
    mm = G.metamorphic_gate(vs, {"duration_increase": "increase"}).first()
    assert (mm["cases"], mm["violations"], mm["value"], mm["passed"]) == (4, 4, 1.0, False)
    rob = {r["metric"]: r["value"] for r in G.robustness_gate(vs, "label").collect()}
    assert rob["robustness_perturbation"] == 1.0
    assert math.isclose(rob["f1_clean"], 0.4) and rob["f1_inflation"] == 0.0


def test_verdict(spark):
    rows = spark.createDataFrame([("a", True), ("b", False)], "gate string, passed boolean")
    v = G.verdict(rows).first()
    assert v["production_ready"] is False and v["failed_checks"] == 1
