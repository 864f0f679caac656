"""Variant cases of FIXTURES F8 and F9."""

from readyspark import presets as P
from readyspark.operators import variants as V

F8 = [(1, 12.0, 1200.0, 100.0, "<0"), (2, 24.0, 2400.0, 100.0, "0<=X<200"), (3, 36.0, 3600.0, 100.0, ">=200")]
S8 = "app_id long, duration double, credit_amount double, monthly_payment double, checking_status string"


def test_perturbation_in_range_and_repeatable(spark):
    df = spark.createDataFrame(F8, S8)
    a = V.apply_variant(df, V.perturbation("app_id")).orderBy("app_id").collect()
    b = V.apply_variant(df.repartition(3), V.perturbation("app_id")).orderBy("app_id").collect()
    assert a == b and len(a) == 3
    for r, (_, d, amt, _, _) in zip(a, F8):
        assert 0.95 * d - 0.5 <= r["duration"] <= 1.05 * d + 0.5 and r["duration"] == round(r["duration"])
        assert 0.95 * amt <= r["credit_amount"] < 1.05 * amt
        assert r["monthly_payment"] == r["credit_amount"] / r["duration"]


def test_inflation(spark):
    r = V.apply_variant(spark.createDataFrame(F8, S8), V.inflation()).orderBy("app_id").first()
    assert r["credit_amount"] == 1200.0 * 1.03 and r["monthly_payment"] == 1200.0 * 1.03 / 12.0


F9 = [(12.0, "<0", "100<=X<500"), (24.0, "0<=X<200", "500<=X<1000"), (36.0, ">=200", ">=1000"),
      (48.0, "no checking", "<100"), (60.0, "<0", "no known savings")]


def test_category_moves_and_masks(spark):
    df = spark.createDataFrame(F9, "duration double, checking_status string, savings_status string")
    ch, cm = V.category_move("checking_status", P.CHECKING_IMPROVEMENT, P.CHECKING_MOVABLE)
    got = df.select(ch["checking_status"].alias("c"), cm.alias("m")).collect()
    assert [(r["c"], r["m"]) for r in got] == [("0<=X<200", True), (">=200", True), (">=200", False),
                                               ("no checking", False), ("0<=X<200", True)]
    sv, sm = V.category_move("savings_status", P.SAVINGS_DETERIORATION, P.SAVINGS_MOVABLE)
    got = df.select(sv["savings_status"].alias("s"), sm.alias("m")).collect()
    assert [(r["s"], r["m"]) for r in got] == [("<100", True), ("100<=X<500", True), ("500<=X<1000", True),
                                               ("<100", False), ("no known savings", False)]


def test_duration_shift(spark):
    df = spark.createDataFrame([(12.0, 1200.0)], "duration double, credit_amount double")
    r = V.apply_variant(df, V.duration_increase()).first()
    assert r["duration"] == 24.0 and r["monthly_payment"] == 50.0
