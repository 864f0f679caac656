"""Feature cases of FIXTURES F4 and F5."""

import pytest

from readyspark.operators.features import (calculate_features, encode_target, feature_engineering,
                                           gender_from_status, sex_from_status)

F4 = [(2400.0, 24.0, 23.0, "none", "<0", "<100"),
      (6000.0, 30.0, 35.0, "guarantor", "0<=X<200", "500<=X<1000"),
      (12000.0, 48.0, 61.0, "co applicant", "<0", "no known savings")]
F4_SCHEMA = ("credit_amount double, duration double, age double, other_parties string, "
             "checking_status string, savings_status string")


def test_calculated_features(spark):
    out = calculate_features(spark.createDataFrame(F4, F4_SCHEMA)).collect()
    got = [(r["monthly_payment"], r["age_group"], r["has_additional_security"], r["high_risk_financial_status"])
           for r in out]
    assert got == [(100.0, "<25", 0, 1), (200.0, "25-40", 1, 0), (250.0, "60+", 1, 1)]


def test_age_outside_bins_is_null_and_missing_party_counts(spark):
    df = spark.createDataFrame([(100.0, 1.0, 17.0, None, None, None)], F4_SCHEMA)
    r = calculate_features(df).first()
    assert r["age_group"] is None and r["has_additional_security"] == 1 and r["high_risk_financial_status"] == 0


def test_zero_duration_payment_is_null(spark):
    r = calculate_features(spark.createDataFrame([(100.0, 0.0, 30.0, "none", "<0", "<100")], F4_SCHEMA)).first()
    assert r["monthly_payment"] is None


def test_sex_and_gender(spark):
    df = spark.createDataFrame([("female div/dep/mar",), ("male single",), ("A92",), ("unknown",), (None,)], "ps string")
    rows = df.select(sex_from_status("ps").alias("s"), gender_from_status("ps").alias("g")).collect()
    assert [(r["s"], r["g"]) for r in rows] == [("female", "female"), ("male", "male"), (None, "female"),
                                               (None, "unknown"), (None, "unknown")]


def test_feature_engineering_drops_sensitive_and_needs_them(spark):
    df = spark.createDataFrame([(2400.0, 24.0, 23.0, "none", "<0", "<100", "female single", "yes", "yes")],
                               F4_SCHEMA + ", personal_status string, foreign_worker string, own_telephone string")
    out = feature_engineering(df)
    assert "sex" in out.columns and not {"personal_status", "foreign_worker", "own_telephone", "age"} & set(out.columns)
    with pytest.raises(ValueError):
        feature_engineering(df.drop("own_telephone"))


def test_target_encoding(spark):
    df = spark.createDataFrame([("good",), ("bad",), ("good",), ("bad",)], "class string")
    assert [r[0] for r in encode_target(df).collect()] == [0, 1, 0, 1]
    for bad in ["invalid", None]:
        with pytest.raises(ValueError, match="invalid" if bad else "None"):
            encode_target(spark.createDataFrame([("good",), (bad,)], "class string"))


def test_pick_keeps_null_index_null(spark):
    from pyspark.sql import functions as F

    from readyspark.functions.exprs import pick
    df = spark.createDataFrame([(0,), (None,)], "i int")
    out = df.select(pick("i", ["a", "b"]).alias("v"))
    assert [r[0] for r in out.collect()] == ["a", None]
    assert out.agg(F.count_if(F.col("v").isNull())).first()[0] == 1
