"""Rule-suite cases of FIXTURES F2 and F3; fused equals one-by-one."""

from pyspark.sql import functions as F

from readyspark.operators import rules as R


def raw(spark, n=1000, bad=300, nulls=0):
    rows = [("<0", 12, 1000 + i, 30, "bad" if i < bad else "good") for i in range(n)]
    df = spark.createDataFrame(rows, "checking_status string, duration int, credit_amount int, age int, class string")
    if nulls:
        df = df.withColumn("duration", F.when(F.col("credit_amount") < 1000 + nulls, None).otherwise(F.col("duration")))
    return df


def failed(df, rules):
    return {(r["metric"], r["subject"]) for r in R.evaluate_rules(df, rules, "g").where("NOT passed").collect()}


def test_raw_table_passes(spark):
    df = raw(spark)
    assert failed(df, R.raw_suite(df.columns)) == set()
    assert R.assert_rules(df, R.raw_suite(df.columns), "g") is df


def test_raw_failures(spark):
    df = raw(spark, n=999)
    assert ("row_count", "table") in failed(df, R.raw_suite(df.columns))
    df = raw(spark, nulls=60)
    assert failed(df, R.raw_suite(df.columns)) == {("not_null", "duration")}
    df = raw(spark, nulls=40)
    assert failed(df, R.raw_suite(df.columns)) == set()
    df = raw(spark, bad=50)
    assert failed(df, R.raw_suite(df.columns)) == {("min_class_share", "class")}
    df = raw(spark).drop("class")
    assert {("column_exists", "class"), ("min_class_share", "class")} <= failed(df, R.raw_suite(df.columns))
    empty = raw(spark).where("false")
    assert ("non_empty", "table") in failed(empty, R.raw_suite(empty.columns))


def test_assert_raises_with_every_failure(spark):
    df = raw(spark, n=999, bad=50)
    try:
        R.assert_rules(df, R.raw_suite(df.columns), "data_validation")
    except ValueError as e:
        assert "row_count" in str(e) and "min_class_share" in str(e)
    else:
        raise AssertionError("expected a failure")


def prepared(spark, n=800, ones=240, **over):
    rows = []
    for i in range(n):
        r = {"class": 1 if i < ones else 0, "duration": 12, "credit_amount": 1000, "checking_status": "<0",
             "savings_status": "<100", "monthly_payment": 100.0, "age_group": "25-40",
             "has_additional_security": 0, "high_risk_financial_status": 1}
        if i == 0:
            r.update(over)
        rows.append(r)
    return spark.createDataFrame(rows)


def test_prepared_cases(spark):
    assert failed(prepared(spark), R.prepared_suite()) == set()
    assert failed(prepared(spark, n=799), R.prepared_suite()) == {("row_count", "table")}
    assert failed(prepared(spark, ones=40), R.prepared_suite()) == {("min_class_share", "class")}
    assert failed(prepared(spark, **{"class": 2}), R.prepared_suite()) == {("in_set", "class"), ("min_class_share", "class")}
    assert failed(prepared(spark, monthly_payment=0.0), R.prepared_suite()) == {("between", "monthly_payment")}
    assert failed(prepared(spark, has_additional_security=3), R.prepared_suite()) == {("in_set", "has_additional_security")}
    assert failed(prepared(spark, age_group="invalid"), R.prepared_suite()) == {("in_set", "age_group")}
    assert failed(prepared(spark, monthly_payment=None), R.prepared_suite()) == {("not_null", "monthly_payment")}
    assert failed(prepared(spark).drop("age_group"), R.prepared_suite()) == {
        ("column_exists", "age_group"), ("not_null", "age_group"), ("in_set", "age_group")}
    assert failed(prepared(spark).withColumn("age", F.lit(30)), R.prepared_suite()) == {("column_absent", "age")}


def test_fused_equals_one_by_one(spark):
    df = prepared(spark, monthly_payment=0.0)
    suite = R.prepared_suite()
    fused = {(r["metric"], r["subject"], r["comparison"]): (r["value"], r["passed"])
             for r in R.evaluate_rules(df, suite, "g").collect()}
    single = {}
    for rule in suite:
        for r in R.evaluate_rules(df, [rule], "g").collect():
            single[(r["metric"], r["subject"], r["comparison"])] = (r["value"], r["passed"])
    assert fused == single
