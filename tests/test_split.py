"""Exact stratified split and folds (FIXTURES F6), repartition invariance."""

from pyspark.sql import functions as F

import readyspark.operators.metrics as M
from readyspark.operators.split import quotas, stratified_folds, stratified_split


def f6(spark, parts=None):
    rows = [(i, 12 + i, 1000 + i, 100.0, "<0", "male" if i % 2 == 0 else "female", 0 if i < 70 else 1)
            for i in range(100)]
    df = spark.createDataFrame(rows, "app_id long, duration int, credit_amount int, monthly_payment double, "
                                     "checking_status string, sex string, class int")
    return df.repartition(parts) if parts else df


def counts(df):
    return {(r["split"], r["class"]): r["n"] for r in df.groupBy("split", "class").agg(F.count("*").alias("n")).collect()}


def test_exact_counts_and_shares(spark):
    out = stratified_split(f6(spark), "class", "app_id", 0.2, 42)
    assert out.count() == 100
    assert counts(out) == {("train", 0): 56, ("train", 1): 24, ("test", 0): 14, ("test", 1): 6}
    assert out.where("split = 'test'").select("sex").where("sex IS NULL").count() == 0


def test_same_rows_on_any_partitioning_and_bucketing(spark):
    ref = sorted(r[0] for r in stratified_split(f6(spark), "class", "app_id").where("split = 'test'").collect())
    for parts in (1, 4, 17):
        got = stratified_split(f6(spark, parts), "class", "app_id").where("split = 'test'").select("app_id")
        assert sorted(r[0] for r in got.collect()) == ref
    # many buckets per class: the bucketed rank must give the same rows
    got = stratified_split(f6(spark, 3), "class", "app_id", rows_per_bucket=5).where("split = 'test'").select("app_id")
    assert sorted(r[0] for r in got.collect()) == ref


def test_folds_balanced_and_stable(spark):
    df = f6(spark)
    a = stratified_folds(df, "class", "app_id", 5, 42)
    per = {(r["fold"], r["class"]): r["n"] for r in a.groupBy("fold", "class").agg(F.count("*").alias("n")).collect()}
    assert all(per[(f, 0)] == 14 and per[(f, 1)] == 6 for f in range(5))
    b = stratified_folds(f6(spark, 7), "class", "app_id", 5, 42, rows_per_bucket=4)
    assert sorted(map(tuple, a.select("app_id", "fold").collect())) == sorted(map(tuple, b.select("app_id", "fold").collect()))


def test_as_many_classes_as_rows(spark):
    df = spark.range(12_000).withColumnRenamed("id", "app_id").withColumn("c", F.col("app_id") * 7)
    weighted = M.with_class_weights(df, "c")
    assert weighted.columns == ["app_id", "c", "weight"] and weighted.where("weight = 1.0").count() == 12_000
    out = stratified_split(df, "c", "app_id", 0.2, 42)
    assert out.columns == ["app_id", "c", "split"] and out.where("split = 'test'").count() == 2400


def test_quotas_follow_the_largest_remainder(spark):
    counts = spark.createDataFrame([("a", 3), ("b", 3), ("c", 4), (None, 50)], "_class string, _n long")
    assert {r[0]: r[1] for r in quotas(counts, 0.5).collect()} == {"a": 2, "b": 1, "c": 2, None: 0}
    even = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "_class string, _n long")
    assert {r[0]: r[1] for r in quotas(even, 0.5).collect()} == {"a": 1, "b": 1, "c": 0}
    big = spark.createDataFrame([(0, 6 * 10**12 + 1), (1, 4 * 10**12 + 1)], "_class int, _n long")
    assert {r[0]: r[1] for r in quotas(big, 0.25).collect()} == {0: 1_500_000_000_001, 1: 1_000_000_000_000}


def test_null_labels_are_train_and_size_the_buckets(spark):
    rows = [(i, 0 if i < 10 else 1 if i < 20 else None) for i in range(120)]
    df = spark.createDataFrame(rows, "app_id long, class int")
    out = stratified_split(df, "class", "app_id", 0.2, 42, rows_per_bucket=20)
    got = {(r["split"], r["class"]): r["n"] for r in out.groupBy("split", "class").count().withColumnRenamed("count", "n").collect()}
    assert got == {("test", 0): 2, ("test", 1): 2, ("train", 0): 8, ("train", 1): 8, ("train", None): 100}
    ref = stratified_split(df, "class", "app_id", 0.2, 42).where("split = 'test'").select("app_id")
    assert sorted(ref.collect()) == sorted(out.where("split = 'test'").select("app_id").collect())
