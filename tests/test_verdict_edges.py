"""Edges found by review: large counts, limits that are gone, unusual values."""

import pytest
from pyspark.sql import functions as F

from readyspark import presets as P
from readyspark.functions.exprs import right_closed_bins, strip
from readyspark.operators import clean as C
from readyspark.operators import gates as G
from readyspark.operators import metrics as M
from readyspark.operators import ordered as O
from readyspark.operators import rules as R
from readyspark.session import configure, release_tables, run_tables, scale_conf


def test_auc_of_five_billion_rows_of_each_class(spark):
    n = 5_000_000_000
    counts = spark.createDataFrame([(0.1, 0, n // 2), (0.5, n // 2, n // 2), (0.9, n // 2, 0)], "_s double, _pos long, _neg long")
    assert M._auc_of_counts(counts, [], 10).first()["roc_auc"] == pytest.approx(0.875, abs=1e-12)


def test_share_rules_on_the_very_limit(spark):
    df = spark.createDataFrame([(i, "x" if i else "bad", float(i)) for i in range(10)], "i int, c string, v double")
    rows = R.evaluate_rules(df, [R.InSet("c", ("x",), mostly=0.9), R.Between("v", min_value=1, mostly=0.9),
                                 R.InSet("c", ("x",), mostly=0.91)], "g").collect()
    assert [r["passed"] for r in rows] == [True, True, False]


def test_class_share_rules_on_two_columns(spark):
    df = spark.createDataFrame([(i % 4, "a" if i < 90 else "b", i) for i in range(100)], "k int, c string, n int")
    rows = R.evaluate_rules(df, [R.RowCount(min_value=100, max_value=100), R.MinClassShare("k", 0.2), R.MinClassShare("c", 0.2),
                                 R.NotNull("n")], "g").collect()
    got = {(r["metric"], r["subject"]): (r["value"], r["passed"]) for r in rows}
    assert got[("min_class_share", "k")] == (0.25, True) and got[("min_class_share", "c")] == (0.1, False)
    assert got[("row_count", "table")] == (100.0, True) and got[("not_null", "n")] == (1.0, True)


def test_nan_has_no_bin_and_every_white_space_is_trimmed(spark):
    df = spark.createDataFrame([(float("nan"), "\u00a0own\u2003"), (70.0, "\t own\r\n")], "v double, t string")
    got = df.select(right_closed_bins("v", [17, 60, float("inf")], ["young", "old"]), strip("t")).collect()
    assert [tuple(r) for r in got] == [(None, "own"), ("old", "own")]


@pytest.mark.parametrize("n", [2, 1500])
def test_domains_of_any_size_keep_the_columns(spark, n):
    df = spark.createDataFrame([(1, "v1", 5), (2, "w", 6), (3, None, 7)], "id long, c string, z int")
    out = C.domain_filter(df, {"c": [f"v{i}" for i in range(n)]})
    assert out.columns == ["id", "c", "z"] and [tuple(r) for r in out.collect()] == [(1, "v1", 5)]
    rows = spark.createDataFrame([(1.0, "v1", "good"), (1.0, "w", "good")], "a double, c string, class string")
    counts = C.clean_reason_counts(rows, ["a"], {}, {"c": [f"v{i}" for i in range(n)]}, "class", ["good"])
    got = {r["reason"]: r["rows"] for r in counts.collect()}
    assert got["invalid_category_rows"] == 1 and got["kept_rows"] == 1


def test_alignment_is_checked(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k long, l string")
    assert C.aligned(a, a.select("k", F.lit(1).alias("p")), "k").count() == 2
    for bad in ([(1, 0)], [(1, 0), (2, 0), (2, 1)], [(1, 0), (3, 0)], [(1, 0), (None, 0)]):
        with pytest.raises(ValueError, match="align"):
            C.aligned(a, spark.createDataFrame(bad, "k long, p int"), "k")


def test_value_buckets_of_two_levels(spark, monkeypatch):
    monkeypatch.setattr(O, "MAX_VALUE_BUCKETS", 4)
    df = spark.range(1000).select((F.col("id") * 37 % 1000).cast("double").alias("v"))
    rows = O.value_buckets(df, "v", 30, "b").orderBy("v").collect()
    buckets = [r["b"] for r in rows]
    assert buckets == sorted(buckets) and max(buckets.count(b) for b in set(buckets)) <= 60
    got = O.exact_quantiles(df.withColumn("g", F.lit(1)), ["g"], "v", [0.5], rows_per_bucket=20).first()["value"]
    assert got == 499.5


def test_strict_fairness_names_the_absent_group(spark):
    df = spark.createDataFrame([("male", 1, 1)], "sex string, label int, prediction int")
    with pytest.raises(ValueError, match="female"):
        G.fairness_gate(df, "sex", groups=("female", "male"), strict=True)


def test_settings_of_the_user_win(spark):
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "9000")
    try:
        assert configure(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == "9000"
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    assert scale_conf(1)["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"


def test_release_deletes_this_runs_tables_only(spark, tmp_path):
    from readyspark.session import cut_lineage
    before = cut_lineage(spark.range(3))
    assert before.count() == 3 and spark.sparkContext.applicationId in run_tables(spark)
    release_tables(spark)
    with pytest.raises(Exception):
        before.count()


def test_preset_values():
    """Plain copies of what the checks rest on, so a wrong preset can't hide in both sides of an oracle."""
    assert (P.TEST_SIZE, P.SEED, P.N_FOLDS, P.SEARCH_ITERATIONS) == (0.2, 42, 5, 20)
    assert P.EMPLOYMENT_ORDER == ["unemployed", "<1", "1<=X<4", "4<=X<7", ">=7"]
    assert P.PARAM_SPACE["n_estimators"] == [100, 200, 300, 500] and P.PARAM_SPACE["max_depth"] == [None, 3, 5, 10, 20, 30]
    assert dict(P.TARGET_MAPPING) == {"good": 0, "bad": 1}
