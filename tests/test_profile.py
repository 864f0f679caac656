"""Profiling aggregates against brute force on small tables."""

import random

import numpy as np

from readyspark.operators import profile as PR
from readyspark.operators.ordered import exact_quantiles


def data(spark, n=500, seed=7):
    rnd = random.Random(seed)
    rows = [("a" if rnd.random() < 0.7 else "b", float(rnd.randint(0, 60)) + rnd.choice([0.0, 0.25]))
            for _ in range(n)]
    return rows, spark.createDataFrame(rows, "g string, v double")


def test_exact_quantiles_match_numpy_with_many_buckets(spark):
    rows, df = data(spark)
    for rpb in (10_000_000, 7):  # one bucket, and many small buckets
        got = {(r["g"], r["p"]): r["value"]
               for r in exact_quantiles(df, ["g"], "v", [0.25, 0.5, 0.75], rows_per_bucket=rpb).collect()}
        for g in ("a", "b"):
            vals = np.array([v for k, v in rows if k == g])
            for p in (0.25, 0.5, 0.75):
                assert abs(got[(g, p)] - np.quantile(vals, p)) < 1e-9


def test_quartiles_and_box(spark):
    rows, df = data(spark)
    q = {r["g"]: r for r in PR.group_quartiles(df, "g", "v").collect()}
    box = {r["g"]: r for r in PR.box_stats(df, "v", "g").collect()}
    for g in ("a", "b"):
        vals = np.array([v for k, v in rows if k == g])
        q1, q3 = np.quantile(vals, [0.25, 0.75])
        assert abs(q[g]["q1"] - q1) < 1e-9 and abs(q[g]["q3"] - q3) < 1e-9
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = vals[(vals >= lo) & (vals <= hi)]
        assert box[g]["whisker_low"] == inside.min() and box[g]["whisker_high"] == inside.max()
        assert box[g]["outliers"] == len(vals) - len(inside)
    overall = PR.box_stats(df, "v").first()
    assert overall["n"] == len(rows)


def test_histogram_matches_numpy(spark):
    rows, df = data(spark)
    got = {(r["g"], r["bin"]): r["n"] for r in PR.histogram(df, "g", "v", 20).collect()}
    for g in ("a", "b"):
        counts, _ = np.histogram([v for k, v in rows if k == g], bins=20)
        assert [got[(g, i)] for i in range(20)] == list(counts)
    odd = spark.createDataFrame([("c", 2.0), ("c", 2.0), (None, 1.0), (None, 3.0), ("e", None)], "g string, v double")
    bins = {(r["g"], r["bin"]): r["n"] for r in PR.histogram(odd, "g", "v", 4).collect()}
    assert bins == {("c", 0): 0, ("c", 1): 0, ("c", 2): 2, ("c", 3): 0,
                    (None, 0): 1, (None, 1): 0, (None, 2): 0, (None, 3): 1}


def test_value_counts_and_crosstab(spark):
    df = spark.createDataFrame([("x", 1), ("x", 0), ("y", 1), (None, 1)], "a string, c int")
    assert [(r["a"], r["n"]) for r in PR.value_counts(df, "a").collect()] == [("x", 2), ("y", 1)]
    share = {(r["a"], r["c"]): r["share"] for r in PR.crosstab_share(df, "a", "c").collect()}
    assert share == {("x", 0): 0.5, ("x", 1): 0.5, ("y", 0): 0.0, ("y", 1): 1.0}
    order = PR.ordered_crosstab(df, "a", ["y", "empty", "x"], "c").collect()
    assert [(r["a"], r["c"], r["n"], r["share"]) for r in order] == [
        ("y", 0, 0, 0.0), ("y", 1, 1, 1.0), ("empty", 0, 0, 0.0), ("empty", 1, 0, 0.0), ("x", 0, 1, 0.5), ("x", 1, 1, 0.5)]
    wide = {r["a"]: (r["0"], r["1"]) for r in PR.crosstab_wide(df, "a", "c", [0, 1]).collect()}
    assert wide == {"x": (0.5, 0.5), "y": (0.0, 1.0)}


def test_describe(spark):
    rows, df = data(spark)
    d = {r["g"]: r for r in PR.group_describe(df, "g", "v").collect()}
    vals = np.array([v for k, v in rows if k == "a"])
    assert d["a"]["count"] == len(vals) and abs(d["a"]["median"] - np.median(vals)) < 1e-9
    assert abs(d["a"]["std"] - vals.std(ddof=1)) < 1e-9


def test_describe_repeats_single_value_and_null_group(spark):
    rows = [("a", 2.0)] * 5 + [("a", 7.0)] * 3 + [("a", None), ("b", 4.0), (None, 1.0), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    d = {r["g"]: r for r in PR.group_describe(df, "g", "v").collect()}
    a = np.array([2.0] * 5 + [7.0] * 3)
    assert d["a"]["count"] == 8 and abs(d["a"]["mean"] - a.mean()) < 1e-12
    assert abs(d["a"]["std"] - a.std(ddof=1)) < 1e-12 and d["a"]["median"] == 2.0
    assert (d["a"]["min"], d["a"]["max"]) == (2.0, 7.0)
    assert d["b"]["count"] == 1 and d["b"]["std"] is None and d["b"]["median"] == 4.0
    assert d[None]["count"] == 2 and d[None]["mean"] == 2.0 and d[None]["median"] == 2.0
