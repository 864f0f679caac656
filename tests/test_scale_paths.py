"""The large-data code paths, forced on small inputs: many buckets, no
broadcast of the offsets/targets tables, a broadcast semi join for big rule
sets, and a skewed class holding most rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from readyspark.operators import clean as C
from readyspark.operators import metrics as M
from readyspark.operators import ordered as O
from readyspark.operators.split import stratified_split
from readyspark.plans import queries as Q
from tests.conftest import SF0001


def skewed(spark, n=3000, seed=3):
    rnd = random.Random(seed)
    rows = [(i, "hot" if i % 3 else rnd.choice(["a", "b", "c"]), float(rnd.randint(0, 500)), rnd.random() < 0.3)
            for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, g string, v double, y boolean")


def test_quantiles_without_broadcast_and_many_buckets(spark, monkeypatch):
    rows, df = skewed(spark)
    monkeypatch.setattr(O, "BROADCAST_ROWS", 0)
    got = {(r["g"], r["p"]): r["value"]
           for r in O.exact_quantiles(df.repartition(7), ["g"], "v", [0.1, 0.5, 0.9], rows_per_bucket=50).collect()}
    for g in ("hot", "a", "b", "c"):
        vals = np.array([v for _, k, v, _ in rows if k == g])
        for p in (0.1, 0.5, 0.9):
            assert abs(got[(g, p)] - np.quantile(vals, p)) < 1e-9


def test_split_without_broadcast_equals_single_bucket(spark, monkeypatch):
    _, df = skewed(spark)
    ref = stratified_split(df, "g", "id", 0.2, 42).where("split = 'test'").select("id").collect()
    monkeypatch.setattr(O, "BROADCAST_ROWS", 0)
    got = stratified_split(df.repartition(5), "g", "id", 0.2, 42, rows_per_bucket=40).where("split = 'test'")
    assert sorted(r[0] for r in got.select("id").collect()) == sorted(r[0] for r in ref)
    per = {r["g"]: r["n"] for r in got.groupBy("g").agg(F.count("*").alias("n")).collect()}
    assert sum(per.values()) == 600 and per["hot"] == 400


def test_auc_many_buckets_no_broadcast(spark, monkeypatch):
    rows, df = skewed(spark)
    df = df.withColumn("label", F.col("y").cast("int"))
    ref = M.roc_auc(df, "label", "v").first()[0]
    monkeypatch.setattr(O, "BROADCAST_ROWS", 0)
    assert abs(M.roc_auc(df, "label", "v", rows_per_bucket=20).first()[0] - ref) < 1e-12


def test_big_rule_set_uses_semi_join(spark, monkeypatch):
    monkeypatch.setattr(C, "ISIN_LIMIT", 2)
    df = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "c string")
    out = C.domain_filter(df, {"c": ["x", "y", "w"]})
    assert sorted(r[0] for r in out.collect()) == ["x", "y"]
    assert "LeftSemi" in out._jdf.queryExecution().executedPlan().toString()


def test_prepared_rows_are_written_before_the_split(spark, monkeypatch):
    """Each job of the split reads them: unwritten, each would join and clean the tables again."""
    written = []
    real = Q.S.cut_lineage
    monkeypatch.setattr(Q.S, "cut_lineage", lambda df: written.append(df.columns) or real(df))
    split = Q.split_written(spark, SF0001)
    assert written[0] == [c for c in split.columns if c != "split"]


def test_only_scored_columns_are_split(spark, monkeypatch):
    given = []
    real = Q.S.stratified_split
    monkeypatch.setattr(Q.S, "stratified_split", lambda df, *a, **k: given.append(df.columns) or real(df, *a, **k))
    scored = Q.scored_test(spark, SF0001)
    assert "purpose" not in given[0] and {"class", "sex", "p_bad", "prediction"} <= set(scored.columns)
    # the same rows and scores as those of the whole rows
    from readyspark.operators.score import CREDIT_SCORECARD, score
    whole = score(Q.test_rows(spark, SF0001), CREDIT_SCORECARD).select(*scored.columns)
    assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, whole.collect())) != []


def test_merged_partitions_are_bounded(spark):
    """Wide rows are made of a narrow shuffle's: 64 MB of it, Spark's default, are gigabytes of one task."""
    from readyspark.session import build_session, configure
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    assert build_session().conf.get(name) == "8m"
    own = spark.newSession()
    own.conf.set(name, "32m")
    assert configure(own).conf.get(name) == "32m"  # a user's setting wins


def test_readiness_scores_each_row_once(spark):
    from readyspark.operators import rules as R
    from readyspark.operators.score import CREDIT_SCORECARD
    from readyspark.plans import flows
    st = Q.split_written(spark, SF0001)
    rules = R.evaluate_rules(st, R.prepared_suite(), "data_post_processing")
    part = lambda name: st.where(f"split = '{name}'").drop("split")
    out = flows.readiness(flows.Prepared(rules, rules, st, part("train"), part("test")), Q.KEY, {}, CREDIT_SCORECARD)
    for name in ("scored", "variants"):  # written: what reads them doesn't score again
        assert out[name]._jdf.queryExecution().optimizedPlan().toString().startswith("Relation")
    assert out["scored"].count() == part("test").count()
