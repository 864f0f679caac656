"""Forest, encoders, search and stream scoring on the sf0.001 applications."""

import os
import tempfile

from pyspark.sql import functions as F

from readyspark import presets as P
from readyspark.operators import learn as L
from readyspark.operators import metrics as M
from readyspark.operators.score import CREDIT_SCORECARD, score
from readyspark.plans import queries as Q
from readyspark.streaming.scoring import read_sink, run_stream_scoring
from tests.conftest import SF0001

SMALL = {"n_estimators": 15, "max_depth": 5, "min_samples_leaf": 1, "max_features": "sqrt", "bootstrap": True}


def test_ordinal_unknown_is_minus_one(spark):
    df = spark.createDataFrame([("<1", "skilled"), ("weird", None)], "employment string, job string")
    got = L.ordinal_codes(df).select("employment_code", "job_code").collect()
    assert [tuple(r) for r in got] == [(1.0, 2.0), (-1.0, -1.0)]


def test_forest_learns_and_is_repeatable(spark):
    st = Q.split_table(spark, SF0001)
    train = st.where("split = 'train'").drop("split", P.SENSITIVE)
    test = st.where("split = 'test'").drop("split")
    m1 = L.fit_forest(train, P.TARGET, SMALL, exclude=["app_id"])
    feats = m1.stages[-2].getInputCols()
    assert not any(c.startswith(P.SENSITIVE) for c in feats) and "app_id" not in feats
    s1 = score(test, m1)
    auc = M.roc_auc(s1, P.TARGET, "p_bad").first()[0]
    assert auc > 0.5
    m2 = L.fit_forest(train, P.TARGET, SMALL, exclude=["app_id"])
    a = s1.select("app_id", "p_bad").orderBy("app_id").collect()
    b = score(test, m2).select("app_id", "p_bad").orderBy("app_id").collect()
    assert a == b


def test_unknown_category_scores(spark):
    st = Q.split_table(spark, SF0001)
    train = st.where("split = 'train'").drop("split", P.SENSITIVE)
    model = L.fit_forest(train, P.TARGET, SMALL, exclude=["app_id"])
    odd = st.limit(3).withColumn("purpose", F.lit("spaceship")).withColumn("job", F.lit(None).cast("string"))
    assert score(odd, model).where("p_bad IS NOT NULL").count() == 3


def test_search_ranks_candidates(spark):
    """The search as given: every point unchanged, every fold; ranked by mean F1."""
    rows = Q.train_rows(spark, SF0001)
    folds = Q.S.stratified_folds(rows, P.TARGET, Q.KEY, 3, P.SEED).drop(P.SENSITIVE)
    space = {"n_estimators": [5, 8], "max_depth": [2, 3], "min_samples_split": [2], "min_samples_leaf": [1],
             "max_features": ["sqrt"], "bootstrap": [True]}
    cands = L.sample_candidates(space, 3, 7)
    results = L.search(folds, P.TARGET, "fold", cands, exclude=[Q.KEY], parallelism=2)
    got = results.orderBy("rank").collect()
    assert [r["rank"] for r in got] == [1, 2, 3] and got[0]["mean_f1"] == max(r["mean_f1"] for r in got)
    assert {(r["n_estimators"], r["max_depth"]) for r in got} == {(str(c["n_estimators"]), str(c["max_depth"])) for c in cands}
    model, best, scores = L.refit(folds.drop("fold"), P.TARGET, results, cands, exclude=[Q.KEY])
    assert best == cands[got[0]["candidate"]] and model.stages[-1].getNumTrees == best["n_estimators"]
    assert {r["metric"]: r["value"] for r in scores.collect()}["best_cv_f1"] == got[0]["mean_f1"]


def test_unknown_and_null_categories_are_all_zeros(spark):
    from pyspark.ml import Pipeline
    train = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c"), (4, "b")], "id long, c string")
    model = Pipeline(stages=L.encoders(["c"])).fit(train)
    df = spark.createDataFrame([(1, "a"), (2, "zzz"), (3, None), (4, "c")], "id long, c string")
    assert {tuple(r) for r in L.onehot_wide(df, model, "id").collect()} == {
        (1, 1, 0, 0), (2, 0, 0, 0), (3, 0, 0, 0), (4, 0, 0, 1)}


def test_candidates_sampled_reproducibly():
    a = L.sample_candidates(P.PARAM_SPACE, 20, 42)
    assert a == L.sample_candidates(P.PARAM_SPACE, 20, 42) and 0 < len(a) <= 20


def test_stream_scoring_matches_batch(spark):
    base = tempfile.mkdtemp(prefix="stream-test-")
    src = os.path.join(base, "in")
    rows = Q.prepared(spark, SF0001).drop(P.TARGET).withColumn("age", F.lit(30.0)) \
        .withColumn("personal_status", F.lit("male single")).withColumn("foreign_worker", F.lit("yes")) \
        .withColumn("own_telephone", F.lit("no")).drop("monthly_payment", "age_group",
                                                        "has_additional_security", "high_risk_financial_status", "sex")
    rows.repartition(4).write.parquet(src)
    # one file per micro-batch: the backfill drains in several bounded batches
    paths = run_stream_scoring(spark, src, rows.schema, CREDIT_SCORECARD, os.path.join(base, "out"),
                               os.path.join(base, "ckpt"), required=["duration", "credit_amount"],
                               numeric=["duration", "credit_amount"], keep=["app_id"], max_files_per_trigger=1)
    streamed = read_sink(spark, paths["scored"]).select("app_id", "p_bad").orderBy("app_id").collect()
    batch = score(Q.prepared(spark, SF0001), CREDIT_SCORECARD).select("app_id", "p_bad").orderBy("app_id").collect()
    assert streamed == batch
    batches = [f for f in os.listdir(os.path.join(base, "ckpt", "scoring", "commits")) if f.isdigit()]
    assert len(batches) >= 4
