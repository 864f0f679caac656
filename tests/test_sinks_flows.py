"""Sinks (S2, S3, S5, S6, S7) and the flows (W1-W3) on small inputs."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from readyspark import presets as P
from readyspark.operators import clean as C
from readyspark.operators import rules as R
from readyspark.operators.score import CREDIT_SCORECARD
from readyspark.plans import flows
from readyspark.plans import queries as Q
from readyspark.session import cut_lineage
from readyspark.sources import sinks
from tests.conftest import SF0001


def test_parquet_csv_json_and_history(spark):
    base = tempfile.mkdtemp(prefix="sinks-")
    df = spark.createDataFrame([("accuracy", 0.8), ("f1", 0.7)], "metric string, value double")
    sinks.write_parquet(df, os.path.join(base, "p"))
    sinks.write_csv(df, os.path.join(base, "c"))
    assert spark.read.parquet(os.path.join(base, "p")).count() == 2
    assert spark.read.option("header", True).csv(os.path.join(base, "c")).columns == ["metric", "value"]
    rows = spark.createDataFrame([("g", "m", True)], "gate string, metric string, passed boolean")
    sinks.write_report(rows, os.path.join(base, "r"))
    part = [f for f in os.listdir(os.path.join(base, "r")) if f.endswith(".json")][0]
    assert json.loads(open(os.path.join(base, "r", part)).readline())["gate"] == "g"
    hist = os.path.join(base, "h")
    sinks.append_metrics(df, hist, "run-1")
    sinks.append_metrics(df, hist, "run-2")
    assert spark.read.parquet(hist).select("run_id").distinct().count() == 2


def test_publish_only_when_ready(spark):
    base = tempfile.mkdtemp(prefix="publish-")
    scored = spark.createDataFrame([(1, 0.2)], "id long, p_bad double")
    good = spark.createDataFrame([("a", True)], "gate string, passed boolean")
    bad = spark.createDataFrame([("a", True), ("b", False)], "gate string, passed boolean")
    with pytest.raises(ValueError):
        sinks.publish_if_ready(scored, bad, os.path.join(base, "stage1"), os.path.join(base, "target1"))
    assert not os.path.exists(os.path.join(base, "target1"))
    target = os.path.join(base, "target2")
    out = sinks.publish_if_ready(scored, good, os.path.join(base, "stage2"), target)
    assert spark.read.parquet(out["published"]).count() == 1 and sinks.read_published(spark, target).count() == 1
    # the audit judges the staged rows themselves; a refusal leaves the old version
    audit = lambda staged: staged.select(F.lit("a").alias("gate"), (F.col("p_bad") < 0.5).alias("passed"))
    two = spark.createDataFrame([(1, 0.2), (2, 0.9)], "id long, p_bad double")
    with pytest.raises(ValueError):
        sinks.publish_if_ready(two, good, os.path.join(base, "stage3"), target, audit=audit)
    assert sinks.read_published(spark, target).count() == 1
    sinks.publish_if_ready(two.where("id = 1").union(scored), good, os.path.join(base, "stage4"), target, audit=audit)
    assert sinks.read_published(spark, target).count() == 2


def test_flows_prepare_experiment_readiness(spark):
    prep = flows.prepare(Q._dirty(spark, SF0001), "app_id", raise_on_failure=False)
    assert prep.train.count() + prep.test.count() == prep.table.count()
    with pytest.raises(ValueError):  # the dirty table fails the raw class-share rule
        flows.prepare(Q._dirty(spark, SF0001), "app_id", raise_on_failure=True)
    tiny = {"n_estimators": [5], "max_depth": [3], "min_samples_split": [2], "min_samples_leaf": [1, 2],
            "max_features": ["sqrt"], "bootstrap": [True]}
    base = tempfile.mkdtemp(prefix="experiment-")
    done = flows.experiment(prep, "app_id", n_iter=2, k=2, parallelism=2, space=tiny, out_dir=base, run_id="r")
    best = done["best"]
    assert done["results"].count() == 2 and best["n_estimators"] == 5
    history = {(r["kind"], r["name"]): (r["value"], r["text"]) for r in sinks.read_history(spark, os.path.join(base, "history")).collect()}
    assert history[("param", "max_features")] == (None, "sqrt") and history[("param", "bootstrap")] == (None, "True")
    assert history[("param", "max_depth")] == (3.0, "3") and ("metric", "best_cv_f1") in history and len(history) == 12
    assert os.path.exists(os.path.join(base, "model"))
    out = flows.readiness(prep, "app_id", params=best)
    assert out["gate_rows"].where(F.col("gate") == "performance").count() == 6
    assert out["verdict"].count() == 1
    card = flows.readiness(prep, "app_id", params={}, scorer=CREDIT_SCORECARD)
    gates = {r["gate"] for r in card["gate_rows"].select("gate").distinct().collect()}
    assert gates == {"data_validation", "data_post_processing", "performance", "fairness", "robustness",
                     "metamorphic"}
    assert P.SENSITIVE in prep.test.columns


def test_run_readiness_writes_report_and_history_then_refuses(spark):
    base = tempfile.mkdtemp(prefix="run-")
    with pytest.raises(ValueError, match="not published"):
        flows.run_readiness(Q._dirty(spark, SF0001), "app_id", {"n_estimators": 5}, base, "run-1",
                            scorer=CREDIT_SCORECARD)
    assert spark.read.json(os.path.join(base, "report")).count() > 0
    hist = spark.read.parquet(os.path.join(base, "history"))
    assert hist.where("kind = 'metric'").count() > 0 and hist.where("kind = 'param'").count() == 1
    assert not os.path.exists(os.path.join(base, "published"))


def test_flagged_rows_give_rules_reasons_and_clean_rows(spark):
    """One read of the raw rows gives what rules, reason counts and cleaning give apart."""
    every = lambda df: sorted(map(str, df.collect()))
    raw = Q._dirty(spark, SF0001)
    for df in (raw, raw.unionByName(raw.limit(40)).unionByName(raw.limit(40)), raw.where("false")):
        df = cut_lineage(df)
        rules = R.raw_suite(df.columns)
        flagged = cut_lineage(C.flagged_rows(df))
        assert every(R.evaluate_rules(flagged.drop("_reason"), rules, "g", "_copies")) == every(R.evaluate_rules(df, rules, "g"))
        assert every(C.reason_counts(flagged)) == every(C.clean_reason_counts(df))
        kept, clean = C.kept_rows(flagged), C.clean(df)
        assert kept.schema == clean.schema and every(kept) == every(clean)
    prep = flows.prepare(raw, Q.KEY, raise_on_failure=False)
    assert every(prep.prepared_rules) == every(R.evaluate_rules(prep.table.drop("split"), R.prepared_suite(), "data_post_processing"))
    counted = {r["reason"]: r["rows"] for r in prep.reasons.collect()}
    told = {r["_reason"]: r["n"] for r in prep.rejected.groupBy("_reason").agg(
        F.sum(F.when(F.col("_reason") == "null_rows", F.col("_copies")).otherwise(1)).alias("n")).collect()}
    assert told == {k: v for k, v in counted.items() if v and k in C.CLEAN_REASONS[1:-1] and k != "duplicate_rows"}
    assert counted["kept_rows"] == prep.table.count()


def test_raw_rows_are_read_once(spark):
    """A counting UDF below the raw table runs once a row."""
    ran = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        ran.add(1)
        return x

    raw = cut_lineage(Q._dirty(spark, SF0001)).withColumn(Q.KEY, counted.asNondeterministic()(Q.KEY))
    flows.prepare(raw, Q.KEY, raise_on_failure=False)
    assert ran.value == Q._dirty(spark, SF0001).count()
