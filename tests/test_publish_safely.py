"""Versions without a clock, repeated logging, streams that fail half-way."""

import threading

import pytest
from pyspark.sql import functions as F

from readyspark.operators.score import CREDIT_SCORECARD
from readyspark.plans import queries as Q
from readyspark.presets import ALLOWED_CATEGORIES, NUMERIC_COLUMNS
from readyspark.sources import sinks
from readyspark.streaming import scoring
from tests.conftest import SF0001


def test_two_publishers_at_once(spark, tmp_path):
    good = spark.createDataFrame([("g", True)], "gate string, passed boolean")
    target, got, errors = f"{tmp_path}/target", [], []

    def publish(k):
        try:
            for i in range(3):
                rows = spark.createDataFrame([(k, i)], "publisher int, turn int")
                got.append((sinks.publish_if_ready(rows, good, f"{tmp_path}/staging-{k}-{i}", target)["version"], k, i))
        except Exception as e:  # noqa: BLE001 - shown by the assertion below
            errors.append(e)

    threads = [threading.Thread(target=publish, args=(k,)) for k in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and sorted(n for n, _, _ in got) == list(range(1, 10)) == sinks.published_versions(spark, target)
    for n, k, i in got:  # every version is whole and its publisher's
        assert [tuple(r) for r in sinks.read_published(spark, target, n).collect()] == [(k, i)]
    for k in range(3):  # a publisher's later version has the larger number
        mine = [n for n, p, _ in got if p == k]
        assert mine == sorted(mine)
    assert sinks.drop_old_versions(spark, target, keep=2) == list(range(1, 8))
    assert sinks.drop_old_versions(spark, target, keep=0) == [8] and sinks.published_versions(spark, target) == [9]
    assert sinks.read_published(spark, target).count() == 1
    # a claim whose publisher died is passed over, by readers and by the next publisher
    dead = sinks.claim_version(spark, target)
    assert dead == 10 and sinks.published_versions(spark, target) == [9]
    out = sinks.publish_if_ready(spark.createDataFrame([(7, 7)], "publisher int, turn int"), good, f"{tmp_path}/s", target)
    assert out["version"] == 11 and sinks.read_published(spark, target).first()["publisher"] == 7


def test_a_run_logged_twice_has_one_set_of_rows(spark, tmp_path):
    path = f"{tmp_path}/history"
    for value in (1.0, 2.0, 2.0):
        for run in ("a", "b"):
            sinks.append_metrics(spark.createDataFrame([("f1", value), ("auc", None)], "metric string, value double"), path, run)
            sinks.append_params(spark, {"depth": None, "trees": 5}, path, run)
    sinks.append_metrics(spark.createDataFrame([("f1", 9.0)], "metric string, value double"), path, "b", kind="gate")
    got = sorted(tuple(r) for r in sinks.read_history(spark, path).drop("logged_at").fillna("-").fillna(-1.0).collect())
    both = [(run, kind, *rest) for run in ("a", "b") for kind, *rest in (
        ("metric", "auc", -1.0, "-"), ("metric", "f1", 2.0, "-"), ("param", "depth", -1.0, "None"), ("param", "trees", 5.0, "5"))]
    assert got == sorted(both + [("b", "gate", "f1", 9.0, "-")])


def test_a_batch_that_fails_half_written_is_repeated(spark, tmp_path, monkeypatch):
    rows = Q._dirty(spark, SF0001).drop("class")
    rows.repartition(4).write.parquet(f"{tmp_path}/in")
    numeric = list(NUMERIC_COLUMNS)

    def drain(out):
        return scoring.run_stream_scoring(spark, f"{tmp_path}/in", rows.schema, CREDIT_SCORECARD, f"{tmp_path}/{out}", f"{tmp_path}/{out}-ckpt",
                                          required=numeric + list(ALLOWED_CATEGORIES), numeric=numeric, keep=["app_id"], max_files_per_trigger=1)

    real, calls = scoring.score_valid, []

    def failing(checked, scorer, numeric):
        calls.append(1)
        scored = real(checked, scorer, numeric)
        if len(calls) != 2:
            return scored
        # some of the batch's files are written, then a task fails
        return scored.repartition(6).withColumn("p_bad", F.when(F.spark_partition_id() == 5, F.raise_error(F.lit("lost"))).otherwise(F.col("p_bad")))

    monkeypatch.setattr(scoring, "score_valid", failing)
    with pytest.raises(Exception, match="lost"):
        drain("out")
    monkeypatch.setattr(scoring, "score_valid", real)
    broken, whole = drain("out"), drain("whole")
    for sink in ("scored", "rejected"):
        a, b = (scoring.read_sink(spark, x[sink]) for x in (broken, whole))
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str) and a.count() > 0
