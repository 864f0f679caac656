"""What steps leave on disk: shuffle files, intermediate tables, a fit's rows."""

import os
import time

import pytest
from pyspark.sql import functions as F

from readyspark import presets as P
from readyspark import session as SE
from readyspark.llm import passages
from readyspark.operators import forest as FO
from readyspark.operators import learn as L
from readyspark.plans import queries as Q

from tests.conftest import SF0001

SMALL = {**Q.QUERY_FOREST, "n_estimators": 12, "max_depth": 4}


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {n for top in dirs for _, _, names in os.walk(str(top)) for n in names if n.startswith("shuffle_")}


def tables(spark, below=""):
    folder = SE.run_tables(spark).removeprefix("file:") + below
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_a_write_takes_its_shuffle_files_along(spark):
    before = shuffle_files(spark)
    for i in range(3):
        out = SE.cut_lineage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n")))
        assert {r["n"] for r in out.collect()} == {142, 143}
    for _ in range(100):  # deleted beside the query
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    # queries that are no such write keep theirs: a DataFrame may be read again
    assert SE.SHUFFLE_CLEANUP not in spark.conf.getAll
    spark.conf.set(SE.SHUFFLE_CLEANUP, "false")
    try:
        SE.cut_lineage(spark.range(3))
        assert spark.conf.get(SE.SHUFFLE_CLEANUP) == "false"
    finally:
        spark.conf.unset(SE.SHUFFLE_CLEANUP)


def test_tables_are_dropped(spark):
    table = SE.cut_lineage(spark.range(3))
    name = os.path.basename(table._written_to)
    assert name in tables(spark)
    SE.drop_tables(table, spark.range(3))
    assert name not in tables(spark)


def test_passages_leave_small_tables_alone(spark, monkeypatch):
    words = [f"w{i}" for i in range(70)]
    rows = [(f"d{i}", " ".join([f"x{i}_{j}" for j in range(30)] + words + [f"y{i}_{j}" for j in range(30)])) for i in range(9)]
    docs = spark.createDataFrame(rows + [("copy", rows[3][1])], "doc_id string, text string")
    before = tables(spark, "/llm")
    whole = sorted(passages.repeated_passages(docs).collect())
    left = {n.split("-")[0] for n in tables(spark, "/llm") - before}
    assert left == {"members", "classes", "copies", "wanted", "spans"}
    monkeypatch.setattr(passages, "ALIGN_PAIRS", 1)
    before = tables(spark, "/llm")
    assert sorted(passages.repeated_passages(docs).collect()) == whole
    assert len([n for n in tables(spark, "/llm") - before if n.startswith("spans-")]) == passages.ALIGN_PARTS
    # the shared passage of all texts but its owner, and the copy
    assert len(whole) == 9 and sum(r["n_words"] == 70 for r in whole) == 8


@pytest.fixture(scope="module")
def split(spark):
    before = tables(spark)
    st = Q.split_written(spark, SF0001)
    return st, tables(spark) - before


def test_prepared_rows_go_when_the_split_is_written(spark, split):
    st, made = split
    rows = [n for n in made if "app_id" in spark.read.parquet(f"{SE.run_tables(spark)}/{n}").columns]
    assert rows == [os.path.basename(st._written_to)]
    assert st.where("split = 'test'").count() > 0


def test_forest_in_groups_of_trees(spark, split, monkeypatch):
    assert not L._forest(SMALL, P.TARGET, "weight", 1).getCacheNodeIds()
    assert L.tree_groups(100, 250_000) == [100] and L.tree_groups(100, 250_001) == [50, 50]
    assert L.tree_groups(100, 50_000_000) == [25] * 4 and L.tree_groups(20, 50_000_000) == [20]
    assert L.tree_groups(30, 10**9) == [15, 15] and L.tree_groups(12, 0) == [12]
    train = split[0].where("split = 'train'").drop("split", P.SENSITIVE)
    test = split[0].where("split = 'test'").drop("split")
    before = tables(spark)
    whole = L.fit_forest(train, P.TARGET, SMALL, exclude=[Q.KEY]).stages[-1]
    assert not [n for n in tables(spark) - before if "features" in spark.read.parquet(f"{SE.run_tables(spark)}/{n}").columns]
    monkeypatch.setattr(L, "FIT_COUNTS", 1)
    monkeypatch.setattr(L, "GROUP_TREES", 5)
    model = L.fit_forest(train, P.TARGET, SMALL, exclude=[Q.KEY])
    forest = model.stages[-1]
    assert forest.getNumTrees == forest.getOrDefault("numTrees") == 12 and forest.numFeatures == whole.numFeatures
    assert {p.name: v for p, v in forest.extractParamMap().items()} == {p.name: v for p, v in whole.extractParamMap().items()}
    assert len({t.toDebugString.split("\n", 1)[1] for t in forest.trees}) == 12
    # the first group's seed is the whole forest's, and no other group's
    scored = FO.walked_scores(test, model, Q.KEY)
    off = scored.agg(F.max(F.abs(F.col("p_bad") - F.col("p_walked"))), F.count("*")).first()
    assert off[0] < 1e-12 and off[1] == test.count()


def test_rows_of_a_fit_are_dealt_out_once(spark):
    rows = spark.range(90_000).withColumn("x", F.col("id") * 2).coalesce(1)
    dealt = SE.spread_once(rows)
    assert dealt.rdd.getNumPartitions() == 5 and dealt.schema == rows.schema
    assert "Exchange" not in dealt._jdf.queryExecution().executedPlan().toString()
    assert dealt.agg(F.sum("x")).first()[0] == rows.agg(F.sum("x")).first()[0]
    assert SE.spread_once(rows.limit(5)).count() == 5


def test_large_search_holds_one_fold(spark, split, monkeypatch):
    rows = split[0].where("split = 'train'").drop("split")
    folds = Q.S.stratified_folds(rows, P.TARGET, Q.KEY, 3, P.SEED).drop(P.SENSITIVE)
    cands = [{**SMALL, "n_estimators": 3, "max_depth": d} for d in (2, 3)]
    want = L.search(folds, P.TARGET, "fold", cands, exclude=[Q.KEY]).orderBy("candidate").collect()
    held, real = [], L.encode_for_forest

    def encode(*args):
        held.append({n for n in tables(spark) if n not in before})
        return real(*args)

    before = tables(spark)
    monkeypatch.setattr(L, "FIT_COUNTS", 1)
    monkeypatch.setattr(L, "encode_for_forest", encode)
    got = L.search(folds, P.TARGET, "fold", cands, exclude=[Q.KEY]).orderBy("candidate").collect()
    features = lambda names: [n for n in names if os.path.isdir(f"{SE.run_tables(spark).removeprefix('file:')}/{n}")
                              and not n.startswith("search-") and "features" in spark.read.parquet(f"{SE.run_tables(spark)}/{n}").columns]
    assert len(held) == 3 and not features(set().union(*held) | tables(spark) - before)
    for a, b in zip(want, got):
        assert all(a[f"mean_{m}"] == pytest.approx(b[f"mean_{m}"], abs=1e-9) for m in ("f1", "roc_auc", "mcc", "accuracy"))
