"""The forest as a node table, and the search that is resumed after a failure."""

import pytest
from pyspark.sql import functions as F

from readyspark import presets as P
from readyspark.operators import forest as FO
from readyspark.operators import learn as L
from readyspark.plans import queries as Q
from tests.conftest import SF0001

SMALL = {"n_estimators": 12, "max_depth": 6, "min_samples_leaf": 1, "max_features": "sqrt", "bootstrap": True}


@pytest.fixture(scope="module")
def fitted(spark):
    st = Q.split_written(spark, SF0001)
    train = st.where("split = 'train'").drop("split", P.SENSITIVE)
    return L.fit_forest(train, P.TARGET, SMALL, exclude=[Q.KEY]), st.where("split = 'test'").drop("split")


def plain_walk(nodes, x):
    total = 0.0
    for tree in nodes.values():
        n = tree[0]
        while n["left"] is not None:
            v = x[n["feature"]]
            n = tree[n["left"] if (v in n["categories"] if n["categories"] is not None else v <= n["threshold"]) else n["right"]]
        total += n["value"]
    return total / len(nodes)


@pytest.mark.parametrize("packed", [500_000, 60, 10])  # one batch, some batches, joins per level
def test_walked_is_reported(spark, fitted, packed):
    model, test = fitted
    test = test.withColumn("purpose", F.when(F.col("duration") > 20, "never seen").otherwise(F.col("purpose")))
    rows = FO.walked_scores(test, model, Q.KEY, packed_nodes=packed).collect()
    assert len(rows) == test.count() and all(abs(r["p_bad"] - r["p_walked"]) < 1e-12 for r in rows)
    assert len({r["p_walked"] for r in rows}) > 20


def test_packed_trees_are_in_no_row(spark, fitted):
    """A join would copy the whole forest into every row; the trees are a subquery's value."""
    model, test = fitted
    plan = FO.walked_scores(test, model, Q.KEY)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan and "Subquery" in plan
    assert "AS _trees" not in plan  # no projection puts them out either


def test_walked_and_fitted_in_even_parts(spark, fitted, monkeypatch):
    from readyspark.session import spread
    rows = spark.range(90_000).coalesce(1)
    assert spread(rows).rdd.glom().map(len).collect() == [18_000] * 5
    assert spread(rows, 10_000).rdd.getNumPartitions() == 9 and spread(rows.limit(20_000)).rdd.getNumPartitions() == 1
    model, parts = fitted[0], []

    class Fit:
        def fit(self, encoded):
            parts.append(encoded.rdd.getNumPartitions())
            return model.stages[-1]

    monkeypatch.setattr(L, "_forest", lambda *a: Fit())
    L.forest_on([], rows, P.TARGET, SMALL)
    assert parts == [5]


def test_node_table(spark, fitted):
    model, test = fitted
    nodes = {}
    for r in FO.node_table(spark, model).collect():
        nodes.setdefault(r["tree"], {})[r["node"]] = r
    assert len(nodes) == 12 and all(sorted(t) == list(range(len(t))) for t in nodes.values())
    assert any(n["categories"] is not None for t in nodes.values() for n in t.values())
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array
    encoded = PipelineModel(stages=model.stages[:-1]).transform(test).withColumn("x", vector_to_array("features"))
    reported = {r[0]: r[1] for r in model.transform(test).select(Q.KEY, vector_to_array("probability")[1]).collect()}
    for r in encoded.select(Q.KEY, "x").limit(60).collect():
        assert plain_walk(nodes, r["x"]) == pytest.approx(reported[r[0]], abs=1e-12)


def test_search_is_resumed(spark, tmp_path, monkeypatch):
    rows = Q.train_rows(spark, SF0001)
    folds = Q.S.stratified_folds(rows, P.TARGET, Q.KEY, 3, P.SEED).drop(P.SENSITIVE)
    space = {"n_estimators": [4, 6], "max_depth": [2, 3], "min_samples_split": [2], "min_samples_leaf": [1],
             "max_features": ["sqrt"], "bootstrap": [True]}
    cands = L.sample_candidates(space, 3, 7)
    real, fits, encoders = L._forest, [], []
    real_encode = L.encode_for_forest

    def counted(params, *rest):
        fits.append(params)
        if len(fits) == 5:
            raise RuntimeError("killed")
        return real(params, *rest)

    def encode(*args):
        encoders.append(1)
        return real_encode(*args)

    monkeypatch.setattr(L, "_forest", counted)
    monkeypatch.setattr(L, "encode_for_forest", encode)
    run = lambda ledger: L.search(folds, P.TARGET, "fold", cands, exclude=[Q.KEY], parallelism=1, ledger=ledger)
    with pytest.raises(RuntimeError, match="killed"):
        run(str(tmp_path))
    # one fold's encoder serves all its candidates (the pipeline's own forest stage is never fitted)
    assert len(encoders) == 3
    done = sum(L._committed(spark, str(p)) for p in tmp_path.glob("*/fits/*/*"))
    assert 0 < done < 9
    monkeypatch.setattr(L, "_forest", lambda *a: fits.append(a) or real(*a))
    fits.clear()
    resumed = run(str(tmp_path)).orderBy("rank").collect()
    again = len(fits)
    fits.clear()
    assert run(str(tmp_path)).orderBy("rank").collect() == resumed and not fits  # nothing left to fit
    monkeypatch.setattr(L, "_forest", real)
    clean = L.search(folds, P.TARGET, "fold", cands, exclude=[Q.KEY], parallelism=3).orderBy("rank").collect()
    assert [r["candidate"] for r in clean] == [r["candidate"] for r in resumed]
    for a, b in zip(clean, resumed):
        assert all(a[f"mean_{m}"] == pytest.approx(b[f"mean_{m}"], abs=1e-9) for m in ("f1", "roc_auc", "mcc", "accuracy"))
    # only the missing fits; an encoder's pipeline has a forest as its last stage, which isn't fitted
    assert 9 - done <= again <= 9 - done + 3
    # other rows are another search: none of its fits are taken over
    other = L.fingerprint(folds.limit(50), P.TARGET, "fold", cands, [Q.KEY], P.SEED)
    assert other != L.fingerprint(folds, P.TARGET, "fold", cands, [Q.KEY], P.SEED)
