"""Flows (W1-W3): prepare, experiment, readiness.

Each flow is plain DataFrame code. The prepared and split table is written
once to the shared checkpoint folder (it feeds many later jobs), so a lost
executor never sends the work back to the raw scan.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readyspark import presets as P
from readyspark.operators import clean as C
from readyspark.operators import features as FE
from readyspark.operators import gates as G
from readyspark.operators import learn as L
from readyspark.operators import metrics as M
from readyspark.operators import rules as R
from readyspark.operators import split as S
from readyspark.operators import variants as V
from readyspark.operators.score import score
from readyspark.session import cut_lineage, spread
from readyspark.sources import sinks


@dataclass
class Prepared:
    raw_rules: DataFrame
    prepared_rules: DataFrame
    table: DataFrame  # prepared rows with a ``split`` column
    train: DataFrame
    test: DataFrame
    reasons: DataFrame | None = None  # rows removed by each cleaning step
    rejected: DataFrame | None = None  # distinct rows that cleaning removed, with ``_copies`` and ``_reason``


def prepare(raw: DataFrame, key: str, raise_on_failure: bool = True) -> Prepared:
    """Raw rules, cleaning, features, target encoding, prepared rules, split.

    ``raw`` is read once: its distinct rows are written with their copies and the
    reason for which cleaning removes them, and the raw rules (each row counted as
    often as it was there), the reasons' counts and the cleaning read that table.
    """
    rows = cut_lineage(C.flagged_rows(raw))
    # a few dozen rows from one aggregate: kept as a written table, so the check
    # below and the final report don't compute them again
    raw_rules = cut_lineage(R.evaluate_rules(rows.drop("_reason"), R.raw_suite(raw.columns), "data_validation", "_copies"))
    if raise_on_failure:
        R.raise_on_failed(raw_rules, "data_validation")
    # features are row by row and cheap: made again by the target check and the split's
    # small jobs, which read of the written rows the columns they need
    prepared = FE.encode_target(FE.feature_engineering(C.kept_rows(rows)))
    table = cut_lineage(S.stratified_split(prepared, P.TARGET, key, P.TEST_SIZE, P.SEED, checkpoint=False))
    prepared_rules = cut_lineage(R.evaluate_rules(table.drop("split"), R.prepared_suite(), "data_post_processing"))
    if raise_on_failure:
        R.raise_on_failed(prepared_rules, "data_post_processing")
    train = table.where(F.col("split") == "train").drop("split")
    test = table.where(F.col("split") == "test").drop("split")
    return Prepared(raw_rules, prepared_rules, table, train, test, C.reason_counts(rows),
                    rows.where(F.col("_reason").isNotNull()))


def experiment(prep: Prepared, key: str, n_iter: int = P.SEARCH_ITERATIONS, k: int = P.N_FOLDS,
               parallelism: int = 4, space=P.PARAM_SPACE, out_dir: str | None = None,
               run_id: str = "experiment", ledger: str | None = None) -> dict:
    """W1 then the cross-validated search, refit included.

    Returns ``results`` (a row per candidate), ``best`` (its parameters) and
    ``model`` (the best candidate fitted on all training rows). With ``out_dir``
    the best scores and all best parameters are appended to ``history/`` there and
    the model is saved in ``model/``. ``ledger``, a shared folder, keeps every fit that
    ended: a run that died is started again and does only the others.
    """
    folds = S.stratified_folds(prep.train, P.TARGET, key, k, P.SEED)
    train = folds.drop(P.SENSITIVE)  # the sensitive column never reaches the learner
    cands = L.sample_candidates(space, n_iter, P.SEED)
    results = cut_lineage(L.search(train, P.TARGET, "fold", cands, exclude=[key], parallelism=parallelism, ledger=ledger))
    model, best, scores = L.refit(train.drop("fold"), P.TARGET, results, cands, exclude=[key])
    if out_dir:
        sinks.append_metrics(scores, os.path.join(out_dir, "history"), run_id)
        sinks.append_params(train.sparkSession, best, os.path.join(out_dir, "history"), run_id)
        model.write().overwrite().save(os.path.join(out_dir, "model"))
    return {"results": results, "best": best, "model": model}


def readiness(prep: Prepared, key: str, params: dict, scorer=None) -> dict:
    """Train (or take a given scorer), evaluate, gate, report.

    Returns the model, the scored test table, the scored variants and the gate rows; publishing is
    left to ``sinks.publish_if_ready`` so the caller picks the paths.
    """
    model = scorer or L.fit_forest(prep.train.drop(P.SENSITIVE), P.TARGET, params, exclude=[key])
    # read by many jobs below: the forest scores each row once
    test = spread(prep.test)
    scored = cut_lineage(score(test, model))
    metrics = M.classification_metrics(scored, P.TARGET, "prediction", "p_bad")
    baseline = M.majority_baseline(prep.train, test, P.TARGET)
    variants = V.robustness_variants(key) + V.metamorphic_variants()
    vs = cut_lineage(V.score_variants(test, model, variants, keep=[key, P.TARGET]))
    directions = {v.name: v.direction for v in variants if v.direction}
    rows = G.report([
        prep.raw_rules, prep.prepared_rules,
        G.performance_gate(metrics, baseline),
        G.fairness_gate(scored, P.SENSITIVE, P.TARGET, "prediction"),
        G.variant_gates(vs, directions, P.TARGET),
    ])

    def audit(staged: DataFrame) -> DataFrame:
        """The gates that are decided on the scored table itself."""
        again = M.classification_metrics(staged, P.TARGET, "prediction", "p_bad")
        return G.report([G.performance_gate(again, baseline),
                         G.fairness_gate(staged, P.SENSITIVE, P.TARGET, "prediction")])

    return {"model": model, "scored": scored, "gate_rows": rows, "verdict": G.verdict(rows), "audit": audit,
            "variants": vs}


def run_readiness(raw: DataFrame, key: str, params: dict, out_dir: str, run_id: str,
                  scorer=None) -> dict:
    """The whole readiness run with its sinks: W1, W3, the JSON report (S5),
    the metric history (S6) and publish-if-ready (S7).

    ``out_dir`` is a shared folder: ``report/``, ``history/``, ``staging/`` and
    ``published/`` (versions and their pointer) are written under it. Raises
    when a gate fails; the report and the history are written first.
    """
    prep = prepare(raw, key, raise_on_failure=False)
    out = readiness(prep, key, params, scorer)
    rows = cut_lineage(out["gate_rows"])  # read by the report, the history and the audit
    sinks.write_report(rows, os.path.join(out_dir, "report"))
    history = rows.where(F.col("value").isNotNull()).select(
        F.concat_ws(".", "gate", "metric", F.coalesce("subject", F.lit(""))).alias("metric"), "value")
    sinks.append_metrics(history, os.path.join(out_dir, "history"), run_id)
    sinks.append_params(raw.sparkSession, params, os.path.join(out_dir, "history"), run_id)
    model = None if scorer is not None else out["model"]
    published = sinks.publish_if_ready(out["scored"], rows, os.path.join(out_dir, "staging"),
                                       os.path.join(out_dir, "published"), model, out["audit"])
    return {"gate_rows": rows, **published}
