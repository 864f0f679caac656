"""Encoders, random forest and the cross-validated search.

Encoding and learning are Spark ML stages in one ``Pipeline``, so the encoder
is fitted on exactly the rows the forest sees (inside every fold too) and the
fitted ``PipelineModel`` scores tables and streams alike.
"""

from __future__ import annotations

import hashlib
import itertools
import random
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import (OneHotEncoder, OneHotEncoderModel, SQLTransformer, StringIndexer, StringIndexerModel,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readyspark import presets as P
from readyspark.operators.features import numeric_columns
from readyspark.operators.metrics import METRICS, confusion, rate_columns, roc_auc, with_class_weights
from readyspark.session import cut_lineage, drop_tables, drop_unused_shuffles, run_tables, spread_once

# of a task's statistics of the nodes that one pass splits
NODE_MEMORY_MB = 1024
# rows x trees whose bootstrap counts one fit keeps (4 bytes each, and the row besides), on disk beyond
# the memory; a forest above that is fitted in groups of trees, GROUP_TREES at least
FIT_COUNTS = 25_000_000
GROUP_TREES = 25
# Spark refuses trees deeper than 30; "no limit" maps to the deepest allowed
MAX_DEPTH_UNLIMITED = 30


def ordinal_expr(column: str, order: Sequence[str]) -> str:
    """L1 as SQL: position in the declared order, 0-based; unknown and null are -1."""
    arr = ", ".join("'" + v.replace("'", "''") + "'" for v in order)
    return f"CAST(coalesce(array_position(array({arr}), `{column}`), 0) - 1 AS DOUBLE)"


def ordinal_codes(df: DataFrame, ordinal: Mapping[str, Sequence[str]] = P.ORDINAL_FEATURES) -> DataFrame:
    """L1 on a DataFrame: ``<column>_code`` per ordinal feature."""
    return df.withColumns({f"{c}_code": F.expr(ordinal_expr(c, order)) for c, order in ordinal.items()})


def onehot_wide(df: DataFrame, model: PipelineModel, key: str) -> DataFrame:
    """L2 in explicit columns ``<column>__<i>`` (i = position in the sorted
    categories), expanded from the fitted pipeline's own vectors; an unknown or
    null value gives all zeros."""
    from pyspark.ml.functions import vector_to_array
    index, onehot = [next(s for s in model.stages if isinstance(s, kind))
                     for kind in (StringIndexerModel, OneHotEncoderModel)]
    out = onehot.transform(index.transform(df))
    arrays = {c: vector_to_array(f"{c}__vec") for c in index.getInputCols()}
    return out.select(key, *[F.element_at(arrays[c], i + 1).cast("int").alias(f"{c}__{i}")
                             for c, labels in zip(index.getInputCols(), index.labelsArray) for i in range(len(labels))])


def encoders(nominal: Sequence[str]) -> list:
    """L2 as stages: known categories get a slot each, an unknown or null value
    the index after them, which ``dropLast`` turns into all zeros."""
    return [StringIndexer(inputCols=list(nominal), outputCols=[f"{c}__idx" for c in nominal],
                          handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=[f"{c}__idx" for c in nominal], outputCols=[f"{c}__vec" for c in nominal],
                          dropLast=True)]


def feature_plan(df: DataFrame, exclude: Sequence[str]) -> dict:
    """L3: column roles, numeric columns chosen by type (P20)."""
    excluded = set(exclude) | set(P.BINARY_FEATURES)
    return {
        "ordinal": {c: o for c, o in P.ORDINAL_FEATURES.items() if c in df.columns},
        "nominal": [c for c in P.NOMINAL_FEATURES if c in df.columns],
        "binary": [c for c in P.BINARY_FEATURES if c in df.columns],
        "numeric": numeric_columns(df, exclude=sorted(excluded)),
    }


def forest_params(candidate: Mapping) -> dict:
    """Map a search point onto Spark's forest; min_samples_split has no
    Spark counterpart and is dropped."""
    depth = candidate.get("max_depth")
    return {
        "numTrees": int(candidate.get("n_estimators", 100)),
        "maxDepth": MAX_DEPTH_UNLIMITED if depth is None else int(depth),
        "minInstancesPerNode": int(candidate.get("min_samples_leaf", 1)),
        "featureSubsetStrategy": str(candidate.get("max_features", "sqrt")),
        "bootstrap": bool(candidate.get("bootstrap", True)),
    }


def build_pipeline(df: DataFrame, label: str, params: Mapping, exclude: Sequence[str] = (),
                   weight_col: str | None = "weight", seed: int = P.SEED) -> Pipeline:
    """L1-L4 as one Pipeline: ordinal SQL codes, string index + one-hot
    (unknown -> zeros), assembler, weighted random forest."""
    plan = feature_plan(df, list(exclude) + [label] + ([weight_col] if weight_col else []))
    ord_sql = ", ".join(f"{ordinal_expr(c, o)} AS `{c}__ord`" for c, o in plan["ordinal"].items())
    stages = []
    if ord_sql:
        stages.append(SQLTransformer(statement=f"SELECT *, {ord_sql} FROM __THIS__"))
    nominal = plan["nominal"]
    if nominal:
        stages += encoders(nominal)
    inputs = ([f"{c}__ord" for c in plan["ordinal"]] + [f"{c}__vec" for c in nominal]
              + plan["binary"] + plan["numeric"])
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    stages.append(_forest(params, label, weight_col, seed))
    return Pipeline(stages=stages)


def _forest(params: Mapping, label: str, weight_col: str | None, seed: int) -> RandomForestClassifier:
    # nodes of a level are split in as few passes as the memory allows. Rows walk the trees
    # at every level: a cache of their nodes is as large as their bootstrap counts, held
    # twice while a level's is made, and copied to the checkpoint folder every ten levels
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, seed=seed, maxMemoryInMB=NODE_MEMORY_MB,
                                **forest_params(params))
    return rf.setWeightCol(weight_col) if weight_col else rf


def encode_for_forest(train: DataFrame, label: str, exclude: Sequence[str] = ()) -> tuple[list, DataFrame]:
    """L1-L3 and the class weights fitted on these rows: the fitted encoder stages,
    and ``features``, label and ``weight`` written once. Any number of forests is
    fitted on that table."""
    weighted = with_class_weights(train.withColumn(label, F.col(label).cast("double")), label, "weight")
    pipe = build_pipeline(weighted, label, {}, exclude, "weight")
    encoder = Pipeline(stages=pipe.getStages()[:-1]).fit(weighted)
    return encoder.stages, cut_lineage(encoder.transform(weighted).select("features", label, "weight"))


def fit_forest(train: DataFrame, label: str, params: Mapping, exclude: Sequence[str] = (),
               seed: int = P.SEED) -> PipelineModel:
    """L4: balanced class weights and encoders computed on these rows, which are
    then encoded once; the forest is fitted on the written encoded table."""
    stages, encoded = encode_for_forest(train, label, exclude)
    model = forest_on(stages, encoded, label, params, seed)
    drop_tables(encoded)
    return model


def forest_on(stages: Sequence, encoded: DataFrame, label: str, params: Mapping, seed: int = P.SEED) -> PipelineModel:
    """A forest fitted on a table of :func:`encode_for_forest`, behind its encoder stages."""
    groups, rows = tree_groups(forest_params(params)["numTrees"], encoded.count()), spread_once(encoded)
    if len(groups) == 1:
        return PipelineModel(stages=[*stages, _forest(params, label, "weight", seed).fit(rows)])
    fits = []
    for i, trees in enumerate(groups):
        # a seed of its own, or all groups would draw the same trees
        group = _forest({**params, "n_estimators": trees}, label, "weight", seed + i * 1_000_003)
        fits.append(group.fit(rows))
        drop_unused_shuffles(encoded.sparkSession)
    return PipelineModel(stages=[*stages, joined_forest(fits)])


def tree_groups(trees: int, rows: int) -> list[int]:
    """How many trees of a forest are fitted at once, and then the next: all, where the
    rows' bootstrap counts are at most ``FIT_COUNTS``."""
    most = trees if rows * trees <= FIT_COUNTS else min(trees, max(GROUP_TREES, FIT_COUNTS // rows))
    n = -(-trees // most)
    return [trees // n + (i < trees % n) for i in range(n)]


def joined_forest(fits: Sequence[RandomForestClassificationModel]) -> RandomForestClassificationModel:
    """One forest with the trees of all: a forest's trees are drawn and grown each for
    itself, so groups of them are those of one forest."""
    first, sc = fits[0]._java_obj, SparkContext._active_spark_context
    grown = [tree for fit in fits for tree in fit._java_obj.trees()]
    ml = sc._jvm.org.apache.spark.ml.classification
    trees = sc._gateway.new_array(ml.DecisionTreeClassificationModel, len(grown))
    for i, tree in enumerate(grown):
        trees[i] = tree
    whole = ml.RandomForestClassificationModel(first.uid(), trees, first.numFeatures(), first.numClasses())
    number = sc._jvm.org.apache.spark.ml.param.ParamMap().put(first.numTrees(), len(grown))
    return RandomForestClassificationModel._from_java(first.copyValues(whole, number))


def sample_candidates(space: Mapping[str, Sequence] = P.PARAM_SPACE, n_iter: int = P.SEARCH_ITERATIONS,
                      seed: int = P.SEED) -> list[dict]:
    """Draw ``n_iter`` distinct points of the grid with a seeded generator;
    points that differ only in a parameter Spark lacks are merged (L5)."""
    names = list(space)
    grid = [dict(zip(names, combo)) for combo in itertools.product(*[space[n] for n in names])]
    rng = random.Random(seed)
    picked = rng.sample(grid, min(n_iter, len(grid)))
    seen, out = set(), []
    for c in picked:
        key = tuple(sorted(forest_params(c).items()))
        if key not in seen:
            seen.add(key)
            out.append(c)
    return out


def fingerprint(train: DataFrame, label: str, fold_col: str, candidates: Sequence[Mapping], exclude: Sequence[str],
                seed: int) -> str:
    """What a search is of: its rows (an order-free checksum), columns, points and seed."""
    rows = train.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*train.columns) % (1 << 40))).first()
    points = [sorted((k, str(v)) for k, v in c.items()) for c in candidates]
    text = repr((tuple(rows), sorted(train.columns), label, fold_col, points, sorted(exclude), seed))
    return hashlib.md5(text.encode()).hexdigest()


def _committed(spark, path: str) -> bool:
    """Whether a write to the folder ended: its last step puts this file there."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def search_predictions(train: DataFrame, label: str, fold_col: str, candidates: Sequence[Mapping],
                       exclude: Sequence[str] = (), parallelism: int = 4, seed: int = P.SEED,
                       ledger: str | None = None) -> DataFrame:
    """L6's fits: the held-out predictions (``candidate``, ``fold``, label,
    ``prediction``, ``p_bad``) of every candidate on every fold.

    Encoder and class weights are fitted once per fold, on its training rows, and
    both parts are written encoded; all candidates of the fold share them. Below
    ``ledger``, a shared folder, each fit's predictions are written under the
    search's fingerprint, candidate and fold, and count from the moment their write
    is committed: a search that is started again with the same folder does only
    the fits that are missing, and one that died half-way is written anew. Rows of
    a null fold take no part.
    """
    # every fold reads the training rows again: read them from one written copy
    train = cut_lineage(train.where(F.col(fold_col).isNotNull()))
    spark = train.sparkSession
    base = ledger or f"{run_tables(spark)}/search-{uuid.uuid4().hex}"
    base = f"{base.rstrip('/')}/{fingerprint(train, label, fold_col, candidates, exclude, seed)}"
    folds = sorted(r[0] for r in train.select(fold_col).distinct().collect())

    def place(i: int, f: int) -> str:
        return f"{base}/fits/candidate={i}/fold={f}"

    missing = [(i, f) for f in folds for i in range(len(candidates)) if not _committed(spark, place(i, f))]

    def encoded(f: int) -> tuple[DataFrame, DataFrame, DataFrame]:
        stages, rows = encode_for_forest(train.where(F.col(fold_col) != f), label, [*exclude, fold_col])
        held = PipelineModel(stages=stages).transform(train.where(F.col(fold_col) == f))
        return rows, spread_once(rows), cut_lineage(held.select("features", F.col(label).cast("int").alias(label)))

    def run(job: tuple[int, int]) -> None:
        _, rows, held = tables[job[1]]
        scored = _forest(candidates[job[0]], label, "weight", seed).fit(rows).transform(held)
        # a fit's predictions are written as it ends, and its model is let go: the
        # driver holds as many models as run at once, not one for each fit
        scored.select(label, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability")[1].alias("p_bad")).write.mode("overwrite").parquet(place(*job))

    # the encoded tables of all folds, and as many fits at a time as asked for, where the rows'
    # bootstrap counts of that many are few; else one fold and one fit after the other, as the
    # disk then holds the tables and counts of one (each fit is a job for all executors)
    todo = sorted({f for _, f in missing})
    trees = max((forest_params(c)["numTrees"] for c in candidates), default=0)
    fits = max(1, parallelism)
    large = train.count() * trees * fits > FIT_COUNTS
    for some in [[f] for f in todo] if large else [todo]:
        tables = {f: encoded(f) for f in some}
        with ThreadPoolExecutor(max_workers=1 if large else fits) as pool:
            list(pool.map(run, [job for job in missing if job[1] in tables]))
        drop_tables(*(t for held in tables.values() for t in held))
        if large:
            tables.clear()
            drop_unused_shuffles(spark)
    drop_tables(train)
    schema = f"`{label}` int, prediction int, p_bad double, candidate int, fold int"
    return spark.read.schema(schema).parquet(f"{base}/fits")


def search(train: DataFrame, label: str, fold_col: str, candidates: Sequence[Mapping],
           exclude: Sequence[str] = (), parallelism: int = 4, seed: int = P.SEED, ledger: str | None = None) -> DataFrame:
    """Every candidate on every fold (:func:`search_predictions`), then all six
    scores per (candidate, fold) from one grouped aggregate plus one grouped AUC.

    Returns one row per candidate: parameters, mean scores, ``rank`` by mean F1
    (ties: earlier candidate first). Fits run through a small thread pool;
    each fit is itself a distributed Spark job.
    """
    return ranked(search_predictions(train, label, fold_col, candidates, exclude, parallelism, seed, ledger), label, candidates)


def ranked(preds: DataFrame, label: str, candidates: Sequence[Mapping]) -> DataFrame:
    """The candidates with their mean scores over the folds of written predictions."""
    spark = preds.sparkSession
    conf = confusion(preds, label, "prediction", ["candidate", "fold"])
    rates = rate_columns()
    per_fold = conf.select("candidate", "fold", *[rates[m].alias(m) for m in METRICS if m != "roc_auc"])
    aucs = roc_auc(preds, label, "p_bad", ["candidate", "fold"])
    per_fold = per_fold.join(aucs, ["candidate", "fold"], "left")
    means = per_fold.groupBy("candidate").agg(*[F.avg(m).alias(f"mean_{m}") for m in METRICS])
    params = spark.createDataFrame(
        [(i, str(c.get("n_estimators")), str(c.get("max_depth")), str(c.get("min_samples_split")),
          str(c.get("min_samples_leaf")), str(c.get("max_features")), str(c.get("bootstrap")))
         for i, c in enumerate(candidates)],
        "candidate int, n_estimators string, max_depth string, min_samples_split string, "
        "min_samples_leaf string, max_features string, bootstrap string")
    out = params.join(means, "candidate")
    return out.withColumn("rank", F.row_number().over(
        Window.orderBy(F.desc_nulls_last("mean_f1"), F.asc("candidate"))))  # one row per candidate


def best_candidate(results: DataFrame, candidates: Sequence[Mapping]) -> dict:
    """The parameters of the rank-1 row (one row to the driver)."""
    i = results.where(F.col("rank") == 1).select("candidate").first()[0]
    return dict(candidates[i])


def refit(train: DataFrame, label: str, results: DataFrame, candidates: Sequence[Mapping],
          exclude: Sequence[str] = (), seed: int = P.SEED) -> tuple[PipelineModel, dict, DataFrame]:
    """L6's end: the rank-1 candidate fitted on all training rows. Returns the
    model, its parameters and its mean scores as (metric, value) rows."""
    best = best_candidate(results, candidates)
    top = results.where(F.col("rank") == 1)
    scores = top.select(F.inline(F.array(*[F.struct(F.lit(f"best_cv_{m}").alias("metric"),
                                                    F.col(f"mean_{m}").alias("value")) for m in METRICS])))
    return fit_forest(train, label, best, exclude, seed), best, scores
