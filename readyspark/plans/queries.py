"""Named queries over the driver tables: one per operator of the inventory.

Each takes (spark, sf_dir) and returns a lazy DataFrame whose double columns
are rounded to 6 places (results are compared with an independent SQL engine
at that precision).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readyspark import presets as P
from readyspark.operators import clean as C
from readyspark.operators import features as FE
from readyspark.operators import profile as PR
from readyspark.operators import rules as R
from readyspark.session import configure, cut_lineage, drop_tables
from readyspark.sources.applications import applications, dirty_applications
from readyspark.sources.tables import read_table


def finish(df: DataFrame, cols=None) -> DataFrame:
    """Round the named double columns (all doubles when ``cols`` is None) to 6 places.

    Only sums and averages of doubles need it: their order of addition is not
    fixed. Row-wise arithmetic is IEEE-exact and left as computed.
    """
    return df.select(*[F.round(F.col(f.name), 6).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (cols is None or f.name in cols)
                       else F.col(f.name)
                       for f in df.schema.fields])


def _apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applications(configure(spark), sf_dir)


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_applications(configure(spark), sf_dir)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean(_dirty(spark, sf_dir))


def prepared(spark: SparkSession, sf_dir: str, check: bool = False) -> DataFrame:
    """Cleaned, featured and target-encoded applications (the W1 table)."""
    out = FE.feature_engineering(cleaned(spark, sf_dir))
    if check:
        return FE.encode_target(out)
    mapping = F.create_map(*[x for k, v in P.TARGET_MAPPING.items() for x in (F.lit(k), F.lit(v))])
    return out.withColumn(P.TARGET, F.try_element_at(mapping, F.col(P.TARGET)).cast("int"))


# ---------------------------------------------------------------- data stage

def q_clean_applications(spark, sf_dir):
    return cleaned(spark, sf_dir)


def q_clean_reason_counts(spark, sf_dir):
    return C.clean_reason_counts(_dirty(spark, sf_dir))


def q_contract_split(spark, sf_dir):
    checked = C.contract_split(_dirty(spark, sf_dir), required=["duration", "credit_amount", "housing", "class"],
                               numeric=["duration", "credit_amount"])
    return checked.select("app_id", F.array_join("reasons", ",").alias("reasons"), "valid")


def q_feature_table(spark, sf_dir):
    return FE.feature_engineering(cleaned(spark, sf_dir))


def q_gender_codes(spark, sf_dir):
    a = _apps(spark, sf_dir)
    return (a.select(FE.gender_from_status().alias("gender"))
             .groupBy("gender").agg(F.count(F.lit(1)).alias("n")))


def q_target_encoding(spark, sf_dir):
    enc = FE.encode_target(cleaned(spark, sf_dir).select("app_id", P.TARGET))
    return enc


def q_rule_suite_raw(spark, sf_dir):
    d = _dirty(spark, sf_dir)
    return R.evaluate_rules(d, R.raw_suite(d.columns), "data_validation")


def q_rule_suite_prepared(spark, sf_dir):
    return R.evaluate_rules(prepared(spark, sf_dir), R.prepared_suite(), "data_post_processing")


def q_shape_summary(spark, sf_dir):
    from readyspark.sources.tables import shape_summary
    return shape_summary(_dirty(spark, sf_dir), P.TARGET)


# ---------------------------------------------------------------- profiling

def _clean_with_gender(spark, sf_dir):
    return cleaned(spark, sf_dir).withColumn("gender", FE.gender_from_status())


def q_value_counts(spark, sf_dir):
    return PR.value_counts(cleaned(spark, sf_dir), "purpose")


def q_crosstab_share(spark, sf_dir):
    return finish(PR.crosstab_share(_clean_with_gender(spark, sf_dir), "gender", P.TARGET, percent=True))


def q_ordered_crosstab(spark, sf_dir):
    return finish(PR.ordered_crosstab(cleaned(spark, sf_dir), "employment", P.EMPLOYMENT_ORDER, P.TARGET))


ORDERED_PROFILES = [("employment", P.EMPLOYMENT_ORDER), ("checking_status", P.CHECKING_ORDER),
                    ("savings_status", P.SAVINGS_ORDER), ("job", P.JOB_ORDER),
                    ("installment_commitment", P.INSTALLMENT_ORDER)]


def q_ordered_crosstabs(spark, sf_dir):
    """A3 for all five declared orders, as one long table from one aggregate."""
    return finish(PR.ordered_crosstabs(cleaned(spark, sf_dir), ORDERED_PROFILES, P.TARGET))


def q_group_describe(spark, sf_dir):
    return finish(PR.group_describe(cleaned(spark, sf_dir), P.TARGET, "credit_amount"))


def q_group_quartiles(spark, sf_dir):
    return finish(PR.group_quartiles(cleaned(spark, sf_dir), P.TARGET, "credit_amount"))


def q_histogram(spark, sf_dir):
    return PR.histogram(cleaned(spark, sf_dir), P.TARGET, "age", 20)


def q_box_stats(spark, sf_dir):
    return finish(PR.box_stats(cleaned(spark, sf_dir), "credit_amount", P.TARGET))


def q_box_stats_overall(spark, sf_dir):
    return finish(PR.box_stats(cleaned(spark, sf_dir), "duration"))


def q_sorted_classes(spark, sf_dir):
    return PR.sorted_classes(cleaned(spark, sf_dir), P.TARGET)


def q_event_quartiles(spark, sf_dir):
    ev = read_table(configure(spark), sf_dir, "events")
    return finish(PR.group_quartiles(ev, "event_type", "value"))


def q_event_histogram(spark, sf_dir):
    ev = read_table(configure(spark), sf_dir, "events")
    return PR.histogram(ev, "event_type", "value", 30)


QUERIES = {
    "clean_applications": q_clean_applications,
    "clean_reason_counts": q_clean_reason_counts,
    "contract_split": q_contract_split,
    "feature_table": q_feature_table,
    "gender_codes": q_gender_codes,
    "target_encoding": q_target_encoding,
    "rule_suite_raw": q_rule_suite_raw,
    "rule_suite_prepared": q_rule_suite_prepared,
    "shape_summary": q_shape_summary,
    "value_counts": q_value_counts,
    "crosstab_share": q_crosstab_share,
    "ordered_crosstab": q_ordered_crosstab,
    "ordered_crosstabs": q_ordered_crosstabs,
    "group_describe": q_group_describe,
    "group_quartiles": q_group_quartiles,
    "histogram": q_histogram,
    "box_stats": q_box_stats,
    "box_stats_overall": q_box_stats_overall,
    "sorted_classes": q_sorted_classes,
    "event_quartiles": q_event_quartiles,
    "event_histogram": q_event_histogram,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minimum slice: raw rule rows and prepared rule rows of one run."""
    return q_rule_suite_raw(spark, sf_dir).unionByName(q_rule_suite_prepared(spark, sf_dir))


# ---------------------------------------------------------------- split, metrics, gates

from readyspark.operators import gates as G  # noqa: E402
from readyspark.operators import metrics as M  # noqa: E402
from readyspark.operators import split as S  # noqa: E402
from readyspark.operators import variants as V  # noqa: E402
from readyspark.operators.score import CREDIT_SCORECARD, label_text, score  # noqa: E402

KEY = "app_id"


def split_table(spark, sf_dir):
    return S.stratified_split(prepared(spark, sf_dir), P.TARGET, KEY, P.TEST_SIZE, P.SEED)


def split_written(spark, sf_dir):
    """The split table written once to the shared checkpoint folder, for
    queries that read both parts (or one part twice): the ranking shuffle then
    runs once, as in the prepare flow (W1). The prepared rows, which the split's
    jobs read, are deleted when it is written."""
    rows = S.cut_lineage(prepared(spark, sf_dir))
    split = cut_lineage(S.stratified_split(rows, P.TARGET, KEY, P.TEST_SIZE, P.SEED, checkpoint=False))
    drop_tables(rows)
    return split


def test_rows(spark, sf_dir):
    return split_table(spark, sf_dir).where(F.col("split") == "test").drop("split")


def train_rows(spark, sf_dir):
    return split_table(spark, sf_dir).where(F.col("split") == "train").drop("split")


def scored_test(spark, sf_dir):
    """Key, target, group and scores of the test rows. Only the columns that are scored go through
    the split, whose input is written."""
    read = dict.fromkeys([KEY, P.TARGET, P.SENSITIVE, *[t.column for t in CREDIT_SCORECARD.terms]])
    split = S.stratified_split(prepared(spark, sf_dir).select(*read), P.TARGET, KEY, P.TEST_SIZE, P.SEED)
    return score(split.where(F.col("split") == "test"), CREDIT_SCORECARD).select(KEY, P.TARGET, P.SENSITIVE, "p_bad", "prediction")


def q_exact_split(spark, sf_dir):
    return split_table(spark, sf_dir).select(KEY, P.TARGET, "split")


def q_split_summary(spark, sf_dir):
    return (split_table(spark, sf_dir).groupBy("split", P.TARGET).agg(F.count(F.lit(1)).alias("n")))


def q_stratified_folds(spark, sf_dir):
    tr = train_rows(spark, sf_dir)
    return S.stratified_folds(tr, P.TARGET, KEY, P.N_FOLDS, P.SEED).select(KEY, P.TARGET, "fold")


def q_majority_baseline(spark, sf_dir):
    st = split_written(spark, sf_dir)
    return M.majority_baseline(st.where(F.col("split") == "train"), st.where(F.col("split") == "test"), P.TARGET)


def q_class_weights(spark, sf_dir):
    return M.class_weights(train_rows(spark, sf_dir), P.TARGET)


def q_confusion(spark, sf_dir):
    return M.confusion(scored_test(spark, sf_dir), P.TARGET, "prediction")


def q_classification_metrics(spark, sf_dir):
    return M.classification_metrics(scored_test(spark, sf_dir), P.TARGET, "prediction", "p_bad")


def q_roc_auc(spark, sf_dir):
    return M.roc_auc(scored_test(spark, sf_dir), P.TARGET, "p_bad")


def q_group_rates(spark, sf_dir):
    return G.group_rates(scored_test(spark, sf_dir), P.SENSITIVE, P.TARGET, "prediction")


def q_separation_gap(spark, sf_dir):
    return G.fairness_gate(scored_test(spark, sf_dir), P.SENSITIVE, P.TARGET, "prediction")


def _performance(spark, sf_dir):
    st = split_written(spark, sf_dir)
    sc = score(st.where(F.col("split") == "test"), CREDIT_SCORECARD)
    metrics = M.classification_metrics(sc, P.TARGET, "prediction", "p_bad")
    base = M.majority_baseline(st.where(F.col("split") == "train"), st.where(F.col("split") == "test"), P.TARGET)
    return G.performance_gate(metrics, base)


def q_performance_gate(spark, sf_dir):
    return _performance(spark, sf_dir)


def q_scorecard_scoring(spark, sf_dir):
    sc = label_text(score(prepared(spark, sf_dir).drop(P.TARGET), CREDIT_SCORECARD))
    return sc.select(KEY, "p_bad", "prediction", "prediction_label", "probability_good", "probability_bad")


def _variant_rows(spark, sf_dir, changes, mask=None):
    t = test_rows(spark, sf_dir)
    cols = [KEY] + [c for c in changes]
    if mask is not None:  # the mask reads the values before the move
        t = t.withColumn("mask", mask)
        cols.append("mask")
    return V.apply_variant(t, changes).select(*cols)


def q_perturbed_rows(spark, sf_dir):
    return _variant_rows(spark, sf_dir, V.perturbation(KEY))


def q_inflated_rows(spark, sf_dir):
    return _variant_rows(spark, sf_dir, V.inflation())


def q_duration_shift(spark, sf_dir):
    return _variant_rows(spark, sf_dir, V.duration_increase())


def q_checking_shift(spark, sf_dir):
    ch, mask = V.category_move("checking_status", P.CHECKING_IMPROVEMENT, P.CHECKING_MOVABLE)
    return _variant_rows(spark, sf_dir, ch, mask)


def q_savings_shift(spark, sf_dir):
    ch, mask = V.category_move("savings_status", P.SAVINGS_DETERIORATION, P.SAVINGS_MOVABLE)
    return _variant_rows(spark, sf_dir, ch, mask)


def _variant_scores(spark, sf_dir, variants):
    return V.score_variants(test_rows(spark, sf_dir), CREDIT_SCORECARD, variants, keep=[KEY, P.TARGET])


def _directions():
    return {v.name: v.direction for v in V.metamorphic_variants()}


def q_robustness_gate(spark, sf_dir):
    return G.robustness_gate(_variant_scores(spark, sf_dir, V.robustness_variants(KEY)), P.TARGET)


def q_metamorphic_gate(spark, sf_dir):
    return G.metamorphic_gate(_variant_scores(spark, sf_dir, V.metamorphic_variants()), _directions())


def gate_rows(spark, sf_dir):
    """W1 + W3 with the scorecard: the prepared and split table is built once
    (checkpointed) and every gate reads it."""
    from readyspark.plans.flows import prepare, readiness
    prep = prepare(_dirty(spark, sf_dir), KEY, raise_on_failure=False)
    return readiness(prep, KEY, params={}, scorer=CREDIT_SCORECARD)["gate_rows"]


def q_gate_report(spark, sf_dir):
    return gate_rows(spark, sf_dir)


def q_gate_overview(spark, sf_dir):
    return G.overview(gate_rows(spark, sf_dir))


def q_readiness_verdict(spark, sf_dir):
    return G.verdict(gate_rows(spark, sf_dir))


def _doc_scored(spark, sf_dir):
    """documents with labels: quality as the label, a length rule as the
    prediction, language as the group."""
    spark = configure(spark)
    d = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    j = d.join(lab, "doc_id")
    return j.withColumn("prediction", (F.col("n_chars") >= 2000).cast("int"))


def q_document_group_rates(spark, sf_dir):
    return G.group_rates(_doc_scored(spark, sf_dir), "lang", "quality", "prediction")


def q_document_class_balance(spark, sf_dir):
    j = _doc_scored(spark, sf_dir)
    return R.evaluate_rules(j, [R.RowCount(min_value=1), R.InSet("quality", (0, 1)),
                                R.MinClassShare("quality", P.MIN_CLASS_SHARE)], "document_labels")


QUERIES.update({
    "exact_split": q_exact_split,
    "split_summary": q_split_summary,
    "stratified_folds": q_stratified_folds,
    "majority_baseline": q_majority_baseline,
    "class_weights": q_class_weights,
    "confusion": q_confusion,
    "classification_metrics": q_classification_metrics,
    "roc_auc": q_roc_auc,
    "group_rates": q_group_rates,
    "separation_gap": q_separation_gap,
    "performance_gate": q_performance_gate,
    "scorecard_scoring": q_scorecard_scoring,
    "perturbed_rows": q_perturbed_rows,
    "inflated_rows": q_inflated_rows,
    "duration_shift": q_duration_shift,
    "checking_shift": q_checking_shift,
    "savings_shift": q_savings_shift,
    "robustness_gate": q_robustness_gate,
    "metamorphic_gate": q_metamorphic_gate,
    "gate_report": q_gate_report,
    "gate_overview": q_gate_overview,
    "readiness_verdict": q_readiness_verdict,
    "document_group_rates": q_document_group_rates,
    "document_class_balance": q_document_class_balance,
})


# ---------------------------------------------------------------- learning, streaming

from readyspark.operators import learn as L  # noqa: E402

# a point of the search space (presets.PARAM_SPACE), for the queries that fit one forest
QUERY_FOREST = {"n_estimators": 100, "max_depth": 10, "min_samples_split": 2, "min_samples_leaf": 1,
                "max_features": "sqrt", "bootstrap": True}


def q_ordinal_encoding(spark, sf_dir):
    enc = L.ordinal_codes(prepared(spark, sf_dir))
    return enc.select(KEY, "employment_code", "job_code")


def q_onehot_wide(spark, sf_dir):
    """L2 as the forest has it: the pipeline's own encoder stages, fitted on train."""
    from pyspark.ml import Pipeline
    st = split_written(spark, sf_dir)
    model = Pipeline(stages=L.encoders(P.NOMINAL_FEATURES)).fit(st.where(F.col("split") == "train"))
    return L.onehot_wide(st.where(F.col("split") == "test"), model, KEY)


def q_onehot_slots(spark, sf_dir):
    """L2 for columns of many categories: customers (as text) and priorities of the
    filled orders are the categories, every order is encoded; the slots are those of
    the written sparse vectors."""
    from readyspark.operators import categories as K
    spark = configure(spark)
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority",
                                                        F.col("o_custkey").cast("string").alias("customer"))
    fitted = K.fit_categories(orders.where("o_orderstatus = 'F'"), ["customer", "o_orderpriority"])
    rows = K.encode(orders, fitted)
    first, stored = fitted["customer"].size, F.from_json(F.to_json(F.struct("onehot")), "onehot struct<size int, indices array<int>>")
    rows = rows.select("o_orderkey", stored["onehot"].alias("v"))
    return rows.select("o_orderkey", F.try_element_at(F.filter("v.indices", lambda i: i < first), F.lit(1)).alias("customer_slot"),
                       F.try_element_at(F.filter("v.indices", lambda i: i >= first), F.lit(1)).alias("priority_slot"),
                       F.col("v.size").alias("slots"))


def q_class_balance(spark, sf_dir):
    return R.evaluate_rules(prepared(spark, sf_dir), [R.MinClassShare(P.TARGET, P.MIN_CLASS_SHARE)],
                            "class_balance")


def q_forest_scores(spark, sf_dir):
    st = split_written(spark, sf_dir)
    train = st.where(F.col("split") == "train").drop("split", P.SENSITIVE)
    model = L.fit_forest(train, P.TARGET, QUERY_FOREST, exclude=[KEY])
    return score(st.where(F.col("split") == "test").drop("split"), model).select(KEY, P.TARGET, "p_bad", "prediction")


def q_forest_score_facts(spark, sf_dir):
    """What holds for the scores of any forest: a row per test row, probabilities
    within 0..1, and a prediction that is the probability's cut at one half."""
    p = F.col("p_bad")
    return q_forest_scores(spark, sf_dir).select(
        KEY, P.TARGET, ((p >= 0) & (p <= 1)).alias("in_range"),
        ((p == 0.5) | (F.col("prediction") == (p > 0.5).cast("int"))).alias("is_cut"))


def _fitted(spark, sf_dir):
    """The forest fitted on the train rows, and the split."""
    st = split_written(spark, sf_dir)
    train = st.where(F.col("split") == "train").drop("split", P.SENSITIVE)
    return L.fit_forest(train, P.TARGET, QUERY_FOREST, exclude=[KEY]), st


def q_forest_walk(spark, sf_dir):
    """L3-L5, L8, L9 a second way: the fitted forest as a node table, walked by SQL
    expressions. Per test row whether the walked probability is the reported one
    and the prediction its cut; and whether the walked scores' AUC is above that of
    the majority class, which scores all rows alike (one half)."""
    from readyspark.operators import forest as FO
    model, st = _fitted(spark, sf_dir)
    both = cut_lineage(FO.walked_scores(st.where(F.col("split") == "test").drop("split"), model, KEY))
    above = M.roc_auc(both, P.TARGET, "p_walked").first()["roc_auc"] > 0.5
    p = F.col("p_walked")
    return both.select(KEY, P.TARGET, (F.abs(F.col("p_bad") - p) < 1e-9).alias("same_probability"),
                       ((F.abs(p - 0.5) < 1e-9) | (F.col("prediction") == (p > 0.5).cast("int"))).alias("same_label"),
                       F.lit(bool(above)).alias("above_majority"))


# W2 as a query: a search space small enough for a check, its fits, folds and scores as always
QUERY_SPACE = {"n_estimators": [20], "max_depth": [3, 5], "min_samples_split": [2], "min_samples_leaf": [1],
               "max_features": ["sqrt"], "bootstrap": [True]}

SCORES_SQL = """
WITH c AS (
  SELECT candidate, fold, double(count_if(prediction = 1 AND class = 1)) AS tp, double(count_if(prediction = 0 AND class = 0)) AS tn,
         double(count_if(prediction = 1 AND class = 0)) AS fp, double(count_if(prediction = 0 AND class = 1)) AS fn FROM {preds} GROUP BY ALL),
ranks AS (
  SELECT candidate, fold, class, rank() OVER (PARTITION BY candidate, fold ORDER BY p_bad)
         + (count(*) OVER (PARTITION BY candidate, fold, p_bad) - 1) / 2.0D AS r FROM {preds}),
auc AS (
  SELECT candidate, fold, (sum(CASE WHEN class = 1 THEN r END) - count_if(class = 1) * (count_if(class = 1) + 1) / 2.0D)
         / (count_if(class = 1) * count_if(class = 0)) AS roc_auc FROM ranks GROUP BY ALL)
SELECT candidate, avg((tp + tn) / (tp + tn + fp + fn)) AS accuracy, avg(coalesce(try_divide(tp, tp + fp), 0)) AS precision,
       avg(coalesce(try_divide(tp, tp + fn), 0)) AS recall, avg(coalesce(try_divide(2 * tp, 2 * tp + fp + fn), 0)) AS f1,
       avg(coalesce(try_divide(tp * tn - fp * fn, sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))), 0)) AS mcc,
       avg(roc_auc) AS roc_auc
FROM c JOIN auc USING (candidate, fold) GROUP BY candidate"""


def q_search_scores(spark, sf_dir):
    """The six mean scores of each candidate over its five folds, against
    plain SQL over the predictions that the fits wrote; and the rank by mean F1."""
    rows = train_rows(spark, sf_dir)
    folds = S.stratified_folds(rows, P.TARGET, KEY, P.N_FOLDS, P.SEED).drop(P.SENSITIVE)
    cands = L.sample_candidates(QUERY_SPACE, P.SEARCH_ITERATIONS, P.SEED)
    preds = L.search_predictions(folds, P.TARGET, "fold", cands, exclude=[KEY])
    results = L.ranked(preds, P.TARGET, cands)
    again = spark.sql(SCORES_SQL, preds=preds).withColumnRenamed("candidate", "_c")
    place = F.row_number().over(Window.orderBy(F.desc("f1"), "_c"))  # one row per candidate
    same = [(F.abs(F.col(f"mean_{m}") - F.col(m)) < 1e-9).alias(f"same_{m}") for m in M.METRICS]
    return results.join(again.withColumn("_rank", place), F.col("candidate") == F.col("_c")).select(
        "candidate", "max_depth", *same, (F.col("rank") == F.col("_rank")).alias("same_rank"))


GATES_SQL = """
WITH c AS (
  SELECT sex, double(count_if(prediction = 1 AND class = 1)) AS tp, double(count_if(prediction = 0 AND class = 0)) AS tn,
         double(count_if(prediction = 1 AND class = 0)) AS fp, double(count_if(prediction = 0 AND class = 1)) AS fn FROM {scored} GROUP BY sex),
t AS (SELECT sum(tp) AS tp, sum(tn) AS tn, sum(fp) AS fp, sum(fn) AS fn FROM c),
ranks AS (SELECT class, rank() OVER (ORDER BY p_bad) + (count(*) OVER (PARTITION BY p_bad) - 1) / 2.0D AS r FROM {scored}),
auc AS (
  SELECT (sum(CASE WHEN class = 1 THEN r END) - count_if(class = 1) * (count_if(class = 1) + 1) / 2.0D)
         / (count_if(class = 1) * count_if(class = 0)) AS a FROM ranks),
major AS (SELECT class FROM {train} GROUP BY class ORDER BY count(*) DESC, class LIMIT 1),
plain AS (SELECT avg(CASE WHEN s.class = m.class THEN 1.0D ELSE 0.0D END) AS a FROM {scored} s CROSS JOIN major m),
rates AS (SELECT sex, coalesce(try_divide(fp, fp + tn), 0) AS fpr, coalesce(try_divide(fn, fn + tp), 0) AS fnr,
                 coalesce(try_divide(tp, tp + fn), 0) AS tpr FROM c),
gaps AS (
  SELECT abs(max(fpr) FILTER (WHERE sex = 'female') - max(fpr) FILTER (WHERE sex = 'male')) AS fpr,
         abs(max(fnr) FILTER (WHERE sex = 'female') - max(fnr) FILTER (WHERE sex = 'male')) AS fnr FROM rates),
f AS (
  SELECT 2 * count_if(class = 1 AND pred_base = 1 AND variant = 'inflation') / double(count_if(variant = 'inflation' AND class = 1)
           + count_if(variant = 'inflation' AND pred_base = 1)) AS clean,
         2 * count_if(class = 1 AND prediction = 1 AND variant = 'inflation') / double(count_if(variant = 'inflation' AND class = 1)
           + count_if(variant = 'inflation' AND prediction = 1)) AS inflation,
         2 * count_if(class = 1 AND prediction = 1 AND variant = 'perturbation') / double(count_if(variant = 'perturbation' AND class = 1)
           + count_if(variant = 'perturbation' AND prediction = 1)) AS perturbation FROM {variants}),
moved AS (
  SELECT variant, avg(CASE WHEN CASE WHEN variant = 'checking_status_improvement' THEN p_bad > p_base ELSE p_bad < p_base END
                      THEN 1.0D ELSE 0.0D END) AS rate
  FROM {variants} WHERE mask AND variant NOT IN ('inflation', 'perturbation') GROUP BY variant)
SELECT 'accuracy' AS metric, '' AS subject, (tp + tn) / (tp + tn + fp + fn) AS value, (tp + tn) / (tp + tn + fp + fn) > a AS passed FROM t, plain
UNION ALL SELECT 'precision', '', coalesce(try_divide(tp, tp + fp), 0), coalesce(try_divide(tp, tp + fp), 0) > 0.5D FROM t
UNION ALL SELECT 'recall', '', tp / (tp + fn), tp / (tp + fn) > 0.7D FROM t
UNION ALL SELECT 'f1', '', 2 * tp / (2 * tp + fp + fn), 2 * tp / (2 * tp + fp + fn) > 0.6D FROM t
UNION ALL SELECT 'mcc', '', m, m > 0.4D FROM (
  SELECT coalesce(try_divide(tp * tn - fp * fn, sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))), 0) AS m FROM t)
UNION ALL SELECT 'roc_auc', '', a, a > 0.8D FROM auc
UNION ALL SELECT 'false_positive_rate', sex, fpr, true FROM rates
UNION ALL SELECT 'false_negative_rate', sex, fnr, true FROM rates
UNION ALL SELECT 'true_positive_rate', sex, tpr, true FROM rates
UNION ALL SELECT 'fpr_difference', '', fpr, true FROM gaps
UNION ALL SELECT 'fnr_difference', '', fnr, true FROM gaps
UNION ALL SELECT 'separation_difference', '', (fpr + fnr) / 2, (fpr + fnr) / 2 <= 0.05D FROM gaps
UNION ALL SELECT 'f1_clean', '', clean, true FROM f
UNION ALL SELECT 'f1_perturbation', '', perturbation, true FROM f
UNION ALL SELECT 'f1_inflation', '', inflation, true FROM f
UNION ALL SELECT 'robustness_perturbation', '', perturbation / clean, true FROM f
UNION ALL SELECT 'robustness_inflation', '', inflation / clean, true FROM f
UNION ALL SELECT 'mean_robustness_score', '', (perturbation / clean + inflation / clean) / 2,
  (perturbation / clean + inflation / clean) / 2 >= 0.95D FROM f
UNION ALL SELECT 'violation_rate', variant, rate, rate <= 0.1D FROM moved"""


def q_forest_gates(spark, sf_dir):
    """W3 with a fitted forest: every gate row of the run (performance, fairness,
    robustness, metamorphic), and whether plain SQL over the run's written scores
    comes to the same value and verdict."""
    from readyspark.plans.flows import Prepared, readiness
    st = split_written(spark, sf_dir)
    part = lambda name: st.where(F.col("split") == name).drop("split")
    rules = cut_lineage(R.evaluate_rules(st, R.prepared_suite(), "data_post_processing"))
    prep = Prepared(rules, rules, st, part("train"), part("test"))
    out = readiness(prep, KEY, QUERY_FOREST)
    rows = cut_lineage(out["gate_rows"].where(F.col("gate") != "data_post_processing"))
    scored = out["scored"].select(KEY, P.TARGET, P.SENSITIVE, "prediction", "p_bad")  # written, as the variants are
    variants = out["variants"]
    again = spark.sql(GATES_SQL, scored=scored, train=prep.train.select(P.TARGET), variants=variants)
    near = lambda a, b: (a.isNull() & b.isNull()) | F.coalesce(F.abs(a - b) < 1e-9, F.lit(False))
    on = (F.col("r.metric") == F.col("s.metric")) & (F.coalesce("r.subject", F.lit("")) == F.col("s.subject"))
    return rows.alias("r").join(again.alias("s"), on, "full").select(
        F.col("r.gate").alias("gate"), F.col("r.metric").alias("metric"), F.coalesce("r.subject", F.lit("")).alias("subject"),
        near(F.col("r.value"), F.col("s.value")).alias("same_value"), (F.col("r.passed") == F.col("s.passed")).alias("same_verdict"))


def _streamed(spark, sf_dir, keep):
    """X2 over the applications: they are landed as Parquet files in this run's
    folder below the shared checkpoint folder and drained by the streaming scorer."""
    import os
    import uuid

    from readyspark.session import run_tables
    from readyspark.streaming.scoring import run_stream_scoring
    spark = configure(spark)
    base = os.path.join(run_tables(spark), f"stream-{uuid.uuid4().hex}")
    src = os.path.join(base, "in")
    rows = _dirty(spark, sf_dir).drop(P.TARGET)
    rows.write.parquet(src)
    numeric = list(P.NUMERIC_COLUMNS)
    return run_stream_scoring(spark, src, rows.schema, CREDIT_SCORECARD, os.path.join(base, "out"),
                              os.path.join(base, "ckpt"), required=numeric + list(P.ALLOWED_CATEGORIES),
                              numeric=numeric, keep=keep)


def q_stream_scores(spark, sf_dir):
    from readyspark.streaming.scoring import read_sink
    return read_sink(spark, _streamed(spark, sf_dir, [KEY])["scored"])


def q_stream_rejected(spark, sf_dir):
    """X2's other sink: rejected rows with their contract columns as they came."""
    from readyspark.streaming.scoring import read_sink
    return read_sink(spark, _streamed(spark, sf_dir, [KEY, "duration", "credit_amount", "housing"])["rejected"])


def q_stream_published(spark, sf_dir):
    """X2 with S7's models: applications of even number are drained while version 1 is
    live, then version 2 is published and the others come. Per valid row the version
    that scored it, and whether that model scores it so as a table, too."""
    from readyspark.sources import sinks
    from readyspark.streaming.scoring import read_sink, run_stream_scoring, score_valid
    spark, base = configure(spark), _folder(spark, "stream-published")
    st = split_written(spark, sf_dir)
    train = st.where(F.col("split") == "train").drop("split", P.SENSITIVE, "age")
    test = st.where(F.col("split") == "test").drop("split")
    passed = spark.createDataFrame([("given", True)], "gate string, passed boolean")
    rows = cut_lineage(_dirty(spark, sf_dir).drop(P.TARGET))
    numeric, models = list(P.NUMERIC_COLUMNS), {}
    encoders, encoded = L.encode_for_forest(train, P.TARGET, [KEY])
    for version, depth in ((1, 3), (2, 6)):
        models[version] = L.forest_on(encoders, encoded, P.TARGET, {**QUERY_FOREST, "n_estimators": 10, "max_depth": depth})
        got = sinks.publish_if_ready(score(test, models[version]).select(KEY, "p_bad"), passed, f"{base}/staging-{version}",
                                     f"{base}/target", model=models[version])
        assert got["version"] == version
        rows.where(F.col(KEY) % 2 == version - 1).write.mode("append").parquet(f"{base}/in")
        run_stream_scoring(spark, f"{base}/in", rows.schema, sinks.PublishedModel(spark, f"{base}/target"), f"{base}/out",
                           f"{base}/ckpt", required=numeric + list(P.ALLOWED_CATEGORIES), numeric=numeric, keep=[KEY])
    checked = C.contract_split(rows, numeric + list(P.ALLOWED_CATEGORIES), numeric)
    table = None
    for version, model in models.items():
        part = score_valid(checked.where(F.col(KEY) % 2 == version - 1), model, numeric).select(KEY, F.col("p_bad").alias("_p"))
        table = part if table is None else table.unionByName(part)
    table = table.groupBy(KEY).agg(F.collect_set("_p").alias("_p"))  # an application may be there twice
    return read_sink(spark, f"{base}/out/scored").join(table, KEY, "full").select(
        KEY, "model_version", F.array_contains("_p", F.col("p_bad")).alias("same_probability"))


# ---------------------------------------------------------------- sinks, alignment

def _folder(spark, kind):
    import uuid

    from readyspark.session import run_tables
    return f"{run_tables(configure(spark))}/{kind}-{uuid.uuid4().hex}"


def q_parquet_round_trip(spark, sf_dir):
    """The cleaned applications written by class and read back."""
    from readyspark.sources import sinks
    path = _folder(spark, "parquet")
    rows = cleaned(spark, sf_dir)
    sinks.write_parquet(rows, path, partition_by=[P.TARGET])
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


def q_csv_round_trip(spark, sf_dir):
    """S3: the cleaned applications as CSV with a header, read back by the same schema."""
    from readyspark.sources import sinks
    path = _folder(spark, "csv")
    rows = cleaned(spark, sf_dir)
    sinks.write_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


def q_report_round_trip(spark, sf_dir):
    """The raw rule rows as a JSON report, read back without its time stamp."""
    from readyspark.sources import sinks
    path = _folder(spark, "report")
    rows = q_rule_suite_raw(spark, sf_dir)
    sinks.write_report(rows, path)
    return spark.read.schema(rows.schema).json(path)


def q_history_round_trip(spark, sf_dir):
    """Two runs' metrics and a forest's parameters in one history table."""
    from readyspark.sources import sinks
    path = _folder(spark, "history")
    metrics = cut_lineage(q_classification_metrics(spark, sf_dir))
    for run in ("run-1", "run-2"):
        sinks.append_metrics(metrics, path, run)
    sinks.append_params(spark, {**QUERY_FOREST, "max_depth": None}, path, "run-1")
    return sinks.read_history(spark, path).drop("logged_at")


def _publish(spark, sf_dir, ready: bool):
    """S7 on the scored test rows; the audit reads the staged rows."""
    from readyspark.sources import sinks
    path = _folder(spark, "publish")
    scored = scored_test(spark, sf_dir).select(KEY, P.TARGET, "p_bad", "prediction")

    def audit(staged):
        # p_bad within 0..1, and more rows than any table has if it is to refuse
        return R.evaluate_rules(staged, [R.Between("p_bad", 0, 1), R.RowCount(min_value=1 if ready else 10 ** 15)], "audit")

    passed = spark.createDataFrame([("given", True)], "gate string, passed boolean")
    return lambda: sinks.publish_if_ready(scored, passed, f"{path}/staging", f"{path}/published", audit=audit), path


def q_published_scores(spark, sf_dir):
    """S7, ready: what the pointer's version holds."""
    from readyspark.sources import sinks
    publish, path = _publish(spark, sf_dir, True)
    publish()
    return sinks.read_published(spark, f"{path}/published")


def q_refused_publication(spark, sf_dir):
    """S7, not ready: a row per staged row, and that no version was published."""
    publish, path = _publish(spark, sf_dir, False)
    try:
        publish()
        refused = False
    except ValueError:
        refused = True
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/published")
    there = target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
    return spark.read.parquet(f"{path}/staging").select(KEY, F.lit(refused and not there).alias("refused"))


def q_aligned_rates(spark, sf_dir):
    """J1 on tables kept apart: labels and groups on one side, predictions on the other."""
    scored = cut_lineage(scored_test(spark, sf_dir).select(KEY, P.TARGET, P.SENSITIVE, "prediction"))
    both = C.aligned(scored.select(KEY, P.TARGET, P.SENSITIVE), scored.select(KEY, "prediction"), KEY)
    return G.group_rates(both, P.SENSITIVE, P.TARGET, "prediction")


def q_crosstab_wide(spark, sf_dir):
    return finish(PR.crosstab_wide(_clean_with_gender(spark, sf_dir), "gender", P.TARGET, P.TARGET_VALUES))


def q_weighted_rows(spark, sf_dir):
    """M10 on rows: the balanced weight of every training row."""
    return M.with_class_weights(train_rows(spark, sf_dir), P.TARGET).select(KEY, P.TARGET, "weight")


def q_numeric_column_counts(spark, sf_dir):
    """P20: the prepared table's numeric columns, with their filled rows."""
    rows = prepared(spark, sf_dir)
    names = FE.numeric_columns(rows, exclude=[KEY, P.TARGET])
    one = rows.agg(*[F.count(c).alias(c) for c in names])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("filled")) for c in names])))


QUERIES.update({
    "ordinal_encoding": q_ordinal_encoding,
    "onehot_wide": q_onehot_wide,
    "onehot_slots": q_onehot_slots,
    "class_balance": q_class_balance,
    "forest_scores": q_forest_scores,
    "forest_score_facts": q_forest_score_facts,
    "forest_walk": q_forest_walk,
    "search_scores": q_search_scores,
    "forest_gates": q_forest_gates,
    "stream_published": q_stream_published,
    "stream_scores": q_stream_scores,
    "stream_rejected": q_stream_rejected,
    "parquet_round_trip": q_parquet_round_trip,
    "csv_round_trip": q_csv_round_trip,
    "report_round_trip": q_report_round_trip,
    "history_round_trip": q_history_round_trip,
    "published_scores": q_published_scores,
    "refused_publication": q_refused_publication,
    "aligned_rates": q_aligned_rates,
    "crosstab_wide": q_crosstab_wide,
    "weighted_rows": q_weighted_rows,
    "numeric_column_counts": q_numeric_column_counts,
})
