"""Classification metrics over scored tables.

Confusion counts are four ``count_if`` in one aggregate (optionally per
group); every rate is derived from them, with 0 for an undefined ratio. The
ROC-AUC is exact with tied scores averaged: scores are counted per distinct
value, and the negatives ranked below each score come from the bucketed
running count, so no task ever holds all scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readyspark.operators.ordered import (BROADCAST_ROWS, ROWS_PER_BUCKET, bucket_count, null_safe_join,
                                          running_sum, value_buckets)
from readyspark.session import cut_lineage

METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc", "mcc"]


def _zero_div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction",
              group_cols: Sequence[str] = ()) -> DataFrame:
    """M1: tn, fp, fn, tp with labels fixed to 0/1 (one partial aggregate)."""
    y, p = F.col(label), F.col(prediction)
    aggs = [F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
            F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"),
            F.count(F.lit(1)).alias("samples")]
    return df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)


def rate_columns() -> dict:
    """M2-M6 from the confusion columns."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    total = tn + fp + fn + tp
    d = lambda c: c.cast("double")
    mcc_den = F.sqrt(d(tp + fp) * d(tp + fn) * d(tn + fp) * d(tn + fn))
    return {
        "accuracy": _zero_div(tp + tn, total),
        "precision": _zero_div(tp, tp + fp),
        "recall": _zero_div(tp, tp + fn),
        "f1": _zero_div(2 * tp, 2 * tp + fp + fn),
        "mcc": F.when(mcc_den > 0, (d(tp) * d(tn) - d(fp) * d(fn)) / mcc_den).otherwise(F.lit(0.0)),
    }


def roc_auc(df: DataFrame, label: str = "label", score: str = "p_bad",
            group_cols: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """M7: exact ROC-AUC with ties counted half, per group if given.

    AUC = sum over distinct scores s of pos(s) * (neg(< s) + neg(s) / 2) / (P * N).
    Twice the numerator is an integer, so the result does not depend on the
    order of addition. Null when a class is absent (the metric is undefined).
    """
    group_cols = list(group_cols)
    y, s = F.col(label), F.col(score).cast("double")
    per_score = (df.where(s.isNotNull() & ~F.isnan(s))
                   .groupBy(*group_cols, s.alias("_s"))
                   .agg(F.count_if(y == 1).alias("_pos"), F.count_if(y == 0).alias("_neg")))
    # feeds the size, the sketch, the offsets and the sum: counted once
    return _auc_of_counts(cut_lineage(per_score), group_cols, rows_per_bucket)


def _auc_of_counts(per_score: DataFrame, group_cols: list, rows_per_bucket: int) -> DataFrame:
    """AUC from one row per (group, distinct score) with ``_pos`` and ``_neg``."""
    n_buckets = bucket_count(per_score.count(), rows_per_bucket)
    per_score = value_buckets(per_score, "_s", n_buckets)
    ranked = running_sum(per_score, group_cols, "_bucket", ["_s"], weight=F.col("_neg"),
                         single_bucket=n_buckets == 1)
    # products of two counts pass a long near 2e9 rows of each class: 38 digits hold
    # them exactly, so the sum is still independent of its order
    wide = lambda c: c.cast("decimal(19,0)")
    twice = (wide(F.col("_pos")) * (wide(F.col("_before")) + wide(F.col("_before") + F.col("_neg")))).cast("decimal(38,0)")
    agg = [F.sum(twice).alias("_num2"), F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n")]
    out = ranked.groupBy(*group_cols).agg(*agg) if group_cols else ranked.agg(*agg)
    auc = F.try_divide(F.col("_num2").cast("double"),
                       F.lit(2.0) * F.col("_p").cast("double") * F.col("_n").cast("double"))
    return out.select(*group_cols, auc.alias("roc_auc"))


def score_counts(df: DataFrame, label: str = "label", prediction: str = "prediction",
                 score: str = "p_bad") -> DataFrame:
    """Scored rows counted per (score, prediction): positives ``_pos``,
    negatives ``_neg`` and all rows ``_all``. A partial aggregate; every metric
    of M8 is a sum over this table, so the scored rows are read once."""
    y = F.col(label)
    return (df.groupBy(F.col(score).cast("double").alias("_s"), F.col(prediction).alias("_p"))
              .agg(F.count_if(y == 1).alias("_pos"), F.count_if(y == 0).alias("_neg"),
                   F.count(F.lit(1)).alias("_all")))


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                           score: str | None = "p_bad") -> DataFrame:
    """M8: the six metrics as long rows (metric, value).

    With a score, the scored rows are counted once per (score, prediction)
    (:func:`score_counts`, written to the shared checkpoint folder); the
    confusion counts and the per-score table of the AUC are both sums over
    that table, so the scored input (and the split behind it) is evaluated
    once. Metric rows are unioned, never joined.
    """
    rates = rate_columns()
    if score is None:
        conf = confusion(df, label, prediction)
        auc = conf.select(F.lit("roc_auc").alias("metric"), F.lit(None).cast("double").alias("value"))
    else:
        counts = cut_lineage(score_counts(df, label, prediction, score))
        p, zero = F.col("_p"), F.lit(0).cast("long")
        conf = counts.agg(F.coalesce(F.sum(F.when(p == 0, F.col("_neg"))), zero).alias("tn"),
                          F.coalesce(F.sum(F.when(p == 1, F.col("_neg"))), zero).alias("fp"),
                          F.coalesce(F.sum(F.when(p == 0, F.col("_pos"))), zero).alias("fn"),
                          F.coalesce(F.sum(F.when(p == 1, F.col("_pos"))), zero).alias("tp"),
                          F.coalesce(F.sum("_all"), zero).alias("samples"))
        s = F.col("_s")
        per_score = (counts.where(s.isNotNull() & ~F.isnan(s)).groupBy("_s")
                           .agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg")))
        auc = _auc_of_counts(per_score, [], ROWS_PER_BUCKET).select(
            F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value"))
    rows = conf.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), rates[m].alias("value")) for m in METRICS if m != "roc_auc"])))
    return rows.unionByName(auc)


def majority_baseline(train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """M9: accuracy on ``test`` of always predicting the most frequent training
    class (ties: smallest label). Two class-count tables, joined by class."""
    tr = train.groupBy(label).agg(F.count(F.lit(1)).alias("_ntr"))
    te = test.groupBy(label).agg(F.count(F.lit(1)).alias("_nte"))
    both = tr.join(te, on=label, how="full")
    w = Window.orderBy(F.desc_nulls_last("_ntr"), F.asc(label))  # over one row per class
    ranked = both.withColumns({"_r": F.row_number().over(w),
                               "_tot": F.sum(F.coalesce("_nte", F.lit(0))).over(Window.partitionBy())})
    return ranked.where(F.col("_r") == 1).select(
        F.col(label).alias("majority_class"),
        _zero_div(F.coalesce(F.col("_nte"), F.lit(0)), F.col("_tot")).alias("baseline_accuracy"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight n / (k * n_c) per class (one row per class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    everything = Window.partitionBy()  # over one row per class
    return counts.select(label, "n_c",
                         (F.sum("n_c").over(everything).cast("double")
                          / (F.count(F.lit(1)).over(everything) * F.col("n_c"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Attach the balanced weight to every row. The weight table has one row per
    class and is joined by class: broadcast when its counted rows allow it, else
    by shuffle, so any number of classes works."""
    weights = cut_lineage(class_weights(df, label).select(label, F.col("weight").alias(out)))
    return null_safe_join(df, weights, [label], "left", broadcast=weights.count() <= BROADCAST_ROWS)
