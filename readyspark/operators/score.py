"""Scorers: anything that maps a feature table to ``prediction`` and ``p_bad``.

Two kinds fit the gates: a fitted ``PipelineModel`` (see ``learn``) and the
linear scorecard below, which is pure column arithmetic (so it can be checked
against SQL). Scoring a table is a projection: no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readyspark.functions.exprs import col_of


@dataclass(frozen=True)
class Term:
    column: str
    weight: float
    equals: object = None  # None: numeric term weight * column; else indicator column == equals


@dataclass
class Scorecard:
    """p_bad = clip(intercept + sum of terms, 0, 1), prediction = p_bad >= cutoff.

    Terms are added left to right in the declared order, so the arithmetic is
    the same in any engine.
    """
    intercept: float
    terms: list = field(default_factory=list)
    cutoff: float = 0.5

    def raw(self) -> Column:
        acc = F.lit(float(self.intercept))
        for t in self.terms:
            if t.equals is None:
                part = F.lit(float(t.weight)) * col_of(t.column).cast("double")
            else:
                part = F.when(F.coalesce(col_of(t.column) == F.lit(t.equals), F.lit(False)),
                              F.lit(float(t.weight))).otherwise(F.lit(0.0))
            acc = acc + part
        return acc

    def transform(self, df: DataFrame, p_col: str = "p_bad", pred_col: str = "prediction") -> DataFrame:
        p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), self.raw()))
        return df.withColumn(p_col, p).withColumn(pred_col, (F.col(p_col) >= self.cutoff).cast("int"))


# the scorecard used by the oracle-checked gate queries; weights are binary
# fractions (and one power of two per unit of amount) so sums are exact
CREDIT_SCORECARD = Scorecard(
    intercept=0.0625,
    terms=[
        Term("checking_status", 0.25, "<0"),
        Term("checking_status", 0.125, "0<=X<200"),
        Term("savings_status", 0.125, "<100"),
        Term("savings_status", 0.0625, "100<=X<500"),
        Term("credit_history", 0.125, "critical/other existing credit"),
        Term("credit_history", 0.0625, "delayed previously"),
        Term("high_risk_financial_status", 0.0625, 1),
        Term("duration", 0.0078125),
        Term("credit_amount", 2.0 ** -16),
    ],
)


def score(df: DataFrame, scorer, p_col: str = "p_bad", pred_col: str = "prediction") -> DataFrame:
    """Apply a scorer: a Scorecard, or a fitted Spark ML model whose output has
    ``probability`` and ``prediction`` (only those two are kept)."""
    if isinstance(scorer, Scorecard):
        return scorer.transform(df, p_col, pred_col)
    from pyspark.ml.functions import vector_to_array
    before = set(df.columns)
    out = scorer.transform(df)
    if "probability" not in out.columns:
        # the metamorphic and AUC checks need P(bad); fail here, not deep in a gate
        raise ValueError("the scorer gives no class probabilities ('probability' column missing)")
    out = out.withColumn(p_col, vector_to_array("probability")[1]) \
             .withColumn("_pred", F.col("prediction").cast("int"))
    added = [c for c in out.columns if c not in before and c not in (p_col, "_pred")]
    return out.drop(*added).withColumnRenamed("_pred", pred_col)


def label_text(df: DataFrame, pred_col: str = "prediction", p_col: str = "p_bad") -> DataFrame:
    """The app's answer for every row: label 0/1, good/bad text, both probabilities."""
    return df.withColumns({
        "prediction_label": F.when(F.col(pred_col) == 1, "bad").otherwise("good"),
        "probability_good": 1.0 - F.col(p_col),
        "probability_bad": F.col(p_col),
    })
