"""Test-data variants and multi-variant scoring.

Variants are projections of the test table. Noise is keyed: the uniform
number of a cell is derived from (row key, column, seed), so a variant is the
same on any partitioning and on retry. ``score_variants`` scores the base
rows once, then every variant of every row in one further pass: rows are
exploded into (variant, mask, changed columns), carry the base score along,
and one ``groupBy(variant)`` gives all counts. No join, no shuffle by key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readyspark import presets as P
from readyspark.functions.exprs import keyed_uniform, lookup, safe_divide
from readyspark.operators.score import score


@dataclass
class Variant:
    name: str
    changes: Mapping[str, Column]
    mask: Column = field(default_factory=lambda: F.lit(True))
    direction: str | None = None  # metamorphic: "increase" / "decrease" of p_bad expected


def _payment(amount: Column, duration: Column) -> Column:
    return safe_divide(amount, duration)


def perturbation(key: str, seed: int = P.SEED, low: float = P.PERTURB_LOW, high: float = P.PERTURB_HIGH,
                 columns: Sequence[str] = P.PERTURB_COLUMNS) -> dict:
    """V1: duration and amount times keyed uniform [low, high); duration rounded
    half-to-even; all clipped at 0; payment recomputed."""
    factor = {c: F.lit(low) + F.lit(high - low) * keyed_uniform(key, c, seed) for c in columns}
    duration = F.greatest(F.bround(F.col("duration") * factor["duration"], 0), F.lit(0.0))
    amount = F.greatest(F.col("credit_amount") * factor["credit_amount"], F.lit(0.0))
    return {"duration": duration, "credit_amount": amount,
            "monthly_payment": F.greatest(_payment(amount, duration), F.lit(0.0))}


def inflation(factor: float = P.INFLATION_FACTOR) -> dict:
    """V2: amount times the factor, payment recomputed."""
    amount = F.col("credit_amount") * F.lit(factor)
    return {"credit_amount": amount, "monthly_payment": _payment(amount, F.col("duration"))}


def duration_increase(months: int = P.DURATION_INCREASE_MONTHS) -> dict:
    """V3: duration plus n months for every row, payment recomputed."""
    duration = F.col("duration") + F.lit(months)
    return {"duration": duration, "monthly_payment": _payment(F.col("credit_amount"), duration)}


def category_move(column: str, mapping: Mapping[str, str], movable: Sequence[str]) -> tuple[dict, Column]:
    """V4/V5: move a category one step; unknown values stay. Mask: movable rows."""
    return {column: lookup(column, mapping)}, F.coalesce(F.col(column).isin(list(movable)), F.lit(False))


def apply_variant(df: DataFrame, changes: Mapping[str, Column]) -> DataFrame:
    missing = [c for c in changes if c not in df.columns and c != "monthly_payment"]
    if missing:
        raise ValueError(f"variant needs absent columns: {missing}")
    return df.withColumns(dict(changes))


def robustness_variants(key: str) -> list[Variant]:
    return [Variant("perturbation", perturbation(key)), Variant("inflation", inflation())]


def metamorphic_variants() -> list[Variant]:
    checking, checking_mask = category_move("checking_status", P.CHECKING_IMPROVEMENT, P.CHECKING_MOVABLE)
    savings, savings_mask = category_move("savings_status", P.SAVINGS_DETERIORATION, P.SAVINGS_MOVABLE)
    return [
        Variant("duration_increase", duration_increase(), F.lit(True), "increase"),
        Variant("checking_status_improvement", checking, checking_mask, "decrease"),
        Variant("savings_status_deterioration", savings, savings_mask, "increase"),
    ]


def score_variants(df: DataFrame, scorer, variants: Sequence[Variant], keep: Sequence[str] = ()) -> DataFrame:
    """Score base rows once and all variants in one more pass.

    Output: one row per (input row, variant) with ``variant``, ``mask``,
    ``p_base``, ``pred_base``, ``p_bad``, ``prediction`` and the ``keep`` columns.
    """
    base = score(df, scorer).withColumnsRenamed({"p_bad": "p_base", "prediction": "pred_base"})
    features = [c for c in df.columns]
    changed = sorted({c for v in variants for c in v.changes})
    for c in changed:
        if c not in features and c != "monthly_payment":
            raise ValueError(f"variant changes absent column {c}")
    structs = []
    for v in variants:
        fields = [F.lit(v.name).alias("variant"), F.coalesce(v.mask, F.lit(False)).alias("mask")]
        fields += [(v.changes[c] if c in v.changes else F.col(c)).alias(c) for c in changed]
        structs.append(F.struct(*fields))
    unchanged = [c for c in df.columns if c not in changed]
    exploded = base.select(*unchanged, "p_base", "pred_base", F.explode(F.array(*structs)).alias("_v"))
    flat = exploded.select(*unchanged, "p_base", "pred_base", F.col("_v.variant").alias("variant"),
                           F.col("_v.mask").alias("mask"), *[F.col(f"_v.{c}").alias(c) for c in changed])
    scored = score(flat.select(*df.columns, "p_base", "pred_base", "variant", "mask"), scorer)
    return scored.select(*keep, "variant", "mask", "p_base", "pred_base", "p_bad", "prediction")
