"""Derived features, classifiers, drops and target encoding.

All are projections (one ``withColumns`` each, collapsed by Catalyst into the
scan's stage); only the strict target encoding runs a check job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readyspark import presets as P
from readyspark.functions.exprs import right_closed_bins, safe_divide, strip


def monthly_payment(df: DataFrame, amount: str = "credit_amount", duration: str = "duration",
                    out: str = "monthly_payment") -> DataFrame:
    """Amount / duration; a zero duration gives null instead of an error."""
    return df.withColumn(out, safe_divide(amount, duration))


def age_group(df: DataFrame, column: str = "age", edges=P.AGE_EDGES, labels=P.AGE_LABELS,
              out: str = "age_group") -> DataFrame:
    """Right-closed bins with labels; values outside every bin are null."""
    return df.withColumn(out, right_closed_bins(column, edges, labels))


def additional_security(df: DataFrame, column: str = "other_parties",
                        none_value: str = P.SECURITY_NONE,
                        out: str = "has_additional_security") -> DataFrame:
    """1 unless the value is exactly ``none``; a missing party counts as 1."""
    return df.withColumn(out, (~F.col(column).eqNullSafe(F.lit(none_value))).cast("int"))


def high_risk_status(df: DataFrame, checking: str = "checking_status",
                     savings: str = "savings_status",
                     checking_value: str = P.HIGH_RISK_CHECKING,
                     savings_values: Sequence[str] = P.HIGH_RISK_SAVINGS,
                     out: str = "high_risk_financial_status") -> DataFrame:
    """Equals-and-in-set flag; null never counts as a match."""
    cond = (F.col(checking) == checking_value) & F.col(savings).isin(list(savings_values))
    return df.withColumn(out, F.coalesce(cond, F.lit(False)).cast("int"))


def sex_from_status(column: str = "personal_status"):
    """``female`` if the text holds it, else ``male`` if it holds that, else null."""
    text = F.lower(F.coalesce(F.col(column).cast("string"), F.lit("none")))
    return F.when(text.contains("female"), "female").when(text.contains("male"), "male")


def gender_from_status(column: str = "personal_status",
                       male_codes: Sequence[str] = P.MALE_CODES,
                       female_codes: Sequence[str] = P.FEMALE_CODES):
    """Survey codes first, then the words, else ``unknown``."""
    text = F.lower(strip(F.coalesce(F.col(column).cast("string"), F.lit("none"))))
    return (F.when(text.isin(list(male_codes)), "male")
             .when(text.isin(list(female_codes)), "female")
             .when(text.contains("female"), "female")
             .when(text.contains("male"), "male")
             .otherwise("unknown"))


def drop_columns(df: DataFrame, columns: Sequence[str], strict: bool = True) -> DataFrame:
    """Drop columns; with ``strict`` an absent column is an error
    (Spark's own ``drop`` ignores unknown names)."""
    missing = [c for c in columns if c not in df.columns]
    if strict and missing:
        raise ValueError(f"columns to drop are absent: {missing}")
    return df.drop(*[c for c in columns if c in df.columns])


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Every column except the excluded ones (target, sensitive, key)."""
    return [c for c in df.columns if c not in set(exclude)]


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """P20: columns of any numeric type in schema order, minus exclusions."""
    kinds = T.NumericType
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, kinds) and f.name not in set(exclude)]


def ordered_category(column: str, order: Sequence) -> tuple:
    """(value kept only when in the declared order, 1-based position)."""
    arr = F.array(*[F.lit(v) for v in order])
    c = F.col(column)
    kept = F.when(F.coalesce(c.isin(list(order)), F.lit(False)), c)
    return kept, F.array_position(arr, kept)


def calculate_features(df: DataFrame) -> DataFrame:
    """P11-P14 in one projection."""
    out = monthly_payment(df)
    out = age_group(out)
    out = additional_security(out)
    return high_risk_status(out)


def feature_engineering(df: DataFrame, sensitive_source: str = "personal_status",
                        sensitive: str = P.SENSITIVE,
                        drop: Sequence[str] = P.DELETED_ATTRIBUTES) -> DataFrame:
    """Features, the sensitive group column, then the sensitive attributes dropped."""
    out = calculate_features(df)
    out = out.withColumn(sensitive, sex_from_status(sensitive_source))
    return drop_columns(out, drop, strict=True)


def encode_target(df: DataFrame, target: str = P.TARGET,
                  mapping: Mapping[str, int] = P.TARGET_MAPPING) -> DataFrame:
    """Strict value mapping; any unmapped or null value is an error.

    One aggregate job checks the mapping before the cast; the error lists the
    original offending values (at most 20 of them).
    """
    items = []
    for k, v in mapping.items():
        items.extend([F.lit(k), F.lit(v)])
    mapped = F.try_element_at(F.create_map(*items), F.col(target).cast("string"))
    bad = df.where(mapped.isNull())
    n_bad = bad.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if n_bad:
        sample = [r[0] for r in bad.select(F.col(target).cast("string")).distinct().limit(20).collect()]
        raise ValueError(f"target encoding failed: {n_bad} rows with unmapped values {sample}")
    return df.withColumn(target, mapped.cast("int"))
