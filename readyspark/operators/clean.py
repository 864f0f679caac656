"""Cleaning: null and duplicate removal, lenient numbers, ranges, domains.

Every step is a row-wise predicate except the duplicate removal, which is one
aggregate over all columns. Catalyst pushes the later row-wise filters below
that aggregate, so the shuffle carries only rows that survive them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readyspark import presets as P
from readyspark.functions.exprs import all_of, any_of, is_nullish, lenient_double, strip
from readyspark.operators.ordered import BROADCAST_ROWS

# sets larger than this are matched with a join against a table of their values instead of isin
ISIN_LIMIT = 1000


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any column of ``subset``."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Keep one row of each group of exact copies (partial aggregation
    collapses copies map-side, so a hot duplicate never reaches one task whole)."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def to_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lenient conversion to double; unreadable text and NaN become null."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: lenient_double(c, types[c]) for c in columns})


def range_condition(minimums: Mapping[str, float] | None = None,
                    maximums: Mapping[str, float] | None = None):
    conds = [F.col(c) >= F.lit(v) for c, v in (minimums or {}).items()]
    conds += [F.col(c) <= F.lit(v) for c, v in (maximums or {}).items()]
    return all_of(conds)


def range_filter(df: DataFrame, minimums: Mapping[str, float] | None = None,
                 maximums: Mapping[str, float] | None = None) -> DataFrame:
    """P5: one conjunctive filter, inclusive bounds; null fails."""
    return df.where(range_condition(minimums, maximums))


def strip_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast to text and remove surrounding whitespace of any kind."""
    return df.withColumns({c: strip(F.col(c).cast("string")) for c in columns})


def domain_condition(allowed: Mapping[str, Sequence]):
    return all_of(F.coalesce(F.col(c).isin(list(v)), F.lit(False))
                  for c, v in allowed.items() if len(v) <= ISIN_LIMIT)


def _rule_table(spark, values: Sequence, name: str) -> DataFrame:
    """The distinct values of a large set as a column ``name``; broadcast up to a
    known number of values, else left to the join's own choice."""
    rule = spark.createDataFrame([(v,) for v in set(values)], [name])
    return F.broadcast(rule) if len(values) <= BROADCAST_ROWS else rule


def domain_filter(df: DataFrame, allowed: Mapping[str, Sequence]) -> DataFrame:
    """Keep rows whose value lies in the column's allowed set.

    Small sets become one ``isin`` conjunction. A set above ``ISIN_LIMIT``
    values is a table, matched by a left-semi join on a name of its own, so
    columns and their order stay the same at any size.
    """
    out = df.where(domain_condition(allowed))
    for i, (c, values) in enumerate(allowed.items()):
        if len(values) > ISIN_LIMIT:
            rule = _rule_table(df.sparkSession, values, f"_rule_{i}")
            out = out.join(rule, out[c] == rule[f"_rule_{i}"], "left_semi")
    return out


def clean(df: DataFrame,
          numeric_columns: Sequence[str] = P.NUMERIC_COLUMNS,
          minimums: Mapping[str, float] = P.NUMERIC_MIN,
          allowed: Mapping[str, Sequence[str]] = P.ALLOWED_CATEGORIES,
          target: str = P.TARGET,
          target_values: Sequence[str] = P.TARGET_VALUES) -> DataFrame:
    """The whole cleaning step, in the order of the credit workflow.

    Duplicates are removed before trimming and conversion (so ``" own "`` and
    ``"own"`` rows both stay) and the target is not trimmed.
    """
    out = drop_nulls(df)
    out = drop_duplicates(out)
    out = to_numeric(out, numeric_columns)
    out = drop_nulls(out, numeric_columns)
    out = range_filter(out, minimums)
    out = strip_text(out, list(allowed))
    out = domain_filter(out, allowed)
    return out.where(F.coalesce(F.col(target).isin(list(target_values)), F.lit(False)))


CLEAN_REASONS = [
    "input_rows", "null_rows", "duplicate_rows", "non_numeric_rows",
    "out_of_range_rows", "invalid_category_rows", "invalid_target_rows", "kept_rows",
]


def clean_reason_counts(df: DataFrame,
                        numeric_columns: Sequence[str] = P.NUMERIC_COLUMNS,
                        minimums: Mapping[str, float] = P.NUMERIC_MIN,
                        allowed: Mapping[str, Sequence[str]] = P.ALLOWED_CATEGORIES,
                        target: str = P.TARGET,
                        target_values: Sequence[str] = P.TARGET_VALUES) -> DataFrame:
    """Rows removed by each cleaning reason, in step order, from one job.
    Output: (step, reason, rows), one row per reason; see :func:`flagged_rows`."""
    return reason_counts(flagged_rows(df, numeric_columns, minimums, allowed, target, target_values))


def flagged_rows(df: DataFrame,
                 numeric_columns: Sequence[str] = P.NUMERIC_COLUMNS,
                 minimums: Mapping[str, float] = P.NUMERIC_MIN,
                 allowed: Mapping[str, Sequence[str]] = P.ALLOWED_CATEGORIES,
                 target: str = P.TARGET,
                 target_values: Sequence[str] = P.TARGET_VALUES) -> DataFrame:
    """The distinct rows as given, with ``_copies`` and ``_reason``: the first step of
    :func:`clean` that removes the row, null for the rows that it keeps.

    Copies are counted by one aggregate over all columns (the same shuffle the
    duplicate removal needs); every later reason is a flag on the distinct row.
    """
    cols = df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    grouped = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies"))
    has_null = any_of(is_nullish(c, types[c]) for c in cols)
    num = {c: lenient_double(c, types[c]) for c in numeric_columns}
    numeric_bad = any_of(v.isNull() for v in num.values())
    range_bad = ~all_of(F.coalesce(num[c] >= F.lit(v), F.lit(False)) if c in num
                        else F.coalesce(F.col(c) >= F.lit(v), F.lit(False))
                        for c, v in minimums.items())
    # large sets as in domain_filter: an outer join marks the rows that match
    inside = []
    for i, (c, v) in enumerate(allowed.items()):
        text = strip(F.col(c).cast("string"))
        if len(v) > ISIN_LIMIT:
            rule = _rule_table(df.sparkSession, v, f"_rule_{i}")
            grouped = grouped.join(rule, text == rule[f"_rule_{i}"], "left")
            inside.append(F.col(f"_rule_{i}").isNotNull())
        else:
            inside.append(F.coalesce(text.isin(list(v)), F.lit(False)))
    domain_bad = ~all_of(inside)
    target_bad = ~F.coalesce(F.col(target).isin(list(target_values)), F.lit(False))
    reason = (F.when(has_null, "null_rows").when(numeric_bad, "non_numeric_rows").when(range_bad, "out_of_range_rows")
               .when(domain_bad, "invalid_category_rows").when(target_bad, "invalid_target_rows"))
    return grouped.select(*cols, "_copies", reason.alias("_reason"))


def reason_counts(flagged: DataFrame) -> DataFrame:
    """:func:`clean_reason_counts` of :func:`flagged_rows`. Copies of a row with a null
    go with it; other copies are duplicates."""
    reason, null = F.col("_reason"), F.col("_reason").eqNullSafe("null_rows")
    every = [F.sum("_copies"), F.sum(F.when(null, F.col("_copies"))), F.sum(F.when(~null, F.col("_copies") - 1))]
    every += [F.count_if(reason == name) for name in CLEAN_REASONS[3:-1]] + [F.count_if(reason.isNull())]
    sums = flagged.agg(*[c.alias(name) for c, name in zip(every, CLEAN_REASONS)])
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(name).alias("reason"),
                 F.coalesce(F.col(name), F.lit(0)).cast("long").alias("rows"))
        for i, name in enumerate(CLEAN_REASONS)])))


def kept_rows(flagged: DataFrame,
              numeric_columns: Sequence[str] = P.NUMERIC_COLUMNS,
              allowed: Mapping[str, Sequence[str]] = P.ALLOWED_CATEGORIES) -> DataFrame:
    """:func:`clean`'s rows from those of :func:`flagged_rows`: nothing is left to
    remove, so only the conversions are made."""
    out = flagged.where(F.col("_reason").isNull()).drop("_copies", "_reason")
    return strip_text(to_numeric(out, numeric_columns), list(allowed))


def contract_split(df: DataFrame, required: Sequence[str],
                   numeric: Sequence[str] = ()) -> DataFrame:
    """The input contract of the scoring form, applied to whole tables.

    Adds ``reasons`` (array of failed checks: missing value, non-numeric
    value) and ``valid``. Callers route valid and rejected rows with a filter;
    nothing leaves the executors.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    checks = [F.when(is_nullish(c, types[c]), F.lit(f"missing:{c}")) for c in required]
    for c in numeric:
        if c in types:
            checks.append(F.when(F.col(c).isNotNull() & lenient_double(c, types[c]).isNull(),
                                 F.lit(f"non_numeric:{c}")))
    reasons = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return df.withColumn("reasons", reasons).withColumn("valid", F.size("reasons") == 0)


def aligned(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """J1 for tables kept apart (labels, predictions, groups): an inner join on
    ``key`` that must match one to one. Raises when a key is null or repeated on
    either side, or has no partner; the checks are one aggregate a side and one
    over the keys alone."""
    counted = [t.groupBy(key).agg(F.count(F.lit(1)).alias(n)) for t, n in ((left, "_l"), (right, "_r"))]
    both = counted[0].join(counted[1], key, "full")
    bad = both.agg(F.count_if(F.col(key).isNull()).alias("null"), F.count_if((F.col("_l") > 1) | (F.col("_r") > 1)).alias("repeated"),
                   F.count_if(F.col("_l").isNull() | F.col("_r").isNull()).alias("alone")).first().asDict()
    if any(bad.values()):
        raise ValueError(f"rows don't align on {key}: {bad}")
    return left.join(right, key)
