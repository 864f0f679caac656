"""Profiling aggregates: counts, cross tables, group statistics, histograms,
box statistics (A1-A8).

Every output is a long table (one row per group and measure), built from
partial aggregates; no group is ever collected into one task or the driver.
Group-level scalars (totals, min/max) come back as small tables joined by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readyspark.operators.features import ordered_category
from readyspark.operators.ordered import (BROADCAST_ROWS, counted_quantiles, exact_quantiles,
                                          null_safe_join, value_table)
from readyspark.session import cut_lineage

QUARTILES = (0.25, 0.5, 0.75)

# values of a cross table's columns that are joined at once
COLUMN_LIST = 10_000


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """A1: count per non-null value, most frequent first."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), F.asc(column)))


def crosstab_share(df: DataFrame, row: str, col: str, percent: bool = False) -> DataFrame:
    """A2: row-normalised cross table in long form (row, col, n, share), a row
    for every pair of an occurring row and an occurring column, 0 where they
    never meet.

    Counts per cell are a partial aggregate, written once: everything after works
    on that table. The grid is completed by a join of the row totals with the
    columns, which come in lists of about ``COLUMN_LIST`` values each; with one
    list it is broadcast. No task holds more than one row's cells.
    """
    cells = cut_lineage(df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
                          .groupBy(row, col).agg(F.count(F.lit(1)).alias("n")))
    columns = cut_lineage(cells.select(F.col(col).alias("_col")).distinct())
    lists = max(1, -(-columns.count() // COLUMN_LIST))
    listed = columns.groupBy(F.pmod(F.xxhash64("_col"), F.lit(lists)).cast("int").alias("_list")).agg(F.collect_list("_col").alias("_every"))
    listed = F.broadcast(listed) if lists == 1 else listed
    per_row = cells.groupBy(row).agg(F.map_from_entries(F.collect_list(F.struct(col, "n"))).alias("_cells"), F.sum("n").alias("_total"))
    dealt = per_row.withColumn("_list", F.explode(F.sequence(F.lit(0), F.lit(lists - 1))))
    full = dealt.join(listed, "_list").select(row, "_cells", "_total", F.explode("_every").alias(col))
    n = F.coalesce(F.try_element_at("_cells", F.col(col)), F.lit(0)).cast("long")
    return full.select(row, col, n.alias("n"), (n / F.col("_total") * (100.0 if percent else 1.0)).alias("share"))


def crosstab_wide(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """A2 in the wide form: one column per declared value of ``col``, missing cells 0."""
    wide = (df.where(F.col(row).isNotNull()).groupBy(row)
              .pivot(col, list(values)).agg(F.count(F.lit(1))).na.fill(0))
    total = sum((F.col(f"`{v}`") for v in values), F.lit(0))
    return wide.select(row, *[F.coalesce(F.try_divide(F.col(f"`{v}`").cast("double"), total.cast("double")),
                                         F.lit(0.0)).alias(str(v)) for v in values])


def _ordered_cells(cells: DataFrame, declared: Sequence[tuple], col: str) -> DataFrame:
    """Counts (feature, position, col, n) as a full table: every declared
    category meets every occurring value of ``col``; an empty category has
    counts and shares of 0."""
    entries = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(c).alias("category"),
                                 F.lit(i).cast("bigint").alias("position")) for f, c, i in declared])
    key = lambda f, p: F.concat_ws(":", p.cast("string"), f)
    per_col = cells.groupBy(col).agg(F.map_from_entries(F.collect_list(F.struct(
        key(F.col("feature"), F.col("position")).alias("k"), "n"))).alias("_cells"))
    full = per_col.select(col, "_cells", F.explode(entries).alias("_e")).select("_e.*", col, "_cells")
    n = F.coalesce(F.try_element_at("_cells", key(F.col("feature"), F.col("position"))), F.lit(0)).cast("long")
    full = full.select("feature", "category", "position", col, n.alias("n"))
    total = F.sum("n").over(Window.partitionBy("feature", "position"))
    return full.withColumn("share", F.coalesce(F.try_divide(F.col("n").cast("double"), total.cast("double")), F.lit(0.0)))


def ordered_crosstabs(df: DataFrame, orders: Sequence[tuple[str, Sequence]], col: str) -> DataFrame:
    """A3 for several declared-order features in one pass.

    Every row is exploded into one (feature, position) entry per feature, values
    outside a feature's order are dropped, and a single partial aggregate counts
    all cells; missing cells and shares are filled in on the small cell table.
    Output: feature, category (text), position (1-based), col, n, share.
    """
    entries = [F.struct(F.lit(feature).alias("feature"), ordered_category(feature, order)[1].alias("position"))
               for feature, order in orders]
    exploded = df.select(F.col(col), F.explode(F.array(*entries)).alias("_e")).select("_e.*", col)
    cells = (exploded.where(F.col("position").isNotNull() & F.col(col).isNotNull())
                     .groupBy("feature", "position", col).agg(F.count(F.lit(1)).alias("n")))
    declared = [(f, v if isinstance(v, str) else str(int(v)), i) for f, order in orders for i, v in enumerate(order, 1)]
    return _ordered_cells(cells, declared, col)


def ordered_crosstab(df: DataFrame, row: str, order: Sequence, col: str) -> DataFrame:
    """A3: cross table of one declared-order category; values outside the order
    are dropped, ``position`` (1-based) gives the row order."""
    _, position = ordered_category(row, order)
    coerced = df.select(F.lit(row).alias("feature"), position.alias("position"), F.col(col))
    cells = (coerced.where(F.col("position").isNotNull() & F.col(col).isNotNull())
                    .groupBy("feature", "position", col).agg(F.count(F.lit(1)).alias("n")))
    full = _ordered_cells(cells, [(row, v, i) for i, v in enumerate(order, 1)], col)
    return full.select(F.col("category").alias(row), "position", col, "n", "share").orderBy("position", col)


def _numbers(df: DataFrame, group: str, column: str) -> DataFrame:
    v = F.col(column).cast("double")
    return df.select(F.col(group), v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))


def group_describe(df: DataFrame, group: str, column: str) -> DataFrame:
    """A4: count, mean, median, sample std, min, max per group (nulls ignored).

    All but the median are one map-side-combined aggregate (the deviation by
    mergeable central moments), which shuffles a row per group and task; only
    the median needs the counted value table.
    """
    moments = _numbers(df, group, column).groupBy(group).agg(
        F.count("_v").alias("count"), F.avg("_v").alias("mean"), F.stddev_samp("_v").alias("std"),
        F.min("_v").alias("min"), F.max("_v").alias("max"))
    med = exact_quantiles(df, [group], column, [0.5]).select(group, F.col("value").alias("median"))
    out = null_safe_join(moments, med, [group], how="left")
    return out.select(group, "count", "mean", "std", "min", "max", "median")


def group_quartiles(df: DataFrame, group: str, column: str, exact: bool = True,
                    accuracy: int = 10_000) -> DataFrame:
    """A5: Q1, median and Q3 per group, linear interpolation.

    ``exact=False`` uses the mergeable ``percentile_approx`` sketch (one pass,
    bounded memory) for a quick look at very large groups.
    """
    if not exact:
        v = F.col(column).cast("double")
        arr = F.percentile_approx(v, list(QUARTILES), accuracy)
        return (df.where(v.isNotNull()).groupBy(group).agg(arr.alias("_q"))
                  .select(group, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                          F.col("_q")[2].alias("q3")))
    long = exact_quantiles(df, [group], column, QUARTILES)
    return long.groupBy(group).agg(
        F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.5, F.col("value"))).alias("median"),
        F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("q3"))


def histogram(df: DataFrame, group: str, column: str, bins: int) -> DataFrame:
    """Equal-width histogram per group over the group's own [min, max], all
    ``bins`` bins, empty ones with 0; the last bin is closed. A constant group
    gets the range [v - 0.5, v + 0.5].

    Two map-side-combined passes over the two columns, written once: minimum and maximum (a row per group, written,
    and broadcast after a count), then the bin counts; a task shuffles at most
    groups x bins rows, however many values there are.
    """
    # two narrow columns, written: what is behind them (cleaning) runs once for both passes
    vals = cut_lineage(_numbers(df, group, column))
    rng = vals.groupBy(group).agg(F.min("_v").alias("_mn"), F.max("_v").alias("_mx"))
    same = F.col("_mn") == F.col("_mx")
    rng = cut_lineage(rng.select(group, F.when(same, F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_lo"),
                                 F.when(same, F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_hi")))
    joined = null_safe_join(vals, rng, [group], broadcast=rng.count() <= BROADCAST_ROWS)
    idx = F.floor((F.col("_v") - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo")))
    counts = (joined.withColumn("bin", F.least(idx, F.lit(bins - 1)).cast("int"))
                    .groupBy(group, "bin").agg(F.count(F.lit(1)).alias("n")))
    every = rng.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("_hi") - F.col("_lo")) / bins
    return null_safe_join(every, counts, [group, "bin"], how="left").select(
        group, "bin", (F.col("_lo") + F.col("bin") * width).alias("lower"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("upper"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def box_stats(df: DataFrame, column: str, group: str | None = None, whis: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the last value inside 1.5 IQR, outlier count.

    Quartiles, whiskers and counts all come from the (group, value, count)
    table, so the input is read once. Fences (one row per group) are joined to
    that table, broadcast after a size check, and one partial aggregate finds
    the whiskers.
    """
    groups = [group] if group else ["_all"]
    base = df.select(F.col(group) if group else F.lit("all").alias("_all"), F.col(column).alias("_x"))
    vals = value_table(base, groups, "_x")
    q = counted_quantiles(vals, groups, QUARTILES)
    quart = q.groupBy(*groups).agg(
        F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.5, F.col("value"))).alias("median"),
        F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    quart = quart.withColumns({"_lf": F.col("q1") - iqr * whis, "_uf": F.col("q3") + iqr * whis})
    joined = null_safe_join(vals, quart, groups, broadcast=not group or quart.count() <= BROADCAST_ROWS)
    inside = (F.col("_v") >= F.col("_lf")) & (F.col("_v") <= F.col("_uf"))
    out = joined.groupBy(*groups, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("_cnt"))), F.lit(0)).alias("outliers"),
        F.sum("_cnt").alias("n"))
    return out if group else out.drop("_all")


def sorted_classes(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values, sorted."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)
