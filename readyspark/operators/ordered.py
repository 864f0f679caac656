"""Exact running sums within groups without putting a whole group in one task.

A plain ``Window.partitionBy(group).orderBy(x)`` sorts a whole group in one
task; with one group holding a third of all rows that task holds a third of
the data. Here rows carry a bucket that never decreases along the order
(``h >> k`` for a uniform hash, or value ranges from an approximate-quantile
sketch). Bucket totals form a small table (groups x buckets rows) whose prefix
sums give each bucket's offset; inside a bucket an ordinary window finishes
the count. Every window task then holds one bucket of one group.

Used by the exact split and folds (T1, T2), exact quartiles (A5, A7) and the
tie-aware ROC-AUC (M7).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readyspark.session import cut_lineage

# rows of an offsets/targets table up to which it is broadcast; such a row is a
# few keys and one long (tens of bytes), so the bound is tens of megabytes
BROADCAST_ROWS = 1_000_000
# target rows per bucket: one bucket of one group is what a window task sorts
ROWS_PER_BUCKET = 200_000
# hash buckets are top bits of a 32-bit hash: up to 2^20 of them
MAX_HASH_BUCKETS = 1 << 20
# value buckets come from one sketch holding their edges: keep that array modest
MAX_VALUE_BUCKETS = 16_384


def bucket_count(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET, cap: int = MAX_HASH_BUCKETS) -> int:
    return int(max(1, min(cap, math.ceil(rows / max(1, rows_per_bucket)))))


def hash_bucket(h: Column, n_buckets: int) -> Column:
    """Monotone bucket of a uniform 32-bit hash: its top bits."""
    bits = max(0, math.ceil(math.log2(max(1, n_buckets))))
    return F.shiftright(h, 32 - bits) if bits else F.lit(0)


def value_buckets(df: DataFrame, value_col: str, n_buckets: int, out: str = "_bucket",
                  accuracy: int = 10_000) -> DataFrame:
    """Add a bucket that is monotone in ``value_col``; edges come from one
    mergeable approximate-quantile sketch (bounded memory, one small result)."""
    if n_buckets > MAX_VALUE_BUCKETS:
        return _two_level_buckets(df, value_col, n_buckets, out, accuracy)
    if n_buckets <= 1:
        return df.withColumn(out, F.lit(0.0))
    probs = [i / n_buckets for i in range(1, n_buckets)]
    accuracy = max(accuracy, 4 * n_buckets)  # rank error well below one bucket
    edges = df.agg(F.percentile_approx(F.col(value_col).cast("double"), probs, accuracy).alias("e")).first()["e"]
    edges = sorted({float(e) for e in (edges or []) if e is not None and not math.isnan(e)})
    if not edges:
        return df.withColumn(out, F.lit(0.0))
    splits = [-math.inf] + edges + [math.inf]
    tmp = "_bucket_value"
    b = Bucketizer(splits=splits, inputCol=tmp, outputCol=out, handleInvalid="keep")
    return b.transform(df.withColumn(tmp, F.col(value_col).cast("double"))).drop(tmp)


def _two_level_buckets(df: DataFrame, value_col: str, n_buckets: int, out: str, accuracy: int) -> DataFrame:
    """Value buckets beyond what one sketch may hold: each of ``MAX_VALUE_BUCKETS``
    ranges has a sketch of its own, so a bucket keeps its size at any data size.
    The edges table has one row per range, at most ``MAX_VALUE_BUCKETS``."""
    inner = math.ceil(n_buckets / MAX_VALUE_BUCKETS)
    outer = value_buckets(df, value_col, MAX_VALUE_BUCKETS, "_range", accuracy)
    v = F.col(value_col).cast("double")
    probs = [i / inner for i in range(1, inner)]
    edges = cut_lineage(outer.groupBy(F.col("_range").alias("_edge_range")).agg(
        F.array_distinct(F.percentile_approx(v, probs, max(accuracy, 4 * inner))).alias("_edges")))
    joined = outer.join(F.broadcast(edges), F.col("_range") == F.col("_edge_range"), "left")
    place = F.coalesce(F.size(F.filter("_edges", lambda e: e <= v)), F.lit(0))
    return joined.withColumn(out, F.col("_range") * F.lit(float(inner)) + place).drop("_range", "_edge_range", "_edges")


def running_sum(df: DataFrame, group_cols: Sequence[str], bucket_col: str, order_cols: Sequence,
                weight: Column | None = None, out_before: str = "_before",
                out_through: str = "_through", single_bucket: bool = False,
                offsets_rows: int | None = None) -> DataFrame:
    """Exact running sum of ``weight`` (default 1) within ``group_cols`` in
    ``order_cols`` order; ``bucket_col`` must be non-decreasing along that order.

    Adds ``_before`` (sum over earlier rows) and ``_through`` (including this row).
    ``single_bucket``: the caller sized the data to one bucket per group (at most
    ``ROWS_PER_BUCKET`` rows), so every offset is 0 and the offsets job is skipped.
    ``offsets_rows``: a bound on groups x buckets the caller knows; without it
    the offsets table is counted before it may be broadcast.
    """
    group_cols = list(group_cols)
    w = weight if weight is not None else F.lit(1)
    data = df.withColumn("_w", w.cast("long"))
    if single_bucket:
        within = (Window.partitionBy(*group_cols).orderBy(*order_cols)
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return (data.withColumn(out_through, F.sum("_w").over(within))
                    .withColumn(out_before, F.col(out_through) - F.col("_w")).drop("_w"))
    totals = data.groupBy(*group_cols, bucket_col).agg(F.sum("_w").alias("_bt"))
    prior = Window.partitionBy(*group_cols).orderBy(bucket_col).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group_cols, bucket_col,
                            F.coalesce(F.sum("_bt").over(prior), F.lit(0)).alias("_off"))
    rows = offsets_rows if offsets_rows is not None else offsets.count()  # groups x buckets rows
    small = rows <= BROADCAST_ROWS
    keys = group_cols + [bucket_col]
    joined = null_safe_join(data, offsets, keys, broadcast=small)
    within = (Window.partitionBy(*keys).orderBy(*order_cols)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    through = F.col("_off") + F.sum("_w").over(within)
    return (joined.withColumn(out_through, through)
                  .withColumn(out_before, F.col(out_through) - F.col("_w"))
                  .drop("_off", "_w"))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                   broadcast: bool = False) -> DataFrame:
    """Equi-join on ``keys`` where null matches null; keeps one copy of the keys.
    ``broadcast`` is for a right side whose size the caller has checked."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    r = F.broadcast(r) if broadcast else r
    cond = [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]
    return left.join(r, on=cond, how=how).drop(*[f"_r_{k}" for k in keys])


def value_table(df: DataFrame, group_cols: Sequence[str], value_col: str) -> DataFrame:
    """Rows counted per (group, value): group columns, ``_v`` (double) and
    ``_cnt``. Null and NaN values are left out.

    The count is a partial aggregate, so repeated values leave each task as one
    row. The table feeds several small jobs (size, sketch, offsets, ranks, and
    the per-group statistics of the profiling operators), so it is written once
    to the shared checkpoint folder: the input is read and shuffled only once.
    """
    v = F.col(value_col).cast("double")
    vals = (df.where(v.isNotNull() & ~F.isnan(v))
              .groupBy(*group_cols, v.alias("_v")).agg(F.count(F.lit(1)).alias("_cnt")))
    return cut_lineage(vals)


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str, probs: Sequence[float],
                    rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Exact quantiles with linear interpolation (x_lo + (x_hi - x_lo) * frac at
    position (n - 1) * p), per group, for data of any size and skew.
    Output: group columns, ``p`` and ``value``.
    """
    return counted_quantiles(value_table(df, group_cols, value_col), group_cols, probs, rows_per_bucket)


def counted_quantiles(vals: DataFrame, group_cols: Sequence[str], probs: Sequence[float],
                      rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """:func:`exact_quantiles` over a :func:`value_table`.

    Ranks come from :func:`running_sum`; the few wanted ranks per group form a
    small table that is broadcast (after a size check) and matched by rank
    range, so the big side is never shuffled by group.
    """
    group_cols = list(group_cols)
    n_vals = vals.count()
    n_buckets = bucket_count(n_vals, rows_per_bucket)
    vals = value_buckets(vals, "_v", n_buckets)
    ranked = running_sum(vals, group_cols, "_bucket", ["_v"], weight=F.col("_cnt"), single_bucket=n_buckets == 1)
    sizes = vals.groupBy(*group_cols).agg(F.sum("_cnt").alias("_n"))
    pos = (F.col("_n") - 1) * F.col("p")
    targets = (sizes.select(*group_cols, "_n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"))
                    .withColumns({"_lo": F.floor(pos).cast("long"), "_hi": F.ceil(pos).cast("long"),
                                  "_frac": pos - F.floor(pos)})
                    .select(*group_cols, "p", "_frac",
                            F.explode(F.array(F.struct(F.lit("lo").alias("k"), F.col("_lo").alias("r")),
                                              F.struct(F.lit("hi").alias("k"), F.col("_hi").alias("r")))).alias("t"))
                    .select(*group_cols, "p", "_frac", F.col("t.k").alias("_k"), F.col("t.r").alias("_r")))
    t = targets.select(*[F.col(c).alias(f"_t_{c}") for c in group_cols], "p", "_frac", "_k", "_r")
    # groups x probabilities x 2 rows; there are no more groups than value rows,
    # so the count job is needed only when that bound is too large
    bound = n_vals * len(probs) * 2
    if bound <= BROADCAST_ROWS or t.count() <= BROADCAST_ROWS:
        t = F.broadcast(t)
    cond = [ranked[c].eqNullSafe(t[f"_t_{c}"]) for c in group_cols]
    cond += [t["_r"] >= ranked["_before"], t["_r"] < ranked["_through"]]
    hits = ranked.join(t, on=cond, how="inner")
    picked = hits.groupBy(*group_cols, "p").agg(
        F.max(F.when(F.col("_k") == "lo", F.col("_v"))).alias("_xlo"),
        F.max(F.when(F.col("_k") == "hi", F.col("_v"))).alias("_xhi"),
        F.max("_frac").alias("_frac"))
    return picked.select(*group_cols, "p",
                         (F.col("_xlo") + (F.col("_xhi") - F.col("_xlo")) * F.col("_frac")).alias("value"))
