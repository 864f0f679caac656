"""Reproducible exact stratified split and stratified folds.

A row's place is decided by a hash of its own key and the seed, never by a
partition-dependent random stream, so the result is the same on 1 or 1,000
partitions and after any task retry. Per-class test quotas follow the
largest-remainder rule, so class shares in train and test equal the overall
shares as closely as integers allow. Rows carry a hash bucket that is monotone
in their order; bucket totals give each bucket's offset inside its class, so
no class, however large, is ever sorted in one task. The split only ranks the
rows of each class's cutoff bucket; the folds rank every row (see ``ordered``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readyspark.functions.exprs import hash32
from readyspark.operators.ordered import (BROADCAST_ROWS, ROWS_PER_BUCKET, bucket_count, hash_bucket,
                                          null_safe_join, running_sum)
from readyspark.session import cut_lineage


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class, null included: a small table, written once."""
    return cut_lineage(df.groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("_n")))


def quotas(counts: DataFrame, test_size: float) -> DataFrame:
    """``_class`` and ``_q``: integer quotas proportional to the class counts that
    sum to ceil(test_size * n); remainders are handed out largest first, ties by
    class order. The null class gets 0. Exact integer arithmetic; the windows
    run over one row per class."""
    every = Window.partitionBy()
    live = counts.where(F.col("_class").isNotNull())
    n = F.sum("_n").over(every)
    live = live.withColumns({"_all": n, "_take": F.ceil(F.lit(float(test_size)) * n)})
    part, total = "cast(_take as decimal(19,0)) * cast(_n as decimal(19,0))", "cast(_all as decimal(19,0))"
    live = live.withColumns({"_whole": F.expr(f"cast(({part}) div {total} as bigint)"), "_rem": F.expr(f"({part}) % {total}")})
    left = F.col("_take") - F.sum("_whole").over(every)
    rank = F.row_number().over(Window.orderBy(F.desc("_rem"), "_class"))
    live = live.withColumns({"_left": left, "_rank": rank})
    shares = live.select("_class", (F.col("_whole") + (F.col("_rank") <= F.col("_left")).cast("long")).alias("_q"))
    return shares.unionByName(counts.where(F.col("_class").isNull()).select("_class", F.lit(0).cast("long").alias("_q")))


def class_rank(df: DataFrame, label: str, key: str, salt: str, seed: int, max_class: int,
               rows_per_bucket: int = ROWS_PER_BUCKET, n_classes: int | None = None) -> DataFrame:
    """0-based rank of each row inside its class, by (hash(key, salt, seed), key)."""
    h = hash32(key, F.lit(salt), seed) if salt else hash32(key, seed)
    ranked = df.withColumn("_h", h)
    n_buckets = bucket_count(max_class, rows_per_bucket)
    ranked = ranked.withColumn("_hb", hash_bucket(F.col("_h"), n_buckets))
    bound = (n_classes + 1) * n_buckets if n_classes is not None else None
    ranked = running_sum(ranked, [label], "_hb", ["_h", key], single_bucket=n_buckets == 1,
                         offsets_rows=bound)
    return ranked.withColumn("_rank", F.col("_before")).drop("_before", "_through", "_hb")


def stratified_split(df: DataFrame, label: str, key: str, test_size: float = 0.2, seed: int = 42,
                     rows_per_bucket: int = ROWS_PER_BUCKET, out: str = "split",
                     checkpoint: bool = True) -> DataFrame:
    """Add ``split`` = 'test' for exactly ceil(test_size * n) rows, chosen
    per class by quota, else 'train'. Row count is kept.

    A row is test when its rank inside its class, in (hash(key, seed), key)
    order, is below the class quota. Rows carry a hash bucket that is monotone
    in that order, and bucket totals give each bucket's offset in its class
    (a small table: at most (classes + 1) x buckets rows, broadcast when that
    bound is small, else joined by shuffle). A
    bucket that ends at or below the quota is test, one that starts at or
    above it is train: decided in a map-only projection. Only the rows of the
    one bucket per class that straddles the quota are ranked by a window, so
    the split shuffles at most one bucket per class, never the table.

    The input feeds the class counts, the bucket totals and the two branches,
    so by default it is written once to the shared checkpoint folder first.
    """
    if checkpoint:
        df = cut_lineage(df)
    counts = class_counts(df, label)
    take = cut_lineage(quotas(counts, test_size))
    size = counts.agg(F.count(F.lit(1)).alias("classes"), F.max("_n").alias("largest")).first()
    n_buckets = bucket_count(size["largest"] or 0, rows_per_bucket)
    few = size["classes"] * n_buckets <= BROADCAST_ROWS  # rows of the tables joined below: known without a job
    data = df.withColumn("_h", hash32(key, seed)).withColumn("_hb", hash_bucket(F.col("_h"), n_buckets))
    if n_buckets == 1:
        # every class fits one window task (at most rows_per_bucket rows), and its
        # only bucket straddles the quota: rank each class directly
        placed = _with_class(data, take, label, few)
        rank = F.row_number().over(Window.partitionBy(label).orderBy("_h", key)) - 1
        return placed.withColumn(out, F.when(rank < F.col("_q"), "test").otherwise("train")).drop("_h", "_hb", "_q")
    totals = data.groupBy(F.col(label).alias("_class"), "_hb").agg(F.count(F.lit(1)).alias("_bt"))
    prior = Window.partitionBy("_class").orderBy("_hb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_off", F.coalesce(F.sum("_bt").over(prior), F.lit(0)))
    offsets = null_safe_join(offsets, take, ["_class"], broadcast=few)
    placed = _with_class(data, offsets, label, few, ["_hb"])
    straddles = (F.col("_off") < F.col("_q")) & (F.col("_off") + F.col("_bt") > F.col("_q"))
    decided = (placed.where(~straddles)
                     .withColumn(out, F.when(F.col("_off") + F.col("_bt") <= F.col("_q"), "test").otherwise("train")))
    within = Window.partitionBy(label, "_hb").orderBy("_h", key)
    rank = F.col("_off") + F.row_number().over(within) - 1
    ranked = (placed.where(straddles)
                    .withColumn(out, F.when(rank < F.col("_q"), "test").otherwise("train")))
    helpers = ["_h", "_hb", "_bt", "_off", "_q"]
    return decided.drop(*helpers).unionByName(ranked.drop(*helpers))


def _with_class(data: DataFrame, small: DataFrame, label: str, few: bool, keys: Sequence[str] = ()) -> DataFrame:
    """``data`` with the columns of a per-class table, null class included."""
    return null_safe_join(data, small.withColumnRenamed("_class", label), [label, *keys], broadcast=few)


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42,
                     rows_per_bucket: int = ROWS_PER_BUCKET, out: str = "fold") -> DataFrame:
    """Fold number 0..k-1, dealt round-robin along each class's hash order,
    so every fold holds floor or ceil of n_c / k rows of each class."""
    size = class_counts(df, label).agg(F.count(F.lit(1)).alias("classes"), F.max("_n").alias("largest")).first()
    ranked = class_rank(df, label, key, "fold", seed, size["largest"] or 0, rows_per_bucket,
                        n_classes=size["classes"])
    return ranked.withColumn(out, F.pmod(F.col("_rank"), F.lit(k)).cast("int")).drop("_rank", "_h")
