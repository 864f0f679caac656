"""Parquet sources and the schema/shape summary."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one table (S1). Column pruning and filter pushdown are
    left to Catalyst: callers select and filter, the scan reads only that."""
    return spark.read.parquet(table_path(sf_dir, name))


def shape_summary(df: DataFrame, target: str | None = None) -> DataFrame:
    """Columns, types and row count (S4), plus the count per target value.

    One row per column with its type and the table's row count; when a target
    is given, one further row per target value carries that value's count.
    Everything comes from one aggregate job over the table.
    """
    fields = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    group = [F.col(target).cast("string").alias("_value")] if target else [F.lit(None).cast("string").alias("_value")]
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("rows"))
    schema_rows = total.select(F.inline(F.array(*[
        F.struct(F.lit("column").alias("kind"), F.lit(name).alias("name"), F.lit(dtype).alias("type"),
                 F.coalesce(F.col("rows"), F.lit(0)).cast("long").alias("rows"))
        for name, dtype in fields])))
    if not target:
        return schema_rows
    value_rows = counts.where(F.col("_value").isNotNull()).select(
        F.lit("target_value").alias("kind"), F.col("_value").alias("name"),
        F.lit(None).cast("string").alias("type"), F.col("_n").cast("long").alias("rows"))
    return schema_rows.unionByName(value_rows)
