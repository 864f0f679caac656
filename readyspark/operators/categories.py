"""One-hot encoding for any number of categories (L2).

The encoder stages of ``learn`` keep a column's labels as an array on the driver
and in the schema. Here a column's categories are a table, joined by value, so a
column may have millions of them; the slots are the same as the stages give.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readyspark.operators.ordered import BROADCAST_ROWS, running_sum
from readyspark.session import cut_lineage, run_tables

# text of the categories up to which their table is broadcast
BROADCAST_BYTES = 32 << 20


@dataclass(frozen=True)
class Categories:
    """A column's sorted categories: ``value`` and its 0-based place ``idx``."""
    table: DataFrame
    size: int
    small: bool  # counted, in rows and bytes, to be broadcast


def fit_categories(df: DataFrame, columns: Sequence[str]) -> dict[str, Categories]:
    """The categories of each column in these rows, in the order of their UTF-8 bytes
    (the stages' order, but for characters beyond U+FFFF). Null is none.

    Distinct values are dealt into ranges and numbered range by range, each from
    the sum of the ranges before it: no sort of all in one task, no list on the driver.
    """
    return {c: _fit(df.select(F.col(c).cast("string").alias("value"))) for c in columns}


def _fit(values: DataFrame) -> Categories:
    distinct = cut_lineage(values.where("value IS NOT NULL").distinct())
    # the numbers of the ranges are written: a range never moves under a later job
    ranges = cut_lineage(distinct.repartitionByRange("value").select("value", F.spark_partition_id().alias("_part")))
    table = cut_lineage(running_sum(ranges, [], "_part", ["value"]).select("value", F.col("_before").cast("long").alias("idx")))
    n = table.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("bytes")).first()
    return Categories(table, n["rows"], n["rows"] <= BROADCAST_ROWS and n["bytes"] <= BROADCAST_BYTES)


def with_slots(df: DataFrame, fitted: Mapping[str, Categories]) -> DataFrame:
    """``<column>__idx`` (long) for each fitted column: the place of its value among
    the categories, null for an unknown or null value."""
    for i, (c, categories) in enumerate(fitted.items()):
        table = categories.table.select(F.col("value").alias(f"_value_{i}"), F.col("idx").alias(f"{c}__idx"))
        if categories.small:
            table = F.broadcast(table)
        df = df.join(table, F.col(c).cast("string") == F.col(f"_value_{i}"), "left").drop(f"_value_{i}")
    return df


def n_slots(fitted: Mapping[str, Categories]) -> int:
    return sum(c.size for c in fitted.values())


def onehot(fitted: Mapping[str, Categories]) -> Column:
    """The row's sparse one-hot vector over all fitted columns, side by side, as the
    struct that a vector is stored as. An unknown value has no slot, hence zeros."""
    places, before = [], 0
    for c, categories in fitted.items():
        places.append((F.col(f"{c}__idx") + before).cast("int"))
        before += categories.size
    known = F.filter(F.array(*places), lambda x: x.isNotNull())
    return F.struct(F.lit(0).cast("byte").alias("type"), F.lit(before).alias("size"), known.alias("indices"),
                    F.transform(known, lambda _: F.lit(1.0)).alias("values"))


def encode(df: DataFrame, fitted: Mapping[str, Categories], out: str = "onehot") -> DataFrame:
    """``df`` with the sparse vector column ``out``, which learners take as it is.

    The table is written once, the vector as its plain struct, and read back with
    the column declared a vector, so no row passes through Python and the schema
    holds no name per slot."""
    if n_slots(fitted) > 2 ** 31 - 1:
        raise ValueError("a vector holds at most 2^31 - 1 slots")
    rows = with_slots(df, fitted).withColumn(out, onehot(fitted)).drop(*[f"{c}__idx" for c in fitted])
    path = f"{run_tables(df.sparkSession)}/onehot-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    fields = [T.StructField(out, VectorUDT()) if f.name == out else f for f in rows.schema.fields]
    return df.sparkSession.read.schema(T.StructType(fields)).parquet(path)
