"""Connected components of a link table: a Spark loop of star contractions, and
one task for graphs whose counted links fit it easily."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readyspark.llm.common import prepare_python, tidy, written

SMALL = 200_000  # links (a few megabytes) up to which one task does it


def _in_one_task(edges: DataFrame) -> DataFrame:
    """Union-find over all links; only for a counted, small number of them."""
    prepare_python(edges.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}
        kind = None

        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for b in batches:
            kind = b.schema.field("u").type
            for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                u, v = root(u), root(v)
                if u != v:
                    parent[max(u, v)] = min(u, v)  # the smallest id stays the root
        if parent:
            ids = list(parent)
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array([root(x) for x in ids], kind)],
                                             names=["id", "component_id"])

    kind = edges.schema["u"].dataType.simpleString()
    return edges.coalesce(1).mapInArrow(tidy(run), f"id {kind}, component_id {kind}")


def _state(edges: DataFrame) -> tuple:
    """Size and order-free checksum of an edge table: one small aggregate."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 40))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id``, ``component_id`` (smallest id reachable) of every id in ``links``.

    Each turn links every larger neighbour of an id to the smallest of its
    neighbourhood (large star), then every smaller one and the id itself
    likewise (small star); a turn that changes nothing ends it, after about the
    logarithm of the longest path. Smallest neighbours are map-side-combined
    minima joined back, so an id with very many links is no single task's
    group; a turn's edges never exceed the links, and each turn is written to
    the shared folder. At most ``SMALL`` distinct links go to one task instead,
    with the same result. Links with a null end are dropped; no links, no rows.
    """
    edges = (links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                  .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    edges = written(edges, "edges")
    state = _state(edges)
    if state[0] <= SMALL:
        return _in_one_task(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u")
                     .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .union(least.select("u", F.col("m").alias("v"))).distinct())
        edges = written(small, "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    root = edges.groupBy("u").agg(F.min("v").alias("component_id"))
    roots = edges.select("v").distinct().join(root, F.col("v") == F.col("u"), "left_anti")
    return (root.select(F.col("u").alias("id"), "component_id")
                .union(roots.select(F.col("v").alias("id"), F.col("v").alias("component_id"))))
