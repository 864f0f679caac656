"""A fitted forest as a table of nodes, and a scorer that walks it with SQL
expressions (L3-L5, L8, L9 checked by a second way to the same probabilities).

A node is a row (tree, node, feature, threshold, categories, left, right, value):
a row of features goes left if its feature is at most the threshold, or one of the
categories; a leaf's value is the share of the positive class among the weighted
training rows that came to it. A forest's probability is the mean of its trees'
leaf values.

Trees are packed into arrays, so a table is scored in one projection: no join.
Batches of trees are scalar subqueries, ``PACKED_NODES`` nodes at most; a tree
larger than that is walked by a join with its nodes per level instead.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readyspark.session import cut_lineage, run_tables, spread

PACKED_NODES = 500_000  # of one subquery's value: about 60 bytes each


def node_table(spark: SparkSession, model: PipelineModel, path: str | None = None) -> DataFrame:
    """The nodes of the model's last stage, from its saved form (written to ``path``,
    by default this run's folder of intermediate tables). Nodes of a tree are
    numbered from 0, the root, without gaps."""
    path = path or f"{run_tables(spark)}/forest-{uuid.uuid4().hex}"
    model.stages[-1].write().overwrite().save(path)
    split = F.col("nodeData.split")
    total = F.aggregate("nodeData.impurityStats", F.lit(0.0), lambda s, x: s + x)
    inner = F.col("nodeData.leftChild") >= 0
    ordered = split["numCategories"] < 0
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"),
        F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner & ordered, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner & ~ordered, split["leftCategoriesOrThreshold"]).alias("categories"),
        F.when(inner, F.col("nodeData.leftChild")).alias("left"),
        F.when(inner, F.col("nodeData.rightChild")).alias("right"),
        F.coalesce(F.try_divide(F.col("nodeData.impurityStats")[1], total), F.lit(0.0)).alias("value"))


def _packed_sum(x: Column, trees: Column, depth: int) -> Column:
    """The sum of the trees' leaf values for the features ``x``."""
    def leaf(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            value = F.get(x, F.get(tree["feature"], at))
            # a node without a threshold has categories
            left = F.coalesce(value <= F.get(tree["threshold"], at), F.array_contains(F.get(tree["categories"], at), value))
            return F.when(left, F.get(tree["left"], at)).otherwise(F.get(tree["right"], at))

        return F.get(tree["value"], F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), F.lit(0), step))

    return F.aggregate(trees, F.lit(0.0), lambda s, tree: s + leaf(tree))


def _packed(nodes: DataFrame) -> DataFrame:
    """One row with all trees, an array of each column of a tree's nodes. A leaf is its
    own child, so a walk that came to it stays there."""
    here = nodes.select("tree", "node", F.coalesce("feature", F.lit(0)).alias("feature"),
                        F.when(F.col("left").isNull(), F.lit(0.0)).otherwise(F.col("threshold")).alias("threshold"), "categories",
                        F.coalesce("left", "node").alias("left"), F.coalesce("right", "node").alias("right"), "value")
    names = ["feature", "threshold", "categories", "left", "right", "value"]
    ordered = here.groupBy("tree").agg(F.sort_array(F.collect_list(F.struct("node", *names))).alias("t"))
    return ordered.select(F.struct(*[F.col("t")[c].alias(c) for c in names]).alias("t")).agg(F.collect_list("t").alias("_trees"))


def _joined_sum(rows: DataFrame, nodes: DataFrame, key: str, depth: int) -> DataFrame:
    """``key`` and the sum of the leaf values of ``nodes``' trees, a join per level."""
    at = rows.select(key, "_x").crossJoin(F.broadcast(nodes.select("tree").distinct())).withColumn("node", F.lit(0))
    done = None
    for _ in range(depth + 1):
        here = at.join(nodes, ["tree", "node"])
        leaves = here.where(F.col("left").isNull()).select(key, "value")
        done = leaves if done is None else done.unionByName(leaves)
        goes = F.when(F.col("categories").isNull(), F.element_at("_x", F.col("feature") + 1) <= F.col("threshold")).otherwise(
            F.expr("array_contains(categories, element_at(_x, feature + 1))"))
        at = cut_lineage(here.where(F.col("left").isNotNull()).select(
            key, "_x", "tree", F.when(goes, F.col("left")).otherwise(F.col("right")).alias("node")))
        done = cut_lineage(done)
    return done.groupBy(key).agg(F.sum("value").alias("_part"))


def walk(df: DataFrame, nodes: DataFrame, key: str, features: str = "features", out: str = "p_walked",
         packed_nodes: int = PACKED_NODES, max_depth: int = 30) -> DataFrame:
    """``df`` (encoded rows) with the forest's probability of the positive class.

    ``key`` names the rows where trees are too large to pack; every other row of
    ``df`` stays as it is. ``max_depth``: no leaf is deeper. A null feature vector
    gives null."""
    sizes = nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).orderBy("tree").collect()  # a row per tree
    depth = min(max_depth, max((r["n"] for r in sizes), default=1) // 2)  # at most the inner nodes
    rows = df.withColumn("_x", vector_to_array(features)).withColumn("_sum", F.lit(0.0))
    batch, held, batches = [], 0, []
    for r in sizes:
        if r["n"] > packed_nodes:
            continue
        if held + r["n"] > packed_nodes:
            batches, batch, held = batches + [batch], [], 0
        batch.append(r["tree"])
        held += r["n"]
    for trees in batches + [batch] if batch else batches:
        # one row of at most packed_nodes nodes: a scalar subquery, whose value each task
        # holds once (used once, so it is put into the sum below and never into a row);
        # a cross join would copy all trees into every row
        packed = cut_lineage(_packed(nodes.where(F.col("tree").isin(trees))))
        rows = rows.withColumn("_trees", packed.scalar())
        rows = rows.withColumn("_sum", F.col("_sum") + _packed_sum(F.col("_x"), F.col("_trees"), depth)).drop("_trees")
    large = [r["tree"] for r in sizes if r["n"] > packed_nodes]
    if large:
        rows = cut_lineage(rows)
        parts = _joined_sum(rows.where("_x IS NOT NULL"), nodes.where(F.col("tree").isin(large)), key, depth)
        rows = rows.join(parts, key, "left").withColumn("_sum", F.col("_sum") + F.col("_part")).drop("_part")
    return rows.withColumn(out, F.col("_sum") / F.lit(float(max(1, len(sizes))))).drop("_x", "_sum")


def walked_scores(df: DataFrame, model: PipelineModel, key: str, packed_nodes: int = PACKED_NODES) -> DataFrame:
    """``df`` with ``p_bad`` and ``prediction`` as the model reports them, and ``p_walked``."""
    nodes = cut_lineage(node_table(df.sparkSession, model))
    encoded = PipelineModel(stages=model.stages[:-1]).transform(spread(df))
    reported = model.stages[-1].transform(encoded)
    both = walk(reported, nodes, key, packed_nodes=packed_nodes, max_depth=model.stages[-1].getOrDefault("maxDepth"))
    return both.select(*df.columns, vector_to_array("probability")[1].alias("p_bad"),
                       F.col("prediction").cast("int").alias("prediction"), "p_walked")
