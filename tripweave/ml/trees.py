"""Saved boosted trees as a table, and scores by walking it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BOOSTING_STAGE = "stages/*_GBTRegressor_*"


def tree_nodes(spark: SparkSession, path: str) -> DataFrame:
    """One row per node of a model saved by ``save_model``.

    Columns: ``tree``, ``node``, ``weight`` of the tree, ``prediction``; for inner nodes ``left`` and
    ``right``, the ``feature`` (position in the vector), and either the ``threshold`` up to which or the
    ``categories`` with which a row goes left. A leaf has nulls there.
    """
    stage = f"{path}/{_BOOSTING_STAGE}"
    weights = spark.read.parquet(f"{stage}/treesMetadata").toDF("tree", "_metadata_text", "weight").drop("_metadata_text")
    nodes = spark.read.parquet(f"{stage}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    split, inner = F.col("split"), F.col("leftChild") >= 0
    ordered = split["numCategories"] < 0
    return nodes.join(weights, "tree").select(
        "tree", F.col("id").alias("node"), "weight", "prediction",
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner & ordered, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(inner & ~ordered, split["leftCategoriesOrThreshold"]).alias("categories"),
    )


def _size_of(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number of trees and the deepest level the fit allowed, from the saved settings."""
    saved = spark.read.json(f"{path}/{_BOOSTING_STAGE}/metadata")
    deepest = [F.col(f"{params}.maxDepth") for params in ("paramMap", "defaultParamMap")
               if "maxDepth" in saved.schema[params].dataType.fieldNames()]
    found = saved.select("numTrees", F.coalesce(*deepest).alias("depth")).first()
    return found["numTrees"], found["depth"]


def walk_trees(rows: DataFrame, path: str, *key: str, features: str = "features") -> DataFrame:
    """The key columns and ``prediction``, by one equality join with the saved nodes per level.

    Shares nothing with the model's own scorer, so it checks that one, and it needs no model object, only the
    files. ``key`` names each row once. Every row is taken through every tree, so it costs trees times rows;
    the nodes number at most trees times two to the depth, whatever the rows are.
    """
    nodes = tree_nodes(rows.sparkSession, path)
    trees, depth = _size_of(rows.sparkSession, path)
    at = rows.select(
        *key, vector_to_array(features).alias("_x"),
        F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("node"))
    inner = nodes.where(F.col("left").isNotNull()).drop("weight", "prediction")
    value = F.get("_x", F.col("feature"))
    goes_left = F.coalesce(value <= F.col("threshold"), F.array_contains("categories", value))
    for _ in range(depth):
        child = F.when(goes_left, F.col("left")).otherwise(F.col("right"))
        at = at.join(inner, ["tree", "node"], "left").select(
            *key, "_x", "tree", F.when(F.col("left").isNull(), F.col("node")).otherwise(child).alias("node"))
    leaves = nodes.where(F.col("left").isNull()).select("tree", "node", (F.col("weight") * F.col("prediction")).alias("_part"))
    return at.join(leaves, ["tree", "node"]).groupBy(*key).agg(F.sum("_part").alias("prediction"))


def feature_use(spark: SparkSession, path: str, names: Sequence[str] = ()) -> DataFrame:
    """How many splits of the saved trees ask for each feature: ``feature`` (its name where one is given), ``splits``."""
    position = F.col("feature")
    name = F.get(F.array(*map(F.lit, names)), position) if names else F.lit(None).cast("string")
    inner = tree_nodes(spark, path).where(position.isNotNull())
    label = F.coalesce(name, position.cast("string")).alias("feature")
    return inner.select(label).groupBy("feature").agg(F.count("*").alias("splits"))
