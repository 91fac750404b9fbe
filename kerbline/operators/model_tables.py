"""Trained models as tables: nodes of trees, coefficients, and scores worked out from them.

MLlib keeps a model in memory and scores row by row. The tables here hold the same model as rows, so that
it can be inspected, joined and checked with SQL: trees are walked level by level by joins, linear models
are sums over (row, feature) products, importances and gradients are aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.plans.durable import attach, durable, shared_folder

INTERCEPT = "(intercept)"


@dataclass
class Trees:
    """Nodes of a tree model.

    `nodes` has tree, node (0 is the root), feature, threshold, categories (that go left, if not by
    threshold), left, right (null in leaves), prediction, stats (of classes, or count and sums), gain,
    weight (of the tree) and cover (weight of the training rows that reached the node).
    """

    nodes: DataFrame
    depth: int
    trees: int
    boosted: bool


def read_trees(spark: SparkSession, path: str, depth: int) -> Trees:
    """The node table of a saved tree, forest or boosted model of at most `depth` levels."""
    held = spark.read.parquet(f"{path}/data")
    if "nodeData" in held.columns:
        weights = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
        rows = held.select(F.col("treeID").alias("tree"), "nodeData.*")
        rows = attach(rows, weights, ["tree"])
    else:
        rows = held.select(F.lit(0).alias("tree"), "*", F.lit(1.0).alias("weight"))
    inner = F.col("leftChild") >= 0
    by_categories = F.col("split.numCategories") >= 0
    lefts = F.col("split.leftCategoriesOrThreshold")
    nodes = durable(
        rows.select(
            "tree",
            F.col("id").alias("node"),
            F.when(inner, F.col("split.featureIndex")).alias("feature"),
            F.when(inner & ~by_categories, F.get(lefts, 0)).alias("threshold"),
            F.when(inner & by_categories, lefts).alias("categories"),
            F.when(inner, F.col("leftChild")).alias("left"),
            F.when(inner, F.col("rightChild")).alias("right"),
            "prediction",
            F.col("impurityStats").alias("stats"),
            F.when(inner, F.col("gain")).alias("gain"),
            "weight",
        )
    )
    # Regression trees keep count, sum and sum of squares; class trees have all of a row's stats >= 0.
    first = spark.read.text(f"{path}/metadata").first()[0]
    boosted = "GBT" in first.split('"class":"')[1].split('"')[0]
    count = F.get("stats", 0) if boosted else F.aggregate("stats", F.lit(0.0), lambda a, b: a + b)
    nodes = nodes.withColumn("cover", count)
    return Trees(nodes, depth, nodes.agg(F.count_distinct("tree")).first()[0], boosted)


def tree_nodes(model: Model, spark: SparkSession) -> Trees:
    """The node table of a tree, forest or boosted model. It is saved, so nodes never pass the driver."""
    path = f"{shared_folder(spark)}/model-{uuid4().hex}"
    model.write().save(path)
    return read_trees(spark, path, model.getOrDefault("maxDepth"))


def leaves(trees: Trees, rows: DataFrame, key: Sequence[str], features: str = "features") -> DataFrame:
    """The leaf that each row reaches in each tree: key columns, tree, prediction, stats, weight.

    Rows go down one level at a time by a join on (tree, node). The node table is sent whole to every executor,
    as MLlib does with the model when it scores, so rows stay where they are. A shuffle would move a row per tree
    at every level, and all rows of a tree share its root.
    """
    inner = trees.nodes.filter("left IS NOT NULL").select("tree", "node", "feature", "threshold", "categories", "left", "right")
    ends = trees.nodes.select("tree", "node", "prediction", "stats", "weight")
    inner, ends = F.broadcast(inner), F.broadcast(ends)
    at = rows.select(
        *key,
        vector_to_array(features).alias("_x"),
        F.explode(F.sequence(F.lit(0), F.lit(trees.trees - 1))).alias("tree"),
        F.lit(0).alias("node"),
    )
    value = F.get("_x", F.col("feature"))
    goes_left = F.coalesce(value <= F.col("threshold"), F.array_contains("categories", value))
    for _ in range(trees.depth):
        child = F.when(goes_left, F.col("left")).otherwise(F.col("right"))
        at = at.join(inner, ["tree", "node"], "left").select(
            *key, "_x", "tree", F.coalesce(F.when(F.col("left").isNotNull(), child), F.col("node")).alias("node")
        )
    return at.drop("_x").join(ends, ["tree", "node"]).drop("node")


def tree_scores(trees: Trees, rows: DataFrame, key: Sequence[str], features: str = "features") -> DataFrame:
    """Probability of class 1 from the node table: key columns and `prob_walked`.

    A forest averages the class shares of the leaves; a boosted model adds the weighted leaf values to a
    margin, whose double is the log odds.
    """
    reached = leaves(trees, rows, key, features)
    if trees.boosted:
        margin = F.sum(F.col("weight") * F.col("prediction"))
        return reached.groupBy(*key).agg((1 / (1 + F.exp(-2 * margin))).alias("prob_walked"))
    share = F.get("stats", 1) / F.aggregate("stats", F.lit(0.0), lambda a, b: a + b)
    return reached.groupBy(*key).agg(F.avg(share).alias("prob_walked"))


def node_importances(trees: Trees, names: Sequence[str]) -> DataFrame:
    """Feature and importance from the node table: gain times rows, as shares of their sum.

    Each tree of a forest counts alike; the trees of a boosted model count by what they gain.
    """
    parts = trees.nodes.filter("left IS NOT NULL").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("cover")).alias("part"))
    if not trees.boosted:
        whole = parts.groupBy("tree").agg(F.sum("part").alias("whole"))
        parts = attach(parts, whole, ["tree"]).withColumn("part", F.col("part") / F.nullif("whole", F.lit(0.0)))
    sums = parts.groupBy("feature").agg(F.sum("part").alias("part"))
    total = F.nullif(sums.agg(F.sum("part")).scalar(), F.lit(0.0))
    listed = trees.nodes.sparkSession.createDataFrame(list(enumerate(names)), "feature int, name string")
    return (
        F.broadcast(listed)
        .join(sums, "feature", "left")
        .select(F.col("name").alias("feature"), F.coalesce(F.col("part") / total, F.lit(0.0)).alias("importance"))
    )


def coefficients(model: Model, names: Sequence[str], spark: SparkSession) -> DataFrame:
    """Place, feature and coefficient of a linear model; the intercept has place -1."""
    rows = [(i, n, float(c)) for i, (n, c) in enumerate(zip(names, model.coefficients.toArray().tolist(), strict=True))]
    return spark.createDataFrame([(-1, INTERCEPT, float(model.intercept)), *rows], "place int, feature string, coefficient double")


def margins(table: DataFrame, rows: DataFrame, key: Sequence[str], features: str = "features") -> DataFrame:
    """Sum of coefficient times value, and the intercept, for each row: key columns and `margin`."""
    cells = rows.select(*key, F.posexplode(vector_to_array(features)).alias("place", "_value"))
    summed = attach(cells, table.select("place", "coefficient"), ["place"], "inner").groupBy(*key)
    intercept = table.filter("place = -1").select("coefficient").scalar()
    return summed.agg((F.sum(F.col("coefficient") * F.col("_value")) + intercept).alias("margin"))


def sigmoid(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


def loss_gradient(
    table: DataFrame, rows: DataFrame, reg: float, weight: str | None = None,
    key: str = "event_id", label: str = "label", features: str = "features",
) -> DataFrame:
    """Feature and derivative of the penalised logistic loss by its coefficient; all 0 at the optimum.

    The loss is the weighted mean log loss and `reg` / 2 times the squares of the coefficients, each in
    units of its feature's standard deviation; derivatives are in these units too. A feature without
    spread has none.
    """
    weighing = F.col(weight).cast("double") if weight else F.lit(1.0)
    held = rows.select(key, F.col(label).alias("_y"), weighing.alias("_w"), features)
    spread = vector_to_array(Summarizer.metrics("std").summary(F.col(features), F.col("_w"))["std"])
    total, stds = held.agg(F.sum("_w"), spread).first()
    scored = held.join(margins(table, held, [key], features), key)
    slope = (F.col("_w") * (sigmoid(F.col("margin")) - F.col("_y")) / total).alias("_slope")
    cells = scored.select(slope, F.posexplode(vector_to_array(features)).alias("place", "_value"))
    sums = cells.groupBy("place").agg(F.sum(F.col("_slope") * F.col("_value")).alias("_data"))
    bias = scored.agg(F.sum(slope).alias("_data")).select(F.lit(-1).alias("place"), "_data")
    std = F.coalesce(F.get(F.array(*map(F.lit, stds)), F.greatest("place", F.lit(0))), F.lit(0.0))
    penal = F.when(F.col("place") < 0, F.col("_data")).when(
        std > 0, F.col("_data") / std + F.lit(reg) * std * F.col("coefficient")
    )
    return F.broadcast(table).join(sums.unionByName(bias), "place").select("feature", penal.alias("gradient"))
