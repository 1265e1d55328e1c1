"""Fitted models as tables, and scores computed from them with joins alone.

A linear model is a table (column, level, weight): numerics have no level, the intercept no column. A row's
score is the sparse dot product of its (column, level, value) entries with the weights: numerics in one
expression, each category by a join of its levels. Rows neither multiply nor move while the levels are small
enough to broadcast, which Spark decides by their size.

A forest is a table of nodes (tree, node, slot, threshold, left, right, value, gain, share). Rows walk down level
by level, by a join with the nodes where they stand; rows that need no grouping walk in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskmill.operators.encode import feature_names
from riskmill.session import scratch_path, sized
from riskmill.spec import TableSpec

WEIGHTS = "column string, level string, weight double"
UNKNOWN = "__unknown"


def linear_weights(model: PipelineModel, df: DataFrame, spec: TableSpec) -> DataFrame:
    """The weights of a fitted logistic regression over plain columns; scaling is folded in."""
    names = feature_names(model.transform(df.limit(0)), spec)
    fitted = model.stages[-1]
    scaler = next((s for s in model.stages if hasattr(s, "mean") and hasattr(s, "std")), None)
    weights, intercept = [float(w) for w in fitted.coefficients.toArray()], float(fitted.intercept)
    rows = []
    for i, (name, weight) in enumerate(zip(names, weights)):
        column, _, level = name.partition("=")
        if column in spec.categorical:
            rows.append((column, level, weight))
            continue
        if scaler is not None:
            spread = float(scaler.std[i])
            weight = weight / spread if spread else 0.0
            intercept -= weight * float(scaler.mean[i])
        rows.append((name, None, weight))
    return df.sparkSession.createDataFrame([(None, None, intercept), *rows], WEIGHTS)


def linear_scores(
    df: DataFrame, weights: DataFrame, numeric: Sequence[str], categorical: Sequence[str], keep: Sequence[str],
    target: str = "score",
) -> DataFrame:
    """The kept columns and the probability of class 1 by a table of weights.

    A level without a weight has that of the unknown level, or none. The weights are stored once, so that their
    size decides on broadcasting.
    """
    weights = sized(weights, "weights")
    margin = F.coalesce(weights.filter(F.col("column").isNull()).select("weight").scalar(), F.lit(0.0))
    plain = weights.filter(F.col("level").isNull() & F.col("column").isNotNull()).agg(
        F.map_from_entries(F.collect_list(F.struct("column", "weight")))
    ).scalar()
    for column in numeric:
        margin = margin + F.col(column).cast("double") * F.coalesce(F.try_element_at(plain, F.lit(column)), F.lit(0.0))
    rows = df.select(*dict.fromkeys([*keep, *categorical]), margin.alias("_margin"))
    for column in categorical:
        levels = weights.filter((F.col("column") == column) & F.col("level").isNotNull()).select(
            F.col("level").alias(column), F.col("weight").alias("_weight")
        )
        other = levels.filter(F.col(column) == UNKNOWN).select("_weight").scalar()
        rows = rows.join(levels, column, "left").withColumn(
            "_margin", F.col("_margin") + F.coalesce("_weight", other, F.lit(0.0))
        ).drop("_weight")
    return rows.select(*keep, _logistic(F.col("_margin")).alias(target))


def _logistic(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


def tree_nodes(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The nodes of a fitted forest or boosted trees, read from where the model is written.

    value: the share of class 1 in a forest's node, or what a boosted tree adds; weight: of the tree.
    Binary slots are compared with one half, so that every node has a threshold.
    """
    spark, fitted = df.sparkSession, model.stages[-1]
    path = scratch_path(spark, "forest")
    fitted.write().save(path)
    trees = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    node = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    split, stats = F.col("split"), F.col("impurityStats")
    binary = split["numCategories"] == 2
    swapped = binary & (split["leftCategoriesOrThreshold"][0] == 1.0)
    boosted = isinstance(fitted, GBTClassificationModel)
    if fitted.numClasses != 2 or node.filter(split["numCategories"] > 2).limit(1).count():
        raise ValueError("two classes and two-valued categories only")
    return node.join(trees, "tree").select(
        "tree", F.col("id").alias("node"), split["featureIndex"].alias("slot"),
        F.when(binary, 0.5).otherwise(F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(swapped, F.col("rightChild")).otherwise(F.col("leftChild")).alias("left"),
        F.when(swapped, F.col("leftChild")).otherwise(F.col("rightChild")).alias("right"),
        (F.col("prediction") if boosted else stats[1] / (stats[0] + stats[1])).alias("value"),
        "gain", (stats[0] if boosted else stats[0] + stats[1]).alias("mass"), "weight",
    )


def tree_margins(
    df: DataFrame, nodes: DataFrame, key: Sequence[str], values: str, levels: int, grouped: bool = True
) -> DataFrame:
    """Per key: the weighted sum of the leaves that a row reaches, and the sum of the trees' weights.

    grouped=False: per row, whatever its key, with nothing shuffled, sorted or spilled.

    values: an array column, by slot. levels: of the deepest tree. A leaf has a slot of -1. The nodes are sent to
    every task: a row becomes one per tree, so estimates of either side say little, and shuffling that side for every
    level would cost more than any forest that was fitted.
    """
    if not grouped:
        return _row_margins(df, nodes, key, values, levels)
    fields = ["tree", "node", "slot", "threshold", "left", "right", "value", "weight"]
    roots = nodes.filter(F.col("node") == 0).agg(F.collect_list(F.struct(*fields))).scalar()  # one per tree
    at = df.select(*key, F.col(values).alias("_values"), F.explode(roots).alias("_root")).select(*key, "_values", "_root.*")
    steps = F.broadcast(nodes.select(
        F.col("tree").alias("_tree"), F.col("node").alias("_node"), F.col("slot").alias("_slot"),
        F.col("threshold").alias("_threshold"), F.col("left").alias("_left"), F.col("right").alias("_right"),
        F.col("value").alias("_value"),
    ))
    for _ in range(levels):
        down = F.when(F.col("slot") < 0, F.col("node")).when(
            F.get("_values", F.col("slot")) <= F.col("threshold"), F.col("left")
        ).otherwise(F.col("right"))
        at = at.withColumn("node", down).join(
            steps, (F.col("tree") == F.col("_tree")) & (F.col("node") == F.col("_node"))
        ).select(
            *key, "_values", "tree", "node", "weight", F.col("_slot").alias("slot"), F.col("_threshold").alias("threshold"),
            F.col("_left").alias("left"), F.col("_right").alias("right"), F.col("_value").alias("value"),
        )
    return at.groupBy(*key).agg(
        F.sum(F.col("value") * F.col("weight")).alias("margin"), F.sum("weight").alias("weights")
    )


def _row_margins(df: DataFrame, nodes: DataFrame, key: Sequence[str], values: str, levels: int) -> DataFrame:
    """As `tree_margins`, for every row by itself: each tree is an array of its nodes, in which children have places."""
    places = nodes.select(
        "tree", "node", (F.row_number().over(Window.partitionBy("tree").orderBy("node")) - 1).alias("place")
    )
    placed = nodes.join(places, ["tree", "node"])
    for side in ("left", "right"):
        child = places.select("tree", F.col("node").alias(side), F.col("place").alias(f"{side}_place"))
        placed = placed.join(child, ["tree", side], "left")
    node = F.struct("place", "node", "slot", "threshold", "left_place", "right_place", "value", "weight")
    trees = placed.groupBy("tree").agg(F.sort_array(F.collect_list(node)).alias("nodes"))
    forest = trees.filter(F.col("nodes")[0]["node"] == 0).agg(F.collect_list("nodes")).scalar()

    def leaf(tree):
        # A step to a node that is not there gives NULL, and the tree does not count, as in a join.
        return F.aggregate(F.array_repeat(F.lit(0), levels), F.get(tree, F.lit(0)), lambda at, _: F.when(
            at["slot"] < 0, at
        ).when(
            F.get("_values", at["slot"]) <= at["threshold"], F.get(tree, at["left_place"])
        ).otherwise(F.get(tree, at["right_place"])))

    def plus(total, x):
        return F.when(x.isNull(), total).otherwise(F.coalesce(total, F.lit(0.0)) + x)

    nothing, one = F.lit(None).cast("double"), F.lit(1)
    start = F.struct(nothing.alias("margin"), nothing.alias("weights"), F.lit(0).alias("trees"))
    total = F.aggregate(F.transform("_forest", leaf), start, lambda sums, at: F.when(at.isNull(), sums).otherwise(F.struct(
        plus(sums["margin"], at["value"] * at["weight"]).alias("margin"),
        plus(sums["weights"], at["weight"].cast("double")).alias("weights"), (sums["trees"] + one).alias("trees"),
    )))
    # Both through an array of one: else Spark would write the numbers of a row into every step, and walk again to filter.
    rows = df.select(*key, F.explode_outer(F.array(values)).alias("_values"))
    sums = rows.select(*key, "_values", forest.alias("_forest")).select(*key, total.alias("_total"))
    sums = sums.select(*key, F.explode_outer(F.array("_total")).alias("_sums")).filter("_sums.trees > 0")
    return sums.select(*key, "_sums.margin", "_sums.weights")


def forest_scores(margins: DataFrame, target: str = "score") -> DataFrame:
    """The mean share of class 1 over the trees."""
    return margins.withColumn(target, F.col("margin") / F.col("weights")).drop("margin", "weights")


def boosted_scores(margins: DataFrame, target: str = "score") -> DataFrame:
    """The probability of class 1 by boosted trees."""
    return margins.withColumn(target, _logistic(2 * F.col("margin"))).drop("margin", "weights")


def tree_importances(nodes: DataFrame, per_tree: bool = True) -> DataFrame:
    """Per slot: its gains, weighted by the rows they split, as a share of all.

    In a forest every tree counts alike (per_tree); boosted trees count by their gains.
    """
    gains = nodes.filter(F.col("slot") >= 0).groupBy("tree", "slot").agg(F.sum(F.col("gain") * F.col("mass")).alias("gain"))
    trees = gains.groupBy("tree").agg(F.sum("gain").alias("whole")).filter("whole > 0")
    share = F.col("gain") / F.col("whole") if per_tree else F.col("gain")
    parts = gains.join(trees, "tree").groupBy("slot").agg(F.sum(share).alias("part"))
    return parts.select("slot", (F.col("part") / parts.agg(F.sum("part")).scalar()).alias("importance"))


def vector_values(df: DataFrame, features: str = "features", target: str = "values") -> DataFrame:
    """Adds a vector's slots as an array."""
    return df.withColumn(target, vector_to_array(features))
