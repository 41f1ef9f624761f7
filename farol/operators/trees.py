"""Tree ensembles as tables of nodes and paths.

A node table has one row per node: tree, node (0 is the root, left and right
name children), feature and threshold (NULL at a leaf), cover (weight of the
rows that reached it), gain, value and the tree's weight. The weighted values
of the leaves that a row reaches add up to a probability for forests and to
log-odds for boosted trees. A value goes left when it is at most the
threshold; NULL and NaN go right, as in the fitted models.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farol.functions import rules
from farol.operators.boosting import BoostedTreesModel
from farol.operators.forest import RandomForestModel
from farol.session import new_path
from farol.sources import sinks

MAX_NODES = 1_000_000  # an ensemble travels to every task: 100 MB at most


def node_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Nodes of a fitted forest or boosted ensemble, read from its stored form."""
    classifier = model.stages[-1]
    if isinstance(classifier, BoostedTreesModel):
        return spark.createDataFrame(
            classifier.node_rows(), "tree int, node int, feature int, threshold double, left int, right int, cover double, gain double, value double"
        ).withColumn("weight", F.lit(1.0))
    if isinstance(classifier, RandomForestModel):
        return spark.createDataFrame(
            classifier.node_rows(), "tree int, node int, feature int, threshold double, left int, right int, cover double, gain double, value double, weight double"
        )
    if not hasattr(classifier, "treeWeights"):
        raise ValueError("the model has no trees")
    boosted = isinstance(classifier, GBTClassificationModel)
    path = new_path(spark, "trees")
    classifier.write().save(path)
    stored = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    if not stored.where("split.numCategories > 2").isEmpty():
        raise ValueError("splits on sets of categories have no threshold; encode the categories first")
    # A split of two categories keeps the list of those that go left: {1} is the mirror image of a threshold.
    mirrored = (F.col("split.numCategories") == 2) & (F.get("split.leftCategoriesOrThreshold", F.lit(0)) == 1.0)
    cut = F.when(F.col("split.numCategories") == 2, F.lit(0.5)).otherwise(F.get("split.leftCategoriesOrThreshold", F.lit(0)))
    inner = F.col("leftChild") >= 0
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    first = F.get("impurityStats", F.lit(0))
    scale = 2.0 if boosted else 1.0 / len(classifier.treeWeights)
    weights = F.array(*[F.lit(float(w) * scale) for w in classifier.treeWeights])
    return stored.select(
        "tree", F.col("id").alias("node"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"), F.when(inner, cut).alias("threshold"),
        F.when(inner, F.when(mirrored, F.col("rightChild")).otherwise(F.col("leftChild"))).alias("left"),
        F.when(inner, F.when(mirrored, F.col("leftChild")).otherwise(F.col("rightChild"))).alias("right"),
        (first if boosted else total).alias("cover"), F.when(inner, F.col("gain")).alias("gain"),
        (F.col("prediction") if boosted else F.get("impurityStats", F.lit(1)) / total).alias("value"),
        F.get(weights, F.col("tree")).alias("weight"),
    )


def node_importance(nodes: DataFrame, names: list[str], per_tree: bool = True) -> DataFrame:
    """Share of each feature in all gains, weighted by cover; features without a split have 0.

    With ``per_tree`` every tree counts alike, as in a forest; else every gain does.
    """
    gains = nodes.where("feature is not null").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("cover")).alias("g"))
    if per_tree:
        totals = gains.groupBy("tree").agg(F.sum("g").alias("t"))
        gains = gains.join(totals, "tree").withColumn("g", rules.share(F.col("g"), F.col("t")))
    by_feature = gains.groupBy("feature").agg(F.sum("g").alias("g"))
    total = by_feature.agg(F.sum("g")).scalar()
    slots = nodes.sparkSession.createDataFrame(list(enumerate(names)), "feature int, variavel string")
    return slots.join(by_feature, "feature", "left").select(
        "variavel", F.coalesce(rules.share(F.col("g"), total), F.lit(0.0)).alias("importancia"))


def _ensemble(nodes: DataFrame) -> DataFrame:
    """The ensemble as one row: an array of trees, each an array of nodes in the order of their numbers."""
    if nodes.count() > MAX_NODES:
        raise ValueError(f"an ensemble of over {MAX_NODES} nodes does not travel to every task")
    fields = ["node", "feature", "threshold", "left", "right", "value"]
    trees = nodes.groupBy("tree").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("nodes"), F.max("weight").alias("weight"))
    return trees.agg(F.sort_array(F.collect_list(F.struct("tree", "weight", "nodes"))))


def _goes_left(x: Column, node: Column) -> Column:
    return F.coalesce(F.get(x, node["feature"]) <= node["threshold"], F.lit(False))


def _visited(tree: Column, x: Column, depth: int) -> Column:
    """Numbers of the nodes a row passes, root first."""
    def step(path: Column, _: Column) -> Column:
        node = F.get(tree["nodes"], F.element_at(path, -1))
        child = F.when(_goes_left(x, node), node["left"]).otherwise(node["right"])
        return F.when(node["feature"].isNull(), path).otherwise(F.concat(path, F.array(child)))

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), F.array(F.lit(0)), step)


def with_score(df: DataFrame, x: Column, nodes: DataFrame, depth: int, name: str = "score") -> DataFrame:
    """``df`` and the weighted sum of the leaves its rows reach; ``x`` is an array of the features."""
    def add(total: Column, tree: Column) -> Column:
        leaf = F.get(tree["nodes"], F.element_at(_visited(tree, F.col("_x"), depth), -1))
        return total + tree["weight"] * leaf["value"]

    return df.withColumn("_x", x).withColumn("_trees", _ensemble(nodes).scalar()).withColumn(
        name, F.aggregate("_trees", F.lit(0.0), add)).drop("_x", "_trees")


def with_cover(nodes: DataFrame, df: DataFrame, x: Column, depth: int) -> DataFrame:
    """The node table with the number of rows of ``df`` that reach each node as its cover."""
    passed = df.select(x.alias("_x")).withColumn("_trees", _ensemble(nodes).scalar()).select(
        F.explode(F.flatten(F.transform("_trees", lambda t: F.transform(
            _visited(t, F.col("_x"), depth), lambda n: F.struct(t["tree"].alias("tree"), n.alias("node")))))).alias("n"))
    counts = passed.groupBy("n.tree", "n.node").agg(F.count(F.lit(1)).cast("double").alias("cover"))
    return nodes.drop("cover").join(counts, ["tree", "node"], "left").withColumn("cover", F.coalesce("cover", F.lit(0.0)))


def paths(nodes: DataFrame) -> DataFrame:
    """A row per leaf: tree, leaf, value with the tree's weight, and one step per feature tested on the way.

    A step holds the interval (low, high] of the feature that leads here, open
    ends NULL, and the share of the rows above that come this way.
    """
    nodes, _ = sinks.stage(nodes, "nodes")
    at = nodes.where("node = 0").select("tree", "node").distinct().selectExpr(
        "tree", "node", "cast(null as double) as above",
        "cast(array() as array<struct<feature:int,low:double,high:double,share:double>>) as steps",
        "cast(null as struct<feature:int,low:double,high:double>) as last")
    leaves = []
    found = 1
    while found:
        share = F.coalesce(F.try_divide("cover", "above"), F.lit(0.0))
        longer = F.concat("steps", F.array(F.struct("last.feature", "last.low", "last.high", share.alias("share"))))
        # One level of all trees per turn; a level is written, so plans stay short.
        level, found = sinks.stage(at.join(nodes, ["tree", "node"]).withColumn(
            "steps", F.when(F.col("last").isNull(), F.col("steps")).otherwise(longer)), "level")
        leaves.append(level.where("feature is null").select("tree", F.col("node").alias("leaf"), (F.col("weight") * F.col("value")).alias("value"), "steps"))
        none = F.lit(None).cast("double")
        ways = F.array(
            F.struct(F.col("left").alias("node"), F.struct("feature", none.alias("low"), F.col("threshold").alias("high")).alias("last")),
            F.struct(F.col("right").alias("node"), F.struct("feature", F.col("threshold").alias("low"), none.alias("high")).alias("last")),
        )
        at = level.where("feature is not null").select("tree", F.col("cover").alias("above"), "steps", F.inline(ways))
    every = leaves[0]
    for more in leaves[1:]:
        every = every.unionByName(more)
    one = every.select("tree", "leaf", "value", F.inline_outer("steps")).groupBy("tree", "leaf", "value", "feature").agg(
        F.max("low").alias("low"), F.min("high").alias("high"), F.product("share").alias("share"))
    step = F.when(F.col("feature").isNotNull(), F.struct("feature", "low", "high", "share"))
    return one.groupBy("tree", "leaf", "value").agg(F.sort_array(F.collect_list(step)).alias("steps"))


def base_value(paths: DataFrame) -> DataFrame:
    """The score expected of a row none of whose features is known, as one row."""
    share = F.aggregate("steps", F.lit(1.0), lambda a, s: a * s["share"])
    return paths.agg(F.sum(F.col("value") * share).alias("base"))


def path_attribution(df: DataFrame, x: Column, paths: DataFrame, names: list[str], keys: list[str]) -> DataFrame:
    """Exact path-dependent Shapley contributions to the score, summed per ``keys`` and feature.

    With a row key the contributions of a row and ``base_value`` add up to its
    score. Features that no path tests have no row. For a leaf whose steps are
    met (o = 1) or not (0) and keep the share z of the rows, the weighted sum
    over all subsets of the other features equals the integral over t in
    (0, 1) of the product of o * t + z * (1 - t): a polynomial, so Gauss's
    points for its degree give it exactly. Leaves travel to the rows; rows are
    shuffled only as one sum per key, feature and task.
    """
    paths, n = sinks.stage(paths, "paths")
    if n > MAX_NODES:
        raise ValueError(f"an ensemble of over {MAX_NODES} leaves does not travel to every task")
    longest = paths.agg(F.max(F.size("steps"))).first()[0] or 0
    points, weights = np.polynomial.legendre.leggauss(max(1, (longest + 1) // 2))
    gauss = F.array(*[F.struct(F.lit((1 + float(p)) / 2).alias("t"), F.lit(float(w) / 2).alias("w")) for p, w in zip(points, weights, strict=True)])
    leaves = paths.where(F.size("steps") > 0).agg(F.sort_array(F.collect_list(F.struct("tree", "leaf", "value", "steps")))).scalar()

    def met(s: Column) -> Column:
        v = F.coalesce(F.get("_x", s["feature"]), F.lit(float("nan")))
        return (s["low"].isNull() | (v > s["low"])) & (s["high"].isNull() | (v <= s["high"]))

    def at(s: Column, t: Column) -> Column:
        return s["o"] * t + s["share"] * (1 - t)

    pieces = (
        df.select(*keys, x.alias("_x")).withColumn("_leaves", leaves)
        .select(*keys, "_x", F.explode("_leaves").alias("_leaf"))
        .select(*keys, F.col("_leaf.value").alias("_v"), F.transform("_leaf.steps", lambda s: F.struct(
            s["feature"].alias("feature"), s["share"].alias("share"), F.when(met(s), 1.0).otherwise(0.0).alias("o"))).alias("_s"))
        .withColumn("_q", F.transform(gauss, lambda q: F.struct(
            q["t"].alias("t"), F.aggregate("_s", q["w"], lambda a, s: a * at(s, q["t"])).alias("p"))))
        .select(*keys, F.inline(F.transform("_s", lambda s: F.struct(s["feature"].alias("_f"), (
            F.col("_v") * (s["o"] - s["share"]) * F.aggregate("_q", F.lit(0.0), lambda a, q: a + F.coalesce(F.try_divide(q["p"], at(s, q["t"])), F.lit(0.0)))
        ).alias("_c")))))
    )
    label = F.get(F.array(*[F.lit(n) for n in names]), F.col("_f"))
    return pieces.groupBy(*keys, label.alias("variavel")).agg(F.sum("_c").alias("contribuicao"))
