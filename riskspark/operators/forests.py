"""Random forests as node tables: one fitted forest scored as many smaller ones.

The trees of a forest are drawn one by one, and a node's split doesn't depend on how deep its tree may grow. So the
first k trees of a fitted forest, cut at depth d, are a forest of k trees of depth d, once sibling leaves with one
prediction are merged as a fit does at its end. A grid over the number and the depth of trees needs one fit for
each combination of its other parameters, and one pass over the data scores all its cuts.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators.metrics import rates_from_counts
from riskspark.operators.modelling import FEATURES, Counted, assembled, combinations_of, equal_rows, metric_distance, parallel, params_text, with_weights
from riskspark.session import materialise, shared_folder

#: Parameters that a cut of one forest can stand for.
CUTS = ("numTrees", "maxDepth")
TREE = "struct<feature: array<int>, threshold: array<double>, left: array<int>, right: array<int>, votes: array<array<double>>>"


def forest_nodes(model: RandomForestClassificationModel, spark: SparkSession) -> DataFrame:
    """(tree, node, prediction, counts, left, right, feature, threshold): the model as Spark stores it."""
    path = f"{shared_folder(spark)}/forest-{uuid.uuid4().hex}"
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    node = F.col("nodeData")
    return nodes.select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), node["prediction"].alias("prediction"), node["impurityStats"].alias("counts"),
        node["leftChild"].alias("left"), node["rightChild"].alias("right"), node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"))


@dataclass
class Node:
    prediction: float
    counts: list[float]
    left: int
    right: int
    feature: int
    threshold: float | None

    def votes(self) -> list[float]:
        """Each class's share at the node."""
        total = sum(self.counts)
        return [c / total if total else 0.0 for c in self.counts]


def standing_for(nodes: Sequence[Node], depth: int) -> list[int]:
    """For every node, the node that a row which passes it ends in once the tree is cut at `depth`.

    Where a row of the uncut tree ends decides where it ends in the cut one: at the first node on its way that is a
    leaf there, by depth or as its two leaves have one prediction.
    """
    leaf = [True] * len(nodes)
    order, at = [(0, 0)], 0
    while at < len(order):
        node, level = order[at]
        at += 1
        if nodes[node].left >= 0 and level < depth:
            leaf[node] = False
        if nodes[node].left >= 0:
            order += [(nodes[node].left, level + 1), (nodes[node].right, level + 1)]
    for node, _ in reversed(order):
        if not leaf[node]:
            a, b = nodes[node].left, nodes[node].right
            leaf[node] = leaf[a] and leaf[b] and nodes[a].prediction == nodes[b].prediction
    stands = [-1] * len(nodes)
    for node, _ in order:
        if stands[node] < 0 and leaf[node]:
            stands[node] = node
        for child in (nodes[node].left, nodes[node].right):
            if child >= 0:
                stands[child] = stands[node]
    return stands


def tree_row(nodes: Sequence[Node], depths: Sequence[int]) -> tuple:
    """One tree as arrays by node; `votes` has two shares for each cut depth, those of the node standing for it."""
    cuts = [standing_for(nodes, d) for d in depths]
    votes = [[v for stands in cuts for v in (nodes[stands[i]].votes() if stands[i] >= 0 else [0.0, 0.0])] for i in range(len(nodes))]
    return ([n.feature for n in nodes], [n.threshold for n in nodes], [n.left for n in nodes], [n.right for n in nodes], votes)


def forest_row(nodes: DataFrame, depths: Sequence[int]) -> list[tuple]:
    """The trees of a forest; a forest has at most numTrees * 2^(maxDepth + 1) nodes, and the driver makes the cuts."""
    trees: dict[int, list[Node]] = {}
    for r in nodes.orderBy("tree", "node").collect():
        trees.setdefault(r.tree, []).append(Node(r.prediction, list(r.counts), r.left, r.right, r.feature, r.threshold))
    return [tree_row(t, depths) for t in trees.values()]


def _leaf(tree: Column, x: Column, depth: int) -> Column:
    """The node of the uncut tree that the features `x` end in."""
    def down(node: Column, _: Column) -> Column:
        goes_left = F.get(x, F.get(tree["feature"], node)) <= F.get(tree["threshold"], node)
        return F.when(F.get(tree["left"], node) < 0, node).when(goes_left, F.get(tree["left"], node)).otherwise(F.get(tree["right"], node))
    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), down)


def cut_predictions(df: DataFrame, forests: DataFrame, x: str, trees: Sequence[int], depths: Sequence[int]) -> DataFrame:
    """Rows of `df` for each forest (forest, trees) with `predicted`: array<int>, by number of trees, then by depth.

    The forests, a few rows, are one scalar; every row is scored where it is.
    """
    every = forests.agg(F.collect_list(F.struct("forest", "trees"))).scalar()
    rows = df.withColumn("__f", F.explode(every)).withColumn("forest", F.col("__f.forest"))
    ends = F.transform(F.col("__f.trees"), lambda t: F.get(t["votes"], _leaf(t, F.col(x), max(depths))))
    rows = rows.withColumn("__votes", ends)

    def share(k: int, at: int) -> Column:
        return F.aggregate(F.slice("__votes", 1, k), F.lit(0.0), lambda a, v: a + F.get(v, F.lit(at)))

    # A tie goes to class 0.
    predicted = [(share(k, 2 * j + 1) > share(k, 2 * j)).cast("int") for k in trees for j in range(len(depths))]
    return rows.withColumn("predicted", F.array(*predicted)).drop("__f", "__votes")


def forest_grid_search(grid: Mapping[str, Sequence[Any]], train: DataFrame, test: DataFrame, features: Sequence[str] = FEATURES,
                       label: str = "Ever90_12M", seed: int = 42, parallelism: int = 4) -> DataFrame:
    """Train and test metrics for each combination of `grid`, and the distance between the two, as `grid_search` gives.

    One forest is fitted for each combination of the parameters but numTrees and maxDepth, with the most trees of the
    greatest depth. Equal feature vectors are counted first and scored once; those of `train` serve the fits as well,
    so a large frame is read once for both.
    """
    spark = train.sparkSession
    trees, depths = sorted(set(grid["numTrees"])), sorted(set(grid["maxDepth"]))
    fits = combinations_of({k: v for k, v in grid.items() if k not in CUTS})
    known = equal_rows(train, [*features, label])
    data = assembled(Counted(train, known), features, label)
    try:
        def fit(i: int) -> tuple[int, list[tuple]]:
            forest = RandomForestClassifier(numTrees=trees[-1], maxDepth=depths[-1], seed=seed, maxMemoryInMB=512)
            model = with_weights(forest, fits[i]).fit(data)
            return i, forest_row(forest_nodes(model, spark), depths)

        fitted = parallel(spark, [lambda i=i: fit(i) for i in range(len(fits))], parallelism)
    finally:
        data.unpersist()
    forests = spark.createDataFrame(fitted, f"forest int, trees array<{TREE}>")

    parts = [df.select(F.lit(name).alias("part"), F.col(label).cast("int").alias("label"), F.array(*[F.col(f).cast("double") for f in features]).alias("x"), n.alias("n"))
             for name, df, n in (("train", known, F.col("__n")), ("test", test, F.lit(1).cast("long")))]
    # Written, as who ranks the combinations reads them twice.
    vectors = materialise(parts[0].unionByName(parts[1]).groupBy("part", "label", "x").agg(F.sum("n").alias("n")), "vectors")
    scored = cut_predictions(vectors, forests, "x", trees, depths)
    each = scored.select("part", "label", "n", "forest", F.posexplode("predicted").alias("cut", "prediction"))
    some = lambda y, z: F.sum(F.when((F.col("label") == y) & (F.col("prediction") == z), F.col("n")).otherwise(0)).cast("long")
    counts = each.groupBy("forest", "cut", "part").agg(some(1, 1).alias("tp"), some(0, 1).alias("fp"), some(1, 0).alias("fn"), some(0, 0).alias("tn"))

    named = []
    for i, combo in enumerate(combinations_of(grid)):
        cut = trees.index(combo["numTrees"]) * len(depths) + depths.index(combo["maxDepth"])
        named.append((i, params_text(combo), fits.index({k: v for k, v in combo.items() if k not in CUTS}), cut))
    names = spark.createDataFrame(named, "combination int, params string, forest int, cut int")
    rates = rates_from_counts(counts.join(names, ["forest", "cut"]).select("combination", "params", "part", "tp", "fp", "fn", "tn"))
    return metric_distance(rates)
