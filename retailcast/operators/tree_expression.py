"""Tree ensembles as one native expression over their nodes.

A fitted Spark ML forest or boosted ensemble becomes arrays with one entry per node (feature,
threshold, children, value), and a prediction a fold over the trees, each descended by a fold over
its depth.  That makes a prediction an ordinary column: it can stand inside other higher-order
functions, such as a forecast that feeds each prediction back, without a plan per step.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from retailcast.session import ensure_checkpoint_dir


def _array(values: list, kind: str) -> Column:
    """An array literal, parsed from its text: one call whatever its length, folded by the optimizer."""
    text = ", ".join(f"{v!r}{'D' if kind == 'double' else ''}" for v in values)
    return F.expr(f"cast(array({text}) as array<{kind}>)")


@dataclass
class TreeEnsemble:
    """Nodes of all trees in one numbering; a leaf is its own child on both sides."""

    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    value: list[float]
    roots: list[int]
    weights: list[float]
    divisor: float
    depth: int

    @classmethod
    def of(cls, model) -> TreeEnsemble:
        """The nodes of a fitted forest or boosted ensemble, read from its saved form.

        As many rows reach the driver as the model has nodes, which its depth and number of trees bound.
        Splits on categories are refused: a feature vector of plain numbers has none.
        """
        spark = SparkSession.getActiveSession()
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
        model.write().save(path)
        nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").select(
            "treeID", "id", "prediction", "leftChild", "rightChild", "split.featureIndex", "split.numCategories",
            F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold")).orderBy("treeID", "id").collect()
        place = {(n["treeID"], n["id"]): k for k, n in enumerate(nodes)}
        if any(n["leftChild"] >= 0 and n["numCategories"] >= 0 for n in nodes):
            raise ValueError("splits on categories have no threshold")
        inner = [n["leftChild"] >= 0 for n in nodes]
        child = lambda n, c: place[n["treeID"], n[c]] if n["leftChild"] >= 0 else place[n["treeID"], n["id"]]
        depth = {}
        for n in nodes:  # ids are given in pre-order, so a parent comes before its children
            d = depth.setdefault((n["treeID"], n["id"]), 0)
            if n["leftChild"] >= 0:
                depth[n["treeID"], n["leftChild"]] = depth[n["treeID"], n["rightChild"]] = d + 1
        trees = sorted({n["treeID"] for n in nodes})
        forest = isinstance(model, RandomForestRegressionModel)
        return cls([n["featureIndex"] if i else 0 for n, i in zip(nodes, inner)], [n["threshold"] if i else 0.0 for n, i in zip(nodes, inner)],
                   [child(n, "leftChild") for n in nodes], [child(n, "rightChild") for n in nodes], [n["prediction"] for n in nodes],
                   [place[t, 0] for t in trees], [1.0] * len(trees) if forest else list(model.treeWeights),
                   float(len(trees)) if forest else 1.0, max(depth.values()))

    def predict(self, x: Column) -> Column:
        """Prediction for an array of feature values.  A missing value (NaN) goes right at every split, as in the
        model's own prediction."""
        feature, left, right = _array(self.feature, "int"), _array(self.left, "int"), _array(self.right, "int")
        threshold, value = _array(self.threshold, "double"), _array(self.value, "double")
        trees = F.arrays_zip(_array(self.roots, "int").alias("root"), _array(self.weights, "double").alias("weight"))

        def descend(root: Column, xs: Column) -> Column:
            step = lambda at, _: F.when(F.get(xs, F.get(feature, at)) <= F.get(threshold, at), F.get(left, at)).otherwise(F.get(right, at))
            return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, self.depth))), root, step)

        # the outer fold over one element binds the features, so that they are made once and not for each node
        def total(xs: Column) -> Column:
            return F.aggregate(trees, F.lit(0.0), lambda s, t: s + F.get(value, descend(t["root"], xs)) * t["weight"])

        return F.aggregate(F.array(x), F.lit(0.0), lambda _, xs: total(xs)) / F.lit(self.divisor)
