"""Fitted MLlib tree ensembles as arrays: staged losses with patience (K3, K20) and per-row explanation.

A model is small (trees x nodes), whatever the data: its nodes are read back from its saved form in the shared folder and go
to the executors inside the Arrow functions below; rows never leave them.

Staged losses: one pass over the held-out rows adds up the squared error of every prefix of the boosted trees. The
patience rule then reads the best number of trees from at most ``maxIter`` sums; later trees are cut off.

Explanation: path-dependent tree Shapley values. On the way to a leaf each feature i has a share z_i of the training weight
that follows the leaf's branches where i splits, and a row either follows them (o_i = 1) or not (0). The leaf adds its value
times prod(o_i, i known) * prod(z_i, i unknown) to the expected prediction, so its Shapley values depend on the row by
the pattern of its o_i alone: they are computed once per pattern that occurs, not once per row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


@dataclass
class Tree:
    """Arrays by node (0 the root); a leaf has left -1. ``categories``: node -> values that go left, for categorical splits."""
    weight: float
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    categories: dict[int, np.ndarray]

    def goes_left(self, node: int, x: np.ndarray) -> np.ndarray:
        column = x[:, self.feature[node]]
        if node in self.categories:
            return np.isin(column, self.categories[node])
        return column <= self.threshold[node]  # NaN goes right, as in MLlib

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if self.left[node] < 0:
                out[rows] = self.value[node]
                continue
            left = self.goes_left(node, x[rows])
            todo += [(self.left[node], rows[left]), (self.right[node], rows[~left])]
        return out

    def leaves(self):
        """(value, {feature: (share of the cover that follows, [(node, whether the path goes left), ...])}) of each leaf."""
        todo = [(0, {})]
        while todo:
            node, path = todo.pop()
            if self.left[node] < 0:
                yield self.value[node], path
                continue
            f = int(self.feature[node])
            for child, side in ((self.left[node], True), (self.right[node], False)):
                share, steps = path.get(f, (1.0, []))
                part = self.cover[child] / self.cover[node] if self.cover[node] > 0 else 0.0
                todo.append((child, path | {f: (share * part, [*steps, (node, side)])}))

    def mean(self) -> float:
        """Expected value where no feature is known."""
        return float(sum(v * math.prod(z for z, _ in path.values()) for v, path in self.leaves()))


def read_trees(model, spark: SparkSession | None = None) -> list[Tree]:
    """Trees of a fitted GBT or forest, with their weights. At most trees x nodes rows reach the driver."""
    spark = spark or SparkSession.getActiveSession()
    path = scratch_path(spark, "model")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data").collect()
    weights = list(model.treeWeights)
    if type(model).__name__.startswith("RandomForest"):
        weights = [w / sum(weights) for w in weights]
    by_tree: dict[int, list] = {}
    for r in rows:
        by_tree.setdefault(r["treeID"], []).append(r["nodeData"])
    out = []
    for t, nodes in sorted(by_tree.items()):
        at = {n["id"]: i for i, n in enumerate(sorted(nodes, key=lambda n: n["id"]))}
        nodes = sorted(nodes, key=lambda n: n["id"])
        leaf = [n["leftChild"] < 0 for n in nodes]
        split = [n["split"] for n in nodes]
        categories = {}
        for i, (s, end) in enumerate(zip(split, leaf)):
            if not end and s["numCategories"] >= 0:
                categories[i] = np.array(s["leftCategoriesOrThreshold"], float)
        out.append(Tree(
            float(weights[t]), np.array([-1 if e else at[n["leftChild"]] for n, e in zip(nodes, leaf)]),
            np.array([-1 if e else at[n["rightChild"]] for n, e in zip(nodes, leaf)]), np.array([-1 if e else s["featureIndex"] for s, e in zip(split, leaf)]),
            np.array([np.nan if e or i in categories else s["leftCategoriesOrThreshold"][0] for i, (s, e) in enumerate(zip(split, leaf))]),
            np.array([n["prediction"] for n in nodes]), np.array([n["impurityStats"][0] for n in nodes]), categories))
    return out


def _matrix(column: pa.Array, wide: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, np.float64).reshape(len(column), wide)


def inputs(features: Sequence[str]):
    """Features as one array of doubles; null is NaN, as the assembler keeps it."""
    return F.array(*[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(float("nan"))) for f in features])


# ---- staged losses -------------------------------------------------------------------------------------------

def staged_loss(trees: Sequence[Tree], df: DataFrame, features: Sequence[str], label: str, weight: str | None = None) -> list[float]:
    """Mean squared error of the first 1, 2, ... trees over the rows of ``df``, in one pass; [] without rows."""
    wide, n = len(features), len(trees)
    trees = list(trees)

    def sums(batches):
        total = np.zeros(n + 1)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0), wide)
            y, w = (np.asarray(batch.column(i).to_numpy(zero_copy_only=False), np.float64) for i in (1, 2))
            now = np.zeros(len(x))
            for k, t in enumerate(trees):
                now += t.weight * t.predict(x)
                total[k] += float((w * (y - now) ** 2).sum())
            total[n] += w.sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(n + 1), pa.int32()), pa.array(total)], names=["k", "s"])

    rows = df.where(F.col(label).isNotNull()).select(
        inputs(features).alias("x"), F.col(label).cast("double").alias("y"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"))
    got = dict(rows.mapInArrow(sums, "k int, s double").groupBy("k").agg(F.sum("s")).collect())  # a row a tree
    return [got[k] / got[n] for k in range(n)] if got.get(n) else []


def best_prefix(losses: Sequence[float], patience: int) -> int:
    """Number of trees at the least loss, found before ``patience`` trees in a row brought none smaller; 0 without losses."""
    best = 0
    for k, loss in enumerate(losses, 1):
        if best == 0 or loss < losses[best - 1]:
            best = k
        elif k - best >= patience:
            break
    return best


def truncated(model, n_trees: int, spark: SparkSession | None = None):
    """The model of the first ``n_trees`` trees of a GBT regressor; predictions stay on the JVM."""
    java, spark = model._java_obj, spark or SparkSession.getActiveSession()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    n_trees = max(1, min(n_trees, model.getNumTrees))
    trees, kept = java.trees(), gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n_trees)
    weights = gateway.new_array(jvm.double, n_trees)
    for i in range(n_trees):
        kept[i], weights[i] = trees[i], float(model.treeWeights[i])
    short = jvm.org.apache.spark.ml.regression.GBTRegressionModel(java.uid(), kept, weights)
    out = type(model)(short)
    out._resetUid(java.uid())
    return out.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


# ---- explanation ---------------------------------------------------------------------------------------------

def leaf_values(value: float, shares: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """Shapley values of one leaf for patterns ``follows`` (patterns x features, 0 or 1); ``shares`` as above."""
    m, p = follows.shape
    out = np.zeros((m, p))
    for i in range(p):
        # coefficients of prod(z_j + o_j y) over the others: y^k collects coalitions of k known features
        poly = np.zeros((m, p))
        poly[:, 0] = 1.0
        size = 0
        for j in range(p):
            if j != i:
                size += 1
                poly[:, 1:size + 1] = poly[:, 1:size + 1] * shares[j] + poly[:, :size] * follows[:, j:j + 1]
                poly[:, 0] *= shares[j]
        sizes = [math.factorial(k) * math.factorial(p - 1 - k) / math.factorial(p) for k in range(p)]
        out[:, i] = value * (follows[:, i] - shares[i]) * (poly @ np.array(sizes))
    return out


def shapley(trees: Sequence[Tree], x: np.ndarray) -> np.ndarray:
    """Path-dependent Shapley values (rows x features) of the weighted sum of the trees."""
    out = np.zeros(x.shape)
    for t in trees:
        sides = {node: t.goes_left(node, x) for node in range(len(t.left)) if t.left[node] >= 0}
        for value, path in t.leaves():
            if not path:
                continue
            names = list(path)
            follows = np.ones((len(x), len(names)), np.uint8)
            for c, f in enumerate(names):
                for node, left in path[f][1]:
                    follows[:, c] &= sides[node] == left
            code = follows @ (1 << np.arange(len(names), dtype=np.int64)) if len(names) < 63 else None
            _, first, inverse = np.unique(follows if code is None else code, axis=0, return_index=True, return_inverse=True)
            shares = np.array([path[f][0] for f in names])
            values = leaf_values(t.weight * value, shares, follows[first].astype(np.float64))
            out[:, names] += values[inverse.ravel()]
    return out


def explain(model, df: DataFrame, features: Sequence[str], key: str = "row_id") -> DataFrame:
    """``key``, base, one column ``shap_<feature>`` a feature, and prediction (their sum) for each row of ``df``.

    Null and NaN features go right at every split, as in the model. Any fitted GBT or forest regressor; of a GBT classifier the
    values explain the margin.
    """
    trees = read_trees(model, df.sparkSession)
    wide = len(features)
    base = sum(t.weight * t.mean() for t in trees)

    @F.arrow_udf("array<double>")
    def values(rows: pa.Array) -> pa.Array:
        x = _matrix(rows, wide)
        phi = shapley(trees, x)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * wide, pa.int32()), pa.array(phi.ravel()))

    out = df.select(F.col(key), values(inputs(features)).alias("_zk_phi"))
    total = F.aggregate("_zk_phi", F.lit(base), lambda a, v: a + v)
    return out.select(key, F.lit(base).alias("base"), *[F.col("_zk_phi")[i].alias(f"shap_{f}") for i, f in enumerate(features)], total.alias("prediction"))
